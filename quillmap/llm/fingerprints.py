"""Document fingerprints by content-defined chunking.

A gear hash over the UTF-8 bytes proposes boundaries; normalised chunking takes a
strict mask before the normal size and a loose one after it, between a least and a
most size. The masks look at bits that only the last 10 bytes reach, and no rule knows
a byte's place in the text, so a text has the same chunks wherever it stands but for
the first few. A fingerprint is the set of the chunks' digests with their lengths, and
likeness is the share of a document's distinct chunk bytes that the other document has too.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmap.llm.fast_tokens import slices

#: Sizes of chunks in bytes; the normal size is small so that texts of a few lines have many.
LEAST, NORMAL, MOST = 2, 12, 48
#: The strict mask allows a boundary after 1 of 16 bytes, the loose one after 1 of 4.
STRICT, LOOSE = np.uint32(0x0F << 6), np.uint32(0x03 << 8)
#: Bytes that reach the masks' bits, and bytes that are worked on at a time.
REACH, WINDOW = 10, 1_000_000
_GEAR = np.array([int.from_bytes(hashlib.md5(bytes([b])).digest()[:4], "big") for b in range(256)], np.uint32)
_CODE = np.array([int.from_bytes(hashlib.md5(bytes([b])).digest()[4:12], "big") for b in range(256)], np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
#: Numbers of six bits as letters.
_LETTERS = np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz~", np.uint8)
#: A chunk's digest has 42 bits, seven letters; an eighth is its length.
_SHIFTS = np.arange(36, -1, -6, dtype=np.uint64)


def _places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in the bytes after which a boundary is allowed, and whether the strict mask allows it too.

    The gear hash h = 2h + gear[byte] is a sum over shifted arrays, made by doubling.
    """
    out, strict = [], []
    for lo in range(0, len(data), WINDOW):
        back = min(lo, REACH + 2)
        h = _GEAR[data[lo - back : lo + WINDOW]]
        for k in (1, 2, 4, 8):
            more = h[:-k] << np.uint32(k)
            h[k:] += more
        h = h[back:]
        hits = np.flatnonzero((h & LOOSE) == 0)
        out.append(hits + lo + 1)
        strict.append((h[hits] & STRICT) == 0)
    return (np.concatenate(out), np.concatenate(strict)) if out else (np.zeros(0, np.int64), np.zeros(0, bool))


def _ends(n: int, places: list[int], strict: list[bool]) -> list[int]:
    """Ends of the chunks of n bytes."""
    ends, last = [], 0
    for p, s in zip(places, strict, strict=True):
        size = p - last
        if size < LEAST:
            continue
        while size > MOST:
            last += MOST
            ends.append(last)
            size = p - last
        if size >= NORMAL or s and size >= LEAST:
            ends.append(p)
            last = p
    while n - last > MOST:
        last += MOST
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def _digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """42-bit digests of slices of the bytes, by a polynomial over the bytes' codes; starts ascend."""
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + WINDOW, "right")))
        lo, n = int(starts[i]), int(ends[j - 1] - starts[i])
        falling = np.cumprod(np.full(n, _INVERSE))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_CODE[data[lo : lo + n]] * falling)])
        rising = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, _BASE))])
        a, b = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = (sums[b] - sums[a]) * rising[b]
        i = j
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out >> np.uint64(22)


def chunk_sets(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per text its distinct chunks: ascending digests, and their lengths in bytes; of an empty text none."""
    gap = bytes(REACH + 2)  # before every text, so that texts do not see each other; its places are passed over
    data = np.frombuffer(b"".join(x for t in texts for x in (gap, t)), np.uint8)
    places, strict = _places(data)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    first = (np.cumsum(sizes + len(gap)) - sizes).astype(np.int64)
    lo, hi = np.searchsorted(places, first, "right"), np.searchsorted(places, first + sizes, "right")
    ends, counts = [], []
    for k in range(len(texts)):
        own = _ends(int(sizes[k]), (places[lo[k] : hi[k]] - first[k]).tolist(), strict[lo[k] : hi[k]].tolist())
        ends.append(np.array(own, np.int64) + first[k])
        counts.append(len(own))
    cuts = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    last = np.concatenate(ends) if ends else np.zeros(0, np.int64)
    begin = np.concatenate([np.zeros(1, np.int64), last[:-1]]) if len(last) else last
    begin[cuts[:-1][np.array(counts, np.int64) > 0]] = first[np.array(counts, np.int64) > 0]
    digests, lengths = _digests(data, begin, last), last - begin
    out = []
    for k in range(len(texts)):
        d, at = np.unique(digests[cuts[k] : cuts[k + 1]], return_index=True)
        out.append((d, lengths[cuts[k] + at]))
    return out


def encode(chunks: tuple[np.ndarray, np.ndarray]) -> str:
    """Eight letters a chunk, ascending: digest and length; the same for equal texts."""
    digests, lengths = chunks
    parts = (digests[:, None] >> _SHIFTS) & np.uint64(63)
    return _LETTERS[np.concatenate([parts, lengths[:, None].astype(np.uint64)], 1).astype(np.intp)].tobytes().decode("ascii")


def decode(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    value = np.zeros(256, np.uint64)
    value[_LETTERS] = np.arange(64)
    parts = value[np.frombuffer(fingerprint.encode("ascii"), np.uint8)].reshape(-1, 8)
    return (parts[:, :7] << _SHIFTS).sum(1, dtype=np.uint64), parts[:, 7].astype(np.int64)


def containment(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Share of a's chunk bytes that b has; two empty texts are alike, an empty and another one are not."""
    if not len(a[0]):
        return float(not len(b[0]))
    return float(a[1][np.isin(a[0], b[0], assume_unique=True)].sum() / a[1].sum())


def _compress(batches):
    import pyarrow as pa
    import zstandard

    z = zstandard.ZstdCompressor(level=1)
    for b in batches:
        packed = pa.array([z.compress((t or "").encode()) for t in b.column("text").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), packed], ["doc_id", "packed"])


def _pairs(batches):
    """Rows sorted by range and id; each row of a range but a borrowed one meets the next."""
    import zstandard

    import pyarrow as pa

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    z, before = zstandard.ZstdDecompressor(), None
    for b in batches:
        rows = list(zip(*(b.column(c).to_pylist() for c in ("range", "borrowed", "doc_id", "packed")), strict=True))
        for lo, hi in slices([3 * len(r[3]) for r in rows]):
            part = [(*r[:3], z.decompress(r[3]).decode()) for r in rows[lo:hi]]
            own = chunk_sets([r[3].encode() for r in part])
            pairs = []
            for r, c in zip(part, own, strict=True):
                if before and not before[0][1] and before[0][0] == r[0]:
                    pairs.append((*before, r, c))
                before = (r, c)
            edited = []
            for a, _, nxt, _ in pairs:
                k = len(a[3]) // 4
                edited.append((a[3][: len(a[3]) - k] + nxt[3][:k]).encode())
            out = []
            for (a, c, _, d), e, f in zip(pairs, edited, chunk_sets(edited) if edited else [], strict=True):
                out.append((a[2], len(a[3]), hashlib.sha256(e).hexdigest(), encode(c), encode(f), containment(c, f), containment(c, d)))
            cols = list(zip(*out, strict=True)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, types, strict=True)], names)


def fingerprint_documents(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Per row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next higher id (of rows with one id, any
    order among them; null ids come first), after the last the first: a single
    document's next is itself. Ids are cut into ranges at quantiles, so a task streams
    one range in order; the first row of a range is lent to the range before. A null
    text is empty; an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions")) * 2
    # the quantiles, and below one head a range: as many rows as there are ranges come to the driver
    found = ids.filter(F.col("doc_id").isNotNull()).agg(F.expr(f"percentile_approx(doc_id, array({', '.join(str(k / n) for k in range(1, n))}), 10000)" if n > 1 else "array(cast(null as bigint))").alias("q"), F.min("doc_id").alias("low")).first()
    nulls = ids.filter(F.col("doc_id").isNull()).limit(1).count()
    bounds = sorted({b for b in (found["q"] or []) if b is not None and b > (found["low"] if not nulls else b - 1)})
    # range k holds ids of at least bounds[k - 1] and less than bounds[k]
    own = F.size(F.filter(F.array(*map(F.lit, bounds)).cast("array<bigint>"), lambda x: x <= F.col("doc_id"))) if bounds else F.lit(0)
    packed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_compress, "doc_id long, packed binary")
    ranged = packed.withColumn("range", F.when(F.col("doc_id").isNull(), 0).otherwise(own).cast("int"))
    heads = ids.groupBy(F.when(F.col("doc_id").isNull(), 0).otherwise(own).cast("int").alias("range")).agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("has"), F.col("doc_id"))).alias("first")).orderBy("range").collect()
    lent = [(h["range"], h["first"]["doc_id"], heads[i - 1]["range"]) for i, h in enumerate(heads)]
    small = spark.createDataFrame(lent, "at int, head long, to int")
    ranged = ranged.join(F.broadcast(small), (F.col("range") == F.col("at")) & F.col("doc_id").eqNullSafe(F.col("head")), "left").withColumn("lend", F.col("to"))
    both = F.array(F.struct(F.col("range").alias("range"), F.lit(False).alias("borrowed")), F.struct(F.col("lend").alias("range"), F.lit(True).alias("borrowed")))
    rows = ranged.select("doc_id", "packed", F.inline(F.filter(both, lambda x: x["range"].isNotNull())))
    # a borrowed row is last: it is the next of its range's last row
    dealt = rows.repartition(n, "range").sortWithinPartitions("range", "borrowed", "doc_id", "packed")
    return dealt.mapInArrow(_pairs, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
