"""Substring deduplication with a compressed FM-index per shard.

Every window of words has a minimiser, the least hash of its word n-grams, so equal
windows meet under equal minimisers. Minimisers that only one text has are left out;
the segments around the others are dealt to shards by minimiser. A shard indexes its
distinct segments in an FM-index (a Burrows-Wheeler transform in a wavelet matrix of
bit vectors) and streams the segments against it: backward search gives each place's
matching statistic up to the threshold, and those that reach it report the least
document in the range of suffixes. Copies of a whole text are told by its digest first.
"""

from __future__ import annotations

import hashlib
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmap.llm.common import released, written
from quillmap.llm.fast_tokens import pack_texts, slices, unpack_texts
from quillmap.llm.jaccard_join import _split, hashed_words

#: Words of the n-grams among which a window's minimiser is the least.
GRAM = 5
#: Words of distinct segments in a shard's index, at most: larger shards are indexed in parts.
SHARD_WORDS = 100_000
#: Places of the stream that are searched at a time.
QUERIES = 16_000
#: Bytes of a word's hash in a segment.
SYMBOL = 6
_MIX = np.uint64(0x9E3779B97F4A7C15)
_ONE = np.uint32(1)
_NONE = np.iinfo(np.int64).max


class RangeLeast:
    """Least number of ranges: ranks of 32 bits, running minima within blocks, a sparse table over the blocks only."""

    BLOCK = 32

    def __init__(self, numbers: np.ndarray):
        self.names, ranks = np.unique(numbers, return_inverse=True)
        n, size = len(ranks), self.BLOCK
        padded = np.full(-(-n // size) * size, len(self.names), np.int32)
        padded[:n] = ranks
        blocks = padded.reshape(-1, size)
        self.ranks = padded
        self.ahead = np.minimum.accumulate(blocks, 1).reshape(-1)
        self.behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].reshape(-1)
        self.table = [blocks.min(1)]
        while 2 ** len(self.table) <= len(blocks):
            last, half = self.table[-1], 2 ** (len(self.table) - 1)
            self.table.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """For each lo < hi."""
        a, b = lo // self.BLOCK, (hi - 1) // self.BLOCK
        out = np.minimum(self.behind[lo], self.ahead[hi - 1])
        near = np.flatnonzero(a == b)
        if len(near):
            out[near] = self.ranks[lo[near]]
            k = 1
            while len(near := near[hi[near] - lo[near] > k]):  # most ranges are short: only those still open go on
                out[near] = np.minimum(out[near], self.ranks[lo[near] + k])
                k += 1
        far = np.flatnonzero(b - a > 1)
        if len(far):
            n = b[far] - a[far] - 1
            level = np.frexp(n.astype(np.float64))[1] - 1  # the greatest power of two that is no more
            for v in np.unique(level):
                own = far[level == v]
                row = self.table[v]
                out[own] = np.minimum(out[own], np.minimum(row[a[own] + 1], row[b[own] - (1 << int(v))]))
        return self.names[out]


class FMIndex:
    """Over sequences of symbols, each with a number; answers for patterns of up to `longest` symbols."""

    def __init__(self, sequences: list[np.ndarray], numbers: np.ndarray, longest: int):
        sizes = np.array([len(x) for x in sequences], np.int64)
        flat = np.concatenate([np.zeros(0, np.uint64), *sequences])
        self.alphabet, codes = np.unique(flat, return_inverse=True)
        text = np.zeros(max(1, int((sizes + 1).sum())), np.int32)  # 0 separates
        text[np.arange(len(flat)) + np.repeat(np.arange(len(sizes)), sizes)] = codes + 1
        n = len(text)
        rank, step = text.astype(np.int64), 1
        while step <= longest:  # suffixes in the order of their first `step` symbols, doubled
            key = rank * (n + 2)
            key[: n - step] += rank[step:] + 1
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            rank[order] = np.cumsum(np.concatenate([[False], ordered[1:] != ordered[:-1]]))
            step *= 2
        self.sigma = len(self.alphabet) + 1
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.sigma))]).astype(np.int32)
        self._wavelet(text[order - 1])
        owner = np.repeat(np.asarray(numbers, np.int64), sizes + 1) if len(sizes) else np.full(1, _NONE)
        self.least = RangeLeast(owner[order])

    def _wavelet(self, bwt: np.ndarray) -> None:
        """Bits of each level packed in words of 32, with the number of ones before each word."""
        self.levels = []
        for bit in reversed(range(max(1, int(self.sigma - 1).bit_length()))):
            ones = (bwt >> bit & 1).astype(np.uint8)
            padded = np.zeros(-(-(len(ones) + 1) // 32) * 32, np.uint8)
            padded[: len(ones)] = ones
            words = np.packbits(padded, bitorder="little").view(np.uint32)
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int32))[:-1]]).astype(np.int32)
            self.levels.append((bit, words, counts, np.int32(len(ones) - ones.sum())))
            bwt = np.concatenate([bwt[ones == 0], bwt[ones == 1]])
        self.start = self._descend(np.arange(self.sigma, dtype=np.int32), np.zeros(self.sigma, np.int32))

    def _descend(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        for bit, words, counts, zeros in self.levels:
            at = i >> 5
            ones = counts[at] + np.bitwise_count(words[at] & ((_ONE << (i & 31).view(np.uint32)) - _ONE))
            i = np.where(symbols & (1 << bit), zeros + ones, i - ones)
        return i

    def _follow(self, symbols: np.ndarray, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As _descend, and whether the transform has that symbol at i: what a range of one place needs of its end."""
        own = np.ones(len(i), bool)
        for bit, words, counts, zeros in self.levels:
            at, place = i >> 5, (i & 31).view(np.uint32)
            word, one = words[at], (symbols & (1 << bit)) != 0
            own &= ((word >> place) & _ONE).view(np.int32).astype(bool) == one
            ones = counts[at] + np.bitwise_count(word & ((_ONE << place) - _ONE))
            i = np.where(one, zeros + ones, i - ones)
        return i, own

    def extend(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the ranges of the patterns with a symbol before them."""
        base = self.before[symbols] - self.start[symbols]
        low, own = self._follow(symbols, lo)
        low += base
        high = low + own
        wide = np.flatnonzero(hi - lo != 1)
        if len(wide):
            high[wide] = base[wide] + self._descend(symbols[wide], hi[wide])
        return low, high

    def codes(self, symbols: np.ndarray) -> np.ndarray:
        """The index's codes; 0, which matches nothing here, for symbols it has not."""
        if not len(self.alphabet):
            return np.zeros(len(symbols), np.int32)
        at = np.minimum(np.searchsorted(self.alphabet, symbols), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == symbols, at + 1, 0).astype(np.int32)

    def matches(self, codes: np.ndarray, ends: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Matching statistics of a stream of codes: for each end, the length up to `most` of the longest match that ends
        before it, and the least number among the sequences with a match of length `most`."""
        codes = np.asarray(codes, np.int32)
        length, least = np.zeros(len(ends), np.int64), np.full(len(ends), _NONE)
        live = np.arange(len(ends))
        lo, hi = np.zeros(len(ends), np.int32), np.full(len(ends), self.before[-1])
        for k in range(1, most + 1):
            live_at = ends[live] - k
            c = np.where(live_at >= 0, codes[np.maximum(live_at, 0)], np.int32(0))
            lo, hi = (self.before[c], self.before[c + 1]) if k == 1 else self.extend(c, lo, hi)
            on = (hi > lo) & (c > 0)
            if not on.all():
                live, lo, hi = live[on], lo[on], hi[on]
            length[live] = k
            if not len(live):
                return length, least
        least[live] = self.least(lo, hi)
        return length, least


def minimiser_runs(h: np.ndarray, places: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of a text's windows with one minimiser, of texts whose word hashes lie one after the other between places:
    the text, the run's first place in h, its number of windows and its minimiser."""
    gram = min(GRAM, window)
    n = len(h) - window + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    g = np.zeros(len(h) - gram + 1, np.uint64)
    for j in range(gram):
        g = (g ^ h[j : len(h) - gram + 1 + j]) * _MIX
        g ^= g >> np.uint64(29)
    least = g[:n].copy()
    for j in range(1, window - gram + 1):
        np.minimum(least, g[j : n + j], out=least)
    text = np.repeat(np.arange(len(places) - 1), np.diff(places))[:n]
    whole = np.flatnonzero(np.arange(window, n + window) <= places[text + 1])  # windows within one text
    text, least = text[whole], least[whole].view(np.int64)
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(whole)), bool), (text[1:] != text[:-1]) | (least[1:] != least[:-1])]))
    return text[first], whole[first], np.diff(np.concatenate([first, [len(whole)]])), least[first]


def _minimiser_rows(window: int):
    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        for b in batches:
            texts = b.column("text")
            for lo, hi in slices(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
                text, _, _, least = minimiser_runs(*hashed_words(texts.slice(lo, hi - lo)), window)
                order = np.lexsort((least, text))
                text, least = text[order], least[order]
                new = np.concatenate([np.ones(min(1, len(text)), bool), (text[1:] != text[:-1]) | (least[1:] != least[:-1])])
                places = np.searchsorted(text[new], np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column("tk").slice(lo, hi - lo), pa.ListArray.from_arrays(pa.array(places), pa.array(least[new]))], ["tk", "fps"])

    return run


def _segment_rows(window: int):
    """Runs of windows with one shared minimiser: their words, the first window's place."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for at, texts in unpack_texts(b):
                h, places = hashed_words(pa.array(texts, pa.string()))
                text, first, windows, least = minimiser_runs(h, places, window)
                # that a minimiser is shared holds for all texts alike, so the lists of a slice serve together
                own = np.isin(least, b.column("fps").slice(at.start, len(at)).flatten().to_numpy())
                text, first, sizes, least = text[own], first[own], windows[own] + window - 1, least[own]
                ends = np.cumsum(sizes)
                words = np.arange(sizes.sum()) + np.repeat(first - ends + sizes, sizes)
                raw = np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SYMBOL])[words]
                offsets = np.concatenate([[0], ends * SYMBOL]).astype(np.int32)
                segments = pa.BinaryArray.from_buffers(pa.binary(), len(text), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
                rows = pa.array(text + at.start)
                start = pa.array((first - places[text]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([b.column("tk").take(rows), b.column("lo").take(rows), start, pa.array(least), segments], ["tk", "lo", "start", "fp", "segment"])

    return run


def _symbols(segments: list[bytes]) -> list[np.ndarray]:
    """The words' hashes of each segment, from 1: 0 separates."""
    raw = np.frombuffer(b"".join(segments), np.uint8).reshape(-1, SYMBOL)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :SYMBOL] = raw
    flat, ends = out.reshape(-1).view("<u8") + np.uint64(1), list(accumulate(len(x) // SYMBOL for x in segments))
    return [flat[lo:hi] for lo, hi in zip([0, *ends], ends)]


def _searcher(window: int):
    def run(pdf):
        import pandas as pd

        own = pdf[pdf["indexed"].to_numpy()]
        index = FMIndex(_symbols(own["segment"].tolist()), own["lo"].to_numpy(np.int64), window)
        stream = pdf[pdf["streamed"].to_numpy()]
        sequences = _symbols(stream["segment"].tolist())
        if not sequences:
            return pd.DataFrame({"segment_key": [], "least": []})
        sizes = np.array([len(x) for x in sequences])
        windows = sizes - window + 1
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        within = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        codes, ends = index.codes(np.concatenate(sequences)), np.repeat(starts, windows) + within + window
        least = np.concatenate([index.matches(codes, ends[lo : lo + QUERIES], window)[1] for lo in range(0, len(ends), QUERIES)])
        return pd.DataFrame({"segment_key": stream["segment_key"].to_numpy(), "least": np.split(least, np.cumsum(windows)[:-1])})

    return run


def dealt(segments: DataFrame, bound: int) -> DataFrame:
    """segments (shard, segment_key, segment and more) once for each cell of their shard: part, slice, indexed, streamed.

    A shard within the bound on bytes is one cell. A larger one has as many parts, which
    are indexed, as slices, which are searched, and a cell for each part and slice: no task
    holds more than a part and a slice, however often a passage occurs.
    """
    parts = segments.groupBy("shard").agg(F.ceil(F.sum(F.octet_length("segment")) / bound).cast("int").alias("parts"))
    own = segments.join(parts, "shard")
    place = lambda k: F.pmod(F.xxhash64("segment_key", F.lit(k)), F.col("parts")).cast("int")
    cell = lambda p, k, i, o: F.struct(p.alias("part"), k.alias("slice"), i.alias("indexed"), o.alias("streamed"))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    indexed = F.transform(every, lambda k: cell(place(1), k, F.lit(True), k == place(2)))
    streamed = F.transform(F.filter(every, lambda p: p != place(1)), lambda p: cell(p, place(2), F.lit(False), F.lit(True)))
    return own.select(*segments.columns, F.inline(F.concat(indexed, streamed)))


def covered_windows(docs: DataFrame, window: int = 13) -> tuple[DataFrame, DataFrame]:
    """(firsts, covered): tk, lo of each distinct text, its least id; tk, windows: places of the
    windows of its first document whose words also start in a document with a smaller id.

    docs: doc_id (not null), tk (a digest of the text, 128 bits), text. A window's words
    are told apart by their 48-bit hashes, all 13 of them; segments by 128-bit digests.
    """
    firsts = written(docs.groupBy("tk").agg(F.min("doc_id").alias("lo")), "firsts")
    listed = written(docs.select("tk", "text").mapInArrow(_minimiser_rows(window), "tk binary, fps array<long>"), "minimisers")
    # half of a digest is enough here: texts that share it are only searched more than they need
    half = F.xxhash64("tk").alias("half")
    fps = listed.select(half, F.explode("fps").alias("fp"))
    shared = written(fps.groupBy("fp").agg(F.min("half").alias("a"), F.max("half").alias("b")).filter("a <> b").select("fp"), "shared")
    own = written(fps.join(shared, "fp").groupBy("half").agg(F.collect_set("fp").alias("fps")).join(firsts.select("*", half), "half").drop("half"), "own")
    packed = docs.select("doc_id", "tk", "text").mapInArrow(pack_texts, "doc_id long, tk binary, packed binary")
    first = packed.join(own, "tk").filter(F.col("doc_id") == F.col("lo")).select("tk", "lo", "fps", "packed")
    segments = written(first.mapInArrow(_segment_rows(window), "tk binary, lo long, start int, fp long, segment binary"), "segments")
    words = segments.agg(F.sum(F.octet_length("segment"))).first()[0] or 0
    shards = max(1, -(-words // (SYMBOL * SHARD_WORDS // 2)))
    keyed = segments.withColumn("shard", F.pmod("fp", F.lit(shards)))
    key = F.unhex(F.md5(F.concat(F.unhex(F.lpad(F.hex("fp"), 16, "0")), "segment"))).alias("segment_key")
    distinct = written(keyed.groupBy("shard", "fp", "segment").agg(F.min("lo").alias("lo")).select("shard", key, "segment", "lo"), "distinct")
    found = written(dealt(distinct, SYMBOL * SHARD_WORDS).groupBy("shard", "part", "slice").applyInPandas(_searcher(window), "segment_key binary, least array<long>"), "found")
    places = F.filter(F.transform("least", lambda m, i: F.when(m < F.col("lo"), F.col("start") + i)), lambda x: x.isNotNull())
    occurrences = segments.select("tk", "lo", "start", key).join(found, "segment_key").select("tk", places.alias("windows")).filter(F.size("windows") > 0)
    return firsts, written(occurrences.groupBy("tk").agg(F.array_distinct(F.flatten(F.collect_list("windows"))).alias("windows")), "covered")


def _cutter(window: int):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            ids, copies, lists = (b.column(c).to_pylist() for c in ("doc_id", "copy", "windows"))
            for at, texts in unpack_texts(b):
                out = []
                for i, t in zip(at, texts, strict=True):
                    words = [w for w in _split(t) if w]
                    gone = np.zeros(len(words) + 1, np.int32)
                    w = np.arange(max(0, len(words) - window + 1)) if copies[i] else np.array(lists[i] or [], np.int64)
                    np.add.at(gone, w, 1)
                    np.add.at(gone, w + window, -1)
                    left = np.cumsum(gone[:-1]) == 0
                    kept = " ".join([x for x, k in zip(words, left.tolist(), strict=True) if k])
                    edges = np.flatnonzero(np.diff(np.concatenate([[True], left, [True]]).astype(np.int8)))
                    removed = [{"start": int(x), "end": int(y)} for x, y in edges.reshape(-1, 2)]
                    out.append((ids[i], len(words), int(len(words) - left.sum()), hashlib.sha256(kept.encode()).hexdigest(), kept, removed))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), strict=True)], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "removed"])

    return run


def remove_repeated(docs: DataFrame, window: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: doc_id, n_words, n_removed, kept_sha256, kept, removed (intervals of words, end exclusive).

    Removes each word covered by a window of words that also starts in a document with a
    smaller id; windows are judged on the input. A null text has no words. Rows without
    an id have no smaller or larger documents and stay whole; rows with one id are not
    smaller than each other. An empty table gives an empty result; other columns are
    ignored.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("tk", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    firsts, covered = covered_windows(rows.filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull()), window)
    known = firsts.join(covered, "tk", "left")
    packed = rows.select("doc_id", "tk", "text").mapInArrow(released(pack_texts), "doc_id long, tk binary, packed binary").join(known, "tk", "left")
    numbered = F.col("doc_id").isNotNull()
    judged = packed.select("doc_id", "packed", F.coalesce(F.col("doc_id") > F.col("lo"), F.lit(False)).alias("copy"), F.when(numbered, F.col("windows")).alias("windows"))
    return judged.mapInArrow(released(_cutter(window)), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string, removed array<struct<start:long,end:long>>")


SQL = r"""
WITH a AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), CAST([] AS VARCHAR[])) AS ws FROM documents),
w AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM a WHERE len(ws) >= 13)),
m AS (SELECT s, min(doc_id) AS lo FROM w GROUP BY s),
c AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT w.doc_id, unnest(range(w.i, w.i + 13)) AS p FROM w JOIN m USING (s) WHERE m.lo < w.doc_id) GROUP BY doc_id)
SELECT a.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(list_filter(ws, lambda x, i: gone IS NULL OR NOT list_contains(gone, i)), ' ')) AS kept_sha256
FROM a LEFT JOIN c USING (doc_id)
"""
