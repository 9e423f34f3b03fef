"""N-gram Jaccard join by chosen paths.

The sets are the distinct word shingles of a text. Texts with equal sets are one class
from the start. Each run splits the sets recursively: a node of the recursion samples
one or two of their tokens (coordinates of a minhash sketch, so that two sets share a
token with probability of their Jaccard similarity), and sets with the same token go
on together. Small buckets are compared by brute force on the sketches. In a large
bucket all sets are compared to one member, the pivot; those near it are linked to it,
and those very near it go no further, for by the triangle inequality of the Jaccard
distance whatever is similar to them is near the pivot as well. The rest is split on
until no bucket is large; each level takes a pivot and all that is very near it from
each bucket, so this ends. Runs repeat until a pair at the threshold is met with the
target probability.

Buckets only propose: proposed components are then compared exactly, all pairs within
a component whose sizes allow the similarity, in blocks of bounded size; a block
returns counts and a spanning forest, never its pairs.
"""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmap.llm.common import cache, released, written
from quillmap.llm.fast_tokens import pack_texts, unpack_texts
from quillmap.llm.graph import components

#: Minhash coordinates of 16 bits.
COORDINATES = 64
#: Most sets in a bucket that is compared by brute force.
SMALL = 512
#: Levels through which runs_for() counts a pair's way; buckets are split as long as they are large.
DEPTH = 6
#: A block of the exact comparison holds so many sets and shingles on average, at most.
BLOCK_SETS, BLOCK_SHINGLES = 512, 500_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_rng = np.random.default_rng(2018)
_A = _rng.integers(1, 2**63, COORDINATES, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, COORDINATES, np.uint64)

_words: dict[str, int] = cache()


def word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words of a whole text: runs of anything but ASCII white space."""
    import xxhash

    tokens = [w for w in _split(text) if w]
    if len(_words) > 400_000:
        _words.clear()
    out, get, digest = np.empty(len(tokens), np.uint64), _words.get, xxhash.xxh3_64_intdigest
    for i, w in enumerate(tokens):
        v = get(w)
        if v is None:
            v = _words[w] = digest(w)
        out[i] = v
    return out


def hashed_words(texts) -> tuple[np.ndarray, np.ndarray]:
    """word_hashes of many texts (an Arrow array) one after the other, and where each text's begin, with the end; null is empty."""
    import pyarrow.compute as pc
    import xxhash

    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    words = lists.flatten()
    coded = words.dictionary_encode()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    out = hashes[coded.indices.to_numpy()]
    places = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())]).astype(np.int64)
    filled = pc.binary_length(words).to_numpy() > 0  # white space at either end leaves an empty word
    return out[filled], np.concatenate([[0], np.cumsum(filled)])[places]


def _split(text: str) -> list[str]:
    for c in "\t\n\x0b\x0c\r":
        if c in text:
            text = text.replace(c, " ")
    return text.split(" ")


def shingles(text: str, k: int = 5) -> np.ndarray:
    """Ascending distinct hashes of k consecutive words; a shorter text is one shingle, an empty one none."""
    h = word_hashes(text)
    if not len(h):
        return h
    k = min(k, len(h))
    out = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        out = (out ^ h[j : len(h) - k + 1 + j]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def sketch(s: np.ndarray) -> np.ndarray:
    least = np.full(COORDINATES, 2**64 - 1, np.uint64)
    for lo in range(0, len(s), 4096):
        np.minimum(least, (s[lo : lo + 4096, None] * _A + _B).min(0), out=least)
    return ((least ^ (least >> np.uint64(31))) * _MIX >> np.uint64(48)).astype(np.uint16)


def runs_for(threshold: float, recall: float) -> int:
    """Runs after which a pair at the threshold has met with the probability, DEPTH levels down."""
    more = 1 / threshold - 1  # probability of a second branch
    met = 1.0
    for _ in range(DEPTH):
        met = (1 - more) * threshold * met + more * (1 - (1 - threshold * met) ** 2)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def _sets(k: int):
    def run(batches):
        import pyarrow as pa
        import xxhash

        for b in batches:
            keys, sizes, sketches = [], [], []
            for t in b.column("text").to_pylist():
                s = shingles(t or "", k)
                keys.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sizes.append(len(s))
                sketches.append(sketch(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "row", "tx")), pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(sketches, pa.binary())], ["doc_id", "row", "tx", "set_key", "n", "sketch"])

    return run


_SIGN = -(2**63)


def set_number(row: Column, set_key: Column) -> Column:
    """16 bytes that tell sets apart and order them by their least row: the row, then half of the set's digest."""
    return F.concat(F.unhex(F.lpad(F.hex(row.bitwiseXOR(F.lit(_SIGN))), 16, "0")), F.substring(set_key, 1, 8))


def row_of(number: Column) -> Column:
    """The row in a set's number."""
    return F.conv(F.hex(F.substring(number, 1, 8)), 16, -10).cast("long").bitwiseXOR(F.lit(_SIGN))


def _groups(batches, columns):
    """(key, rows) of runs of equal keys, across batches; key: the first column."""
    key, held = None, []
    for b in batches:
        for r in zip(*(b.column(c).to_pylist() for c in columns), strict=True):
            if r[0] != key and held:
                yield key, held
                held = []
            key = r[0]
            held.append(r)
    if held:
        yield key, held


def _roots(n: int, pairs) -> list[int]:
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in pairs:
        i, j = find(i), find(j)
        if i != j:
            root[max(i, j)] = min(i, j)
    return [find(i) for i in range(n)]


def _brute(similar: float):
    """Spanning edges of the pairs in each small bucket whose sketches agree enough."""

    def run(batches):
        import pyarrow as pa

        out = []
        for _, rows in _groups(batches, ["path", "sid", "sketch"]):
            ids = [r[1] for r in rows]
            m = np.frombuffer(b"".join(r[2] for r in rows), np.uint16).reshape(len(rows), -1)
            if len(ids) < 2:
                continue
            found = [np.nonzero((m[lo : lo + 64, None, :] == m[None, lo + 1 :, :]).mean(2) >= similar) for lo in range(0, len(ids), 64)]
            i, j = (np.concatenate(x) for x in zip(*((a + lo, b + lo + 1) for lo, (a, b) in zip(range(0, len(ids), 64), found, strict=True)), strict=True))
            i, j = i[j > i], j[j > i]
            if len(i):
                out += [(ids[a], ids[r]) for a, r in enumerate(_roots(len(ids), zip(i.tolist(), j.tolist(), strict=True))) if a != r]
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], ["a", "b"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out, strict=True)], ["a", "b"])

    return run


def _pivots(near: float, same: float):
    """Rows of large buckets with their pivot: whether they are near it, and whether they stay."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            own, other = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(b.num_rows, -1) for c in ("sketch", "pivot_sketch"))
            alike, others = (own == other).mean(1), pa.compute.not_equal(b.column("sid"), b.column("pivot")).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([b.column("path"), b.column("sid"), b.column("sketch"), b.column("pivot"), pa.array((alike >= near) & others), pa.array((alike < same) & others)], ["path", "sid", "sketch", "pivot", "linked", "stays"])

    return run


def proposals(sets: DataFrame, threshold: float, recall: float, small: int = SMALL, seed: int = 1) -> DataFrame:
    """a, b: edges whose components hold the pairs that chosen paths find. sets: sid, sketch."""
    draw = random.Random(seed)
    first = []
    for r in range(runs_for(threshold, recall)):
        for c in draw.sample(range(COORDINATES), 1 + (draw.random() < 1 / threshold - 1)):
            first.append((r, c))

    def token(c):
        return F.col("sketch").substr(c * 2 + 1, F.lit(2))

    starts = F.array(*(F.xxhash64(F.lit(r), F.lit(c), token(F.lit(c))) for r, c in first))
    rows = sets.select("sid", "sketch", F.explode(starts).alias("path"))
    edges, level = None, 0
    while True:
        level += 1
        heavy = written(rows.groupBy("path").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > small).select("path"), "heavy")
        light = rows.join(heavy, "path", "left_anti")
        found = written(light.repartition("path").sortWithinPartitions("path").select("path", "sid", "sketch").mapInArrow(released(_brute(max(0.0, threshold - 0.2))), "a binary, b binary"), "proposed")
        edges = found if edges is None else edges.unionByName(found)
        if heavy.isEmpty():
            return edges
        inside = written(rows.join(heavy, "path", "left_semi"), "large")
        pivots = inside.groupBy("path").agg(F.min(F.struct("sid", "sketch")).alias("p")).select("path", F.col("p.sid").alias("pivot"), F.col("p.sketch").alias("pivot_sketch"))
        met = inside.join(pivots, "path").select("path", "sid", "sketch", "pivot", "pivot_sketch")
        judged = written(met.mapInArrow(released(_pivots(max(0.0, 2 * threshold - 1 - 0.1), threshold + 0.05)), "path long, sid binary, sketch binary, pivot binary, linked boolean, stays boolean"), "judged")
        edges = edges.unionByName(judged.filter("linked").select(F.col("pivot").alias("a"), F.col("sid").alias("b")))
        large = judged.filter("stays").select("path", "sid", "sketch")
        # the node samples its next coordinates by its own path: one, and by chance a second
        at = lambda k: F.pmod(F.xxhash64("path", F.lit(f"{level}:{k}")), F.lit(COORDINATES)).cast("int")
        second = F.pmod(F.xxhash64("path", F.lit(f"{level}:more")), F.lit(1_000_000)) < int(1_000_000 * (1 / threshold - 1))
        step = lambda c: F.xxhash64("path", c, token(c))
        # written, as the next level reads them for sizes, small buckets and large ones
        rows = written(large.select("sid", "sketch", F.explode(F.filter(F.array(step(at(0)), F.when(second & (at(0) != at(1)), step(at(1)))), lambda x: x.isNotNull())).alias("path")), "split")


def similar_pairs(sets: list[np.ndarray], threshold: float, left: int | None = None) -> list[tuple[int, int]]:
    """All pairs i < j with exact Jaccard similarity of at least the threshold; with left, only i < left <= j."""
    sizes = np.array([len(s) for s in sets], np.int64)
    n = len(sets)
    if n <= 24:
        out = []
        for i in range(n if left is None else left):
            for j in range(i + 1 if left is None else left, n):
                if threshold * max(sizes[i], sizes[j]) <= min(sizes[i], sizes[j]) + 1e-9:
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if both >= threshold * (sizes[i] + sizes[j] - both) - 1e-9:
                        out.append((i, j))
        return out
    _, tokens, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(n), sizes)
    shared = counts[tokens] > 1  # others are in no intersection
    order = np.cumsum(counts > 1) - 1
    rows, tokens = rows[shared], order[tokens[shared]]
    cut = n if left is None else left
    both = np.zeros((cut, n - (0 if left is None else left)), np.float32)
    for lo in range(0, int(order[-1]) + 1, 2048):
        here = (tokens >= lo) & (tokens < lo + 2048)
        m = np.zeros((n, 2048), np.float32)
        m[rows[here], tokens[here] - lo] = 1
        both += m[:cut] @ m[n - both.shape[1] :].T
    union = sizes[:cut, None] + sizes[None, n - both.shape[1] :] - both
    hit = both >= threshold * union - 1e-6
    i, j = np.nonzero(np.triu(hit, 1) if left is None else hit)
    return list(zip(i.tolist(), (j + n - both.shape[1]).tolist(), strict=True))


def _shingle_rows(k: int):
    def run(batches):
        import pyarrow as pa
        import xxhash

        for b in batches:
            keep, out, wanted = [], [], b.column("set_key").to_pylist()
            for at, texts in unpack_texts(b):
                for i, t in zip(at, texts, strict=True):
                    s = shingles(t, k)
                    if xxhash.xxh3_128_digest(s.tobytes()) == wanted[i]:
                        keep.append(i)
                        out.append(s.tobytes())
            rest = pa.Table.from_batches([b]).drop_columns(["packed", "set_key"]).take(pa.array(keep, pa.int64())).combine_chunks()
            yield from rest.append_column("shingles", pa.array(out, pa.binary())).to_batches()

    return run


def _exact(threshold: float):
    """Per set of a cell its links and its root in the cell's spanning forest; a cell: one block, or two that meet."""

    def run(batches):
        import pyarrow as pa

        for key, rows in _groups(batches, ["cell", "sid", "block", "weight", "shingles"]):
            rows = sorted({r[1]: r for r in rows}.values(), key=lambda r: (r[2], r[1]))
            own = [np.frombuffer(r[4], np.uint64) for r in rows]
            p, q = key.split("|")[1:]
            left = None if p == q else sum(r[2] == rows[0][2] for r in rows)
            pairs = similar_pairs(own, threshold, left) if left is None or left < len(rows) else []
            links = [0] * len(rows)
            for i, j in pairs:
                links[i] += rows[j][3]
                links[j] += rows[i][3]
            roots = _roots(len(rows), pairs)
            yield pa.RecordBatch.from_arrays([pa.array([r[1] for r in rows], pa.binary()), pa.array(links, pa.int64()), pa.array([rows[r][1] for r in roots], pa.binary())], ["sid", "links", "root"])

    return run


def cells(members: DataFrame, threshold: float, sets: int | None = None, shingle_bound: int | None = None) -> DataFrame:
    """members (sid, component, n and more), block and cell: a row for each cell that a set is compared in.

    A component within the bounds is one block and one cell. A larger one is split by the
    logarithm of the sets' sizes, in steps so wide that similar sets are in one class or in
    two next to each other, and each class into blocks of bounded size; a block meets the
    blocks of its class and of the two beside it.
    """
    sets, shingle_bound = sets or BLOCK_SETS, shingle_bound or BLOCK_SHINGLES
    needed = F.greatest(F.ceil(F.count(F.lit(1)) / sets), F.ceil(F.sum("n") / shingle_bound)).cast("int")
    whole = members.groupBy("component").agg((needed == 1).alias("__one"))
    size = F.when(F.col("__one"), 0).otherwise(F.floor(F.log(F.col("n").cast("double")) / F.lit(-math.log(threshold) * 1.0001 if threshold < 1 else 1.0))).cast("int")
    classed = members.join(whole, "component").withColumn("__class", size).drop("__one")
    # a component has as many classes as its sizes have steps: a short map
    per = classed.groupBy("component", "__class").agg(needed.alias("blocks")).groupBy("component").agg(F.map_from_entries(F.collect_list(F.struct("__class", "blocks"))).alias("__blocks"))
    own, blocks = F.col("__class"), F.col("__blocks")
    placed = classed.join(per, "component").withColumn("__at", F.pmod(F.xxhash64("sid"), F.element_at(blocks, own)).cast("int"))
    name = lambda c, k: F.concat_ws(".", F.lpad(c.cast("string"), 6, "0"), F.lpad(k.cast("string"), 9, "0"))
    block = name(own, F.col("__at"))
    meet = lambda c: F.transform(F.when(F.element_at(blocks, c).isNotNull(), F.sequence(F.lit(0), F.element_at(blocks, c) - 1)).otherwise(F.array().cast("array<int>")), lambda k: name(c, k))
    others = F.concat(meet(own - 1), meet(own), meet(own + 1))
    cell = lambda o: F.concat_ws("|", F.hex("component"), F.least(block, o), F.greatest(block, o))
    return placed.withColumn("block", block).withColumn("cells", F.transform(others, cell)).drop("__class", "__blocks", "__at")


def _classes(docs: DataFrame, k: int, threshold: float, recall: float, id_col: str, text_col: str) -> DataFrame:
    """near_duplicates() with row and tx, by which a row of docs is found again."""
    row, tx = row_keys(F.col(id_col), F.col(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), row.alias("row"), tx.alias("tx"), F.col(text_col).alias("text"))
    own = written(rows.mapInArrow(released(_sets(k)), "doc_id long, row long, tx long, set_key binary, n int, sketch binary"), "sets")
    grouped = own.filter(F.col("set_key").isNotNull()).groupBy("set_key", "n", "sketch").agg(F.min(F.struct("row", "tx")).alias("first"), F.count(F.lit(1)).alias("weight"))
    sets = written(grouped.withColumn("sid", set_number(F.col("first.row"), F.col("set_key"))), "distinct-sets")
    candidates = written(components(proposals(sets.select("sid", "sketch"), threshold, recall)), "candidates")
    known = candidates.join(sets.select(F.col("sid").alias("node"), "set_key", "n", "weight", "first"), "node").withColumnRenamed("node", "sid")
    members = written(cells(known, threshold).withColumn("row", F.col("first.row")).drop("first", "n"), "members")
    packed = rows.select("row", "text").mapInArrow(released(pack_texts), "row long, packed binary")
    # a merge join at every size, so that what holds for small inputs holds for large ones
    texts = packed.join(members.hint("merge"), "row").select("sid", "set_key", "weight", "block", "cells", "packed")
    shingled = texts.mapInArrow(released(_shingle_rows(k)), "sid binary, weight long, block string, cells array<string>, shingles binary")
    dealt = shingled.select("sid", "block", "weight", "shingles", F.explode("cells").alias("cell")).repartition("cell").sortWithinPartitions("cell")
    linked = written(dealt.select("cell", "sid", "block", "weight", "shingles").mapInArrow(released(_exact(threshold)), "sid binary, links long, root binary"), "linked")
    classes = components(linked.select(F.col("sid").alias("a"), F.col("root").alias("b")))
    links = linked.groupBy("sid").agg(F.sum("links").alias("links"))
    result = sets.join(links, "sid", "left").join(classes.withColumnRenamed("node", "sid"), "sid", "left").select("set_key", "first", F.coalesce("component", "sid").alias("class"), F.coalesce(F.col("component") == F.col("sid"), F.lit(True)).alias("leads"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    out = own.select("doc_id", "row", "tx", "set_key", "n").join(written(result, "classes"), "set_key", "left")
    first = F.coalesce(F.col("leads") & (F.col("first") == F.struct("row", "tx")), F.lit(True))
    return out.select("doc_id", "row", "tx", F.coalesce(row_of(F.col("class")), "row").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("n").cast("long").alias("n_shingles"), first.alias("class_first"))


def row_keys(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """A row's number, its id or for want of one a negative number of its text, and a number of its text."""
    tx = F.xxhash64(text)
    return F.coalesce(doc_id.cast("long"), -tx.bitwiseAND(F.lit(2**63 - 1)) - 1), tx


def near_duplicates(docs: DataFrame, k: int = 5, threshold: float = 0.8, recall: float = 0.999, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: doc_id, class_id, n_links, n_shingles, class_first.

    Two documents are linked if their sets of k-word shingles have Jaccard similarity
    of at least the threshold; copies are linked too, and repeated rows, as well as rows
    with one id and different texts, are documents of their own. n_links counts a
    document's links, class_id is the least id in its component of links (of rows without
    an id, a negative number made of the text). class_first marks the row that stands for
    the class, and rows that repeat it. A text of fewer than k words is one shingle of all
    its words. Null texts and texts without words have no shingles and no links, and are
    each their own class. An empty table gives an empty result; other columns are ignored.
    """
    return _classes(docs, k, threshold, recall, id_col, text_col).drop("row", "tx")


def keep_one(docs: DataFrame, k: int = 5, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """The rows of docs, all columns, that stand for their class; of repeated rows one."""
    row, tx = row_keys(F.col("doc_id"), F.col("text"))
    stay = written(_classes(docs.select("doc_id", "text"), k, threshold, recall, "doc_id", "text").filter("class_first").groupBy(F.col("row").alias("__row"), F.col("tx").alias("__tx")).agg(F.count(F.lit(1)).alias("__n")), "stay")
    kept = docs.withColumn("__row", row).withColumn("__tx", tx).join(stay, ["__row", "__tx"])
    if stay.filter("__n > 1").isEmpty():
        return kept.select(*docs.columns)
    return kept.filter("__n = 1").unionByName(kept.filter("__n > 1").dropDuplicates(["__row", "__tx"])).select(*docs.columns)
