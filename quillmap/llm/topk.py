"""Exact top-k search by inner product with multi-resolution segment statistics.

Vectors are turned by an orthonormal rotation, fitted on a bounded sample, so that their
first coordinates vary most; inner products stay. At each level a rotated vector is cut
into leading segments of one coordinate and one long segment of the rest. Mean and
deviation of each segment bound the inner product from above (so the distance from
below), because within a segment sum(q*c) <= length * (mean*mean + deviation*deviation).
Coarse to fine, the bounds discard candidates that cannot reach the query's k-th best
score so far, and the survivors are scored exactly in integers.

Queries go to the tasks in groups of bounded size; for each group every candidate is
read once, where it lies, and a task returns its k best of each query.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmap.llm.common import written

#: Shares of the coordinates that are segments of their own, coarse to fine.
LEVELS = (0.0, 0.25, 0.5, 0.75)
#: Rows on which the rotation is fitted, and the most coordinates that are rotated.
SAMPLE, ROTATED = 1024, 1024
#: Bytes of the queries that are broadcast at a time.
QUERY_BYTES = 64 * 2**20
#: A score below all others; its negative is a number too.
NONE = np.iinfo(np.int64).min + 1


def whole_vectors(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v: floor(scale * x) as long; vectors null or with null or non-finite components take no part."""
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vectors.filter(v.isNotNull() & finite).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("v"))


class Rotation:
    """A centre and an orthonormal matrix for vectors of one length."""

    def __init__(self, sample: np.ndarray):
        x = sample.astype(np.float64)
        self.centre = x.mean(0) if len(x) else np.zeros(x.shape[1])
        d = x.shape[1]
        self.turn = None
        if 1 < d <= ROTATED and len(x) > 1:
            self.turn = np.linalg.svd(x - self.centre, full_matrices=True)[2].T
        self.heads = sorted({int(d * share) for share in LEVELS})

    def __call__(self, m: np.ndarray) -> np.ndarray:
        return m @ self.turn if self.turn is not None else m

    def tails(self, m: np.ndarray) -> list[np.ndarray]:
        """Per level sqrt(length) * mean and deviation of the long segment of rotated rows."""
        out = []
        for h in self.heads:
            rest = m[:, h:]
            root = np.sqrt(rest.shape[1])
            out.append(np.stack([root * rest.mean(1), root * rest.std(1)], 1) if rest.shape[1] else np.zeros((len(m), 2)))
        return out


def search_batch(q_ids, q, c_ids, c, k: int, best: np.ndarray, rotation: Rotation | None = None, seen: list | None = None):
    """(query's place, candidates' ids, scores) of up to k candidates of each query that reach the query's k-th best so far.

    best: of each query the k best scores so far, descending. seen: gets the number of candidates left after each level.
    """
    rotation = rotation or Rotation(c[:SAMPLE])
    d = q.shape[1]
    c_float = c.astype(np.float64)
    base = q.astype(np.float64) @ rotation.centre
    rq, rc = rotation(q.astype(np.float64)), rotation(c_float - rotation.centre)
    q_tails, c_tails = rotation.tails(rq), rotation.tails(rc)
    slack = 1e-9 * np.linalg.norm(rq, axis=1)[:, None] * np.linalg.norm(rc, axis=1).max(initial=0)
    exact_float = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(d, 1) < 2**52
    for i in range(len(q_ids)):
        alive = np.flatnonzero(c_ids != q_ids[i])
        low, part, done = float(best[i, -1]), np.full(len(alive), base[i]), 0
        for level, h in enumerate(rotation.heads):
            if h > done:
                part = part + rc[alive, done:h] @ rq[i, done:h]
                done = h
            upper = part + c_tails[level][alive] @ q_tails[level][i]
            stays = upper + 1e-6 * (1.0 + np.abs(upper)) + slack[i] >= low
            alive, part = alive[stays], part[stays]
            if seen is not None:
                seen[level] += len(alive)
        if not len(alive):
            continue
        scores = (c_float[alive] @ q[i].astype(np.float64)).astype(np.int64) if exact_float else c[alive] @ q[i]
        if len(alive) > 8 * k:  # a few more than k, for ties
            reach = np.partition(scores, -k)[-k]
            alive, scores = alive[scores >= reach], scores[scores >= reach]
        order = np.lexsort((c_ids[alive], -scores))[:k]
        order = order[scores[order] >= best[i, -1]]
        if len(order):
            yield i, c_ids[alive[order]], scores[order]


def _searcher(sent, k: int):
    """A task's k best candidates of each query of the group."""

    def run(batches):
        import pyarrow as pa

        queries, rotations = sent.value
        found = {d: (np.full((len(ids), k), NONE), np.full((len(ids), k), np.iinfo(np.int64).max)) for d, (ids, _) in queries.items()}
        for b in batches:
            ids = b.column("vec_id").to_numpy(zero_copy_only=False)
            v = b.column("v")
            dims = v.value_lengths().to_numpy(zero_copy_only=False)
            for d in np.unique(dims):
                if int(d) not in queries:
                    continue
                at = np.flatnonzero(dims == d)
                c = v.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(at), int(d))
                (q_ids, q), (scores, names) = queries[int(d)], found[int(d)]
                for i, new, s in search_batch(q_ids, q, ids[at], c, k, scores, rotations[int(d)]):
                    both, who = np.concatenate([scores[i], s]), np.concatenate([names[i], new])
                    order = np.lexsort((who, -both))[:k]
                    scores[i], names[i] = both[order], who[order]
        for d, (scores, names) in found.items():
            i, j = np.nonzero(scores > NONE)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (queries[d][0][i], names[i, j], scores[i, j])], ["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest integer inner products, ties to the smaller vec_id.

    Both have vec_id and v (whole_vectors()). Candidates are the rows with another id
    than the query's; vectors of different lengths do not meet. Repeated rows of a
    query count once, repeated candidates each have a rank. Rows with a null id take
    no part. Empty tables, and queries without candidates, give no rows. Queries are
    dealt to as many groups as their bytes ask for, and the candidates are read once for each.
    """
    spark = vectors.sparkSession
    vectors = vectors.filter(F.col("vec_id").isNotNull())
    asked = written(queries.filter(F.col("vec_id").isNotNull()).distinct(), "queries")
    size = asked.agg(F.sum(F.size("v") * 8 + 64)).first()[0] or 0
    groups = max(1, -(-size // QUERY_BYTES))
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    rotations: dict[int, Rotation] = {}
    found = None
    for g in range(groups):
        # at most about QUERY_BYTES come to the driver and go to each executor
        rows = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == g).collect()
        own = {}
        for d in {len(r["v"]) for r in rows}:
            like = [r for r in rows if len(r["v"]) == d]
            own[d] = (np.array([r["vec_id"] for r in like], np.int64), np.array([r["v"] for r in like], np.int64).reshape(len(like), d))
            if d not in rotations:
                known = [r["v"] for r in sample if len(r["v"]) == d]
                rotations[d] = Rotation(np.array(known, np.int64).reshape(len(known), d))
        sent = spark.sparkContext.broadcast((own, {d: rotations[d] for d in own}))
        part = written(vectors.select("vec_id", "v").mapInArrow(_searcher(sent, k), "query_id long, vec_id long, score long"), "best")
        sent.destroy()
        found = part if found is None else found.unionByName(part)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH a AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score FROM a q JOIN a c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
