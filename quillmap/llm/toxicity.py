"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Training sees a bounded, documented sample of labelled rows in one task; per-coordinate
rates and L1 leave a few thousand weights, which go to every scoring task. Each text
is scored whole.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmap.llm.common import cache, release, released

#: Buckets of the feature hash, and so the most weights there can be.
BITS = 22
#: Most labelled rows that training takes, the first by a hash of their id.
TRAINING_ROWS = 12_000
#: Most features that training keeps from one epoch to the next; beyond it they are hashed again.
HELD = 20_000_000
_TOKENS = re.compile(r"[^\W_]+")
#: The two words' distances of the features besides single words: a bigram and two skip-grams.
GAPS = (1, 2, 3)

_words: dict[str, int] = cache()


def features(text: str) -> np.ndarray:
    """Distinct hashed features of a whole text."""
    tokens = _TOKENS.findall(text.lower())
    if len(_words) > 500_000:
        _words.clear()
    get = _words.get
    h = np.empty(len(tokens), np.uint64)
    for i, t in enumerate(tokens):
        v = get(t)
        if v is None:
            v = _words[t] = zlib.crc32(t.encode()) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
        h[i] = v
    parts = [h]
    for g in GAPS:
        if len(h) > g:
            parts.append((h[:-g] * np.uint64(2 * g + 1) ^ (h[g:] >> np.uint64(7))) * np.uint64(0xC2B2AE3D27D4EB4F))
    return np.concatenate(parts) >> np.uint64(64 - BITS)


def train(features_of, labels, epochs: int = 5, alpha: float = 0.5, beta: float = 1.0, l1: float = 8.0, l2: float = 0.0, positive: float = 1.0, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """(indices, weights) that are not 0; index 2**BITS is the intercept. features_of: a callable, by position the hashed features; positive: how much a toxic row counts."""
    n_features = 2**BITS + 1
    z, n = np.zeros(n_features), np.zeros(n_features)
    y, rng = np.asarray(labels, float), np.random.default_rng(seed)
    seen: dict[int, np.ndarray] = {}
    held = 0
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            f = seen.get(i)
            if f is None:
                f = np.append(np.unique(features_of(i)), 2**BITS).astype(np.int32)
                if held + len(f) <= HELD:
                    seen[i], held = f, held + len(f)
            zf, nf = z[f], n[f]
            penalty = np.full(len(f), l1)
            penalty[-1] = 0
            w = np.where(np.abs(zf) <= penalty, 0.0, -(zf - np.sign(zf) * penalty) / ((beta + np.sqrt(nf)) / alpha + l2))
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - y[i]
            g *= positive if y[i] else 1.0
            sigma = (np.sqrt(nf + g * g) - np.sqrt(nf)) / alpha
            z[f] += g - sigma * w
            n[f] += g * g
    penalty = np.full(n_features, l1)
    penalty[-1] = 0
    at = np.flatnonzero(np.abs(z) > penalty)
    return at, -(z[at] - np.sign(z[at]) * penalty[at]) / ((beta + np.sqrt(n[at])) / alpha + l2)


def _hashed(batches):
    """Labelled texts as their distinct features, compressed: what the trainer needs, and no more."""
    import pyarrow as pa
    import zstandard

    z = zstandard.ZstdCompressor(level=1)
    for b in batches:
        packed = [z.compress(np.unique(features(t or "")).astype("<u4").tobytes()) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(c) for c in ("doc_id", "label", "order")] + [pa.array(packed, pa.binary())], ["doc_id", "label", "order", "packed"])


def _trainer(most: int):
    def run(pdf):
        import pandas as pd
        import zstandard

        z = zstandard.ZstdDecompressor()
        pdf = pdf.sort_values(["order", "doc_id", "packed"], kind="stable", ignore_index=True)[:most]
        packed = pdf["packed"].tolist()
        at, w = train(lambda i: np.frombuffer(z.decompress(packed[i]), "<u4"), pdf["label"])
        release()
        return pd.DataFrame({"feature": at.astype(np.int64), "weight": w})

    return run


def fold(doc_id):
    """crc32 of the id as text, modulo 5; a null id is the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5


class ToxicityModel:
    """The weights that are not 0, at most 2**BITS + 1."""

    def __init__(self, at: np.ndarray, weights: np.ndarray):
        self.at, self.weights = np.asarray(at, np.int64), np.asarray(weights, np.float64)

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> ToxicityModel:
        """From labelled rows whose fold is not 0: the first `most` of them by a hash of the id.

        Null labels are no labels. Without any labelled text the model has no weights
        and scores 0.5.
        """
        picked = labels.select(F.col("doc_id").alias("__id"), F.col("toxic").cast("double").alias("label"))
        picked = picked.filter(F.col("label").isNotNull() & F.col("__id").isNotNull() & (fold(F.col("__id")) != 0))
        picked = picked.withColumn("order", F.xxhash64("__id")).orderBy("order", "__id").limit(most)
        rows = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("__id")).select(F.col("doc_id").cast("long").alias("doc_id"), "label", "order", "text")
        hashed = rows.mapInArrow(released(_hashed), "doc_id long, label double, order long, packed binary")
        # repeated rows of an id are rows of their own, so the bound is kept here once more, before one task gets them
        hashed = hashed.orderBy("order", "doc_id", F.xxhash64("packed")).limit(most)
        found = hashed.groupBy(F.lit(0).alias("all")).applyInPandas(_trainer(most), "feature long, weight double").toPandas()
        found = found.sort_values("feature")
        return cls(found["feature"].to_numpy(), found["weight"].to_numpy())

    def scorer(self, spark):
        """Scores Arrow batches; the weights reach each executor once, as a broadcast of at most 16 bytes for each feature."""
        sent = spark.sparkContext.broadcast((self.at, self.weights))

        def run(batches):
            import pyarrow as pa

            at, weights = sent.value
            table = np.zeros(2**BITS, np.float32)
            own = at < 2**BITS
            table[at[own]] = weights[own]
            exact, start = dict(zip(at.tolist(), weights.tolist(), strict=True)), float(weights[~own].sum())
            for b in batches:
                out = []
                for t in b.column("text").to_pylist():
                    f = features(t or "")
                    hit = sorted(set(f[table[f] != 0].tolist())) if len(f) else []
                    out.append(1 / (1 + np.exp(-np.clip(start + sum(exact[i] for i in hit), -35, 35))))
                yield pa.RecordBatch.from_arrays([*(c for n, c in zip(b.schema.names, b.columns, strict=True) if n != "text"), pa.array(out, pa.float64())], [*(n for n in b.schema.names if n != "text"), "score"])

        return run

    def scores(self, docs: DataFrame) -> DataFrame:
        """doc_id, score per row; a null text is the empty one."""
        return docs.select("doc_id", "text").mapInArrow(released(self.scorer(docs.sparkSession)), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")

    def filter(self, docs: DataFrame, threshold: float = 0.5) -> DataFrame:
        """The rows of docs, all columns, that score below the threshold."""
        score = self.scorer(docs.sparkSession)

        def run(batches):
            import pyarrow as pa

            for b in batches:
                (s,) = score([pa.RecordBatch.from_arrays([b.column(b.schema.names.index("text"))], ["text"])])
                yield b.filter(pa.compute.less(s.column("score"), threshold))

        return docs.mapInArrow(released(run), docs.schema)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of docs: doc_id, held_out, score, predicted.

    Fits on labelled rows of the other folds only; a score depends on nothing but the
    text. Null and empty texts get the intercept's score; repeated rows score alike;
    an empty table gives an empty result.
    """
    scored = ToxicityModel.fit(docs, labels).scores(docs)
    return scored.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
