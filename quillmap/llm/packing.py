"""Best-fit packing of token pieces into sequences.

Every piece is a vector (tokens, one document, attention cost = tokens squared) and
every sequence has a capacity in each dimension. Pieces are dealt evenly to shards by
place; each shard packs its own, largest first, into the open sequence that the
chosen rule prefers among those with room in every dimension; sequences left with
much room are opened again and their pieces packed together in a later round.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmap.llm.common import released, written
from quillmap.llm.fast_tokens import load, slices

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cutter(tokenizer: str, end_id: int, most: int):
    def run(batches):
        import pyarrow as pa

        fast, end = load(tokenizer), np.uint32(end_id).tobytes()
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), [t or "" for t in b.column("text").to_pylist()]
            for lo, hi in slices([len(t) for t in texts], 250_000):
                out: list[tuple] = []
                for doc, own in zip(ids[lo:hi], fast.encode(texts[lo:hi]), strict=True):
                    own = memoryview(own + end)
                    for k, at in enumerate(range(0, len(own), 4 * most)):
                        part = own[at : at + 4 * most]
                        out.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def best_fit(lengths: np.ndarray, capacity: np.ndarray, weights: np.ndarray, rule: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each piece; bins count from 0.

    rule "norm": the smallest weighted norm of the residual after placing;
    "dot": the largest weighted dot product of piece and residual. Both only among
    bins with room in tokens, documents and attention cost. Ties: the oldest bin.
    """
    n = len(lengths)
    bins, offsets = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    size = np.stack([lengths, np.ones(n), lengths.astype(np.float64) ** 2]) / capacity[:, None]
    order = np.lexsort((np.arange(n), -lengths))
    least = size[0, order[-1]] if n else 0
    room, tokens, name = np.empty((3, 64)), np.zeros(n + 1, np.int64), np.empty(64, np.int64)
    opened = live = 0
    w = weights[:, None]
    eps = 1e-9
    for i in order:
        x = size[:, i]
        r = room[:, :live]
        fits = (r[0] >= x[0] - eps) & (r[1] >= x[1] - eps) & (r[2] >= x[2] - eps)
        k = np.flatnonzero(fits)
        if len(k):
            left = r[:, k] - x[:, None]
            score = (w * left * left).sum(0) if rule == "norm" else -(w * r[:, k] * x[:, None]).sum(0)
            at = k[np.argmin(score)]
        else:
            if live == room.shape[1]:
                room, name = np.concatenate([room, np.empty_like(room)], 1), np.concatenate([name, np.empty_like(name)])
            at, live = live, live + 1
            room[:, at], name[at] = 1.0, opened
            opened += 1
        room[:, at] -= x
        b = name[at]
        bins[i], offsets[i] = b, tokens[b]
        tokens[b] += lengths[i]
        if room[0, at] < least - eps or room[1, at] < 1 / capacity[1] - eps:  # nothing more can go in
            live -= 1
            room[:, at], name[at] = room[:, live], name[live]
    return bins, offsets


def _packer(capacity, weights, rule: str, turn: int):
    capacity, weights = np.array(capacity, float), np.array(weights, float)

    def run(pdf):
        pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable", ignore_index=True)
        bins, offsets = best_fit(pdf["length"].to_numpy(np.int64), capacity, weights, rule)
        if len(bins) and bins.max() >= 1 << BIN_BITS:
            raise ValueError(f"a shard has more than {1 << BIN_BITS} sequences: fewer shard_pieces are needed")
        pdf["sequence_id"] = sequence_number(turn, pdf["__shard"].to_numpy(np.int64), bins)
        pdf["offset"] = offsets
        pdf["__filled"] = np.bincount(bins, pdf["length"])[bins].astype(np.int64) if len(pdf) else 0
        return pdf

    return run


#: A sequence's number has the round in its two highest bits, then the shard, then so many bits for the shard's sequences.
BIN_BITS = 21


def sequence_number(turn: int, shard, bins):
    """Different for different (round, shard, sequence of it): 4 rounds, 2**40 shards."""
    return (turn << 61) + (shard << BIN_BITS) + bins


def pack(pieces: DataFrame, max_tokens: int = 4096, max_documents: int | None = None, max_attention: int | None = None, weights=(1.0, 1e-3, 1e-3), rule: str = "norm", shard_pieces: int = 4096, full: float = 0.98, rounds: int = 2) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece and length.

    A piece has 1 to max_tokens tokens. Without max_documents and max_attention those
    dimensions hold what max_tokens allows at most, so only the tokens bind. shard_pieces
    bounds a task's memory; each of up to 4 rounds takes the sequences filled below `full`
    apart and packs their pieces, from all shards, anew. Pieces are dealt to shards by
    their place in the written table, so null ids and repeated rows spread like all
    others. An empty table gives an empty result. Other columns stay.
    """
    if not 1 <= rounds <= 4:
        raise ValueError("rounds are 1 to 4")
    capacity = (max_tokens, max_tokens if max_documents is None else max_documents, max_tokens**2 if max_attention is None else max_attention)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    out = [f.name for f in pieces.schema]
    rest, done = written(pieces, "pieces"), None
    for k in range(rounds):
        n = rest.count()
        if k and n == 0:
            break
        shards = max(1, -(-n // shard_pieces))
        # a place in a written table is the same however often a task runs
        dealt = rest.withColumn("__place", F.monotonically_increasing_id()).withColumn("__shard", F.pmod(F.xxhash64("__place", F.lit(k)), F.lit(shards))).drop("__place")
        packed = written(dealt.groupBy("__shard").applyInPandas(_packer(capacity, weights, rule, k), f"{schema}, `__shard` long, sequence_id long, offset long, `__filled` long"), "packed")
        last = k == rounds - 1 or shards == 1
        kept = packed if last else packed.filter(F.col("__filled") >= int(full * max_tokens))
        kept = kept.select(*out, "sequence_id", "offset")
        done = kept if done is None else done.unionByName(kept)
        if last:
            break
        rest = packed.filter(F.col("__filled") < int(full * max_tokens)).select(*out)
    return done


def cut(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 1, max_tokens: int = 4096) -> DataFrame:
    """Token pieces of every document: doc_id, piece, start, length, ids_crc32.

    A null text is empty and still has its end id. Only documents of more than
    max_tokens are cut. Null ids and repeated rows are kept; other columns are ignored.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(released(_cutter(tokenizer, end_id, max_tokens)), PIECES)


def pack_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", max_tokens: int = 4096, **how) -> DataFrame:
    """cut() and pack(): doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(cut(docs, tokenizer, max_tokens=max_tokens), max_tokens, **how)
