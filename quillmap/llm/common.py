"""Shared helpers: written intermediate tables, workers' caches, words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmap.storage import removed, shared_path, written  # noqa: F401

#: Words as every operator here counts them: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_caches: list[dict] = []


def cache() -> dict:
    """A worker's cache, which release() empties."""
    _caches.append({})
    return _caches[-1]


def release() -> None:
    """Empties the caches and gives the memory that is free now back to the system."""
    import ctypes

    import pyarrow as pa

    for c in _caches:
        c.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library, which does without
        pass


def released(run):
    """run, over Arrow batches, with release() after a task: idle workers share an executor's memory with the stages that follow."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
