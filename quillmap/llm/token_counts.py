"""Token counts with a digest cache.

The content digest and the digest of the tokenizer's version are joined to stored
counts; only distinct contents without one are encoded, and appended to the cache.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmap.llm.common import shared_path
from quillmap.llm.fast_tokens import load, slices, version_digest

CACHE = T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("n_tokens", T.LongType()), T.StructField("version", T.StringType())])


class TokenCountCache:
    """Counts by the digests of content and tokenizer version, in a shared store; versions have folders of their own, so others' are not read."""

    def __init__(self, spark: SparkSession, path: str, tokenizer: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.version = version_digest(tokenizer)

    def exists(self) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def read(self) -> DataFrame:
        """digest, version, n_tokens of this version: one row for each digest, also when two jobs have appended the same one."""
        if not self.exists():
            return self.spark.createDataFrame([], CACHE)
        stored = self.spark.read.schema(CACHE).parquet(self.path).filter(F.col("version") == self.version)
        return stored.groupBy("digest", "version").agg(F.max("n_tokens").alias("n_tokens"))

    def append(self, counts: DataFrame) -> None:
        counts.select("digest", "n_tokens", F.lit(self.version).alias("version")).write.mode("append").partitionBy("version").parquet(self.path)


def _packed(batches):
    """Texts, compressed for the shuffle."""
    import pyarrow as pa
    import zstandard

    z = zstandard.ZstdCompressor(level=1)
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array([z.compress(t.encode()) for t in b.column("text").to_pylist()], pa.binary())], ["digest", "packed"])


def _encoder(tokenizer: str):
    def run(batches):
        import pyarrow as pa
        import zstandard

        z, fast = zstandard.ZstdDecompressor(), load(tokenizer)
        for b in batches:
            packed = b.column("packed").to_pylist()
            counts: list[int] = []
            for lo, hi in slices([3 * len(p) for p in packed]):
                counts += [len(ids) // 4 for ids in fast.encode([z.decompress(p).decode("utf-8") for p in packed[lo:hi]])]
            yield pa.RecordBatch.from_arrays([b.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", cache_path: str | None = None, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of docs: id, n_bytes, n_tokens, over_limit (n_tokens > limit).

    The normalisation of a content only takes null as the empty text: anything more
    would change the counts. cache_path: a folder kept from run to run; without it
    the cache starts empty in the shared folder. Null ids and repeated rows are kept
    as they are; an empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    cache = TokenCountCache(spark, cache_path or shared_path(spark, "token-counts"), tokenizer)
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("digest", F.unhex(F.sha2("text", 256))).withColumn("version", F.lit(cache.version))
    misses = keyed.select("digest", "version", "text")
    if cache.exists():
        misses = misses.join(cache.read(), ["digest", "version"], "left_anti")
    distinct = misses.select("digest", "text").mapInArrow(_packed, "digest binary, packed binary").groupBy("digest").agg(F.first("packed").alias("packed"))
    cache.append(distinct.mapInArrow(_encoder(tokenizer), "digest binary, n_tokens long"))
    sized = keyed.select("doc_id", "digest", "version", F.octet_length("text").cast("long").alias("n_bytes"))
    return sized.join(cache.read(), ["digest", "version"], "left").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
