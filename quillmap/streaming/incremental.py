"""Incremental processing: a file stream whose checkpoint remembers what is done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def process_new(spark: SparkSession, source: str, schema: StructType, sink: str, checkpoint: str, step: Callable[[DataFrame], DataFrame]) -> None:
    """Runs `step` over the Parquet files of `source` that no earlier run with this checkpoint has seen, and appends
    to `sink`. A run that is stopped goes on where it was; each file counts once."""
    stream = spark.readStream.schema(schema).parquet(source)
    query = stream.writeStream.foreachBatch(lambda df, _: step(df).write.mode("append").parquet(sink)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
