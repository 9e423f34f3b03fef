"""Tables written between steps, in the folder that all machines of a cluster share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where that is unset, one of our own on a local master, which
    goes when the process ends; on a cluster a machine's own folder would lose rows, so there it is an error."""
    if d := spark.conf.get("spark.checkpoint.dir", None):
        return d
    app = spark.sparkContext.applicationId
    if app not in _own:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        made = tempfile.mkdtemp(prefix="quillmap-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _own[app] = "file://" + made
        spark.sparkContext.setCheckpointDir(_own[app])
    return _own[app]


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/quillmap/{name}-{uuid.uuid4().hex}"


#: Shuffle files go when the execution that made them has ended.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, survives lost executors.

    The shuffle files of the writing are removed with it, as nothing will read them again.
    """
    spark = df.sparkSession
    path, before = shared_path(spark, name), spark.conf.get(_FREE, None)
    spark.conf.set(_FREE, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_FREE) if before is None else spark.conf.set(_FREE, before)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, *tables: DataFrame) -> None:
    """Deletes the files of written tables that nothing will read again."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in {f.rsplit("/", 1)[0] for t in tables for f in t.inputFiles()}:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
