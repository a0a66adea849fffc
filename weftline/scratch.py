"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_scratch: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: `spark.checkpoint.dir`, or
    a local one of our own where that is unset (tests, single machine)."""
    own = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not own:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        own = jvm_dir.get() if jvm_dir.isDefined() else None
    if not own:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        own = "file://" + tempfile.mkdtemp(prefix="weftline-")
        spark.sparkContext.setCheckpointDir(own)
    return own.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/weftline-scratch/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def materialize(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Writes `df` to the shared folder and reads it back, which cuts its
    lineage: a lost executor costs no recomputation, and rows keep the ids
    they were given. With `by`, a column, each value has a folder of its own."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_scratch(spark: SparkSession) -> None:
    """Deletes all scratch tables of this process; results read from them must
    have been written by then. Also runs at exit."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    jvm = spark.sparkContext._jvm
    while _scratch:
        path = jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        path.getFileSystem(conf).delete(path, True)


@atexit.register
def _at_exit() -> None:
    spark = SparkSession.getActiveSession()
    if _scratch and spark is not None and spark.sparkContext._jsc is not None:
        remove_scratch(spark)
