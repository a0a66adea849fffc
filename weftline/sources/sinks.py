"""Sinks: JSONL in overwrite and append forms, two results of one pass, a file
a case, stage skips, keys of response caches (see `keyed` for the tables)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str, drop: tuple[str, ...] = ()) -> None:
    df.drop(*drop).write.mode("overwrite").json(path)


def append_jsonl(df: DataFrame, path: str, drop: tuple[str, ...] = ("messages",), rows_per_file: int | None = None) -> None:
    """Appends; order carries no meaning. Micro-batches are files."""
    writer = df.drop(*drop).write.mode("append")
    (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).json(path)


def write_both(df: DataFrame, raw_path: str, parsed_path: str, parsed: Callable[[DataFrame], DataFrame]) -> None:
    """Raw rows, and what a parser makes of them (one to many); the second is
    read from the first's files, so that the input runs once."""
    df.write.mode("overwrite").json(raw_path)
    parsed(df.sparkSession.read.schema(df.schema).json(raw_path)).write.mode("overwrite").json(parsed_path)


def write_cases(df: DataFrame, path: str, case: str) -> None:
    """A folder a case."""
    df.write.mode("overwrite").partitionBy(case).json(path)


def stage_done(spark: SparkSession, path: str) -> bool:
    """Whether a stage's folder has its success mark, on any file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def run_stage(spark: SparkSession, path: str, stage: Callable[[], DataFrame]) -> DataFrame:
    """The stage's table, computed only where it is not there yet."""
    if not stage_done(spark, path):
        stage().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def cache_key(*parts: Column) -> Column:
    """A hash of the canonical JSON of messages, functions and settings."""
    return F.sha2(F.to_json(F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])), 256)
