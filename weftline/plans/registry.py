"""Queries over the driver's tables, each with its oracle in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Tables = Callable[[str], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Registers a function of a table reader under its own name."""

    def keep(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if f.__name__ in QUERIES:
            raise ValueError(f"query {f.__name__} is registered already")
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return keep


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """The rows in as many partitions as shuffles have, by key."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
