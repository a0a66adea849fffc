"""One place for the session settings that the engine's semantics rest on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "weftline", **settings: str) -> SparkSession:
    """A session with the engine's settings; master, memory and parallelism
    are the caller's or the cluster's."""
    return SparkSession.builder.appName(name).config(map=SETTINGS | settings).getOrCreate()
