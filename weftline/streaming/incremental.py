"""Streaming forms: resumable inference over a growing folder, token deltas,
event-time windows. Folds with state of their own are in `stateful`."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def resumable(source: DataFrame, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, key: str, done: DataFrame | None = None, time: str | None = None, late: str = "1 day") -> StreamingQuery:
    """Every key goes through `work` once, in the micro-batch that first has it.
    Keys are kept in the stream's state, so that a batch costs its own rows and
    not all earlier ones (use the RocksDB state store for many). With an event
    `time`, state is bounded: a key is forgotten once the watermark, `late` behind
    the latest time, has passed it, and rows behind the watermark are left out;
    otherwise keys are kept for ever. A batch is a
    folder `batch_id=n` of `out`, written anew if it is repeated after a failure.
    Rows whose key is in `done`, the output of an earlier job, are left out."""

    def batch(rows: DataFrame, number: int) -> None:
        todo = rows if done is None else rows.join(done.select(key), key, "left_anti")
        work(todo).write.mode("overwrite").parquet(f"{out}/batch_id={number}")

    once = source.withWatermark(time, late).dropDuplicatesWithinWatermark([key]) if time else source.dropDuplicates([key])
    return once.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def join_deltas(deltas: DataFrame, stream: str = "stream", seq: str = "seq", delta: str = "delta") -> DataFrame:
    """Token deltas of each stream, in order, as one text."""
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("o"), F.col(delta).alias("t")))), lambda x: x["t"]), "")
    return deltas.groupBy(stream).agg(joined.alias("text"))


def join_call_fragments(fragments: DataFrame) -> DataFrame:
    """stream, call_index, seq, name, arguments: fragments of each call; the
    first name and all argument pieces in order."""
    ordered = F.array_sort(F.collect_list(F.struct("seq", F.coalesce("arguments", F.lit("")).alias("a"))))
    return fragments.groupBy("stream", "call_index").agg(F.min_by("name", F.when(F.coalesce("name", F.lit("")) != "", F.col("seq"))).alias("name"), F.array_join(F.transform(ordered, lambda x: x["a"]), "").alias("arguments"))


def windowed_counts(events: DataFrame, length: str = "10 minutes", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Event-time windows of events (ts, event_type, value) behind a watermark."""
    window = F.window("ts", length, slide) if slide else F.window("ts", length)
    return events.withWatermark("ts", late).groupBy(window, "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of a user: events no further apart than the gap."""
    return events.withWatermark("ts", late).groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "user_id", "n")
