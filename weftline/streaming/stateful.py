"""Folds whose state outlives a micro-batch: conversations and call fragments,
by transformWithState. Both need Spark's RocksDB state store, which `run` sets
for the query that it starts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def run(updates: DataFrame, out: str, checkpoint: str, endless: bool = False) -> None:
    """Works through what the stream has and waits. A fold on processing time (one
    with a time to live) is `endless`: it would go on without data, and so takes
    all there is in one batch. A batch is a folder
    `batch_id=n` of `out`, written anew if it is repeated after a failure; a later
    run with the same checkpoint goes on where this one stopped. The session's
    state store setting is put back."""
    conf = updates.sparkSession.conf
    before = conf.get(_PROVIDER)
    conf.set(_PROVIDER, _ROCKSDB)
    try:
        write = updates.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        write = write.trigger(once=True) if endless else write.trigger(availableNow=True)
        query = write.foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch_id={n}")).start()
    finally:
        conf.set(_PROVIDER, before)
    query.awaitTermination()


_SESSION = "conv_id bigint, start_ms bigint, end_ms bigint, messages bigint, user_turns bigint, open_calls bigint, closed boolean"


class ConversationFold(StatefulProcessor):
    """Rows (conv_id, ms, role, call_id) of a conversation to one row a session.

    Value state: first and last time, messages, user turns. Map state: the calls
    that have no result yet (an assistant row with a call_id opens one, a function
    row with it closes it). A row `idle_ms` or more behind the last one closes the
    session and opens the next; so does a timer on event time when no row comes,
    and what closes is forgotten. A late row joins the session that is open."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "start_ms bigint, end_ms bigint, messages bigint, user_turns bigint")
        self.calls = handle.getMapState("calls", "call_id string", "ms bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        out, sums = [], self.sums.get() if self.sums.exists() else None
        calls = {c[0]: ms[0] for c, ms in self.calls.iterator()} if sums else {}
        had = set(calls)
        for ms, role, call in sorted((r for f in rows for r in zip(f["ms"], f["role"], f["call_id"])), key=lambda r: r[0]):
            if sums and ms - sums[1] >= self.idle_ms:
                out.append(self._row(key, sums, len(calls), True))
                sums, calls = None, {}
            start, end, n, users = sums or (ms, ms, 0, 0)
            sums = (min(start, ms), max(end, ms), n + 1, users + (role == "user"))
            if isinstance(call, str) and role == "assistant":
                calls[call] = ms
            elif isinstance(call, str) and role == "function":
                calls.pop(call, None)
        out.append(self._row(key, sums, len(calls), False))
        self.sums.update(tuple(int(x) for x in sums))
        for c in had - set(calls):
            self.calls.removeKey((c,))
        for c in set(calls) - had:
            self.calls.updateValue((c,), (int(calls[c]),))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer[0] if isinstance(timer, tuple) else timer)
        self.handle.registerTimer(int(sums[1]) + self.idle_ms)
        yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in _SESSION.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.sums.exists():
            row = self._row(key, self.sums.get(), sum(1 for _ in self.calls.keys()), True)
            self.sums.clear()
            self.calls.clear()
            yield pd.DataFrame([row], columns=[c.split(" ")[0] for c in _SESSION.split(", ")])

    @staticmethod
    def _row(key, sums, open_calls: int, closed: bool) -> tuple:
        return (key[0], *(int(x) for x in sums), open_calls, closed)

    def close(self) -> None:
        pass


def conversation_sessions(messages: DataFrame, idle: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """A stream of (conv_id, ts, role, call_id) to rows of sessions: after each
    micro-batch the open one of every conversation in it, and all that closed."""
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)
    rows = messages.withWatermark("ts", late).select("conv_id", "ts", F.unix_millis("ts").alias("ms"), "role", F.col("call_id").cast("string").alias("call_id"))
    return rows.groupBy("conv_id").transformWithStateInPandas(ConversationFold(idle_ms), _SESSION, "Update", "EventTime")


def latest_sessions(updates: DataFrame) -> DataFrame:
    """The last row of each session among the written updates. A late row can
    move a session's start; its end and messages only grow."""
    return updates.groupBy("conv_id", "end_ms").agg(F.max_by(F.struct("start_ms", "messages", "user_turns", "open_calls", "closed"), F.struct("messages", "closed")).alias("x")).select("conv_id", "x.start_ms", "end_ms", "x.messages", "x.user_turns", "x.open_calls", "x.closed").groupBy("conv_id", "start_ms").agg(F.max_by(F.struct("end_ms", "messages", "user_turns", "open_calls", "closed"), F.struct("messages", "closed")).alias("y")).select("conv_id", "start_ms", "y.*")


_CALL = "stream bigint, call_index bigint, name string, arguments string, fragments bigint, waiting bigint"


class CallFragments(StatefulProcessor):
    """Fragments (stream, call_index, seq, name, arguments) of a call to the call
    so far. Value state: the next seq (from 0), the first name, the arguments up to
    there. Map state: fragments that came before one they follow; a fragment that
    is there already changes nothing. State that is not touched for `ttl_ms` goes."""

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.whole = handle.getValueState("whole", "next bigint, name string, arguments string", self.ttl_ms)
        self.early = handle.getMapState("early", "seq bigint", "name string, arguments string", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.whole.exists()
        at, name, text = self.whole.get() if known else (0, "", "")
        early = {int(k[0]): tuple(v) for k, v in self.early.iterator()} if known else {}
        had = set(early)
        for f in rows:
            for seq, n, a in zip(f["seq"], f["name"], f["arguments"]):
                if seq >= at:
                    early.setdefault(int(seq), (n if isinstance(n, str) else "", a if isinstance(a, str) else ""))
        pieces = [text]
        while at in early:
            n, a = early.pop(at)
            name, at = name or n, at + 1
            pieces.append(a)
        text = "".join(pieces)
        self.whole.update((int(at), name, text))
        for seq in had - set(early):
            self.early.removeKey((seq,))
        for seq in set(early) - had:
            self.early.updateValue((seq,), early[seq])
        yield pd.DataFrame({"stream": [key[0]], "call_index": [key[1]], "name": [name], "arguments": [text], "fragments": [at], "waiting": [len(early)]})

    def close(self) -> None:
        pass


def call_fragments(fragments: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """A stream of fragments to one row a call in each micro-batch: stream,
    call_index, name, arguments, fragments joined so far, fragments waiting for
    an earlier one."""
    return fragments.groupBy("stream", "call_index").transformWithStateInPandas(CallFragments(ttl_ms), _CALL, "Update", "None" if ttl_ms is None else "ProcessingTime")
