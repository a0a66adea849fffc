"""Which of many patterns occur in which of many texts.

Patterns of up to AUTOMATON_BYTES in all are one Aho-Corasick automaton: every
text is read once, whatever their number. Its size is checked before it is
broadcast. A larger set is dealt out by the first PREFIX signs of the patterns:
a Bloom bitmap of the prefixes tells the positions of a text where a pattern may
begin; what follows there is joined with the patterns by prefix and compared. So
neither way pairs texts with patterns that have nothing in common."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from hashlib import blake2b

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.scratch import materialize

#: Bytes of patterns that one automaton may hold (it takes some thirty times as many in a worker).
AUTOMATON_BYTES = 4 << 20
#: Signs that deal out a pattern, bits a prefix, and the most bytes of the bitmap.
PREFIX, BITS, BITMAP_BYTES = 8, 16, 16 << 20

_FOUND = "pattern string, n bigint, first bigint"
_automata: dict[str, ahocorasick.Automaton] = {}


def _automaton(name: str, patterns: Broadcast) -> ahocorasick.Automaton:
    """Built once a worker, which keeps the last one."""
    if name not in _automata:
        _automata.clear()
        a = ahocorasick.Automaton()
        for p in patterns.value:
            a.add_word(p, p)
        a.make_automaton()
        _automata[name] = a
    return _automata[name]


def _rows(key: pa.Array, kind: pa.DataType, hits: list[tuple]) -> pa.RecordBatch:
    """(row, pattern, n, first) with the row's key."""
    row, *rest = zip(*hits) if hits else ((), (), (), ())
    return pa.RecordBatch.from_arrays([key.take(pa.array(row, pa.int64())).cast(kind), pa.array(rest[0], pa.string()), pa.array(rest[1], pa.int64()), pa.array(rest[2], pa.int64())], ["key", "pattern", "n", "first"])


def _searched(patterns: Broadcast):
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(name, patterns)
        for batch in batches:
            hits = []
            for row, text in enumerate(batch.column(1).to_pylist()):
                found: dict[str, list[int]] = {}
                for end, p in automaton.iter(text or "") if len(automaton) else ():
                    seen = found.setdefault(p, [0, end + 1 - len(p)])
                    seen[0] += 1
                hits += [(row, p, n, first) for p, (n, first) in found.items()]
            yield _rows(batch.column(0), batch.column(0).type, hits)

    return run


def _bit(prefix: str, size: int) -> int:
    return int.from_bytes(blake2b(prefix.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big") % size


def _begun(bitmap: Broadcast, longest: int):
    """(key, text) to the places where a pattern may begin: key, prefix, what
    follows as far as the longest pattern reaches, position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(bitmap.value, np.uint8)
        size = len(bits) * 8
        for batch in batches:
            hits = []
            for row, text in enumerate(batch.column(1).to_pylist()):
                for at in range(len(text or "") - PREFIX + 1):
                    p = text[at : at + PREFIX]
                    b = _bit(p, size)
                    if bits[b >> 3] >> (b & 7) & 1:
                        hits.append((row, p, text[at : at + longest], at))
            row, prefix, rest, at = zip(*hits) if hits else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int64())), pa.array(prefix, pa.string()), pa.array(rest, pa.string()), pa.array(at, pa.int64())], ["key", "prefix", "rest", "at"])

    return run


def _marked(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size // 8, np.uint8)
        for batch in batches:
            for p in batch.column(0).to_pylist():
                b = _bit(p, size)
                bits[b >> 3] |= 1 << (b & 7)
        yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()])], ["bits"])

    return run


def occurrences(texts: DataFrame, key: str, text: str, patterns: DataFrame, pattern: str, limit: int = AUTOMATON_BYTES) -> DataFrame:
    """key, pattern, n (how often, overlaps included), first (position of the
    first, from 0) of every pattern in every text that holds it. Null and empty
    patterns occur nowhere; repeated ones count once."""
    context = texts.sparkSession.sparkContext
    known = materialize(patterns.select(F.col(pattern).cast("string").alias("pattern")).filter("pattern <> ''").distinct(), "patterns")
    rows = texts.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).filter("text IS NOT NULL")
    schema = f"key {rows.schema['key'].dataType.simpleString()}"
    size = F.coalesce(F.sum(F.octet_length("pattern") + 8), F.lit(0))
    fits = known.agg(size).first()[0] <= limit
    short = known if fits else known.filter(F.length("pattern") < PREFIX)
    # One automaton; more only for that many patterns shorter than a prefix.
    packs = max(1, -(-short.agg(size).first()[0] // limit))
    found = []
    for r in range(packs):
        some = short.filter(F.pmod(F.xxhash64("pattern"), F.lit(packs)) == r)
        found.append(rows.mapInArrow(_searched(context.broadcast([x.pattern for x in some.collect()])), f"{schema}, {_FOUND}"))
    if not fits:
        long = known.filter(F.length("pattern") >= PREFIX).withColumn("prefix", F.substring("pattern", 1, PREFIX))
        facts = long.agg(F.count_distinct("prefix").alias("n"), F.max(F.length("pattern")).alias("longest")).first()
        bits = min(BITMAP_BYTES * 8, max(1 << 16, 1 << (facts.n * BITS).bit_length()))
        marks = [np.frombuffer(x.bits, np.uint8) for x in long.select("prefix").distinct().coalesce(8).mapInArrow(_marked(bits), "bits binary").collect()]
        bitmap = context.broadcast(np.bitwise_or.reduce([np.zeros(bits // 8, np.uint8), *marks]).tobytes())
        begun = rows.mapInArrow(_begun(bitmap, facts.longest or PREFIX), f"{schema}, prefix string, rest string, at bigint")
        here = begun.join(long, "prefix").filter(F.col("rest").startswith(F.col("pattern")))
        found.append(here.groupBy("key", "pattern").agg(F.count("*").alias("n"), F.min("at").alias("first")))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.withColumnRenamed("key", key)
