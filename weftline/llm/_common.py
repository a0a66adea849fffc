"""Helpers that the training-text operators share: scratch tables, a bounded
Bloom filter, lookups that hot keys cannot skew, connected components."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline import scratch
from weftline.scratch import remove_scratch, scratch_path, shared_dir  # noqa: F401

#: Runs of these characters separate words everywhere in this subpackage.
SPACES = r"[\x20\x09-\x0D]+"
WORDS = r"[^\x20\x09-\x0D]+"

#: A key counts as hot above this share of all rows, so at most this many keys
#: are hot: the proven bound of every broadcast of hot keys. Nor has a key that
#: is not hot more than HOT_ROWS rows, whatever the total is.
HOT_SHARE, HOT_ROWS = 256, 1_000_000

#: Rows that Arrow hands to a worker at a time while a table is written. Spark's
#: default of 10,000 whole texts, or shingle sets, crowds a small executor.
BATCH_ROWS = 500


def materialize(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """`scratch.materialize` with Arrow batches of BATCH_ROWS at most; the
    session's own setting is back when the table is written."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    if not 0 < int(before) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    try:
        return scratch.materialize(df, name, by)
    finally:
        conf.set(key, before)


def lean(f: Callable) -> Callable:
    """A function over Arrow batches that, before and after, gives the memory
    its worker has freed back to the system: workers live on from stage to
    stage, beside the JVM."""

    def trim() -> None:
        gc.collect()
        pa.default_memory_pool().release_unused()
        if sys.platform == "linux":
            with suppress(OSError, AttributeError):  # other C libraries have no such call
                ctypes.CDLL(None).malloc_trim(0)

    def run(batches: Iterator) -> Iterator:
        trim()
        yield from f(batches)
        trim()

    return run


def columns_of(df: DataFrame) -> list[Column]:
    """Every column, whatever characters its name holds."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as it takes to be no
    column of `df`."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def lookup(left: DataFrame, right: DataFrame, keys: str | list[str], n: str, total: int) -> DataFrame:
    """Inner join of `left` with `right`, which has one row per key and the
    key's row count in `n`. Keys with over 1/HOT_SHARE of `total` rows, or over
    HOT_ROWS, are broadcast, so that no task gets all rows of one. They are
    HOT_SHARE or total / HOT_ROWS keys at most."""
    on = [keys] if isinstance(keys, str) else keys
    hot_above = min(max(total // HOT_SHARE, 1000 // HOT_SHARE), HOT_ROWS)
    hot = F.broadcast(right.filter(F.col(n) > hot_above))
    cold = left.join(hot.select(*on), on, "left_anti").join(right.filter(F.col(n) <= hot_above), on)
    return left.join(hot, on).unionByName(cold)


# -- Bloom filter over repeated keys ----------------------------------------

#: Cells a key, hash functions, and the largest filter ever broadcast (16 MB).
BLOOM_CELLS, BLOOM_HASHES, BLOOM_MAX_BITS = 16, 2, 1 << 27


def _cells(keys: list[str], bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(*keys, F.lit(i)), F.lit(bits)) for i in range(BLOOM_HASHES)]


def bloom_bits(n: int) -> int:
    """Power of two near BLOOM_CELLS bits a key. Beyond the bound the filter
    fills up and lets more rows through; results stay the same. Callers that
    must not come to that deal their keys out by `bloom_ranges` first."""
    return min(BLOOM_MAX_BITS, max(1 << 15, 1 << (max(n, 1) * BLOOM_CELLS - 1).bit_length()))


def bloom_ranges(n: int) -> int:
    """How many filters of the largest size n keys need."""
    return max(1, -(-n * BLOOM_CELLS // BLOOM_MAX_BITS))


def bloom_build(rows: DataFrame, keys: list[str], bits: int, least: int) -> DataFrame:
    """Bitmaps of 32768 cells each, as 512 words, at most bits / 32768 rows: a
    cell is set when `least` or more rows hit it (1: seen, 2: seen again)."""
    cells = F.array(*[cell + 1 for cell in _cells(keys, bits)])
    hits = rows.select(F.explode(cells).alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
    bitmaps = (
        hits.filter(F.col("n") >= least)
        .select(F.expr("bitmap_bucket_number(cell)").alias("bucket"), F.expr("bitmap_bit_position(cell)").alias("bit"))
        .groupBy("bucket")
        .agg(F.expr("bitmap_construct_agg(bit)").alias("bitmap"))
    )
    return bitmaps.select("bucket", F.expr("transform(sequence(0, 511), i -> cast(conv(hex(substring(bitmap, i * 8 + 1, 8)), 16, -10) as bigint))").alias("words"))


def bloom_flag(rows: DataFrame, keys: list[str], bits: int, bitmaps: DataFrame, flag: str) -> DataFrame:
    """Adds boolean `flag`: false only if the filter surely lacks the key. The
    bitmaps are broadcast: at most BLOOM_MAX_BITS / 8 bytes."""
    out, tests, extra = rows, [], []
    for i, cell in enumerate(_cells(keys, bits)):
        c, b, w = fresh(rows, f"cell{i}", f"bucket{i}", f"words{i}")
        side = F.broadcast(bitmaps.select(F.col("bucket").alias(b), F.col("words").alias(w)))
        out = out.withColumn(c, cell + 1)
        out = out.join(side, F.expr(f"bitmap_bucket_number({c})") == F.col(b), "left")
        # Bytes of a word are in order, their bits from the right.
        bit = f"cast(bitmap_bit_position({c}) as int)"
        tests.append(F.expr(f"coalesce(shiftright({w}[{bit} div 64], (7 - {bit} div 8 % 8) * 8 + {bit} % 8) & 1, 0) = 1"))
        extra += [c, b, w]
    return out.withColumn(flag, reduce(Column.__and__, tests)).drop(*extra)


def deal_ranges(rows: DataFrame, key: str, n: int) -> list[DataFrame]:
    """`rows`, n of them, by ranges of a hash of the key: as many as it takes for
    a filter of each not to fill up. One range is `rows` itself."""
    ranges = bloom_ranges(n)
    if ranges == 1:
        return [rows]
    (at,) = fresh(rows, "range")
    dealt = materialize(rows.withColumn(at, F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(ranges)).cast("int")), "ranges", by=at)
    return [dealt.filter(F.col(at) == r).drop(at) for r in range(ranges)]


def maybe_repeated(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The rows (n of them, key and others) whose cells of a filter are hit twice
    or more, and boolean `maybe` for all."""
    bits = bloom_bits(n)
    return bloom_flag(rows, [key], bits, materialize(bloom_build(rows, [key], bits, least=2), "bloom"), "maybe")


def repeated_filter(keys: DataFrame, key: str, n: int) -> tuple[int, DataFrame]:
    """Bits and bitmaps of a filter for the keys that `keys`, n rows, have twice
    or more: of cells hit twice; where that would fill up, of the repeated keys
    themselves, which are found range by range."""
    if bloom_ranges(n) == 1:
        bits, least = bloom_bits(n), 2
    else:
        parts = deal_ranges(keys.select(key), key, n)
        again = [maybe_repeated(p, key, n // len(parts)).filter("maybe").groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").select(key) for p in parts]
        keys = union_all([materialize(a, "repeated") for a in again])
        bits, least = bloom_bits(keys.count()), 1
    return bits, materialize(bloom_build(keys, [key], bits, least=least), "bloom")


def possible(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose `key` a filter of the distinct keys `wanted` may hold. Keys
    that one filter can't hold are dealt to ranges of their hash, each with its
    own; a row is tested against its range's."""
    n = wanted.count()
    ranges = bloom_ranges(n)
    if ranges == 1:
        bits = bloom_bits(n)
        return bloom_flag(rows, [key], bits, materialize(bloom_build(wanted, [key], bits, least=1), "bloom"), "maybe").filter("maybe").drop("maybe")
    (flag,) = fresh(rows, "maybe")
    at = F.pmod(F.xxhash64(key, F.lit(-1)), F.lit(ranges))
    out = []
    for r in range(ranges):
        bits = bloom_bits(n // ranges)
        bitmaps = materialize(bloom_build(wanted.filter(at == r), [key], bits, least=1), "bloom")
        out.append(bloom_flag(rows.filter(at == r), [key], bits, bitmaps, flag).filter(F.col(flag)).drop(flag))
    return union_all(out)


# -- connected components ----------------------------------------------------


def components(links: DataFrame, max_rounds: int = 40) -> DataFrame:
    """`links` (a, b: bigint) to (node, root): root is the smallest node that
    can be reached. Large-star and small-star steps by turns; each is an
    aggregate and a lookup, and is written to the shared folder. No neighbour
    list is ever gathered and hubs are looked up as hot keys."""

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.select("a", "b")
        if large:
            both = both.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            both = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        total = edges.count() * (2 if large else 1)
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("n"))
        got = lookup(both, least, "a", "n", total)
        if large:
            out = got.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = got.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(got.select("a", F.col("m").alias("b")))
        return materialize(out.filter("a <> b").distinct(), "stars")

    def mark(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    before = mark(edges)
    for _ in range(max_rounds):
        if not before[0]:
            break
        edges = star(star(edges, large=True), large=False)
        now = mark(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
