"""Shards by a k-d tree over document metadata.

Every document is a point (language, source, length). A node that is larger than
the target is split at the weighted median of its widest dimension, weights
being bytes, until the leaves reach the target. All nodes of a level are split
together. A median is found by radix: histograms of bytes over 32768 bins, four
times, each inside the bin that the last one named. Histograms are summed up and
searched in Spark; the driver sees one row a node. Ties of a dimension are
ordered by a hash of a row number that each document gets at first, so a source
with a third of all rows, or a third of rows that are alike in everything, is
still cut in half. Rows carry the node they are in, and are written after each
level; a level's splits, one row a node, are joined to them. DataFrame functions
only.

Defined cases: a null text has size 1 and the checksum of no bytes; null
metadata sorts first; repeated rows are points of their own; a very long text is
one document, and a shard is larger than others by at most about that; an empty
table gives an empty result; other columns are ignored, whatever their names."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weftline.llm import _common as C

#: Bits of a key: 24 of the dimension, 36 of the hash that orders its ties.
DIM_BITS, TIE_BITS, RADIX_BITS = 24, 36, 15
DIMENSIONS = ("lang", "source", "length")
#: Rows numbered by one task, about.
SLOT_ROWS = 50_000


def _name(column: str) -> Column:
    """Half of the bits are a name's first bytes, which keeps near names
    together; half a hash, as names often differ late (src10, src11)."""
    first = F.coalesce(F.conv(F.rpad(F.hex(F.substring(F.encode(F.col(column), "UTF-8"), 1, 3)), 6, "0"), 16, 10).cast("bigint"), F.lit(0))
    return F.shiftleft(F.shiftright(first, 12), 12).bitwiseOR(F.pmod(F.xxhash64(column), F.lit(4096)))


def points(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, row, k_lang, k_source, k_length; written, as the
    row numbers must stay as they are."""
    text = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.monotonically_increasing_id().alias("row"))
    tie = F.shiftrightunsigned(F.xxhash64("row"), 64 - TIE_BITS)
    length = F.least(F.floor(F.log2(F.col("size").cast("double")) * (1 << 18)), F.lit((1 << DIM_BITS) - 1))
    dims = {"lang": _name("lang"), "source": _name("source"), "length": length}
    return C.materialize(base.select("doc_id", "size", "text_crc32", "row", *[F.shiftleft(v.cast("bigint"), TIE_BITS).bitwiseOR(tie).alias(f"k_{k}") for k, v in dims.items()]), "points")


def _key() -> Column:
    """A row's key in dimension number `dim`."""
    return F.when(F.col("dim") == 0, F.col(f"k_{DIMENSIONS[0]}")).when(F.col("dim") == 1, F.col(f"k_{DIMENSIONS[1]}")).otherwise(F.col(f"k_{DIMENSIONS[2]}"))


def _table(spark: SparkSession, rows: list[tuple], **types: str) -> DataFrame:
    """A few rows of numbers as a table, by SQL functions alone: one a node."""
    schema = ", ".join(f"{c}: {t}" for c, t in types.items())
    listed = json.dumps([dict(zip(types, r)) for r in rows])
    return F.broadcast(spark.range(1).select(F.inline(F.from_json(F.lit(listed), f"array<struct<{schema}>>"))))


def _medians(rows: DataFrame, nodes: dict[int, tuple[int, int]]) -> dict[int, int]:
    """rows: node, size, k_*; nodes: node -> (dimension, bytes to go left). The
    key from which each node's right side starts."""
    spark, state = rows.sparkSession, {n: (dim, need, 0) for n, (dim, need) in nodes.items()}
    steps = (DIM_BITS + TIE_BITS) // RADIX_BITS
    for step in range(1, steps + 1):
        shift = DIM_BITS + TIE_BITS - RADIX_BITS * step
        asked = _table(spark, [(n, *x) for n, x in state.items()], node="bigint", dim="int", need="bigint", low="bigint")
        keyed = rows.join(asked, "node").select("node", "size", "need", "low", _key().alias("key"))
        bins = keyed.filter(F.shiftright("key", shift + RADIX_BITS) == F.col("low")).groupBy("node", F.shiftright("key", shift).alias("bin")).agg(F.sum("size").alias("bytes"), F.first("need").alias("need"))
        upto = F.sum("bytes").over(W.partitionBy("node").orderBy("bin"))
        # The bin that the median lies in, or the last one.
        placed = bins.withColumn("upto", upto).groupBy("node").agg(F.min(F.when(F.col("upto") > F.col("need"), F.struct("bin", "upto", "bytes"))).alias("hit"), F.max(F.struct("bin", "upto", "bytes")).alias("last"))
        for r in placed.collect():
            dim, need, _ = state[r["node"]]
            here, last = r["hit"] or r["last"], r["hit"] is None
            need -= here["upto"] - here["bytes"]
            # At full length: the side on which the last document misses the median by less.
            state[r["node"]] = (dim, need, here["bin"] + (step == steps and (last or 2 * need > here["bytes"])))
    return {n: low for n, (_, _, low) in state.items()}


def assign(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot. Splits until the leaves reach
    `target_bytes`; or `shards` of them, any number from 1, which is the same
    with that part of all bytes as the target. A node of s leaves gives
    floor(s / 2) of them, and as much of its bytes, to its left side."""
    rows = points(docs)
    spark = rows.sparkSession
    if shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    level, leaves, kids, span = rows.withColumn("node", F.lit(1).cast("bigint")), {1: shards}, set(), {}  # the children of node n are 2n and 2n + 1
    while any(s > 1 for s in leaves.values()):
        widths = [(F.max(f"k_{d}") - F.min(f"k_{d}")).alias(d) for d in DIMENSIONS]
        stats = {r["node"]: r for r in level.groupBy("node").agg(F.sum("size").alias("bytes"), *widths).collect()}  # one row a node
        if not span:
            span = {d: max(1, stats[1][d]) if 1 in stats else 1 for d in DIMENSIONS}
        wanted = {}
        for n, s in leaves.items():
            if s > 1 and n in stats:
                widest = max(range(len(DIMENSIONS)), key=lambda i: stats[n][DIMENSIONS[i]] / span[DIMENSIONS[i]])
                wanted[n] = (widest, stats[n]["bytes"] * (s // 2) // s)
        if wanted:
            starts = _medians(level, wanted)
            splits = _table(spark, [(n, wanted[n][0], start) for n, start in starts.items()], node="bigint", dim="int", start="bigint")
            side = F.when(F.col("start").isNull(), F.col("node")).otherwise(2 * F.col("node") + F.when(_key() < F.col("start"), 0).otherwise(1))
            level = C.materialize(level.join(splits, "node", "left").withColumn("node", side).drop("dim", "start"), "level")
        for n, s in list(leaves.items()):
            if s > 1:
                kids.add(n)
                del leaves[n]
                leaves |= {2 * n: s // 2, 2 * n + 1: s - s // 2}

    def in_order(n: int) -> list[int]:
        return in_order(2 * n) + in_order(2 * n + 1) if n in kids else [n]

    numbers = _table(spark, list(zip(in_order(1), range(shards))), node="bigint", shard="int")
    return _slots(level.join(numbers, "node").select("doc_id", "size", "text_crc32", "row", "shard"))


def _slots(rows: DataFrame) -> DataFrame:
    """Numbers the rows of each shard from 0 without gaps: by hash into parts
    of about SLOT_ROWS rows, a window in each part, and the parts' offsets."""
    parts = F.broadcast(rows.groupBy("shard").agg(F.expr(f"cast(1 + count(*) div {SLOT_ROWS} as int)").alias("parts")))  # one row a shard
    dealt = rows.join(parts, "shard").withColumn("part", F.pmod(F.xxhash64("row"), F.col("parts")).cast("int"))
    sizes = dealt.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = W.partitionBy("shard").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    own = F.row_number().over(W.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size", "row"))
    out = dealt.withColumn("own", own).join(offsets, ["shard", "part"])
    return out.select("doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("own") - 1).cast("bigint").alias("slot"))
