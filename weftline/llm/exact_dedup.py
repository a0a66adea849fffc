"""Exact duplicate removal by two passes of a Bloom filter.

Pass 1 hashes every text and counts, cell by cell, how many rows hit a filter
of bounded size; cells hit twice form the filter of possibly repeated hashes.
Pass 2 tests every row against it: rows that miss are unique for certain and
pass straight through, only the others are shuffled and grouped by their full
SHA-256. False positives cost a shuffle of the row and nothing else. Digests
that one filter can't hold are dealt out to ranges, each with a filter of its
own, one after the other; so the share of rows that shuffle does not grow with
their number. DataFrame functions only.

Defined cases: a null text is the empty text, and so equal to it; a null doc_id
sorts after all others; a very long text is hashed as a whole; of rows with equal
text and equal doc_id exactly one stays; an empty table gives an empty result;
further columns are ignored by `find` and carried along by `drop`, whatever
their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm import _common as C


def normalised(text: Column) -> Column:
    """Each run of ASCII white space becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), C.SPACES, " ")


def find(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = C.materialize(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.unhex(F.sha2(normalised(F.col("text").cast("string")), 256)).alias("sha")).withColumn("row", F.monotonically_increasing_id()),
        "digests",
    )
    n = rows.count()
    parts = C.deal_ranges(rows, "sha", n)
    found = [_groups(p, max(1, n // len(parts))) for p in parts]
    if len(found) > 1:
        found = [C.materialize(f, "found") for f in found]
    return C.union_all(found).withColumn("text_sha256", F.lower(F.hex("sha"))).drop("sha")


def _groups(rows: DataFrame, n: int) -> DataFrame:
    """About n rows (doc_id, sha, row) to doc_id, keep_id, group_size, kept, sha."""
    flagged = C.maybe_repeated(rows, "sha", n)
    alone = flagged.filter(~F.col("maybe")).select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"), F.lit(True).alias("kept"), "sha")
    maybe = flagged.filter("maybe").drop("maybe")
    groups = maybe.groupBy("sha").agg(F.count("*").alias("group_size"), F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "row")).alias("first"))
    found = C.lookup(maybe, groups, "sha", "group_size", n)
    return alone.unionByName(found.select("doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "sha"))


def drop(docs: DataFrame) -> DataFrame:
    """The documents that stay, with the columns they came with. Texts travel
    only for rows that may be repeated, and copies shrink to one before the
    shuffle (partial `min_by`)."""
    columns = C.columns_of(docs)
    sha = F.unhex(F.sha2(normalised(F.col("text").cast("string")), 256)).alias("sha")
    digests = C.materialize(docs.select(sha), "digests")
    bits, bitmaps = C.repeated_filter(digests, "sha", digests.count())
    order = F.struct(F.isnull("doc_id"), F.col("doc_id").cast("bigint"), F.xxhash64(*columns)).alias("rank")
    flagged = C.bloom_flag(docs.select(F.struct(*columns).alias("whole"), order, sha), ["sha"], bits, bitmaps, "maybe")
    first = flagged.filter("maybe").groupBy("sha").agg(F.min_by("whole", "rank").alias("whole"))
    return flagged.filter(~F.col("maybe")).select("whole.*").unionByName(first.select("whole.*"))
