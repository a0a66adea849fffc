"""Token counts from an exact length histogram.

Documents are aggregated by encoded length: n documents of each length. Sums
over all longer (and all shorter) lengths then answer, for every context limit
at once, how many documents and tokens fit, which quantile the limit is, and
how many tokens remain when texts are truncated to it. The sums run in two
steps, inside blocks of BLOCK lengths and over the blocks' totals, so that no
task gets the whole histogram.

Defined cases: a null or empty text has length 0 and counts as a document;
repeated rows count each; an empty table gives an empty histogram, totals of 0
and null quantiles; other columns are ignored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weftline.llm import _common as C
from weftline.llm import sentencepiece_codec

BLOCK = 128


def histogram(docs: DataFrame, model_path: str) -> DataFrame:
    """tokens (a length), docs (how many have it). Written to the shared folder:
    texts are encoded once, however often the histogram is read."""
    return C.materialize(sentencepiece_codec.lengths(docs, model_path).groupBy("tokens").agg(F.count("*").alias("docs")), "lengths")


def sums(hist: DataFrame) -> DataFrame:
    """One row for each length that occurs, as a context limit: docs; docs_upto
    and tokens_upto of texts that fit; docs_above and tokens_above of those
    that don't; truncated_tokens when all are cut to the limit; total_docs and
    total_tokens."""
    rows = hist.select("tokens", "docs", (F.col("tokens") * F.col("docs")).alias("mass"), F.floor(F.col("tokens") / BLOCK).alias("block"))
    blocks = rows.groupBy("block").agg(F.sum("docs").alias("docs"), F.sum("mass").alias("mass"))
    # One row a block of lengths: one for each BLOCK tokens of the longest text.
    before, all_blocks = W.orderBy("block").rowsBetween(W.unboundedPreceding, -1), W.orderBy("block").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    placed = blocks.select("block", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("docs", "mass")], *[F.sum(c).over(all_blocks).alias(f"{c}_all") for c in ("docs", "mass")])
    inside = W.partitionBy("block").orderBy("tokens").rowsBetween(W.unboundedPreceding, 0)
    joined = rows.select("tokens", "block", "docs", F.sum("docs").over(inside).alias("d"), F.sum("mass").over(inside).alias("m")).join(placed, "block")
    docs_upto, tokens_upto = F.col("d") + F.col("docs_before"), F.col("m") + F.col("mass_before")
    above = F.col("docs_all") - docs_upto
    return joined.select(
        "tokens",
        "docs",
        docs_upto.alias("docs_upto"),
        tokens_upto.alias("tokens_upto"),
        above.alias("docs_above"),
        (F.col("mass_all") - tokens_upto).alias("tokens_above"),
        (tokens_upto + F.col("tokens") * above).alias("truncated_tokens"),
        F.col("docs_all").alias("total_docs"),
        F.col("mass_all").alias("total_tokens"),
    )


def truncated_total(hist: DataFrame, limits: list[int]) -> DataFrame:
    """limit, docs_above, truncated_tokens for any limits, also such as no
    document's length is."""
    spark = hist.sparkSession
    asked = F.broadcast(spark.createDataFrame([(x,) for x in limits], "limit bigint"))
    cut = hist.select("tokens", "docs", F.explode(F.array(*[F.lit(x).cast("bigint") for x in limits])).alias("limit"))
    found = cut.groupBy("limit").agg(F.sum(F.when(F.col("tokens") > F.col("limit"), F.col("docs")).otherwise(0)).alias("docs_above"), F.sum(F.least("tokens", "limit") * F.col("docs")).alias("truncated_tokens"))
    return asked.join(found, "limit", "left").select("limit", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("docs_above", "truncated_tokens")])


def quantiles(hist: DataFrame, shares: list[float]) -> DataFrame:
    """share, tokens: the least length that at least that share of documents
    does not exceed."""
    rows = sums(hist)
    return rows.agg(*[F.min(F.when(F.col("docs_upto") >= F.lit(q) * F.col("total_docs"), F.col("tokens"))).alias(f"q{i}") for i, q in enumerate(shares)]).select(F.inline(F.array(*[F.struct(F.lit(q).alias("share"), F.col(f"q{i}").alias("tokens")) for i, q in enumerate(shares)])))
