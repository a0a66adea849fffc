"""Words of text without blanks between them: a lexicon that is discovered in the
corpus, and the best path through the lattice of its words.

A string of signs is a word where its parts hold together (cohesion: how much
more often it occurs than its parts would side by side) and where it stands free
(the entropy of what comes before it and behind it)."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: Chinese signs.
RUN = r"[一-鿿]+"
#: Most entries of a lexicon, those with the greatest weight: the bound of its broadcast.
ENTRIES = 500_000


def grams(texts: DataFrame, text: str, longest: int) -> DataFrame:
    """gram, before, behind: every string of 1 to `longest` signs of every run,
    with its neighbours; the end of a run is an empty one. Equal runs are counted
    first: the rows have their number n."""
    runs = texts.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(RUN), F.lit(0))).alias("run")).groupBy("run").agg(F.count("*").alias("n"))
    spans = runs.select("run", "n", F.explode(F.sequence(F.lit(1), F.length("run"))).alias("at")).select("run", "n", "at", F.explode(F.sequence(F.lit(1), F.least(F.lit(longest), F.length("run") - F.col("at") + 1))).alias("k"))
    sign = lambda at: F.when((at >= 1) & (at <= F.length("run")), F.substr(F.col("run"), at, F.lit(1))).otherwise("")
    return spans.select(F.substr(F.col("run"), F.col("at"), F.col("k")).alias("gram"), sign(F.col("at") - 1).alias("before"), sign(F.col("at") + F.col("k")).alias("behind"), "n")


def _entropy(rows: DataFrame, side: str) -> DataFrame:
    """gram, entropy of its neighbours on one side. Each end of a run is a
    neighbour of its own: nothing binds the gram there."""
    counts = rows.groupBy("gram", side).agg(F.sum("n").alias("c"))
    total = F.sum("c").cast("double")
    part = F.when(F.col(side) == "", F.lit(0.0)).otherwise(F.col("c") * F.log(F.col("c").cast("double")))
    # -sum p log p with p = c / total; ends count as c neighbours of one each.
    return counts.groupBy("gram").agg((F.log(total) - F.sum(part) / total).alias(f"{side}_entropy"))


def discover(texts: DataFrame, text: str, longest: int = 4, least: int = 5, cohesion: float = 2.0, entropy: float = 0.8) -> DataFrame:
    """word, n, weight (log of its share): words of two signs or more that occur
    `least` times, whose weakest cut has a log ratio of `cohesion` or more and
    both of whose sides have `entropy` or more; and every single sign."""
    rows = grams(texts, text, longest)
    counts = rows.groupBy("gram").agg(F.sum("n").alias("n"))
    signs = F.broadcast(counts.filter(F.length("gram") == 1).agg(F.sum("n").cast("double").alias("signs")))
    often = counts.filter((F.length("gram") > 1) & (F.col("n") >= least))
    cuts = often.select("gram", "n", F.explode(F.sequence(F.lit(1), F.length("gram") - 1)).alias("k"))
    parts = cuts.select("gram", "n", F.substr("gram", F.lit(1), F.col("k")).alias("a"), F.substr("gram", F.col("k") + 1, F.length("gram")).alias("b"))
    sided = parts.join(counts.select(F.col("gram").alias("a"), F.col("n").alias("n_a")), "a").join(counts.select(F.col("gram").alias("b"), F.col("n").alias("n_b")), "b").join(signs)
    ratio = F.log(F.col("n") * F.col("signs") / (F.col("n_a") * F.col("n_b").cast("double")))
    held = sided.groupBy("gram").agg(F.min(ratio).alias("cohesion")).filter(F.col("cohesion") >= cohesion)
    free = _entropy(rows, "before").join(_entropy(rows, "behind"), "gram").filter((F.col("before_entropy") >= entropy) & (F.col("behind_entropy") >= entropy))
    words = often.join(held, "gram", "left_semi").join(free, "gram", "left_semi")
    both = words.unionByName(counts.filter(F.length("gram") == 1)).join(signs)
    return both.select(F.col("gram").alias("word"), "n", F.log(F.col("n") / F.col("signs")).alias("weight"))


def best_path(run: str, weights: dict[str, float], longest: int, unknown: float) -> list[str]:
    """Words of the run with the greatest sum of weights; of equal sums the one
    with fewer words, then the longer word at the end. A sign that is no entry
    weighs `unknown`."""
    best: list[tuple[float, int, int]] = [(0.0, 0, 0)]  # sum, minus words, length of the last word
    for end in range(1, len(run) + 1):
        ways = []
        for k in range(1, min(longest, end) + 1):
            word = run[end - k : end]
            if word in weights or k == 1:
                total, words, _ = best[end - k]
                ways.append((round(total + weights.get(word, unknown), 9), words - 1, k))
        best.append(max(ways))
    out, end = [], len(run)
    while end:
        k = best[end][2]
        out.append(run[end - k : end])
        end -= k
    return out[::-1]


def segmenter(lexicon: DataFrame, word: str = "word", weight: str = "weight"):
    """A function from a column of runs to their words. The lexicon, cut to its
    ENTRIES weightiest, travels with it."""
    rows = lexicon.select(F.col(word).alias("word"), F.col(weight).cast("double").alias("weight")).filter("word <> '' AND weight IS NOT NULL").orderBy(F.desc("weight"), "word").limit(ENTRIES).collect()
    weights = {r.word: r.weight for r in rows}
    longest = max(map(len, weights), default=1)
    unknown = min(weights.values(), default=0.0) - math.log(2)

    @F.pandas_udf(ArrayType(StringType()))
    def cut(runs: pd.Series) -> pd.Series:
        return runs.map(lambda run: best_path(run, weights, longest, unknown), na_action="ignore")

    return cut


def words(text: Column, cut) -> Column:
    """All words of all Chinese runs of a text, by a `segmenter`."""
    runs = F.regexp_extract_all(text, F.lit(RUN), F.lit(0))
    # A blank, which no run holds, keeps the runs of a text apart on their way.
    return F.when(F.size(runs) > 0, F.filter(cut(F.array_join(runs, " ")), lambda w: w != " ")).otherwise(F.array().cast("array<string>"))
