"""Votes, means with safe scores, thresholds, histograms, folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.functions import structured as S


def majority_vote(votes: DataFrame, key: str, valid: str, order: str, *fields: str) -> DataFrame:
    """true beats false strictly; null votes abstain but are counted; the first
    true vote gives its order and fields."""
    yes = F.col(valid)
    n_true, n_false = F.count_if(yes), F.count_if(~yes)
    first = [F.min_by(F.when(yes, F.col(f)), F.when(yes, F.col(order))).alias(f) for f in fields]
    return votes.groupBy(key).agg(n_true.alias("n_true"), n_false.alias("n_false"), F.count_if(yes.isNull()).alias("n_error"), (n_true > n_false).alias("is_valid"), F.min(F.when(yes, F.col(order))).alias("first_true"), *first)


def histogram(df: DataFrame, value: Column, name: str) -> DataFrame:
    return df.groupBy(value.alias(name)).agg(F.count("*").alias("n")).orderBy(name)


def max_hop(trace: Column) -> Column:
    return F.array_max(F.transform(trace, lambda t: t["hop_level"]))


def success_score(events: DataFrame, key: str, ok: Column, counted: Column | None = None) -> DataFrame:
    """key, n, n_ok, n_fail, score = (ok + fail / 2) / n over counted rows."""
    rows = events if counted is None else events.filter(counted)
    n_ok, n_fail = F.count_if(ok), F.count_if(~ok)
    return rows.groupBy(key).agg(F.count("*").alias("n"), n_ok.alias("n_ok"), n_fail.alias("n_fail"), ((n_ok + n_fail * 0.5) / (n_ok + n_fail)).alias("score"))


def with_safe_score(all_keys: DataFrame, scores: DataFrame, key: str, score: str, safe: float = 1.0) -> DataFrame:
    """Keys without a score get the safe one."""
    return all_keys.join(scores, key, "left").withColumns({"is_safe": F.when(F.col(score).isNull(), 1).otherwise(0), score: F.coalesce(score, F.lit(safe))})


def mean_score(df: DataFrame, key: str, value: Column, safe: float = 1.0, places: int | None = 3) -> DataFrame:
    """Mean of the values that are numbers, rounded half to even; safe if none."""
    mean = F.avg(F.expr("try_cast(_v AS double)"))
    out = df.withColumn("_v", value.cast("string")).groupBy(key).agg(mean.alias("score"))
    score = F.col("score") if places is None else F.bround("score", places)
    return out.select(key, F.coalesce(score, F.lit(safe)).alias("score"))


def overall(*dimensions: Column, safe: float = 1.0) -> Column:
    """Unweighted mean; a dimension that failed counts as safe."""
    return sum((F.coalesce(d.cast("double"), F.lit(safe)) for d in dimensions), F.lit(0.0)) / len(dimensions)


def membership_score(steps: Column, problems: Column) -> Column:
    """Share of steps that are not among the problems."""
    ok = F.aggregate(steps, F.lit(0.0), lambda a, s: a + F.when(F.array_contains(problems, s), 0.0).otherwise(1.0))
    return F.when(F.size(steps) > 0, ok / F.size(steps))


def entry_mean(entries: DataFrame, record: str, parsed: str, field: str) -> DataFrame:
    """Mean over a parsed object's entries that are objects, without `think`; a
    bad value counts 1. `parsed`: a column of JSON text."""
    exploded = entries.select(record, F.explode_outer(F.from_json(S.whole_json(F.col(parsed)), "map<string,string>")).alias("k", "v"))
    value = F.try_variant_get(F.try_parse_json("v"), f"$.{field}", "double")
    rows = exploded.filter((F.col("k") != "think") & F.col("v").startswith("{"))
    return entries.select(record).distinct().join(rows.groupBy(record).agg(F.avg(F.coalesce(value, F.lit(1.0))).alias("score")), record, "left").select(record, F.coalesce("score", F.lit(1.0)).alias("score"))


def quality_total(*ratings: Column) -> tuple[Column, Column]:
    """(sum, sum / n) of ratings; null if one is missing."""
    total = sum(ratings[1:], ratings[0])
    return total, total / F.lit(float(len(ratings)))


#: Bins of one pass, and values that are put in order at the end.
BINS, FEW = 4096, 4096


def order_statistic(df: DataFrame, value: str, rank: int) -> float | None:
    """The exact value at a rank (from 0) among the numbers that are not null,
    NaN last. Each pass counts the values of BINS equal bins of what is left and
    goes on in the bin that has the rank, between its least and greatest value; a
    pass moves BINS sums a task, whatever the rows are."""
    rows = df.select(F.col(value).cast("double").alias("v")).filter("v IS NOT NULL")
    infinite = float("inf")
    plain = rows.filter(F.abs("v") < infinite)
    least, n, most, nan = rows.agg(F.count_if(F.col("v") == -infinite), F.count_if(F.abs("v") < infinite), F.count_if(F.col("v") == infinite), F.count_if(F.isnan("v"))).first()
    for special, times in ((-infinite, least), (None, n), (infinite, most), (float("nan"), nan)):
        if rank < times:
            break
        rank -= times
    else:
        return None
    if special is not None:
        return special
    low, high = plain.agg(F.min("v"), F.max("v")).first()
    while low < high:
        inside = plain.filter(F.col("v").between(low, high))
        if n <= FEW:
            return sorted(r.v for r in inside.collect())[rank]
        half = 0.5 if high - low == infinite else 1.0
        share = (F.col("v") * half - low * half) / F.lit(high * half - low * half)
        bins = inside.groupBy(F.least(F.floor(share * BINS), F.lit(BINS - 1)).alias("bin")).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        for b in sorted(bins.collect()):
            if rank < b.n:
                n, low, high = b.n, b.low, b.high
                break
            rank -= b.n
    return low


def above_percentile(df: DataFrame, score: str, q: float = 0.9) -> DataFrame:
    """Rows from the exact q-quantile (linear interpolation) up."""
    total = df.agg(F.count(score)).first()[0]
    if not total:
        return df.limit(0).withColumn("threshold", F.col(score).cast("double"))
    at = q * (total - 1)
    a = order_statistic(df, score, int(at))
    b = a
    if at != int(at):
        value = F.col(score).cast("double")
        upto, above = df.agg(F.count_if(value <= a), F.min(F.when(value > a, value))).first()
        b = a if upto > int(at) + 1 or above is None else above
    threshold = a if a == b else (int(at) + 1 - at) * a + (at - int(at)) * b
    return df.withColumn("threshold", F.lit(threshold)).filter(F.col(score) >= F.col("threshold"))


def best_attempt(attempts: DataFrame, key: str, attempt: str, test: str, status: str) -> DataFrame:
    """Per attempt the passed tests; the best attempt has most, the latest of
    equals; whether all passed, and whether any test ran."""
    per = attempts.groupBy(key, attempt).agg(F.count_if(F.col(status) == "passed").alias("passed"), F.count(test).alias("tests"), F.bool_and(F.col(status) == "passed").alias("all_passed"))
    best = per.groupBy(key).agg(F.max_by(F.struct(attempt, "passed", "tests", "all_passed"), F.struct("passed", attempt)).alias("b"), F.bool_or(F.col("tests") > 0).alias("has_test"), F.count("*").alias("attempts"))
    return best.select(key, "b.*", "has_test", "attempts")


def concat_in_order(df: DataFrame, key: str, order: str, text: str, separator: str = "\n\n") -> DataFrame:
    """Texts that are not empty, by key, joined in order."""
    rows = df.filter(F.coalesce(F.col(text), F.lit("")) != "")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))), lambda x: x["t"]), separator)
    return rows.groupBy(key).agg(joined.alias(text))


def kv_fold(log: DataFrame, key: str, order: str, op: str, value: str) -> DataFrame:
    """The last put or update of each key, unless a delete follows."""
    last = F.max_by(F.struct(op, value), order).alias("last")
    return log.groupBy(key).agg(last).filter(F.col(f"last.{op}") != "delete").select(key, F.col(f"last.{value}").alias(value))


def stage_counters(df: DataFrame, name: str, ok: Column):
    """(df, observation): successes and total, filled when df is consumed."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return df.observe(seen, F.count("*").alias("total"), F.count_if(ok).alias("success")), seen
