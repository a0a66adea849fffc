"""Joins that hide in record loops: by step id, by position, by name, by call
id, nearest before, resume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.operators import scan


def dependencies(steps: DataFrame, record: str = "uuid", step: str = "_uuid", needs: str = "dependency") -> DataFrame:
    """Each step's dependencies that exist, in their listed order: record, step,
    position, and the referenced step's columns prefixed dep_."""
    listed = steps.select(record, step, F.posexplode(needs).alias("position", "dep_id"))
    target = steps.select(F.col(record), *[F.col(c).alias(f"dep_{c}") for c in steps.columns if c != record])
    return listed.join(target, (listed[record] == target[record]) & (F.col("dep_id") == F.col(f"dep_{step}"))).drop(target[record])


def by_position(trace: Column, needs: Column) -> Column:
    """The d-th (from 1) element for each d; null for 0 and what is outside."""
    return F.transform(needs, lambda d: F.when(d > 0, F.try_element_at(trace, d.cast("int"))))


def by_map_key(environments: Column, ids: Column) -> Column:
    """Entries of a string-keyed map for ids of any kind; missing ones go."""
    return F.filter(F.transform(ids, lambda i: F.struct(i.cast("string").alias("id"), F.try_element_at(environments, i.cast("string")).alias("env"))), lambda x: x["env"].isNotNull())


def describe_tools(targets: Column, tools: Column) -> Column:
    """Numbered lines `i. name: description`, by name; a default where a tool is
    unknown or has no description."""
    known = F.map_from_entries(F.transform(tools, lambda t: F.struct(t["name"].alias("key"), t["description"].alias("value"))))
    line = lambda n, i: F.concat((i + 1).cast("string"), F.lit(". "), n, F.lit(": "), F.coalesce(F.nullif(F.try_element_at(known, n), F.lit("")), F.lit("(no description)")))
    return F.array_join(F.transform(targets, line), "\n")


def results_with_calls(results: DataFrame, calls: DataFrame, record: str, call: str, order: str, name: str) -> DataFrame:
    """Tool results left-joined to their calls by id; the last definition of an
    id wins; without a match the name is null."""
    last = calls.groupBy(record, call).agg(F.max_by(name, order).alias(name))
    return results.join(last, [record, call], "left")


def nearest_before(rows: DataFrame, record: str, name: str, order: str, is_call: Column, value: str, alias: str) -> DataFrame:
    """As-of match: for each row the `value` of the latest earlier call of the
    same record and name. One scan; no join of rows with rows."""
    return scan.ordered(rows, [record, name], [order]).scan(**{alias: scan.last_before(F.when(is_call, F.col(value)))}).plain()


def zip_equal(calls: Column, results: Column) -> Column:
    """i-th call with i-th result; empty where their numbers differ."""
    return F.when(F.size(calls) == F.size(results), F.zip_with(calls, results, lambda a, b: F.struct(a.alias("call"), b.alias("result")))).otherwise(F.expr("array()").cast("array<struct<call:string,result:string>>"))


def resume(todo: DataFrame, done: DataFrame, *keys: str) -> DataFrame:
    """What is not done yet, by key. A null key is never done."""
    return todo.join(done.select(*keys).distinct(), list(keys), "left_anti")


def resume_by(todo: DataFrame, done: DataFrame, key_of_todo: Column, key_of_done: Column) -> DataFrame:
    """The same with keys that both sides compute."""
    keys = done.select(key_of_done.alias("_done")).distinct()
    return todo.withColumn("_key", key_of_todo).join(keys, F.col("_key") == F.col("_done"), "left_anti").drop("_key")


def aligned(ids: Column, results: Column) -> Column:
    """Result i carries id i, and there are as many."""
    return (F.size(ids) == F.size(results)) & F.forall(F.zip_with(ids, results, lambda a, b: a.eqNullSafe(b)), lambda x: x)


def legitimacy(steps: DataFrame, record: str, step: str, needs: str, necessary: str) -> DataFrame:
    """record, legitimate: every step that another depends on is necessary."""
    used = steps.select(F.col(record).alias("_r"), F.explode(needs).alias("_d")).distinct()
    inner = steps.join(used, (F.col(record) == F.col("_r")) & (F.col(step) == F.col("_d")), "left_semi")
    bad = inner.filter(~F.coalesce(F.col(necessary), F.lit(False))).select(record).distinct().withColumn("_bad", F.lit(True))
    return steps.select(record).distinct().join(bad, record, "left").select(record, F.col("_bad").isNull().alias("legitimate"))


def missing_url(text: Column, urls: Column) -> Column:
    """The first URL that the text does not hold; null if it holds all."""
    return F.try_element_at(F.filter(urls, lambda u: ~text.contains(u)), F.lit(1))


def mentioned(message: Column, names: list[str]) -> Column:
    """Names that follow an @, in order, each once; of several that fit, the
    first listed."""
    parts = F.slice(F.split(message, "@"), 2, 1_000_000)
    first = lambda p: F.coalesce(*[F.when(p.startswith(n), n) for n in names])
    return F.array_distinct(F.filter(F.transform(parts, first), lambda x: x.isNotNull()))


def overlay(base: DataFrame, config: DataFrame, key: str) -> DataFrame:
    """Configured values win over a server's own, column by column."""
    other = config.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_{c}") for c in config.columns if c != key])
    joined = base.join(other, F.col(key) == F.col("_k"), "left")
    return joined.select(*[F.coalesce(f"_{c}", c).alias(c) if c != key and c in config.columns else F.col(c) for c in base.columns])


def merged_results(records: DataFrame, merged: DataFrame) -> DataFrame:
    """records: uuid, envs (map), clusters (uuid lists); merged: uuid, members
    (JSON of the list), status, code. Writes a passed cluster's code over its
    members; a record with any cluster that did not pass is dropped."""
    wanted = records.select("uuid", F.explode_outer("clusters").alias("members"))
    found = wanted.join(merged.withColumnRenamed("members", "_m"), (wanted["uuid"] == merged["uuid"]) & (F.to_json("members") == F.col("_m")), "left").drop(merged["uuid"])
    ok = F.bool_and(F.col("members").isNull() | (F.coalesce("status", F.lit("")) == "passed"))
    entries = F.flatten(F.collect_list(F.transform("members", lambda m: F.struct(m.cast("string").alias("key"), F.col("code").alias("value")))))
    new = found.groupBy("uuid").agg(ok.alias("_ok"), entries.alias("_new")).filter("_ok")
    written = records.join(new.withColumn("_new", F.map_from_entries("_new")), "uuid")
    kept = F.map_filter("envs", lambda k, _: ~F.array_contains(F.map_keys("_new"), k))
    return written.select("uuid", F.map_concat(kept, "_new").alias("envs"), "clusters")
