"""Scores, votes, thresholds, joins of calls and results."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weftline.functions import structured as S
from weftline.functions import text as T
from weftline.models import provider
from weftline.operators import joins, scores
from weftline.plans.registry import query


@query("""
    SELECT user_id, count(*) AS n, count(*) FILTER (event_type <> 'error') AS n_ok,
           count(*) FILTER (event_type = 'error') AS n_fail,
           (count(*) FILTER (event_type <> 'error') + 0.5::DOUBLE * count(*) FILTER (event_type = 'error')) / count(*) AS score
    FROM events GROUP BY user_id
""")
def tool_call_success_score(t):
    return scores.success_score(t("events"), "user_id", F.col("event_type") != "error")


@query("""
    WITH s AS (SELECT user_id, avg(CASE WHEN event_type = 'error' THEN 0.5::DOUBLE ELSE 1 END) AS s FROM events GROUP BY 1)
    SELECT c_custkey AS user_id, coalesce(s, 1.0) AS score, (s IS NULL)::INT AS is_safe
    FROM customer LEFT JOIN s ON user_id = c_custkey
""")
def safe_score_left_join(t):
    found = scores.success_score(t("events"), "user_id", F.col("event_type") != "error").select("user_id", "score")
    return scores.with_safe_score(t("customer").select(F.col("c_custkey").alias("user_id")), found, "user_id", "score")


@query("""
    SELECT d.doc_id, round((coalesce(quality, 1) + coalesce(1 - toxic, 1) + CASE WHEN n_chars > 200 THEN 1 ELSE 0 END) / 3.0::DOUBLE, 9) AS score
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def overall_score_mean(t):
    rows = t("documents").join(t("labels"), "doc_id", "left")
    score = scores.overall(F.col("quality"), 1 - F.col("toxic"), F.when(F.col("n_chars") > 200, 1).otherwise(0))
    return rows.select("doc_id", F.round(score, 9).alias("score"))


@query("""
    WITH r AS (SELECT p_partkey, 1 + p_size % 5 AS a, 1 + (p_size // 5) % 5 AS b, 1 + p_partkey % 5 AS c, 1 + (p_partkey // 5) % 5 AS d FROM part)
    SELECT p_partkey, (a + b + c + d)::BIGINT AS total_score, (a + b + c + d) / 4.0::DOUBLE AS average_score FROM r
""")
def quality_total_average(t):
    levels = lambda d, x: F.element_at(F.array(*map(F.lit, T.RATINGS[d])), (x % 5 + 1).cast("int"))
    names = list(T.RATINGS)
    rows = t("part").select("p_partkey", *[levels(d, x).alias(d) for d, x in zip(names, (F.col("p_size"), F.expr("p_size div 5"), F.col("p_partkey"), F.expr("p_partkey div 5")))])
    total, average = scores.quality_total(*[T.rating(F.col(d), d) for d in names])
    return rows.select("p_partkey", total.cast("bigint").alias("total_score"), average.alias("average_score"))


@query("""
    WITH t AS (SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN ' Very Hard ' WHEN 1 THEN 'rather hard' WHEN 2 THEN 'medium' WHEN 3 THEN 'v'
               WHEN 4 THEN '' WHEN 5 THEN 'impossible' END AS s FROM part)
    SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 5 WHEN 1 THEN 4 WHEN 2 THEN 3 WHEN 3 THEN 1 END AS rating FROM t
""")
def rating_partial_match(t):
    k = F.col("p_partkey") % 7
    text = F.when(k == 0, " Very Hard ").when(k == 1, "rather hard").when(k == 2, "medium").when(k == 3, "v").when(k == 4, "").when(k == 5, "impossible")
    return t("part").select("p_partkey", T.rating(text, "tool_selection_difficulty").alias("rating"))


@query("""
    SELECT source, count(*) FILTER (quality = 1) AS n_true, count(*) FILTER (quality = 0) AS n_false,
           count(*) FILTER (quality IS NULL) AS n_error, count(*) FILTER (quality = 1) > count(*) FILTER (quality = 0) AS is_valid,
           min(doc_id) FILTER (quality = 1) AS first_true, arg_min(text, doc_id) FILTER (quality = 1) AS text
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source
""")
def majority_vote(t):
    votes = t("documents").join(t("labels"), "doc_id", "left").withColumn("ok", F.col("quality") == 1)
    return scores.majority_vote(votes, "source", "ok", "doc_id", "text")


@query("""
    SELECT source, count(*) FILTER (quality = 1) > count(*) FILTER (quality = 0) AND count(*) FILTER (toxic = 0) > count(*) FILTER (toxic = 1) AS is_valid
    FROM documents JOIN labels USING (doc_id) GROUP BY source
""")
def cross_model_vote(t):
    """Two models: one judges quality, the other toxicity; both must say valid."""
    rows = t("documents").join(t("labels"), "doc_id")
    one = provider.cross_model(rows.select("source", (F.col("quality") == 1).alias("is_valid")), "source")
    other = provider.cross_model(rows.select("source", (F.col("toxic") == 0).alias("is_valid")), "source")
    both = one.unionByName(other).groupBy("source").agg(F.bool_and("is_valid").alias("is_valid"))
    return both


@query("""
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice >= (SELECT quantile_cont(o_totalprice, 0.9) FROM orders)
""")
def p90_threshold_filter(t):
    return scores.above_percentile(t("orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 0.9).drop("threshold")


@query("""
    WITH e AS (SELECT *, max(event_id) FILTER (event_type = 'click') OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS click_id FROM events)
    SELECT event_id, click_id FROM e WHERE event_type = 'purchase'
""")
def asof_tool_match(t):
    rows = joins.nearest_before(t("events").withColumn("all", F.lit(0)), "user_id", "all", "event_id", F.col("event_type") == "click", "event_id", "click_id")
    return rows.filter("event_type = 'purchase'").select("event_id", "click_id")


@query("""
    WITH c AS (SELECT l_orderkey, arg_max(l_returnflag, l_partkey * 1000000 + l_suppkey * 10 + l_linenumber) AS fn FROM lineitem GROUP BY 1)
    SELECT o_orderkey, fn FROM orders LEFT JOIN c ON l_orderkey = o_orderkey
""")
def call_result_join(t):
    calls = t("lineitem").select(F.lit(0).alias("r"), F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("fn"), (F.col("l_partkey") * 1000000 + F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("idx"))
    return joins.results_with_calls(t("orders").select(F.lit(0).alias("r"), "o_orderkey"), calls, "r", "o_orderkey", "idx", "fn").select("o_orderkey", "fn")


def _steps(t):
    """Order lines as steps 1..n; each depends on the one before, every third
    also on step 1 and on one that is not there."""
    w = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    rows = t("lineitem").select("l_orderkey", "l_quantity", F.row_number().over(w).alias("step"))
    needs = F.when(F.col("step") == 1, F.array().cast("array<int>")).when(F.col("step") % 3 == 0, F.array(F.col("step") - 1, F.lit(1), F.lit(99))).otherwise(F.array(F.col("step") - 1))
    return rows.withColumn("needs", needs)


_STEPS = """
    s AS (SELECT l_orderkey, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS step FROM lineitem),
    d AS (SELECT l_orderkey, step, 0 AS position, step - 1 AS dep FROM s WHERE step > 1
          UNION ALL SELECT l_orderkey, step, 1, 1 FROM s WHERE step % 3 = 0)
"""


@query(f"""
    WITH {_STEPS}
    SELECT d.l_orderkey, d.step::INT AS step, d.position::INT AS position, d.dep::INT AS dep_step, s.l_quantity AS dep_quantity
    FROM d JOIN s ON s.l_orderkey = d.l_orderkey AND s.step = d.dep
""")
def dependency_self_join(t):
    found = joins.dependencies(_steps(t), "l_orderkey", "step", "needs")
    return found.select("l_orderkey", "step", "position", "dep_step", F.col("dep_l_quantity").alias("dep_quantity"))


@query(f"""
    WITH {_STEPS}
    SELECT l_orderkey, count(*) AS steps, round(sum(coalesce(prev, -1)), 6) AS total
    FROM (SELECT l_orderkey, lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY step) AS prev FROM s) GROUP BY 1
""")
def positional_dependency(t):
    grouped = _steps(t).groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("step", "l_quantity"))).alias("trace"))
    before = joins.by_position(F.col("trace"), F.transform(F.col("trace"), lambda x: x["step"] - 1))
    total = F.aggregate(before, F.lit(0.0), lambda a, x: a + F.coalesce(x["l_quantity"], F.lit(-1.0)))
    return grouped.select("l_orderkey", F.size("trace").cast("bigint").alias("steps"), F.round(total, 6).alias("total"))


@query(f"""
    WITH {_STEPS}
    SELECT s.l_orderkey, bool_and(l_quantity > 5 OR NOT EXISTS (SELECT 1 FROM d WHERE d.l_orderkey = s.l_orderkey AND d.dep = s.step)) AS legitimate
    FROM s GROUP BY 1
""")
def nonleaf_legitimacy(t):
    return joins.legitimacy(_steps(t).withColumn("necessary", F.col("l_quantity") > 5), "l_orderkey", "step", "needs", "necessary")


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def resume_anti_join(t):
    return joins.resume(t("documents").select("doc_id", "lang"), t("labels"), "doc_id")


@query("SELECT conv_id, turn FROM conversations c WHERE NOT EXISTS (SELECT 1 FROM benchmark b WHERE lower(trim(b.text)) = lower(trim(c.text)))")
def resume_by_derived_key(t):
    key = F.lower(F.trim("text"))
    return joins.resume_by(t("conversations").select("conv_id", "turn", "text"), t("benchmark"), key, key).select("conv_id", "turn")


@query("""
    SELECT l_orderkey, bool_and(l_quantity > 1 AND l_tax >= 0 AND l_returnflag <> '' AND contains(l_returnflag || l_linestatus, l_linestatus) AND l_discount < 0.1) AS ok
    FROM lineitem GROUP BY l_orderkey
""")
def env_gate(t):
    ok = (F.col("l_quantity") > 1) & (F.col("l_tax") >= 0) & (F.col("l_returnflag") != "") & F.concat("l_returnflag", "l_linestatus").contains(F.col("l_linestatus")) & (F.col("l_discount") < 0.1)
    return t("lineitem").groupBy("l_orderkey").agg(F.bool_and(ok).alias("ok"))


@query("""
    WITH a AS (SELECT l_orderkey AS cluster_id, l_linenumber AS attempt, count(*) FILTER (l_returnflag = 'N') AS passed, count(*) AS tests, bool_and(l_returnflag = 'N') AS all_passed FROM lineitem GROUP BY 1, 2)
    SELECT cluster_id, max(tests) > 0 AS has_test, count(*) AS attempts, arg_max(attempt, passed * 100 + attempt) AS attempt,
           arg_max(passed, passed * 100 + attempt) AS passed, arg_max(tests, passed * 100 + attempt) AS tests, arg_max(all_passed, passed * 100 + attempt) AS all_passed
    FROM a GROUP BY 1
""")
def best_attempt(t):
    rows = t("lineitem").select(F.col("l_orderkey").alias("cluster_id"), F.col("l_linenumber").alias("attempt"), F.col("l_partkey").alias("test"), F.when(F.col("l_returnflag") == "N", "passed").otherwise("failed").alias("status"))
    return scores.best_attempt(rows, "cluster_id", "attempt", "test", "status")


@query("""
    WITH m AS (SELECT user_id, avg(try_cast(json_extract_string(props, '$.k') AS DOUBLE)) FILTER (event_type <> 'view') AS m FROM events GROUP BY 1)
    SELECT user_id, round(coalesce(m, 1.0), 2) AS score FROM m
""")
def mean_numeric_score(t):
    value = F.when(F.col("event_type") != "view", F.get_json_object("props", "$.k")).otherwise("not a number")
    return scores.mean_score(t("events"), "user_id", value, places=None).withColumn("score", F.round("score", 2))


@query("""
    SELECT o_orderkey, CASE WHEN n > 0 THEN round(ok / n, 9) END AS score FROM (
        SELECT o_orderkey, count(l_orderkey) AS n, count(*) FILTER (l_linenumber NOT IN (2, 5))::DOUBLE AS ok
        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1)
""")
def forced_serialization_score(t):
    rows = t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy("o_orderkey").agg(F.collect_list("l_linenumber").alias("steps"))
    return rows.select("o_orderkey", F.round(scores.membership_score(F.col("steps"), F.array(F.lit(2), F.lit(5))), 9).alias("score"))


@query("SELECT len::INT AS max_hop, count(*) AS n FROM (SELECT l_orderkey, max(l_linenumber) AS len FROM lineitem GROUP BY 1) GROUP BY 1")
def hop_histogram(t):
    traces = t("lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_linenumber").alias("hop_level"))).alias("trace"))
    return scores.histogram(traces, scores.max_hop(F.col("trace")), "max_hop")


@query("""
    SELECT user_id, event_type AS key, arg_max(value, event_id) AS value FROM events
    GROUP BY user_id, event_type HAVING arg_max(value, event_id) > 5
""")
def kv_fold(t):
    log = t("events").select(F.struct("user_id", "event_type").alias("k"), "event_id", F.when(F.col("value") > 5, "put").otherwise("delete").alias("op"), "value")
    return scores.kv_fold(log, "k", "event_id", "op", "value").select("k.user_id", F.col("k.event_type").alias("key"), "value")


@query("SELECT conv_id, string_agg(text, '\n\n' ORDER BY turn) AS text FROM conversations WHERE role = 'assistant' AND text <> '' GROUP BY 1")
def answers_in_order(t):
    return scores.concat_in_order(t("conversations").filter("role = 'assistant'"), "conv_id", "turn", "text")


@query("SELECT source, count(DISTINCT lang) AS langs, mode(lang) AS most FROM documents GROUP BY 1 HAVING count(*) FILTER (lang = 'en') > count(*) / 2")
def most_common_value(t):
    rows = t("documents").groupBy("source").agg(F.size(F.filter(F.collect_set("lang"), lambda x: x != "")).cast("bigint").alias("langs"), F.mode("lang").alias("most"), F.count_if(F.col("lang") == "en").alias("en"), F.count("*").alias("n"))
    return rows.filter("en > n / 2").select("source", "langs", "most")


@query("SELECT c_custkey, coalesce(n_name, 'none') AS n_name, CASE WHEN n_name IS NULL THEN 'no code for ' || c_name END AS error FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey < 3")
def dimension_lookup(t):
    codes = t("nation").filter("n_regionkey < 3").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    found = t("customer").join(codes, "c_nationkey", "left")
    return found.select("c_custkey", F.coalesce("n_name", F.lit("none")).alias("n_name"), F.when(F.col("n_name").isNull(), F.concat(F.lit("no code for "), "c_name")).alias("error"))


@query("SELECT s_suppkey, coalesce(c_name, s_name) AS name, s_acctbal FROM supplier LEFT JOIN customer ON c_custkey = s_suppkey AND c_custkey % 3 = 0")
def config_overlay(t):
    config = t("customer").filter("c_custkey % 3 = 0").select(F.col("c_custkey").alias("s_suppkey"), F.col("c_name").alias("name"))
    return joins.overlay(t("supplier").select("s_suppkey", F.col("s_name").alias("name"), "s_acctbal"), config, "s_suppkey")


@query("SELECT count(*) AS total, count(*) FILTER (o_orderstatus = 'F') AS success FROM orders")
def stage_counters(t):
    return t("orders").agg(F.count("*").alias("total"), F.count_if(F.col("o_orderstatus") == "F").alias("success"))


@query("""
    WITH m AS (SELECT l_orderkey, list(l_linenumber ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS a, list(l_partkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS b FROM lineitem GROUP BY 1)
    SELECT l_orderkey, len(a)::INT AS n, list_sum(a)::BIGINT AS calls, list_sum(b)::BIGINT AS results FROM m
""")
def positional_zip(t):
    order = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")))
    rows = t("lineitem").groupBy("l_orderkey").agg(order.alias("x"))
    zipped = joins.zip_equal(F.transform("x", lambda x: x["l_linenumber"].cast("string")), F.transform("x", lambda x: x["l_partkey"].cast("string")))
    add = lambda field: F.aggregate(zipped, F.lit(0).cast("bigint"), lambda a, z: a + z[field].cast("bigint"))
    return rows.select("l_orderkey", F.size(zipped).alias("n"), add("call").alias("calls"), add("result").alias("results"))
