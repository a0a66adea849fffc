"""Projections and gates of records, over rows shaped like tools and steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.operators import joins, records
from weftline.plans.registry import query


def _tools(t):
    """Regions as servers, nations as their tools."""
    tool = F.struct(F.col("n_name").alias("name"), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("code "), F.col("n_nationkey").cast("string"))).otherwise("").alias("description"))
    return t("nation").groupBy("n_regionkey").agg(F.array_sort(F.collect_list(F.struct("n_nationkey", tool.alias("t")))).alias("x")).select("n_regionkey", F.transform("x", lambda x: x["t"]).alias("tools"))


@query("""
    SELECT n_regionkey, string_agg(i || '. **' || n_name || '**: ' || d, chr(10) ORDER BY n_nationkey) AS numbered, string_agg('- ' || n_name || CASE WHEN d <> '' THEN ': ' || d ELSE '' END, chr(10) ORDER BY n_nationkey) AS blocks,
           string_agg(i || '. ' || n_name || ': ' || CASE WHEN d <> '' THEN d ELSE '(no description)' END, chr(10) ORDER BY n_nationkey) AS described
    FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS i, CASE WHEN n_nationkey % 2 = 0 THEN 'code ' || n_nationkey ELSE '' END AS d FROM nation) GROUP BY 1
""")
def tool_rendering(t):
    tools = F.col("tools")
    return _tools(t).select("n_regionkey", records.numbered_tools(tools).alias("numbered"), records.tool_blocks(tools).alias("blocks"), joins.describe_tools(F.transform(tools, lambda x: x["name"]), tools).alias("described"))


@query("""
    SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN source ELSE lang END AS question, TRUE AS kept FROM documents WHERE n_chars >= 500 AND doc_id % 5 <> 0
""")
def effective_question_gate(t):
    rows = t("documents").select("doc_id", "n_chars", records.effective_question(F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("<q>"), "source", F.lit("</q>"))).otherwise(""), F.col("lang")).alias("question"), F.when(F.col("doc_id") % 5 == 0, False).alias("legit"))
    return records.score_gate(rows, "n_chars", "legit", 500).select("doc_id", "question", F.lit(True).alias("kept"))


@query("""
    SELECT p_partkey, p_partkey % 4 = 0 AS ok, p_partkey % 4 <> 1 AS arguments_ok FROM part
""")
def tool_schema_checks(t):
    schema = lambda required, extra="": '{"name": "f", "description": "d", "parameters": {"type": "object", "properties": {"a": {"type": "string"}}, "required": ["' + required + '"]' + extra + "}}"
    k = F.col("p_partkey") % 4
    text = F.when(k == 0, schema("a")).when(k == 1, schema("b")).when(k == 2, schema("a", ', "more": 1')).otherwise('{"name": "f"}')
    parameters = F.when(k == 1, '{"required": ["b"]}').when(k == 2, '{"required": ["a"]}').otherwise("{}")
    return t("part").select("p_partkey", records.tool_schema_ok(text).alias("ok"), records.arguments_ok(parameters, F.lit('{"a": 1}')).alias("arguments_ok"))


@query("""
    SELECT c_custkey, lower(replace(c_mktsegment, '_', ' ')) AS occupation, CASE WHEN length(repeat(c_name, 20)) > 200 THEN substr(repeat(c_name, 20), 1, 200) || '...' ELSE repeat(c_name, 20) END AS persona, 'a, b, c, d, e' AS skills FROM customer
""")
def persona_fields(t):
    letters = F.array(*map(F.lit, "abcdefg"))
    row = records.persona({"age": F.lit(30), "occupation": F.col("c_mktsegment"), "education_level": F.lit("high_school"), "professional_persona": F.repeat("c_name", 20), "skills_and_expertise_list": letters, "hobbies_and_interests_list": letters})
    return t("customer").withColumn("p", row).select("c_custkey", F.lower("p.occupation").alias("occupation"), F.col("p.professional_persona").alias("persona"), F.col("p.skills").alias("skills"))


@query("""
    SELECT r_name, '|n_name|n_nationkey|' || chr(10) || '|---|---|' || chr(10) || string_agg('|' || n_name || '|' || n_nationkey || '|', chr(10) ORDER BY n_nationkey) AS markdown
    FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1
""")
def markdown_table(t):
    rows = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("r_name", "n_name", "n_nationkey", F.col("n_nationkey").alias("o"))
    return records.frame_as_markdown(rows, "o", ["r_name"])


@query("""
    SELECT o_orderkey, lpad((row_number() OVER (ORDER BY o_orderkey) - 1)::VARCHAR, 8, '0') AS prompt_id, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_id, 'score' AS task_type FROM orders
""")
def row_ids(t):
    return records.row_ids(t("orders").select("o_orderkey"), "o_orderkey", "score", "orders").select("o_orderkey", "prompt_id", "row_id", "task_type")


@query("""
    SELECT l_orderkey, string_agg('Call: ' || l_returnflag || '(' || l_linenumber || ') -> ' || l_linestatus, chr(10) ORDER BY i) AS history
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag, l_linestatus) AS i, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem) WHERE i > n - 5 GROUP BY 1
""")
def call_history(t):
    calls = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_returnflag", "l_linestatus"))), lambda x: F.struct(x["l_returnflag"].alias("name"), x["l_linenumber"].cast("string").alias("arguments"), x["l_linestatus"].alias("result")))
    return t("lineitem").groupBy("l_orderkey").agg(calls.alias("c")).select("l_orderkey", records.history(F.col("c")).alias("history"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE c_mktsegment END AS name, c_custkey % 3 = 0 AS one FROM customer")
def first_name_and_exclusivity(t):
    return t("customer").select("c_custkey", records.display_name(F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise(""), F.col("c_mktsegment")).alias("name"), records.exactly_one(F.col("c_name"), F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment"))).alias("one"))


@query("""
    SELECT l_orderkey, count(*) FILTER (l_quantity > 10) AS needed, '{"id":' || l_orderkey || CASE WHEN count(*) > 3 THEN ',"hops":' || count(*) ELSE '' END || '}' AS metadata FROM lineitem GROUP BY 1
""")
def needed_steps_metadata(t):
    grouped = t("lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct((F.col("l_quantity") > 10).alias("tool_necessity"))).alias("trace"))
    meta = records.metadata(id=F.col("l_orderkey"), hops=F.when(F.size("trace") > 3, F.size("trace")))
    return grouped.select("l_orderkey", F.size(records.needed_steps(F.col("trace"))).cast("bigint").alias("needed"), meta.alias("metadata"))
