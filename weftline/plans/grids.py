"""Prompt grids, unions, variations, taxonomies."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import structured as S
from weftline.operators import generators
from weftline.plans.registry import query


@query("""
    SELECT n_name, lang, rep::INT AS rep FROM nation, (VALUES ('en'), ('zh')) l(lang), range(1, 10) r(rep)
    WHERE rep <= CASE WHEN n_nationkey % 3 = 0 THEN n_regionkey ELSE 2 END
""")
def prompt_grid(t):
    weights = t("nation").filter("n_nationkey % 3 = 0").select("n_nationkey", F.col("n_regionkey").alias("n"))
    return generators.prompt_grid(t("nation"), ["en", "zh"], weights, 2, "n_nationkey").select("n_name", "lang", F.col("repeat").alias("rep"))


@query("SELECT r_name, hops::INT AS num_hops, rep::INT AS rep FROM region, range(2, 6) h(hops), range(1, 4) r(rep)")
def hop_grid(t):
    return generators.hop_grid(t("region"), 2, 5, 3).select("r_name", "num_hops", F.col("repeat").alias("rep"))


@query("""
    SELECT s_suppkey, mode, sample::INT AS sample, TRUE AS has_persona FROM supplier, (VALUES ('diverse'), ('complicate'), ('persona')) m(mode), range(1, 3) s(sample)
""")
def augmentation_grid(t):
    personas = t("region").select(F.col("r_regionkey").alias("row_id"), F.col("r_name").alias("persona"))
    grid = generators.augmentation_grid(t("supplier").select("s_suppkey"), ["diverse", "complicate", "persona"], personas, 2, "s_suppkey")
    return grid.select("s_suppkey", "mode", "sample", F.col("persona").isNotNull().alias("has_persona"))


@query("""
    SELECT doc_id, v::INT AS variant, CASE v WHEN 0 THEN text WHEN 1 THEN 'en ' || lang ELSE 'src ' || source END AS question FROM documents, range(0, 3) r(v)
""")
def union_with_variations(t):
    reply = F.concat(F.lit("<response><VARIATION_1 id='1'><question><!-- note -->en "), "lang", F.lit("</question></VARIATION_1><variation_2><question>src "), "source", F.lit("</question></variation_2></response>"))
    rows = t("documents").select("doc_id", F.col("text").alias("q"), reply.alias("reply"))
    return generators.with_variations(rows, F.col("q"), generators.variations(F.col("reply"))).select("doc_id", "variant", "question")


@query("SELECT n_name AS name, 'nation' AS kind, n_nationkey::BIGINT AS id, NULL::DOUBLE AS balance FROM nation UNION ALL SELECT s_name, 'supplier', s_suppkey, s_acctbal FROM supplier")
def union_all_missing_columns(t):
    nations = t("nation").select(F.col("n_name").alias("name"), F.lit("nation").alias("kind"), F.col("n_nationkey").cast("bigint").alias("id"))
    suppliers = t("supplier").select(F.col("s_name").alias("name"), F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return generators.union_all(nations, suppliers)


@query("""
    SELECT r_name AS root, n_name AS leaf, r_name || '-' || n_name AS path, 'nation ' || n_nationkey AS description FROM region JOIN nation ON n_regionkey = r_regionkey
""")
def taxonomy_leaves(t):
    leaf = F.struct(F.concat(F.lit("nation "), F.col("n_nationkey").cast("string")).alias("description"), F.array("n_name").alias("examples"))
    trees = t("nation").groupBy("n_regionkey").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("n_name", leaf)))).alias("tree"))
    rows = trees.join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return generators.leaves(rows, "r_name", "tree").select(F.col("name").alias("root"), F.element_at("path", -1).alias("leaf"), F.concat_ws("-", "name", F.array_join("path", "-")).alias("path"), "description")


@query("""
    SELECT l_orderkey, pos::INT AS position, fn, sha256(l_orderkey || chr(0) || pos) AS item_id FROM (
        SELECT l_orderkey, unnest(list(l_linestatus ORDER BY l_linenumber, l_partkey, l_linestatus)) AS fn, unnest(range(0, count(*))) AS pos FROM lineitem GROUP BY 1)
""")
def explode_with_ids(t):
    rows = t("lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_linestatus"))), lambda x: x["l_linestatus"]).alias("items"))
    return generators.explode_items(rows, "items", "fn", ["l_orderkey"]).select("l_orderkey", "position", "fn", "item_id")


@query("SELECT user_id, list_sort(list_distinct(list(event_type)))::VARCHAR AS kinds FROM events GROUP BY 1")
def distinct_values(t):
    rows = t("events").groupBy("user_id").agg(F.array_sort(F.array_distinct(F.collect_list("event_type"))).alias("k"))
    return rows.select("user_id", F.concat(F.lit("["), F.array_join("k", ", "), F.lit("]")).alias("kinds"))


_DRAW = "('0x' || substr(md5({}), 1, 13))::BIGINT"


@query(f"""
    SELECT doc_id, CASE WHEN {_DRAW.format("'1|' || doc_id")} % 1000000 < 200000 THEN 'zh' ELSE 'en' END AS language, {_DRAW.format("'2|' || doc_id || '|' || coalesce(lang, 'null')")} % 1000000 < 500000 AS masked,
           {_DRAW.format("'3|' || doc_id")} % 7 AS persona, {_DRAW.format("'4|' || doc_id")} % 1000000 < 500000 AS use_query, list_sort(list_distinct(string_split(text, ' ')))[1 + {_DRAW.format("'42|' || doc_id")} % len(list_distinct(string_split(text, ' ')))] AS question,
           {_DRAW.format("'0|' || text")} % 10000 AS call_number FROM documents
""")
def seeded_choice(t):
    """Weighted language, masked example, persona, coin, one of
    the words as a question by seed 42, call number."""
    doc, words = F.col("doc_id"), F.array_sort(F.array_distinct(F.split("text", " ")))
    return t("documents").select(
        "doc_id", F.when(S.coin(1, 0.2, doc), "zh").otherwise("en").alias("language"), S.coin(2, 0.5, doc, F.col("lang")).alias("masked"), S.pick(3, 7, doc).alias("persona"),
        S.coin(4, 0.5, doc).alias("use_query"), S.choice(words, 42, doc).alias("question"), S.call_number(F.col("text")).alias("call_number"),
    )


@query("SELECT event_id, ((row_number() OVER (ORDER BY event_id) - 1) // (SELECT ceil(count(*) / 8)::BIGINT FROM events))::BIGINT AS part FROM events")
def process_split(t):
    """Eight parts of ceil(n / 8) rows, in order."""
    return generators.parts(t("events").select("event_id"), ["event_id"], 8)


@query("SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 20")
def debug_limit(t):
    """T5: the first rows, for a look at what a job would do."""
    return t("documents").select("doc_id", "source").orderBy("doc_id").limit(20)
