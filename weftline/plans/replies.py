"""Repairs of replies, gates, retries, and the provider's composed steps."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import structured as S
from weftline.functions import text as T
from weftline.models import provider
from weftline.operators import records
from weftline.plans.registry import query


@query("SELECT doc_id, lang, source FROM documents WHERE coalesce(text, '') <> '' AND lang <> 'en' AND coalesce(source, '') <> ''")
def filled_rows(t):
    """Null and empty fields drop a row."""
    lang = F.when(F.col("lang") == "en", "").otherwise(F.col("lang"))
    return t("documents").filter(records.all_filled(F.col("text"), lang, F.col("source"))).select("doc_id", "lang", "source")


@query("""
    SELECT page_id, '[file](a b.txt)' || chr(10) || html || chr(10) || chr(10) || '...' || chr(10) || chr(10) || url || chr(10) || chr(10) || '[file](' || regexp_extract(url, '://([^/?#]*)', 1) || ')' || chr(10) || page_id AS text FROM pages
""")
def snippet_rendering(t):
    """Whole texts of two sources, one of them named by its host alone."""
    one = lambda url, *texts: F.struct(url.alias("url"), F.array(*texts).alias("text"))
    host = F.regexp_extract("url", r"^(\w+://[^/?#]*)", 1)
    found = F.array(one(F.concat(host, F.lit("/x/a%20b.txt?v=1")), F.col("html"), F.col("url")), one(host, F.col("page_id").cast("string")))
    return t("pages").select("page_id", records.snippets(found).alias("text"))


@query("SELECT n_nationkey, n_nationkey % 5 IN (0, 1) AS ok FROM nation")
def server_configs(t):
    """A command needs arguments, a URL stands alone."""
    name, k = F.col("n_name"), F.col("n_nationkey") % 5
    entry = lambda body: F.concat(F.lit('{"mcpServers": {"'), name, F.lit('": ' + body + "}}"))
    config = F.when(k == 0, entry('{"command": "run", "args": ["-x"]}')).when(k == 1, entry('{"url": "http://h"}')).when(k == 2, entry('{"command": "run"}')).when(k == 3, F.concat(F.lit('{"servers": "'), name, F.lit('"}'))).otherwise(F.concat(F.lit("no json "), name))
    return t("nation").select("n_nationkey", records.valid_servers(config).alias("ok"))


@query("""
    SELECT doc_id, '--- ' || text || '.' AS stripped, CASE WHEN doc_id % 2 = 0 THEN text ELSE 'show(' || text || ')' END AS unwrapped, text AS plain,
           '{"a": "' || lang || '"}' AS arguments, lang || CASE doc_id % 3 WHEN 0 THEN ' end' WHEN 1 THEN '' ELSE ' x' END AS marked,
           source AS name, '{"lang": "' || lang || '"' AS salvaged
    FROM documents
""")
def reply_repairs(t):
    """F7, F39, F41, F44, F45, F46, N17 over whole texts."""
    x, k, lang = F.col("text"), F.col("doc_id"), F.col("lang")
    around = lambda a, c, b: F.concat(F.lit(a), c, F.lit(b))
    call = F.concat(F.lit('so {"name": "'), "source", F.lit('", "arguments": {"lang": "'), lang, F.lit('"}'))
    return t("documents").select(
        "doc_id",
        T.strip_char_sets(around("```json--- ", x, ".``")).alias("stripped"),
        F.when(k % 2 == 0, T.unwrap_print(F.concat(F.lit(" print("), x, F.lit(")\n")))).otherwise(T.unwrap_print(around("show(", x, ")"))).alias("unwrapped"),
        T.strip_ansi(around("\x1b[1;31m", x, "\x1b[0m\x1bM")).alias("plain"),
        T.drop_trailing_comment(F.concat(F.lit('{"a": "'), lang, F.lit('"} # '), "source")).alias("arguments"),
        T.drop_incomplete_marks(F.concat(lang, F.when(k % 3 == 0, " end\n✿FUNCTION✿").when(k % 3 == 1, "✿RES").otherwise(" x "))).alias("marked"),
        T.salvage_call(call)["name"].alias("name"),
        T.salvage_call(call)["arguments"].alias("salvaged"),
    )


@query("SELECT n_nationkey, least(300.0, pow(2.0, n_nationkey)) AS doubled, least(300.0, 2.5 * pow(1.5, n_nationkey)) AS half_more FROM nation")
def retry_delays(t):
    """D4, D5 without jitter, which would differ from run to run."""
    n = F.col("n_nationkey")
    return t("nation").select("n_nationkey", S.backoff(n).alias("doubled"), S.backoff(n, 2.5, 1.5).alias("half_more"))


@query("""
    SELECT o_orderkey, 'Current date: ' || strftime(o_orderdate, '%A, %B %d, %Y') AS en,
           '当前时间：' || strftime(o_orderdate, '%Y年%m月%d日') || '，星期' || substr('一二三四五六日', isodow(o_orderdate)::INT, 1) || '。' AS zh FROM orders
""")
def date_lines(t):
    """D11 in both languages."""
    day = F.col("o_orderdate")
    return t("orders").select("o_orderkey", T.date_line(day).alias("en"), T.date_line(day, "zh").alias("zh"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 4 <> 3 THEN 'find ' || n_name END AS query, n_nationkey % 4 IN (0, 1) AS is_valid FROM nation")
def back_translated_chains(t):
    """A chain comes back, comes back longer, or its query was no JSON. Two
    replayed model columns, one after the other."""
    name, k = F.col("n_name"), F.col("n_nationkey")
    chains = t("nation").select("n_nationkey", "n_name", F.array(name, k.cast("string")).alias("chain"))
    chain = F.concat(F.lit('["'), name, F.lit('", "'), k.cast("string"), F.lit('"'), F.when(k % 4 == 2, ', "more"').otherwise(""), F.lit("]"))
    answers = [
        (F.concat(F.lit("ask "), name), F.when(k % 4 == 3, "sorry").otherwise(F.concat(F.lit('{"query": "find '), name, F.lit('"}')))),
        (F.concat(F.lit("chain of find "), name), F.concat(F.lit('<think>so</think>```json\n{"chain": '), chain, F.lit("}\n```"))),
    ]
    pairs = t("nation").select(F.explode(F.array(*[F.struct(F.sha2(p, 256).alias("key"), F.lit(0).alias("sample"), r.alias("response"), F.lit(None).cast("string").alias("error")) for p, r in answers])).alias("a")).select("a.*")
    ask = provider.provider("replay", table=pairs)
    return provider.back_translation(chains, F.concat(F.lit("ask "), name), lambda q: F.concat(F.lit("chain of "), q), ask).select("n_nationkey", "query", "is_valid")


@query("""
    SELECT c_custkey, upper(c_mktsegment) AS segment, CASE WHEN c_acctbal < 0 THEN '{"error":"debt","status":"failed"}' ELSE 'ok' END AS balance FROM customer
""")
def operator_chain(t):
    """Named steps in order; one that fails leaves the others. The
    first asks a provider that is chosen by name."""
    ask = provider.provider("rule", response=F.upper)
    steps = provider.Operators()
    steps.add("segment", lambda df: ask(df.withColumn("prompt", F.col("c_mktsegment"))).withColumns({"result": F.col("response"), "failed": F.col("error")}).drop("prompt", "response", "reasoning", "error"))
    steps.add("balance", lambda df: df.withColumns({"result": F.lit("ok"), "failed": F.when(F.col("c_acctbal") < 0, "debt")}))
    got = steps.run(t("customer"), ["segment", "balance"])
    return got.select("c_custkey", F.col("operator_results")["segment"].alias("segment"), F.col("operator_results")["balance"].alias("balance"))
