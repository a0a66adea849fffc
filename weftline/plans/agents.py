"""Agents and remote sources over rule providers and replay tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import structured as S
from weftline.models import agents, provider
from weftline.plans.registry import query
from weftline.sources import remote


def _rule(response):
    return provider.provider("rule", response=response)


@query("""
    WITH d AS (SELECT item_id, text, CASE WHEN item_id % 3 = 0 THEN 'core' ELSE text END AS info FROM benchmark)
    SELECT item_id, split_part(info, ' ', 1) AS keyword, CASE WHEN item_id % 4 = 1 THEN info ELSE '' END AS plain, CASE WHEN item_id % 4 <> 1 THEN info END AS text, length('Vocabulary: a b c' || chr(10) || 'Question: ' || info)::INT AS size
    FROM d
""")
def keyword_strategies(t):
    """A question is shortened, then asked for keywords with a
    vocabulary; a reply that is no JSON leaves the question."""
    question = F.regexp_extract("prompt", r"(?s)Question: (.*)$", 1)
    first = F.to_json(F.struct(F.array(F.split_part(question, F.lit(" "), F.lit(1))).alias("keywords_en"), F.length("prompt").alias("size")))
    splitter = _rule(lambda p: F.when(F.col("item_id") % 3 == 0, '{"information": ["core').when(F.col("item_id") % 3 == 1, '{"information": [], "instruction": []}').otherwise("no idea"))
    generator = _rule(lambda p: F.when(F.col("item_id") % 4 == 1, "none").otherwise(F.concat(F.lit("```json\n"), first, F.lit("\n```"))))
    rows = t("benchmark").select("item_id", F.col("text").alias("query"), F.lit("a b c d").alias("words"))
    got = agents.keyword_requests(agents.split_query(rows, splitter, "Split: {user_request}").select("item_id", F.col("information").alias("query"), "words"), generator, "Vocabulary: {ref_doc}\nQuestion: {user_request}", vocabulary="words", tokens=3)
    v = S.strict_json(F.col("request"))
    keyword = F.coalesce(F.try_variant_get(v, "$.keywords_en", "array<string>")[0], F.split_part("request", F.lit(" "), F.lit(1)))
    return got.select("item_id", keyword.alias("keyword"), F.when(v.isNull(), F.col("request")).otherwise("").alias("plain"), F.try_variant_get(v, "$.text", "string").alias("text"), F.coalesce(F.try_variant_get(v, "$.size", "int"), F.length(F.concat(F.lit("Vocabulary: a b c\nQuestion: "), "query")).cast("int")).alias("size"))


@query("""
    SELECT doc_id AS key, CASE lang WHEN 'en' THEN NULL WHEN 'de' THEN 'second' ELSE 'first' END AS agent, CASE lang WHEN 'en' THEN 'I know: ' || text WHEN 'de' THEN 'second: ' || text ELSE reverse(text) END AS response FROM documents
""")
def agent_routing(t):
    """Own answers, known agents, and an unknown one."""
    lang = F.col("lang")
    router = _rule(lambda p: F.when(lang == "en", F.concat(F.lit("I know: "), p)).when(lang == "de", "Call: second\nReply:").when(lang == "fr", "Call: nobody").otherwise("so Call: x\nCall:  first "))
    known = {"first": _rule(F.reverse), "second": _rule(lambda p: F.concat(F.lit("second: "), p))}
    return agents.route(t("documents").select(F.col("doc_id").alias("key"), F.col("text").alias("prompt"), "lang"), router, known)


@query("""
    SELECT c_custkey AS key, c_name || CASE c_custkey % 4
        WHEN 0 THEN ' @bob @cy|bob:' || c_name || ' @bob @cy|cy:2 lines|bob:' || c_name || ' @bob @cy'
        WHEN 1 THEN '|ann:hi @cy|cy:2 lines|ann:hi @cy'
        WHEN 2 THEN ' @bob quiet' ELSE ' @bob wait|bob:<!-- INTERRUPT: PENDING_USER_INPUT -->' END AS said
    FROM customer
""")
def group_chat(t):
    """Those mentioned in order, also by agents, else the next in
    turn; silence and a pending reply end it."""
    # Agents see all that was said, and answer by it.
    first = F.regexp_extract("prompt", r"^user: (.*)", 1)
    bob = _rule(lambda p: F.when(first.contains("quiet"), " ").when(first.contains("wait"), agents.PENDING).otherwise(first))
    cy = _rule(lambda p: F.concat((F.size(F.split(p, "\n")) - 1).cast("string"), F.lit(" lines")))
    k = F.col("c_custkey") % 4
    start = F.concat("c_name", F.when(k == 0, " @bob @cy").when(k == 1, "").when(k == 2, " @bob quiet").otherwise(" @bob wait"))
    chats = t("customer").select(F.col("c_custkey").alias("key"), F.array(F.struct(F.lit("user").alias("name"), start.alias("content"))).alias("messages"))
    got = agents.group_chat(chats, {"ann": _rule(lambda p: F.lit("hi @cy")), "bob": bob, "cy": cy})
    rest = F.transform(F.slice("messages", 2, 9), lambda m: F.concat(F.lit("|"), m["name"], F.lit(":"), m["content"]))
    return got.select("key", F.concat(F.col("messages")[0]["content"], F.array_join(rest, "")).alias("said"))


@query("""
    SELECT c_custkey AS key, CASE c_custkey % 3 WHEN 0 THEN 'user:more 0|assistant:1|user:more 2|assistant:3|user:more 4|assistant:5'
        WHEN 1 THEN 'user:' || c_name || '|assistant:1|user:more 2|assistant:3|user:more 4|assistant:5' ELSE 'assistant:enough' END AS said
    FROM customer
""")
def simulated_dialogue(t):
    """Three rounds, from nothing, from a question, and one that the user
    ends. The user sees its own lines as the assistant's."""
    lines = lambda p: F.size(F.split(p, "\n"))
    user = _rule(lambda p: F.when(p.startswith("user: enough"), f"bye {agents.STOP}").when(p == "", "more 0").when(p.startswith("assistant: "), F.concat(F.lit("more "), lines(p).cast("string"))))
    assistant = _rule(lambda p: F.when(p.startswith("user: "), lines(p).cast("string")))
    k, none = F.col("c_custkey") % 3, F.array().cast("array<struct<name:string,content:string>>")
    one = lambda name, content: F.array(F.struct(F.lit(name).alias("name"), content.alias("content")))
    chats = t("customer").select(F.col("c_custkey").alias("key"), F.when(k == 0, none).when(k == 1, one("user", F.col("c_name"))).otherwise(one("assistant", F.lit("enough"))).alias("messages"))
    got = agents.dialogue(chats, user, assistant, rounds=3)
    return got.select("key", F.array_join(F.transform("messages", lambda m: F.concat(m["name"], F.lit(":"), m["content"])), "|").alias("said"))


@query("""
    SELECT page_id, CASE WHEN page_id % 3 = 0 THEN html END AS content, CASE page_id % 3 WHEN 0 THEN NULL WHEN 1 THEN 'can not download ' || url || ': status 404' ELSE 'can not download ' || url || ': status unknown' END AS error FROM pages
""")
def remote_files(t):
    """Pages that were fetched, were not found, and were never asked for."""
    # URLs repeat; each row asks for its own.
    asked = t("pages").select("page_id", F.concat("url", F.lit("#"), F.col("page_id").cast("string")).alias("at"), "url")
    found = t("pages").filter("page_id % 3 < 2").select(F.concat("url", F.lit("#"), F.col("page_id").cast("string")).alias("url"), F.when(F.col("page_id") % 3 == 0, 200).otherwise(404).alias("status"), F.col("html").alias("content"))
    got = remote.fetched(asked, found, "at")
    return got.select("page_id", "content", F.replace("error", F.concat(F.lit("#"), F.col("page_id").cast("string"), F.lit(":")), F.lit(":")).alias("error"))


@query("""
    SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN text || chr(10) || chr(10) || lang WHEN 1 THEN 'execute error' ELSE 'No resources found' END AS session,
           CASE doc_id % 4 WHEN 0 THEN 'Success' WHEN 1 THEN 'Success (non-JSON response)' END AS message, CASE doc_id % 4 WHEN 0 THEN 200 WHEN 1 THEN 201 WHEN 2 THEN 404 ELSE 503 END AS code,
           CASE doc_id % 4 WHEN 0 THEN lang WHEN 1 THEN text END AS data, CASE doc_id % 4 WHEN 2 THEN left(text, 500) WHEN 3 THEN 'No error details' END AS detail
    FROM documents
""")
def remote_replies(t):
    """sessions' parts, and REST answers read back from their JSON."""
    part = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("text"))
    k, text, lang = F.col("doc_id"), F.col("text"), F.col("lang")
    blob = F.array(part("blob", text))
    parts = F.when(k % 3 == 0, F.array(part("text", text), part("blob", text), part("text", lang))).when(k % 3 == 1, blob).otherwise(F.slice(blob, 1, 0))
    status = F.when(k % 4 == 0, 200).when(k % 4 == 1, 201).when(k % 4 == 2, 404)
    body = F.when(k % 4 == 0, F.to_json(F.struct("lang", "text"))).when(k % 4 < 3, text)
    v = S.strict_json(remote.rest_reply(status, body))
    data = F.coalesce(F.try_variant_get(v, "$.data.lang", "string"), F.try_variant_get(v, "$.data", "string"))
    session = remote.session_reply(parts, F.when(k % 3 == 2, "list_resources").otherwise("call_tool"))
    return t("documents").select("doc_id", session.alias("session"), F.try_variant_get(v, "$.message", "string").alias("message"), F.try_variant_get(v, "$.code", "int").alias("code"), data.alias("data"), F.try_variant_get(v, "$.detail", "string").alias("detail"))
