"""Further operators, over inputs that are built from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from weftline.functions import structured as S
from weftline.functions import text as T
from weftline.models import provider, tools
from weftline.operators import codecs, generators, joins, messages, records, retrieval, scores
from weftline.plans.registry import query
from weftline.scratch import materialize, scratch_path
from weftline.sources import keyed, readers


@query("""
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'a-b' WHEN 'P' THEN 'new' ELSE '' END AS chains FROM orders
""")
def usable_chains(t):
    """`yes` only, an error drops a chain, a corrected one replaces it."""
    chain = lambda flag, error, new: F.struct(flag.alias("tool_graph_detect"), F.array(F.lit("a"), F.lit("b")).alias("tool_graph_detect_chain"), F.lit(error).cast("string").alias("error_info"), new.alias("new_chain"))
    status, none = F.col("o_orderstatus"), F.array().cast("array<string>")
    listed = F.array(chain(F.when(status == "F", "yes").otherwise("no"), None, none), chain(F.lit("yes"), "2", none), chain(F.when(status == "P", "yes").otherwise("not sure"), "1", F.array(F.lit("new"))))
    return t("orders").select("o_orderkey", F.array_join(F.transform(records.usable_chains(listed), lambda c: F.array_join(c, "-")), ";").alias("chains"))


def _trace(lines):
    rows = lines.select("l_orderkey", F.struct(F.col("l_linenumber").alias("_uuid"), F.col("l_partkey").alias("p"), F.lit(1).alias("hop_level"), F.lit(False).alias("is_parallel"), F.array(F.col("l_linenumber") - 1).alias("dependency"), F.col("l_returnflag").alias("sub_question"), F.col("l_linestatus").alias("sub_answer")).alias("s"))
    return rows.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("s")).alias("trace"))


@query("""
    SELECT l_orderkey, string_agg('id=' || l_linenumber || ' | hop=1 | parallel=false | dep=[' || (l_linenumber - 1) || '] | q=' || l_returnflag || ' | a=' || l_linestatus, chr(10) ORDER BY l_linenumber, l_partkey, l_returnflag, l_linestatus) AS compact,
           '[' || string_agg('{"_uuid":' || l_linenumber || ',"sub_question":"' || l_returnflag || '","sub_answer":"' || l_linestatus || '"}', ',' ORDER BY l_linenumber, l_partkey, l_returnflag, l_linestatus) || ']' AS json
    FROM lineitem GROUP BY 1
""")
def step_rendering(t):
    """P17, P18"""
    return _trace(t("lineitem")).select("l_orderkey", records.compact_steps(F.col("trace")).alias("compact"), records.steps_for_clustering(F.col("trace")).alias("json"))


@query("""
    SELECT n_regionkey, count(*) FILTER (n_nationkey % 2 = 0)::INT AS found, bool_and(n_nationkey % 2 = 0) AS aligned FROM nation GROUP BY 1
""")
def map_key_join(t):
    """Ids of any kind against string keys."""
    even = F.filter(F.collect_list(F.struct(F.col("n_nationkey").cast("string").alias("k"), F.col("n_name").alias("v"))), lambda e: e["k"].cast("int") % 2 == 0)
    rows = t("nation").groupBy("n_regionkey").agg(F.map_from_entries(even).alias("m"), F.collect_list("n_nationkey").alias("ids"))
    got = joins.by_map_key(F.col("m"), F.col("ids"))
    return rows.select("n_regionkey", F.size(got).alias("found"), joins.aligned(F.transform("ids", lambda i: i.cast("string")), F.transform(got, lambda g: g["id"])).alias("aligned"))


@query("""
    SELECT r_name AS uuid, string_agg(n_nationkey || '=' || CASE WHEN n_nationkey % 4 = 1 THEN 'merged' ELSE n_name END, ',' ORDER BY n_nationkey) AS envs
    FROM region JOIN nation ON n_regionkey = r_regionkey WHERE r_regionkey <> 2 GROUP BY 1
""")
def cluster_merge(t):
    """A passed cluster's code over its members; a failed one drops the record."""
    rows = t("region").join(t("nation"), F.col("n_regionkey") == F.col("r_regionkey"))
    members = F.array_sort(F.collect_list(F.when(F.col("n_nationkey") % 4 == 1, F.col("n_nationkey"))))
    found = rows.groupBy(F.col("r_name").alias("uuid"), "r_regionkey").agg(F.map_from_entries(F.collect_list(F.struct(F.col("n_nationkey").cast("string"), "n_name"))).alias("envs"), F.array(members).alias("clusters"))
    merged = found.select("uuid", F.to_json(F.element_at("clusters", 1)).alias("members"), F.when(F.col("r_regionkey") == 2, "failed").otherwise("passed").alias("status"), F.lit("merged").alias("code"))
    entries = F.array_sort(F.transform(F.map_entries("envs"), lambda e: F.struct(e["key"].cast("int").alias("k"), e["value"].alias("v"))))
    out = joins.merged_results(found.select("uuid", "envs", "clusters"), merged)
    return out.select("uuid", F.array_join(F.transform(entries, lambda e: F.concat(e["k"].cast("string"), F.lit("="), e["v"])), ",").alias("envs"))


@query("""
    SELECT conv_id, turn, CASE role WHEN 'system' THEN 'user' WHEN 'user' THEN 'assistant' ELSE 'system' END AS next FROM conversations
""")
def next_speaker(t):
    """W13"""
    names = F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))
    return t("conversations").select("conv_id", "turn", messages.next_speaker(names, F.col("role")).alias("next"))


@query("""
    WITH l AS (SELECT n_regionkey, n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'II. ' || n_name WHEN 1 THEN 'X. ' || n_name ELSE n_name END AS line FROM nation)
    SELECT n_regionkey, line, lead(line) OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS next_heading FROM l WHERE n_nationkey % 3 < 2
""")
def section_headings(t):
    """W16, X11"""
    k = F.col("n_nationkey") % 3
    lines = t("nation").select("n_regionkey", "n_nationkey", F.when(k == 0, F.concat(F.lit("II. "), "n_name")).when(k == 1, F.concat(F.lit("X. "), "n_name")).otherwise(F.col("n_name")).alias("line"))
    return messages.sections(lines, "n_regionkey", "n_nationkey", "line").select("n_regionkey", "line", "next_heading")


@query("""
    WITH w AS (SELECT user_id, event_id, value, event_type, CASE WHEN abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY event_id)) < 2 THEN 0 ELSE 1 END AS c FROM events),
    g AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY event_id) AS paragraph FROM w)
    SELECT user_id, paragraph::BIGINT AS paragraph, max(value) AS value, string_agg(event_type, '' ORDER BY event_id) AS event_type FROM g GROUP BY ALL
""")
def similar_size_paragraphs(t):
    """W14"""
    return messages.similar_size_paragraphs(t("events"), "user_id", "event_id", "value", "event_type")


@query("""
    SELECT p_partkey, p_brand || '|' || p_type AS items, 2 AS n, p_brand AS open, p_name AS joined FROM part
""")
def list_and_block_parsing(t):
    """F12, F14, F21"""
    items = T.list_items(F.concat(F.lit("<t>"), "p_brand", F.lit(" ,, "), "p_type", F.lit(" </t>")))
    reply = F.concat(F.lit("<a>"), "p_brand", F.lit("<b>x"))
    return t("part").select("p_partkey", F.array_join(items, "|").alias("items"), F.size(items).alias("n"), T.open_block(reply, "a").alias("open"), T.join_lines(F.replace("p_name", F.lit(" "), F.lit("\n"))).alias("joined"))


@query("""
    SELECT s_suppkey, '/s/' || s_suppkey || '/{other}' AS url, 'q' AS left_over, 'h?config=' || base64(encode('{"id":' || s_suppkey || '}')) || '&api_key=k&profile=p' AS config FROM supplier
""")
def url_building(t):
    """F29, F30"""
    params = F.create_map(F.lit("ID"), F.col("s_suppkey").cast("string"), F.lit("q"), F.lit("z"))
    u = T.path_template(F.lit("/s/{id}/{other}"), params)
    config = T.config_url(F.lit("h"), F.concat(F.lit('{"id":'), F.col("s_suppkey").cast("string"), F.lit("}")), F.lit("k"), F.lit("p"))
    return t("supplier").select("s_suppkey", u["url"].alias("url"), F.array_join(F.map_keys(u["query"]), ",").alias("left_over"), config.alias("config"))


@query(r"""
    WITH w AS (SELECT doc_id, regexp_extract_all(text, '\s*(?:[\p{L}\p{N}]+|[^\s\p{L}\p{N}])') AS k, text FROM documents)
    SELECT doc_id, CASE WHEN len(k) <= 10 THEN text ELSE array_to_string(k[1:10], '') END AS head,
           CASE WHEN len(k) <= 10 THEN text ELSE array_to_string(k[1:5], '') || '...' || array_to_string(k[-5:], '') END AS both_sides FROM w
""")
def token_truncation(t):
    """F33"""
    x = F.col("text")
    return t("documents").select("doc_id", T.truncate_tokens(x, 10).alias("head"), T.truncate_tokens(x, 10, both_sides=True).alias("both_sides"))


@query("""
    SELECT event_id, (json_extract(props, '$.k'))::BIGINT AS k, 1.5::DOUBLE AS mean, 'call_' || (event_id % 7) AS call_id, user_id = 3 AS nothing,
           event_id AS hex, -user_id AS signed, event_type || chr(39) || 's "A" ' || event_id AS said, [user_id, event_id]::BIGINT[] AS list, event_id % 3 <> 0 AS ok FROM events
""")
def reply_fields(t):
    """A12, N11, N14, N16 and null words. The reply is JSON5: comments, bare and
    single-quoted names, escapes, hexadecimal and signed numbers, commas behind
    the last member; every third has one too many."""
    text = lambda c: F.col(c).cast("string")
    reply = F.concat(
        F.lit("```json\n{// note\nprops: "), F.regexp_replace("props", '"', "'"), F.lit(", 'hex': 0x"), F.hex("event_id"), F.lit(", signed: -"), text("user_id"),
        F.lit(", said: '"), "event_type", F.lit("\\'s \\x22\\u0041\\x22 "), text("event_id"), F.lit("', /* list */ list: [+"), text("user_id"), F.lit(", "), text("event_id"), F.lit(".,],"),
        F.when(F.col("event_id") % 3 == 0, ",").otherwise(""), F.lit("}\n```"),
    )
    fixed = S.loose_json(F.replace(reply, F.lit(",,}"), F.lit(",}")))
    get = lambda path, kind: F.try_variant_get(fixed, path, kind)
    listed = S.score_list(S.strict_json(F.lit('{"tool_score_list": [1, "2", "x", null]}')))
    return t("events").select(
        "event_id", get("$.props.k", "bigint").alias("k"), S.mean(listed).alias("mean"), S.call_id(F.lit(""), F.col("event_id") % 7).alias("call_id"), S.null_word(F.when(F.col("user_id") == 3, "None").otherwise("x")).isNull().alias("nothing"),
        get("$.hex", "bigint").alias("hex"), get("$.signed", "bigint").alias("signed"), get("$.said", "string").alias("said"), get("$.list", "array<bigint>").alias("list"), S.loose_json(reply).isNotNull().alias("ok"),
    )


@query("""
    SELECT c_custkey, c_name || ',new' AS value, 2 AS n, 'a,b,c' AS stop FROM customer
""")
def map_updates(t):
    """M3, M4, M5, U6"""
    m = S.put(S.put(F.create_map(F.lit("k"), F.col("c_name")), "other", F.lit("new")), "k", F.concat("c_name", F.lit(",new")))
    base = F.create_map(F.lit("stop"), F.array(F.lit("a"), F.lit("b")))
    both = S.merge_configs(base, F.create_map(F.lit("stop"), F.array(F.lit("b"), F.lit("c"))), "stop")
    return t("customer").select("c_custkey", F.element_at(m, "k").alias("value"), F.size(m).alias("n"), F.array_join(F.element_at(both, "stop"), ",").alias("stop"))


def _replay(t):
    """Answers to 'q <doc_id>': two samples a document; some are missing."""
    labels = t("labels").join(t("documents").select("doc_id", "lang"), "doc_id")
    rows = labels.select(F.sha2(F.concat(F.lit("q "), F.col("doc_id").cast("string")), 256).alias("key"), "quality", "toxic", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("sample"))
    ok = F.when(F.col("sample") == 0, F.col("quality") == 1).when(F.col("sample") == 1, F.col("toxic") == 0).otherwise(F.lit(True))
    return rows.select("key", "sample", F.concat(F.lit("<think>t</think>"), F.to_json(F.struct(ok.alias("is_valid")))).alias("response"), F.lit(None).cast("string").alias("error"))


@query("""
    WITH v AS (SELECT d.doc_id, l.doc_id IS NULL AS missing, ((quality = 1)::INT + (toxic = 0)::INT + 1)::BIGINT AS n_true FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    SELECT doc_id, CASE WHEN missing THEN 0 ELSE n_true END AS n_true, CASE WHEN missing THEN 0 ELSE 3 - n_true END AS n_false, CASE WHEN missing THEN 3 ELSE 0 END::BIGINT AS n_error, NOT missing AND n_true >= 2 AS is_valid FROM v
""")
def replayed_vote(t):
    """L1, L4, A1: three samples a prompt from a replayed model, parsed and voted."""
    ask = provider.provider("replay", table=_replay(t))
    asked = provider.samples(t("documents").select("doc_id", F.concat(F.lit("q "), F.col("doc_id").cast("string")).alias("prompt")), 3, ask)
    votes = asked.withColumn("ok", F.try_variant_get(S.strict_json(F.col("response")), "$.is_valid", "boolean"))
    return scores.majority_vote(votes, "doc_id", "ok", "sample").drop("first_true")


@query("""
    SELECT event_id, CASE WHEN event_type = 'error' THEN 'Tool error does not exists.' WHEN event_id % 2 = 0 THEN 'r' || event_id ELSE 'An error occurred when calling the tool: no response' END AS content FROM events
""")
def tool_dispatch(t):
    """Unknown tools and failures are text."""
    calls = t("events").select("event_id", F.col("event_type").alias("name"), F.concat(F.lit('{"id": '), F.col("event_id").cast("string"), F.lit("}")).alias("arguments"))
    registry = t("events").filter("event_type <> 'error'").select(F.col("event_type").alias("name")).distinct()
    table = calls.filter("event_id % 2 = 0").select(F.col("name").alias("tool"), F.sha2("arguments", 256).alias("args_key"), F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("content"))
    return provider.call_tools(calls, registry, table).select("event_id", "content")


@query("""
    SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'passed' ELSE 'exception' END AS status, CASE WHEN doc_id % 3 = 0 THEN lang END AS stdout FROM documents
""")
def sandbox_replay(t):
    """Outputs of code that ran before, by its hash."""
    rows = t("documents").select("doc_id", "lang", F.concat(F.lit("print("), F.col("doc_id").cast("string"), F.lit(")")).alias("code"))
    table = rows.filter("doc_id % 3 = 0").select(F.sha2("code", 256).alias("key"), F.lit("passed").alias("status"), F.col("lang").alias("stdout"))
    return provider.sandbox(rows.drop("lang"), table).select("doc_id", "status", "stdout")


_KEPT = """
    SELECT 'c/' || c_custkey AS key, CASE WHEN c_custkey % 5 = 0 THEN 'new' ELSE c_name END AS value FROM customer WHERE c_custkey % 7 <> 0
"""


def _customers(t):
    """A log of four folders: two puts, a put over some of their keys, a delete."""
    name = F.concat(F.lit("c/"), F.col("c_custkey").cast("string")).alias("key")
    spark = t("customer").sparkSession
    table = keyed.KeyedTable(spark, scratch_path(spark, "keyed"), buckets=8)
    table.put(t("customer").select(name, F.col("c_name").alias("value")))
    table.put(t("supplier").select(F.concat(F.lit("s/"), F.col("s_suppkey").cast("string")).alias("key"), F.col("s_name").alias("value")))
    table.put(t("customer").filter("c_custkey % 5 = 0").select(name, F.lit("new").alias("value")))
    table.delete(t("customer").filter("c_custkey % 7 = 0").select(name))
    return table


@query(_KEPT)
def kv_store(t):
    """Put, delete, and a scan below a prefix."""
    return _customers(t).scan("c/")


@query(_KEPT)
def kv_store_compacted(t):
    """The same after compaction, with what is deleted then and put back later."""
    table = _customers(t)
    some = table.scan("c/").filter(F.length("key") % 2 == 0)
    table.delete(some)
    table.compact()
    table.put(materialize(_customers(t).scan("c/"), "again"))
    table.compact()
    table.vacuum()
    return table.scan("c/")


@query("""
    SELECT q.conv_id AS query, string_agg('[' || turn || '] "' || role || chr(10) || text || '"', chr(10) || chr(10) ORDER BY turn) AS text FROM conversations q GROUP BY 1
""")
def web_result_text(t):
    """S24"""
    hits = t("conversations").select(F.col("conv_id").alias("query"), F.col("turn").alias("rank"), F.col("role").alias("title"), F.col("text").alias("snippet"), F.lit("").alias("date"))
    return readers.web_results(hits)


@query("""
    SELECT p_partkey, 'f' || p_partkey AS name, 'a,b' AS params, '{"k": ' || p_partkey || '}' AS literal FROM part
""")
def code_parsing(t):
    """F40, N5"""
    from weftline.functions import code

    source = F.concat(F.lit("import x\ndef f"), F.col("p_partkey").cast("string"), F.lit("(a, b=1):\n    return a"))
    rows = t("part").select("p_partkey", code.first_signature(source).alias("s"), code.literal_as_json(F.concat(F.lit("{'k': "), F.col("p_partkey").cast("string"), F.lit("}"))).alias("literal"))
    return rows.select("p_partkey", "s.name", F.array_join("s.params", ",").alias("params"), "literal")


@query("SELECT doc_id, replace(text, chr(10), '|') AS text FROM documents")
def regrouped_chunks(t):
    """Chunks by document, in chunk order."""
    rows = t("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("chunk_id", "text"))
    return retrieval.regroup(rows, "doc_id", "chunk_id", "text").select("doc_id", F.array_join("text", "|").alias("text"))


@query("""
    SELECT c_custkey, '### ' || c_name || chr(10) || chr(10) || c_name || ': ' || c_mktsegment || ' Parameters: {} Format the arguments as a JSON object.' AS described, '(Uploaded [file](a.pdf), [file](b c.txt))' AS banner,
           'print-' || c_custkey AS bare, c_custkey % 2 = 0 AS nothing FROM customer
""")
def prompt_parts(t):
    """F39, F43, F48, F50, P2"""
    tool = F.struct(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("description"), F.lit("{}").alias("parameters"))
    banner = codecs.upload_banner(F.array(F.lit("/x/a.pdf"), F.lit("http://h/b%20c.txt")))
    call = T.fill(F.lit("print(print-{n})"), {"{n}": F.col("c_custkey").cast("string")})
    reply = F.when(F.col("c_custkey") % 2 == 0, "No answer.").otherwise("42 of them")
    return t("customer").select("c_custkey", codecs.describe_function(tool).alias("described"), banner.alias("banner"), T.unwrap_print(call).alias("bare"), T.no_answer(reply).alias("nothing"))


@query("""
    SELECT doc_id, lang || '.txt,x.pdf' AS files, CASE WHEN lang = 'fr' THEN 'fr' ELSE '' END AS mentioned FROM documents
""")
def files_and_mentions(t):
    """U5, U7, J20"""
    files = generators.distinct_files(F.array(F.concat("lang", F.lit(".txt")), F.lit("x.pdf"), F.lit("y.exe")), F.array(F.lit("x.pdf")), ["txt", "pdf"])
    return t("documents").select("doc_id", F.array_join(files, ",").alias("files"), F.array_join(joins.mentioned(F.concat(F.lit("hello @"), "lang"), ["fr", "xx"]), ",").alias("mentioned"))


@query("SELECT event_type AS tool, user_id, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL")
def dynamic_tools(t):
    """§2.16: a tool a kind of event, registered from rows of a catalogue and
    called by SQL, its calls dealt out by user."""
    spark = t("events").sparkSession
    rules = '{"type": "object", "properties": {"user_id": {"type": "integer"}, "value": {"type": "number"}}, "required": ["user_id", "value"], "additionalProperties": false}'
    kinds = t("events").select("event_type").distinct().filter("event_type IS NOT NULL")
    catalogue = kinds.select(F.concat(F.lit("tool_"), "event_type").alias("name"), F.concat(F.lit("Sums up "), "event_type").alias("description"), F.lit(rules).alias("parameters"), F.lit("totals").alias("function"), F.lit("user_id bigint, n bigint, total double").alias("returns"))
    found = []
    for name in tools.register(spark, catalogue):
        kind = name.removeprefix("tool_")
        calls = t("events").filter(F.col("event_type") == kind).select("user_id", "value")
        found.append(spark.sql(f"SELECT '{kind}' AS tool, * FROM {name}(TABLE({{calls}}) PARTITION BY (user_id), 'user_id', 'value')", calls=calls))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.withColumn("total", F.round("total", 6))


@query("""
    WITH c AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS chunk_id FROM documents),
    s AS (SELECT doc_id, chunk_id::INT AS chunk_id, len(list_intersect(list_distinct(regexp_split_to_array(lower(text), '[ ]+')), ['the', 'and', 'der', 'la']))::DOUBLE AS score FROM c),
    r AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id, chunk_id) AS rank FROM s WHERE score > 0)
    SELECT doc_id, chunk_id, score FROM r WHERE rank <= 50
""")
def searcher_plugin(t):
    """§2.16: a searcher called by its name; the 50 best chunks of all documents."""
    spark = t("documents").sparkSession
    tools.searcher(spark, "by_overlap", "overlap")
    chunks = t("documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("chunk_id", "text"))
    scores = spark.sql("SELECT * FROM by_overlap(TABLE({chunks}) PARTITION BY (doc_id) ORDER BY (chunk_id), 'the and der la')", chunks=chunks)
    return scores.orderBy(F.desc("score"), "doc_id", "chunk_id").limit(50)
