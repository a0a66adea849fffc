"""Scans, sinks, caches and streams: tables are written to the shared folder in
a source's form and read again by the operators."""

from __future__ import annotations

import io
import zipfile
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from weftline.functions import text as T
from weftline.operators import records
from weftline.plans.registry import dealt, query
from weftline.scratch import scratch_path
from weftline.sources import documents, keyed, readers, sinks
from weftline.streaming import incremental, stateful


def _text_file(df: DataFrame, name: str) -> str:
    """Writes one column of lines; the folder's path."""
    path = scratch_path(df.sparkSession, name)
    df.write.text(path)
    return path


@query("SELECT doc_id, text, source FROM documents")
def jsonl_round_trip(t):
    """Whole documents as JSONL and back; line breaks stay inside."""
    docs, path = t("documents"), scratch_path(t("documents").sparkSession, "jsonl")
    sinks.write_jsonl(docs, path, drop=("lang", "n_chars"))
    return readers.jsonl(docs.sparkSession, path, "doc_id bigint, text string, source string")


def _lines(t):
    """Documents as JSON lines; some are broken, empty objects or blank."""
    k = F.col("doc_id")
    line = F.when(k % 7 == 0, F.concat(F.lit("broken "), k.cast("string"))).when(k % 7 == 1, "{}").when(k % 7 == 2, "  ").otherwise(F.to_json(F.struct("doc_id", "text")))
    return t("documents").select(line.alias("value"))


@query("SELECT CASE WHEN doc_id % 7 > 2 THEN doc_id END AS doc_id, CASE WHEN doc_id % 7 = 0 THEN 'broken ' || doc_id ELSE text END AS text, doc_id % 7 = 0 AS bad FROM documents WHERE doc_id % 7 NOT IN (1, 2)")
def jsonl_tolerant_scan(t):
    """Rows, and the bad lines beside them."""
    lines = _lines(t)
    good, bad = readers.jsonl_tolerant(lines.sparkSession, _text_file(lines, "lines"), "doc_id bigint, text string")
    return good.withColumn("bad", F.lit(False)).unionByName(bad.select(F.lit(None).cast("bigint").alias("doc_id"), F.col("value").alias("text"), F.lit(True).alias("bad")))


@query("SELECT CASE WHEN doc_id % 7 > 2 THEN doc_id END AS doc_id, CASE WHEN doc_id % 7 > 2 THEN text END AS text FROM documents WHERE doc_id % 7 NOT IN (0, 2)")
def jsonl_silent_scan(t):
    """S3: bad lines leave no trace; an empty object is a row of nulls."""
    lines = _lines(t)
    return readers.jsonl_silent(lines.sparkSession, _text_file(lines, "lines"), "doc_id bigint, text string")


@query("SELECT n_nationkey, n_name, kind FROM nation, (VALUES ('json'), ('jsonl'), ('parquet')) AS k(kind)")
def record_files(t):
    """One array of objects, objects by line, and columns, by suffix."""
    rows = t("nation").select("n_nationkey", "n_name")
    spark, base = rows.sparkSession, scratch_path(rows.sparkSession, "records")
    rows.agg(F.to_json(F.collect_list(F.struct("n_nationkey", "n_name"))).alias("value")).write.text(f"{base}/x.json")
    sinks.write_jsonl(rows, f"{base}/x.jsonl")
    rows.write.parquet(f"{base}/x.parquet")
    read = [readers.records(spark, f"{base}/x.{kind}", "n_nationkey int, n_name string").withColumn("kind", F.lit(kind)) for kind in ("json", "jsonl", "parquet")]
    return read[0].unionByName(read[1]).unionByName(read[2])


@query("SELECT n_nationkey, n_name FROM nation ORDER BY n_nationkey LIMIT 1")
def first_line_scan(t):
    """Only the first line of a file is read as a record."""
    rows = t("nation").select("n_nationkey", "n_name").orderBy("n_nationkey").coalesce(1)
    path = scratch_path(rows.sparkSession, "first")
    sinks.write_jsonl(rows, path)
    return readers.first_row(readers.jsonl(rows.sparkSession, path, "n_nationkey int, n_name string"))


@query("SELECT c_custkey, c_mktsegment AS first, 2 AS n, c_name AS hobby FROM customer")
def persona_scan(t):
    """List columns of a persona table that are JSON text."""
    rows = t("customer").select("c_custkey", F.to_json(F.array("c_mktsegment", F.lit('quote " and \\'))).alias("skills_list"), F.array("c_name").alias("hobbies_list"))
    path = scratch_path(rows.sparkSession, "personas")
    rows.write.parquet(path)
    return readers.personas(rows.sparkSession, path).select("c_custkey", F.col("skills_list")[0].alias("first"), F.size("skills_list").alias("n"), F.col("hobbies_list")[0].alias("hobby"))


@query("SELECT p_partkey::INT AS key, p_size AS n FROM part")
def weight_table(t):
    """The last line of a key wins; lines without two integers are skipped."""
    key = F.col("p_partkey").cast("string")
    lines = t("part").select(F.concat(key, F.lit(" 0\n"), key, F.lit(" \t"), F.col("p_size").cast("string"), F.lit(" tail\n"), key, F.lit("\nkey n")).alias("value"))
    return readers.weights(lines.sparkSession, _text_file(lines, "weights"))


@query("""
    SELECT s_name AS server_name, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'n' || s_nationkey END AS domain, CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE 2 END AS n, CASE WHEN s_suppkey % 3 <> 0 THEN 'get' END AS first, s_suppkey AS extra
    FROM supplier WHERE s_suppkey % 7 <> 5
""")
def tool_server_layouts(t):
    """Old and new layout; unknown keys stay in the record; what is no
    JSON goes."""
    tools = '"tool_list": [{"name": "get", "description": "d"}, {"name": "put", "parameters": {"a": 1}}]'
    group = F.concat(F.lit('"group_info": {"server_name": "'), "s_name", F.lit('"'), F.when(F.col("s_suppkey") % 3 == 0, "}").otherwise(F.concat(F.lit(', "domain": "n'), F.col("s_nationkey").cast("string"), F.lit(f'"}}, {tools}'))))
    base = F.concat(F.lit('{"base_info": {'), group, F.lit("}"))
    extra = F.concat(F.lit(', "extra": '), F.col("s_suppkey").cast("string"), F.lit("}"))
    value = F.when(F.col("s_suppkey") % 7 == 5, "no json").when(F.col("s_suppkey") % 2 == 0, F.concat(base, extra)).otherwise(F.concat(F.lit('{"mcp_info": '), base, F.lit("}"), extra))
    rows = records.normalise_tools(t("supplier").select(value.alias("value")))
    return rows.select("server_name", "domain", F.size("tools").alias("n"), F.get("tools", F.lit(0))["name"].alias("first"), F.try_variant_get("record", "$.extra", "bigint").alias("extra"))


@query("""
    SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'pdf' WHEN 1 THEN 'html' WHEN 2 THEN 'html' WHEN 3 THEN 'txt' ELSE 'csv' END AS kind, page_id % 5 <> 3 AS tags FROM pages
""")
def file_types(t):
    """By suffix, else by tags of the content."""
    k = F.col("page_id") % 5
    path = F.when(k == 0, F.concat(F.regexp_replace("url", "[?#].*", ""), F.lit("/a.PDF?x=1"))).when(k == 1, F.lit("/data/index")).when(k == 2, "/data/a.htm").when(k == 3, "/data/plain").otherwise("/data/t.csv#top")
    content = F.when(k == 3, T.html_title(F.col("html"))).otherwise(F.col("html"))
    return t("pages").select("page_id", T.html_sniff_type(path, content).alias("kind"), T.has_html_tags(content).alias("tags"))


@query("SELECT text, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS text FROM documents) WHERE text <> '' GROUP BY 1")
def text_file_scan(t):
    """Whole documents as text files; every line is a paragraph. How
    many files there are is Spark's choice, so blank last lines are left out."""
    lines = t("documents").filter("text IS NOT NULL").select("text")
    found = readers.files(lines.sparkSession, _text_file(lines, "texts"), "*.txt")
    pages, _ = documents.parse_cached(found, documents.parse(found.limit(0)))
    return pages.filter("text <> ''").groupBy("text").agg(F.count("*").alias("n"))


@query("SELECT doc_id::VARCHAR AS path, (generate_subscripts(string_split(text, chr(10)), 1) - 1)::INT AS paragraph, unnest(string_split(text, chr(10))) AS text FROM documents")
def text_lines(t):
    """Every line of a text is a paragraph, blank ones too."""
    pages = documents.text_pages(t("documents").select(F.col("doc_id").cast("string").alias("path"), F.col("text").alias("value")))
    return pages.select("path", "paragraph", "text")


@F.pandas_udf(BinaryType())
def _office(parts: pd.Series) -> pd.Series:
    """Names and texts of an OOXML package's parts to its bytes."""

    def one(named) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for p in named:
                z.writestr(p["name"], p["text"])
        return out.getvalue()

    return parts.map(one)


def _part(name: str, *text: str) -> Column:
    return F.struct(F.lit(name).alias("name"), F.concat(*[F.lit(x) if x.startswith("<") else F.col(x) for x in text]).alias("text"))


@query("""
    SELECT p_partkey || '.docx' AS path, 1 AS page_num, 0 AS paragraph, 'text' AS kind, p_name AS text FROM part
    UNION ALL SELECT p_partkey || '.docx', 1, 1, 'table', '|' || p_brand || '|' || p_type || '|' || chr(10) || '|---|---|' FROM part
    UNION ALL SELECT p_partkey || '.pptx', 1, 0, 'text', p_name FROM part
    UNION ALL SELECT p_partkey || '.pptx', 2, 0, 'text', p_brand FROM part
    UNION ALL SELECT p_partkey || '.xlsx', 1, 0, 'table', '|' || p_name || '|' || p_size || '|' || chr(10) || '|---|---|' FROM part
    UNION ALL SELECT p_partkey || '.csv', 1, 0, 'table', '|x|y|' || chr(10) || '|---|---|' || chr(10) || '|' || p_name || '|' || p_size || '|' FROM part
""")
def office_documents(t):
    """A package of each kind from every part. A column
    without values goes from a table, a line with too many fields from a CSV."""
    w, a = '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>', '<a:s xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main">'
    s = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    cell = "</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>"
    docx = F.array(_part("word/document.xml", w + "<w:p><w:r><w:t>", "p_name", "</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>", "p_brand", cell, "p_type", "</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>"))
    pptx = F.array(*[_part(f"ppt/slides/slide{i}.xml", a + "<a:p><a:t>", c, "</a:t></a:p></a:s>") for i, c in ((10, "p_brand"), (9, "p_name"))])
    xlsx = F.array(_part("xl/sharedStrings.xml", f"<sst {s}><si><t>", "p_name", "</t></si></sst>"), _part("xl/worksheets/sheet1.xml", f'<worksheet {s}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>', "p_size", "</v></c></row></sheetData></worksheet>"))
    csv = F.encode(F.concat(F.lit("x,y\n"), "p_name", F.lit(","), F.col("p_size").cast("string"), F.lit("\n1,2,3\n")), "UTF-8")
    # A table of one row group is dealt out to all cores; with a plan a kind, no file is made again for parsers of other kinds.
    parts = dealt(t("part"), "p_partkey").withColumn("p_size", F.col("p_size").cast("string"))
    kinds = (("docx", _office(docx)), ("pptx", _office(pptx)), ("xlsx", _office(xlsx)), ("csv", csv))
    found = reduce(DataFrame.unionByName, [parts.select(F.concat(F.col("p_partkey").cast("string"), F.lit(f".{k}")).alias("path"), F.lit(k).alias("kind"), c.alias("content")) for k, c in kinds])
    return documents.parse(found).select("path", "page_num", "paragraph", "kind", "text")


@query("""
    SELECT p_partkey || '.pdf' AS path, 1 AS page_num, 0 AS paragraph, p_name || ' (' || p_brand || ')' AS text FROM part
    UNION ALL SELECT p_partkey || '.pdf', 1, 1, 'first ' || p_type || chr(10) || 'second ' || p_size || ' same line' FROM part
    UNION ALL SELECT p_partkey || '.pdf', 2, 0, p_type || ' on another page' FROM part
""")
def pdf_documents(t):
    """A heading, a paragraph of two lines, and a second page."""
    text = lambda c: F.concat(F.lit("("), F.regexp_replace(c, r"([()\\\\])", r"\\$1"), F.lit(")"))
    name, kind = F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")")), F.col("p_type")
    one = F.concat(F.lit("BT /F1 20 Tf 50 700 Td "), text(name), F.lit(" Tj ET BT /F1 10 Tf 12 TL 50 600 Td "), text(F.concat(F.lit("first "), kind)), F.lit(" Tj T* "), text(F.concat(F.lit("second "), F.col("p_size").cast("string"))), F.lit(" Tj 90 0 Td [(sa) 20 (me) -300 (line)] TJ ET"))
    two = F.concat(F.lit("BT /F1 10 Tf 50 700 Td "), text(kind), F.lit(" Tj 1 0 0 1 50 400 Tm (on another page) Tj ET"))
    stream = lambda n, body: F.concat(F.lit(f"{n} 0 obj << /Length "), F.octet_length(body).cast("string"), F.lit(" >>\nstream\n"), body, F.lit("\nendstream\nendobj\n"))
    page = "/Type /Page /Parent 2 0 R /Resources << /Font << /F1 7 0 R >> >>"
    head = f"%PDF-1.4\n1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj\n2 0 obj << /Type /Pages /Kids [3 0 R 4 0 R] /Count 2 >> endobj\n3 0 obj << {page} /Contents 5 0 R >> endobj\n4 0 obj << {page} /Contents [6 0 R] >> endobj\n7 0 obj << /Type /Font /Subtype /Type1 >> endobj\n"
    content = F.encode(F.concat(F.lit(head), stream(5, one), stream(6, two), F.lit("%%EOF")), "UTF-8")
    found = t("part").select(F.concat(F.col("p_partkey").cast("string"), F.lit(".pdf")).alias("path"), F.lit("pdf").alias("kind"), content.alias("content"))
    return documents.parse(found).select("path", "page_num", "paragraph", "text")


@query("SELECT c_custkey, c_name || ' é' AS text FROM customer")
def charset_fallback(t):
    """UTF-8 where it is valid, else Latin-1."""
    text = F.concat("c_name", F.lit(" é"))
    data = F.when(F.col("c_custkey") % 2 == 0, F.encode(text, "UTF-8")).otherwise(F.encode(text, "ISO-8859-1"))
    return t("customer").select("c_custkey", readers.decode_text(data).alias("text"))


@query("SELECT doc_id, text, 2 AS n FROM documents")
def append_sink(t):
    """K2, K3: appended twice in files of 50 rows; messages are left out."""
    docs = t("documents").select("doc_id", "text", F.col("source").alias("messages"))
    path = scratch_path(docs.sparkSession, "append")
    for _ in range(2):
        sinks.append_jsonl(docs, path, rows_per_file=50)
    return readers.jsonl(docs.sparkSession, path, "doc_id bigint, text string").groupBy("doc_id", "text").agg(F.count("*").cast("int").alias("n"))


@query("""
    SELECT doc_id, NULL AS line, 'raw' AS sink FROM documents
    UNION ALL SELECT doc_id, unnest(string_split(text, chr(10))), 'parsed' FROM documents
""")
def dual_sink(t):
    """K4: the raw rows, and the lines that are made of them."""
    docs = t("documents").select("doc_id", "text")
    path = scratch_path(docs.sparkSession, "dual")
    sinks.write_both(docs, f"{path}/raw", f"{path}/parsed", lambda df: df.select("doc_id", F.explode(F.split("text", "\n")).alias("line")))
    raw = readers.jsonl(docs.sparkSession, f"{path}/raw", "doc_id bigint").select("doc_id", F.lit(None).cast("string").alias("line"), F.lit("raw").alias("sink"))
    return raw.unionByName(readers.jsonl(docs.sparkSession, f"{path}/parsed", "doc_id bigint, line string").withColumn("sink", F.lit("parsed")))


@query("SELECT n_regionkey, n_nationkey, n_name FROM nation")
def case_files(t):
    """K5: a folder a case."""
    path = scratch_path(t("nation").sparkSession, "cases")
    sinks.write_cases(t("nation"), path, "n_regionkey")
    return readers.jsonl(t("nation").sparkSession, path, "n_regionkey int, n_nationkey int, n_name string")


@query("SELECT r_regionkey, r_name FROM region")
def stage_skip(t):
    """K7: a stage that is done is not run again."""
    rows = t("region")
    path = scratch_path(rows.sparkSession, "stage")
    sinks.run_stage(rows.sparkSession, path, lambda: rows)
    return sinks.run_stage(rows.sparkSession, path, lambda: rows.filter("false"))


@query("""
    SELECT event_id, CASE WHEN EXISTS (FROM events c WHERE c.event_id % 2 = 0 AND c.user_id = e.user_id AND c.event_type = e.event_type) THEN event_type || user_id END AS response FROM events e
""")
def response_cache(t):
    """K8: replies by a hash of the request, looked up in a keyed table."""
    key = sinks.cache_key(F.col("event_type"), F.col("user_id"))
    spark = t("events").sparkSession
    cache = keyed.KeyedTable(spark, scratch_path(spark, "cache"), buckets=8)
    cache.put(t("events").filter("event_id % 2 = 0").select(key.alias("key"), F.concat("event_type", F.col("user_id").cast("string")).alias("value")))
    return cache.lookup(t("events").select("event_id", key.alias("key")), "key").select("event_id", F.col("value").alias("response"))


@query("SELECT doc_id, upper(source) AS source, n_chars FROM documents")
def resumable_inference(t):
    """§2.15: the stream is started twice over rows that are there twice; each is
    worked on once. Every document has the same time, so none is late."""
    docs = t("documents").select("doc_id", "source", "n_chars", F.timestamp_seconds(F.lit(1_000_000)).alias("seen"))
    spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "stream")
    docs.unionByName(docs).write.parquet(f"{path}/in")
    source = spark.readStream.schema(docs.schema).parquet(f"{path}/in")
    for _ in range(2):
        incremental.resumable(source, lambda df: df.withColumn("source", F.upper("source")), f"{path}/out", f"{path}/checkpoint", "doc_id", time="seen").awaitTermination()
    return spark.read.parquet(f"{path}/out").select("doc_id", "source", "n_chars")


@query("""
    WITH w AS (SELECT *, CASE WHEN epoch_us(ts) // 1000 - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) // 1000 < 1800000 THEN 0 ELSE 1 END AS c FROM events),
    g AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM w)
    SELECT user_id AS conv_id, epoch_us(min(ts)) // 1000 AS start_ms, epoch_us(max(ts)) // 1000 AS end_ms, count(*) AS messages, count(*) FILTER (event_type = 'click') AS user_turns FROM g GROUP BY user_id, s
""")
def conversation_state(t):
    """§2.15: a fold a conversation in a stream's state: sessions of users, whose
    clicks count as user turns. The log comes in three parts, with a restart
    before the last."""
    log = t("events").select(F.col("user_id").alias("conv_id"), F.col("ts").cast("timestamp").alias("ts"), F.when(F.col("event_type") == "click", "user").otherwise(F.col("event_type")).alias("role"), F.lit(None).cast("string").alias("call_id"))
    spark, path = log.sparkSession, scratch_path(log.sparkSession, "conversations")
    # Files are taken in order of their time.
    source = lambda: spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    for part, more in enumerate((False, True, True)):
        days = F.greatest(F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2)), F.lit(0))
        log.filter(days == part).coalesce(1).write.mode("append" if part else "overwrite").parquet(f"{path}/in")
        if more:
            stateful.run(stateful.conversation_sessions(source()), f"{path}/out", f"{path}/checkpoint")
    return stateful.latest_sessions(spark.read.parquet(f"{path}/out")).select("conv_id", "start_ms", "end_ms", "messages", "user_turns")


_PIECES = "p AS (SELECT conv_id AS stream, turn AS call_index, role, unnest(string_split(text, '. ')) AS a, generate_subscripts(string_split(text, '. '), 1) - 1 AS seq FROM conversations)"
_CALLS = f"WITH {_PIECES} SELECT stream, call_index, any_value(role) AS name, string_agg(a, '' ORDER BY seq) AS arguments FROM p GROUP BY ALL"


def _fragments(t):
    """Messages as calls: the role is the name, sentences are the fragments."""
    rows = t("conversations").select(F.col("conv_id").alias("stream"), F.col("turn").alias("call_index"), "role", F.posexplode(F.split("text", r"\. ")).alias("seq", "arguments"))
    return rows.select("stream", "call_index", F.col("seq").cast("bigint").alias("seq"), F.when(F.col("seq") == 0, F.col("role")).otherwise("").alias("name"), "arguments")


@query(_CALLS)
def call_fragments(t):
    """§2.15: fragments of each call, joined in one pass."""
    return incremental.join_call_fragments(_fragments(t))


@query(_CALLS)
def streamed_call_fragments(t):
    """§2.15: the same from a stream in which every third fragment comes late, a
    batch after those behind it, and some come twice; restarted in between."""
    rows = _fragments(t)
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "fragments")
    late = F.pmod(F.xxhash64("stream", "call_index", "seq"), F.lit(3)) == 0
    for part in (rows.filter(~late), rows.filter(late | (F.col("seq") == 1))):
        part.write.mode("append").parquet(f"{path}/in")
        source = spark.readStream.schema(rows.schema).parquet(f"{path}/in")
        stateful.run(stateful.call_fragments(source), f"{path}/out", f"{path}/checkpoint")
    done = spark.read.parquet(f"{path}/out").groupBy("stream", "call_index").agg(F.max_by(F.struct("name", "arguments"), "fragments").alias("x"))
    return done.select("stream", "call_index", "x.*")
