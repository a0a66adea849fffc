import io
import zipfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from weftline.models import provider
from weftline.operators import codecs
from weftline.sources import documents, keyed, readers, sinks
from weftline.streaming import incremental, stateful


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_jsonl_forms(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"a": 1, "b": "é"}\n\nbad\n{}\n{"a": 2}\n')
    good, bad = readers.jsonl_tolerant(spark, str(path), "a int, b string")
    assert rows(good) == [(1, "é"), (2, None)] and rows(bad) == [("bad",)]
    assert rows(readers.jsonl_silent(spark, str(path), "a int, b string").filter("a IS NOT NULL")) == [(1, "é"), (2, None)]
    with pytest.raises(Exception):
        readers.jsonl(spark, str(path), "a int").collect()
    (tmp_path / "y.json").write_text('[{"a": 1},\n {"a": 2}]')
    assert rows(readers.records(spark, str(tmp_path / "y.json"), "a int")) == [(1,), (2,)]
    with pytest.raises(ValueError):
        readers.records(spark, "x.xml")


def test_small_tables(spark, tmp_path):
    (tmp_path / "w.txt").write_text("1 5\nx\n2 7 9\n1 6\n")
    assert rows(readers.weights(spark, str(tmp_path / "w.txt"))) == [(1, 6), (2, 7)]
    (tmp_path / "base_en.md").write_text("hello {x}")
    assert rows(readers.prompt_templates(spark, str(tmp_path / "base_en.md"))) == [("base", "en", "hello {x}")]
    hits = spark.createDataFrame([("q", 2, "t2", "s2", ""), ("q", 1, "t1", "s1", "d")], "query string, rank int, title string, snippet string, date string")
    assert readers.web_results(hits).first().text == '[1] "t1\ns1"\nd\n\n[2] "t2\ns2"'
    assert rows(readers.lookup_code(hits.select(F.col("title").alias("city")), spark.createDataFrame([("t1", "7")], "city string, code string"), "city", "code")) == [("t1", "7", None), ("t2", None, "no code for t2")]


def test_charsets(spark):
    df = spark.createDataFrame([("é".encode(),), ("é".encode("latin-1"),)], "b binary")
    assert [r[0] for r in df.select(readers.decode_text(F.col("b"))).collect()] == ["é", "é"]


def office(parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def test_documents_of_many_kinds(spark, tmp_path):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    a = 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main"'
    s = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    (tmp_path / "a.docx").write_bytes(office({"word/document.xml": f"<w:document {w}><w:body><w:p><w:r><w:t>para</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>c1</w:t></w:r></w:p></w:tc><w:tc><w:p/></w:tc></w:tr></w:tbl></w:body></w:document>"}))
    (tmp_path / "b.pptx").write_bytes(office({"ppt/slides/slide1.xml": f"<a:s {a}><a:p><a:t>one</a:t></a:p></a:s>", "ppt/slides/slide10.xml": f"<a:s {a}><a:p><a:t>ten</a:t></a:p></a:s>", "ppt/slides/slide2.xml": f"<a:s {a}><a:tbl><a:tr><a:tc><a:p><a:t>t</a:t></a:p></a:tc></a:tr></a:tbl></a:s>"}))
    (tmp_path / "c.xlsx").write_bytes(office({"xl/sharedStrings.xml": f"<sst {s}><si><t>head</t></si></sst>", "xl/worksheets/sheet1.xml": f'<worksheet {s}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1"><v>3</v></c></row></sheetData></worksheet>'}))
    (tmp_path / "d.csv").write_bytes(b"x,y\n1,2\n3,4,5\n\xff,6\n")
    (tmp_path / "e.html").write_text("<title>T</title><p>one</p><p>two</p>")
    (tmp_path / "f.txt").write_text("l1\n\nl3")
    (tmp_path / "g.pdf").write_bytes(b"%PDF")
    (tmp_path / "h.docx").write_bytes(b"broken")
    found = readers.files(spark, str(tmp_path))
    got = {}
    for r in documents.parse(found).orderBy("path", "page_num", "paragraph").collect():
        got.setdefault(r.path.rsplit("/", 1)[1], []).append((r.page_num, r.kind, r.text))
    assert got["a.docx"] == [(1, "text", "para"), (1, "table", "|c1|\n|---|")]
    assert got["b.pptx"] == [(1, "text", "one"), (2, "table", "|t|\n|---|"), (3, "text", "ten")]
    assert got["c.xlsx"] == [(1, "table", "|head|3|\n|---|---|")]
    assert got["d.csv"] == [(1, "table", "|x|y|\n|---|---|\n|1|2|\n|�|6|")]
    assert [t for _, _, t in got["e.html"]] == ["T", "one", "two"]
    assert [t for _, _, t in got["f.txt"]] == ["l1", "", "l3"]
    assert got["g.pdf"][0][1] == got["h.docx"][0][1] == "error"
    cache = documents.parse(found.filter("path LIKE '%txt'"))
    everything, new = documents.parse_cached(found.filter("path LIKE '%txt' OR path LIKE '%html'"), cache)
    assert new.select("path").distinct().count() == 1 and everything.select("path").distinct().count() == 2


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "é", "m")], "a int, b string, messages string")
    sinks.append_jsonl(df, f"{tmp_path}/a")
    sinks.append_jsonl(df, f"{tmp_path}/a")
    assert spark.read.json(f"{tmp_path}/a").columns == ["a", "b"] and spark.read.json(f"{tmp_path}/a").count() == 2
    sinks.write_both(df, f"{tmp_path}/raw", f"{tmp_path}/parsed", lambda x: x.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))))
    assert spark.read.json(f"{tmp_path}/parsed").count() == 2
    calls = []
    stage = lambda: (calls.append(1), spark.range(3))[1]
    assert sinks.run_stage(spark, f"{tmp_path}/s", stage).count() == sinks.run_stage(spark, f"{tmp_path}/s", stage).count() == 3
    assert len(calls) == 1
    keys = df.select(sinks.cache_key(F.col("a"), F.col("b")).alias("x"), sinks.cache_key(F.col("b"), F.col("a")).alias("y")).first()
    assert len(keys.x) == 64 and keys.x != keys.y


def replayed(spark, pairs):
    table = spark.createDataFrame([(p, s, r, e) for p, s, r, e in pairs], "p string, sample int, response string, error string")
    return provider.provider("replay", table=table.withColumn("key", F.sha2("p", 256)).drop("p"))


def test_replay_and_votes(spark):
    ask = replayed(spark, [("q", 0, "<think>t</think>yes", None), ("q", 1, "no", None), ("e", 0, None, "timeout")])
    got = provider.samples(spark.createDataFrame([("q",), ("e",)], "prompt string"), 2, ask)
    assert rows(got.select("prompt", "sample", "response", "reasoning", "error")) == [("e", 0, None, "", "timeout"), ("e", 1, None, "", "no response"), ("q", 0, "yes", "t", None), ("q", 1, "no", "", None)]


def test_callback_tries_again(spark):
    def client(prompt):
        if prompt == "bad":
            raise RuntimeError("down")
        return prompt.upper()

    ask = provider.provider("callback", call=client, tries=2, base=0.01)
    got = ask(spark.createDataFrame([("a",), ("bad",)], "prompt string"))
    assert rows(got.select("prompt", "response", "error")) == [("a", "A", None), ("bad", None, "RuntimeError: down")]
    with pytest.raises(ValueError):
        provider.register("callback")(lambda: None)


def test_back_translation(spark):
    ask = replayed(spark, [("to query a,b", 0, '{"query": "Q"}', None), ("to chain Q", 0, '```json\n{"chain": ["a", "b"]}\n```', None), ("to query c", 0, '{"query": "R"}', None), ("to chain R", 0, "none", None)])
    chains = spark.createDataFrame([(["a", "b"],), (["c"],)], "chain array<string>")
    got = provider.back_translation(chains, F.concat(F.lit("to query "), F.array_join("chain", ",")), lambda q: F.concat(F.lit("to chain "), q), ask)
    assert sorted((r.query, r.is_valid) for r in got.collect()) == [("Q", True), ("R", False)]
    votes = spark.createDataFrame([(1, True), (1, False), (2, True), (2, True), (2, False)], "k int, is_valid boolean")
    assert rows(provider.cross_model(votes, "k")) == [(1, False), (2, True)]


def test_operator_chain(spark):
    ops = provider.Operators()
    ops.add("ok", lambda df: df.withColumns({"result": F.lit("r"), "failed": F.lit(None).cast("string")}))
    ops.add("bad", lambda df: df.withColumns({"result": F.lit(None).cast("string"), "failed": F.lit("why")}))
    assert ops.run(spark.range(1), ["ok", "bad"]).first().operator_results == {"ok": "r", "bad": '{"error":"why","status":"failed"}'}
    with pytest.raises(ValueError):
        ops.run(spark.range(1), ["ok", "ok"])
    with pytest.raises(ValueError):
        ops.add("ok", lambda df: df)


def test_tools_and_agent_loop(spark, tmp_path):
    spark.sparkContext.setCheckpointDir(str(tmp_path / "cp"))
    call = '<tool_call>\n{"name": "f", "arguments": {"x":1}}\n</tool_call>'
    ask = replayed(spark, [("ask", 0, call, None), (f"ask\n{call}\nresult", 0, "final", None), ("plain", 0, "done", None)])
    registry = spark.createDataFrame([("f",)], "name string")
    table = spark.createDataFrame([("f", '{"x":1}', "result")], "tool string, a string, content string").withColumn("args_key", F.sha2("a", 256)).drop("a")
    answer = lambda calls: provider.call_tools(calls, registry, table)
    tasks = spark.createDataFrame([("k", "ask"), ("p", "plain")], "key string, prompt string")
    got = provider.agent_loop(tasks, ask, answer, codecs.parse_tags)
    assert sorted((r.key, r.n_calls, r.response, r.finished) for r in got.collect()) == [("k", 1, "final", True), ("p", 0, "done", True)]
    unknown = provider.call_tools(spark.createDataFrame([("g", "{}")], "name string, arguments string"), registry, table)
    assert unknown.first().content == "Tool g does not exists."
    ran = provider.sandbox(spark.createDataFrame([("print(1)",), ("x",)], "code string"), spark.createDataFrame([("print(1)", "ok", "1")], "c string, status string, stdout string").withColumn("key", F.sha2("c", 256)))
    assert sorted((r.code, r.status, r.stdout) for r in ran.collect()) == [("print(1)", "ok", "1"), ("x", "exception", None)]


def test_keyed_table(spark, tmp_path):
    table = keyed.KeyedTable(spark, f"{tmp_path}/kv", buckets=4)
    pairs = lambda *kv: spark.createDataFrame(kv, "key string, value string")
    assert table.scan().count() == 0 and table.get("a").count() == 0
    table.put(pairs(("a/b", "1"), ("a/c", "2"), ("ab", "3"), (None, "x"), ("a/b", "0")))
    table.put(pairs(("ab", "9"), ("n", None)))
    table.delete(pairs(("a/c", ""), ("none", "")))
    held = [("a/b", "1"), ("ab", "9"), ("n", None)]
    assert rows(table.scan()) == held and rows(table.scan("a/")) == [("a/b", "1")] and rows(table.get("ab", "a/c")) == [("ab", "9")]
    assert rows(table.lookup(spark.createDataFrame([(1, "ab"), (2, "a/c"), (3, None), (4, "ab")], "i int, k string"), "k")) == [(1, "ab", "9"), (2, "a/c", None), (3, None, None), (4, "ab", "9")]
    table.compact()
    assert [f for f in table.folders()] == [(2, True)] and rows(table.scan()) == held
    table.vacuum()
    assert rows(table.scan()) == held
    table.put(pairs(("a/c", "back")))
    table.delete(pairs(("ab", "")))
    assert rows(table.scan("a")) == [("a/b", "1"), ("a/c", "back")] and len(table.folders()) == 3
    # A folder without its success mark, as a writer that died leaves it, does not count.
    table._write(pairs(("ghost", "1")).selectExpr("key", "value", "false AS deleted"), 99)
    (tmp_path / "kv" / "rows-99" / "_SUCCESS").unlink()
    assert table.get("ghost").count() == 0


def test_keyed_table_reads_only_what_it_needs(spark, tmp_path):
    table = keyed.KeyedTable(spark, f"{tmp_path}/kv", buckets=16)
    table.put(spark.range(4000).selectExpr("concat('k', id) AS key", "id AS value"))
    table.compact()
    plan = table.get("k17")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "EqualTo(key,k17)" in plan
    assert "StringStartsWith(key,k1)" in table.scan("k1")._jdf.queryExecution().executedPlan().toString()
    folders = {p.name for p in (tmp_path / "kv" / "base-0").iterdir() if p.is_dir()}
    assert len(folders) == 16


def test_streams(spark, tmp_path):
    schema = "conv_id bigint, role string"
    spark.createDataFrame([(1, "user"), (1, "assistant"), (2, "user"), (2, "user")], schema).coalesce(1).write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    for _ in range(2):
        incremental.resumable(source, lambda df: df.withColumn("out", F.upper("role")), f"{tmp_path}/out", f"{tmp_path}/cp", "conv_id").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2
    # New rows come with an old key; what an earlier job did is left out.
    spark.createDataFrame([(2, "user"), (3, "user"), (4, "user")], schema).write.mode("append").parquet(f"{tmp_path}/in")
    done = spark.createDataFrame([(4,)], "conv_id bigint")
    incremental.resumable(source, lambda df: df.withColumn("out", F.upper("role")), f"{tmp_path}/out", f"{tmp_path}/cp", "conv_id", done).awaitTermination()
    assert sorted(r.conv_id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2, 3]


def test_resumable_forgets_keys_behind_the_watermark(spark, tmp_path):
    schema = "id bigint, ts timestamp"
    at = lambda day: datetime(2024, 1, day)
    (tmp_path / "in").mkdir()
    source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    for rows_of in ([(1, at(1)), (2, at(1)), (1, at(1))], [(1, at(1)), (3, at(9))], [(3, at(9)), (1, at(1)), (4, at(9))]):
        spark.createDataFrame(rows_of, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        incremental.resumable(source, lambda df: df, f"{tmp_path}/out", f"{tmp_path}/cp", "id", time="ts", late="1 day").awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [1, 2, 3, 4]


def test_conversation_fold(spark, tmp_path):
    """Batches with a restart between them, a late row, open calls, and a
    conversation that its timer closes."""
    schema = "conv_id bigint, ts timestamp, role string, call_id string"
    at = lambda h, m=0: datetime(2024, 1, 1, h, m)
    (tmp_path / "in").mkdir()
    source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    batches = [
        [(1, at(0), "user", None), (1, at(0, 5), "assistant", "a"), (2, at(0, 10), "user", None)],
        [(1, at(0, 20), "function", "a"), (1, at(0, 25), "assistant", "b"), (1, at(0, 4), "user", None)],
        [(3, at(9), "user", None), (2, at(0, 39), "user", None)],
        [(3, at(9, 10), "assistant", "c"), (1, at(9, 20), "user", None)],
    ]
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stateful.run(stateful.conversation_sessions(source, "30 minutes", "20 minutes"), f"{tmp_path}/out", f"{tmp_path}/cp")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != stateful._ROCKSDB
    found = {(r.conv_id, r.start_ms // 60000 % 1440): (r.messages, r.user_turns, r.open_calls, r.closed) for r in stateful.latest_sessions(spark.read.parquet(f"{tmp_path}/out")).collect()}
    assert found == {(1, 0): (5, 2, 1, True), (2, 10): (2, 2, 0, True), (3, 540): (2, 1, 1, False), (1, 560): (1, 1, 0, False)}


@pytest.mark.parametrize("closed", [[False, True], [True, False]])
def test_a_session_that_closes_without_a_row(spark, closed):
    updates = spark.createDataFrame([(2, 10, 39, 2, 2, 0, c) for c in closed], stateful._SESSION).coalesce(1)
    assert rows(stateful.latest_sessions(updates)) == [(2, 10, 39, 2, 2, 0, True)]


def test_call_fragments_in_a_stream(spark, tmp_path):
    schema = "stream bigint, call_index bigint, seq bigint, name string, arguments string"
    (tmp_path / "in").mkdir()
    source = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    for part in ([(1, 0, 0, "f", '{"a"'), (1, 0, 2, "", "1}"), (1, 1, 0, "", None)], [(1, 0, 1, None, ": "), (1, 0, 0, "g", "again"), (1, 1, 1, "h", "{}")]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stateful.run(stateful.call_fragments(source, ttl_ms=3_600_000), f"{tmp_path}/out", f"{tmp_path}/cp", endless=True)
    out = spark.read.schema(f"{stateful._CALL}, batch_id int").parquet(f"{tmp_path}/out")
    assert rows(out.filter("fragments = 1").drop("batch_id")) == [(1, 0, "f", '{"a"', 1, 1), (1, 1, "", "", 1, 0)]
    assert rows(out.filter("fragments > 1").drop("batch_id")) == [(1, 0, "f", '{"a": 1}', 3, 0), (1, 1, "h", "{}", 2, 0)]


def test_deltas_and_fragments(spark):
    deltas = spark.createDataFrame([("s", 2, "b"), ("s", 1, "a")], "stream string, seq int, delta string")
    assert rows(incremental.join_deltas(deltas)) == [("s", "ab")]
    parts = spark.createDataFrame([("s", 0, 1, "f", '{"a"'), ("s", 0, 2, "", ": 1}"), ("s", 1, 1, "g", None)], "stream string, call_index int, seq int, name string, arguments string")
    assert rows(incremental.join_call_fragments(parts)) == [("s", 0, "f", '{"a": 1}'), ("s", 1, "g", "")]
