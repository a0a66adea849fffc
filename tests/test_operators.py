import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftline.operators import chunking, codecs, generators, graphs, joins, messages, records, retrieval, scores

STEP = "array<struct<_uuid:int,hop_level:int,sub_question:string,is_parallel:boolean,dependency:array<int>,sub_answer:string,tool_necessity:boolean>>"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def steps(spark):
    data = [("u", 1, [], True), ("u", 2, [1], True), ("u", 3, [2, 1, 9], False), ("v", 1, None, False), ("v", 0, [1], None), ("w", 1, [], None)]
    return spark.createDataFrame(data, "uuid string, _uuid int, dependency array<int>, needed boolean")


def test_dependencies_keep_their_order(steps):
    got = joins.dependencies(steps).select("uuid", "_uuid", "position", "dep__uuid")
    assert rows(got) == [("u", 2, 0, 1), ("u", 3, 0, 2), ("u", 3, 1, 1), ("v", 0, 0, 1)]


def test_positions_start_at_one(spark):
    df = spark.createDataFrame([(["a", "b"], [1, 2, 0, 3])], "t array<string>, d array<int>")
    assert df.select(joins.by_position(F.col("t"), F.col("d"))).first()[0] == ["a", "b", None, None]


def test_legitimacy(steps):
    assert rows(joins.legitimacy(steps, "uuid", "_uuid", "dependency", "needed")) == [("u", True), ("v", False), ("w", True)]


def test_resume_with_null_and_duplicate_keys(spark):
    todo = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    done = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(joins.resume(todo, done, "k")) == [("b",), (None,)]
    assert joins.resume(todo, done.limit(0), "k").count() == 4
    assert rows(joins.resume_by(todo, done, F.upper("k"), F.upper("k"))) == [("b",), (None,)]


def test_results_take_the_last_definition(spark):
    calls = spark.createDataFrame([(1, "c", 0, "f"), (1, "c", 5, "g")], "r int, id string, idx int, fn string")
    results = spark.createDataFrame([(1, "c"), (1, "x"), (1, None)], "r int, id string")
    assert rows(joins.results_with_calls(results, calls, "r", "id", "idx", "fn")) == [(1, "c", "g"), (1, "x", None), (1, None, None)]


def test_alignment_zip_and_names(spark):
    df = spark.createDataFrame([([1, 2], [1, 2]), ([1, 2], [2, 1]), ([1], [1, 2])], "a array<int>, b array<int>")
    assert [r[0] for r in df.select(joins.aligned(F.col("a"), F.col("b"))).collect()] == [True, False, False]
    text = df.select(joins.zip_equal(F.transform("a", lambda x: x.cast("string")), F.transform("b", lambda x: x.cast("string"))).alias("z"))
    assert [len(r.z) for r in text.collect()] == [2, 2, 0]
    said = spark.createDataFrame([("hi @bob and @ann, @bob",), ("none",)], "m string")
    assert [r[0] for r in said.select(joins.mentioned(F.col("m"), ["ann", "bob"])).collect()] == [["bob", "ann"], []]


def test_merged_results(spark):
    records_ = spark.createDataFrame([("a", {"1": "x", "2": "y", "3": "z"}, [[1, 2]]), ("b", {"1": "x"}, [[1]]), ("c", {"1": "q"}, [])], "uuid string, envs map<string,string>, clusters array<array<int>>")
    merged = spark.createDataFrame([("a", "[1,2]", "passed", "M"), ("b", "[1]", "failed", "N")], "uuid string, members string, status string, code string")
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    assert {r.uuid: r.envs for r in joins.merged_results(records_, merged).collect()} == {"a": {"1": "M", "2": "M", "3": "z"}, "c": {"1": "q"}}


def test_overlay_and_map_keys(spark):
    base = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, d string")
    assert rows(joins.overlay(base, spark.createDataFrame([("a", "new"), ("b", None)], "k string, d string"), "k")) == [("a", "new"), ("b", "y")]
    df = spark.createDataFrame([({"1": "p"}, [1, 2])], "m map<string,string>, i array<int>")
    assert [tuple(x) for x in df.select(joins.by_map_key(F.col("m"), F.col("i"))).first()[0]] == [("1", "p")]


def test_votes(spark):
    data = [("maj", 0, True, "a"), ("maj", 1, True, "b"), ("maj", 2, False, "c"), ("tie", 0, False, "d"), ("tie", 1, True, "e"), ("none", 0, None, "f")]
    got = scores.majority_vote(spark.createDataFrame(data, "k string, i int, ok boolean, t string"), "k", "ok", "i", "t")
    assert rows(got) == [("maj", 2, 1, 0, True, 0, "a"), ("none", 0, 0, 1, False, None, None), ("tie", 1, 1, 0, False, 1, "e")]


def test_means_and_sentinels(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "0.5"), ("b", "x")], "k string, v string")
    assert rows(scores.mean_score(df, "k", F.col("v"))) == [("a", 0.75), ("b", 1.0)]
    one = spark.range(1)
    assert one.select(scores.overall(F.lit(0.5), F.lit(None), F.lit(-100.0), F.lit(1))).first()[0] == -24.375
    entries = spark.createDataFrame([("r", '{"think": {"s": 0}, "a": {"s": 0}, "b": {"s": "x"}, "c": 3}'), ("e", "bad")], "r string, j string")
    assert rows(scores.entry_mean(entries, "r", "j", "s")) == [("e", 1.0), ("r", 0.5)]


def test_percentile_interpolates(spark):
    got = scores.above_percentile(spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "s double"), "s").collect()
    assert [(r.s, round(r.threshold, 6)) for r in got] == [(10.0, 7.9)]


def test_best_attempt_prefers_the_latest_of_equals(spark):
    data = [(1, 1, "t", "passed"), (1, 1, "u", "failed"), (1, 2, "t", "failed"), (1, 2, "u", "passed"), (2, 1, None, "skipped")]
    got = scores.best_attempt(spark.createDataFrame(data, "c int, a int, t string, s string"), "c", "a", "t", "s")
    assert rows(got) == [(1, 2, 1, 2, False, True, 2), (2, 1, 0, 0, False, False, 1)]


def test_fold_and_counters(spark):
    log = spark.createDataFrame([("k", 1, "put", "a"), ("k", 2, "update", "b"), ("d", 1, "put", "x"), ("d", 2, "delete", None)], "k string, i int, op string, v string")
    assert rows(scores.kv_fold(log, "k", "i", "op", "v")) == [("k", "b")]
    df, seen = scores.stage_counters(spark.range(10), "stage", F.col("id") < 3)
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"total": 10, "success": 3}


MESSAGES = "conv_id int, turn int, role string, text string"


def test_plan_segments_and_batches(spark):
    roles = ["user", "assistant", "tool", "tool", "assistant", "tool", "assistant"]
    df = spark.createDataFrame([(1, i, r, r) for i, r in enumerate(roles)], MESSAGES)
    assert [r.turn for r in messages.plan_segments(df).collect()] == [4]
    assert rows(messages.tool_batches(df, "conv_id", "turn", "role", "tool").select("first", "last", "n", "follower")) == [(2, 3, 2, 4)]
    ends = spark.createDataFrame([(1, i, r, r) for i, r in enumerate(roles[:3])], MESSAGES)
    assert messages.tool_batches(ends, "conv_id", "turn", "role", "tool").count() == 0


def test_truncation_rule(spark):
    kind = "array<struct<role:string,content:string,tokens:int>>"

    def run(items, budget):
        df = spark.createDataFrame([(items,)], f"m {kind}")
        return [(x.role, x.content) for x in df.select(messages.truncate_messages(F.col("m"), budget)).first()[0]]

    item = lambda role, n, w="w": (role, " ".join([w] * n), n)
    items = [item("system", 2), item("user", 5, "old"), item("assistant", 3), item("user", 2)]
    assert run(items, 20) == [(r, c) for r, c, _ in items]
    assert run(items, 9) == [("system", "w w"), ("user", "old old"), ("assistant", "w w w"), ("user", "w w")]
    assert run(items, 6) == [("system", "w w"), ("user", "w w")]
    call = [item("user", 3, "q"), item("function", 9, "f"), item("user", 2)]
    assert run(call, 6) == [("user", "q q q"), ("function", "f f... f f"), ("user", "w w")]
    assert run([item("user", 9)], 4) == []


def test_speakers(spark):
    one = spark.range(1)
    names = F.array(F.lit("a"), F.lit("b"), F.lit("c"))
    assert [one.select(messages.next_speaker(names, F.lit(x))).first()[0] for x in ("a", "c", "?")] == ["b", "a", "a"]
    lines = spark.createDataFrame([(1, 0, "I. One"), (1, 1, "text"), (1, 2, "II. Two")], "d int, i int, t string")
    assert rows(messages.sections(lines, "d", "i", "t").select("t", "next_heading")) == [("I. One", "II. Two"), ("II. Two", None)]
    fonts = spark.createDataFrame([(1, 0, 10.0, "a"), (1, 1, 11.0, "b"), (1, 2, 20.0, "c")], "d int, i int, s double, t string")
    assert rows(messages.similar_size_paragraphs(fonts, "d", "i", "s", "t").select("t")) == [("ab",), ("c",)]


def test_walk_counts_are_matrix_powers(spark):
    random.seed(3)
    edges = sorted({(random.randrange(6), random.randrange(6)) for _ in range(14)})
    df = spark.createDataFrame(edges, "src int, dst int")
    counts = {r.n: r["count"] for r in graphs.walks(df, 1, 5).groupBy(F.size("walk").alias("n")).count().collect()}
    nodes = sorted({x for e in edges for x in e})
    matrix = [[int((a, b) in edges) for b in nodes] for a in nodes]
    power, want = [[int(a == b) for b in nodes] for a in nodes], {1: len(nodes)}
    for n in range(2, 6):
        power = [[sum(power[i][k] * matrix[k][j] for k in range(len(nodes))) for j in range(len(nodes))] for i in range(len(nodes))]
        want[n] = sum(map(sum, power))
    assert counts == {n: c for n, c in want.items() if c}


def test_edges_skip_unknown_tools(spark):
    df = spark.createDataFrame([("g", ["a", "?", "b", "b", "a"], ["a", "b"]), ("g", ["a"], ["a", "b"])], "g string, c array<string>, n array<string>")
    assert rows(graphs.edges_from_chains(df, "g", F.col("c"), "n").select("src", "dst")) == [("a", "b"), ("b", "a"), ("b", "b")]
    assert graphs.known_chains(df, "c", "n").count() == 1


def test_chunks(spark):
    random.seed(1)
    word = lambda: random.choice("abcdefg") * random.randint(1, 6)
    sentence = lambda: " ".join(word() for _ in range(random.randint(3, 12)))
    paragraphs = [". ".join(sentence() for _ in range(random.randint(1, 9))) for _ in range(40)]
    paragraphs[7] = " ".join(word() for _ in range(900))

    def split(pages, size=500):
        table = [("u", page, i, p) for page, ps in pages for i, p in enumerate(ps)]
        df = spark.createDataFrame(table, "path string, page_num int, paragraph int, text string")
        return [(r.content, r.token) for r in chunking.chunk_pages(df, size=size).orderBy("chunk_id").collect()]

    chunks = split([(1, paragraphs[:20]), (2, paragraphs[20:])], 100)
    assert len(chunks) > 20
    text = "\n".join(c for c, _ in chunks)
    said, wanted = (Counter("".join(c if c.isalpha() else " " for c in x).split()) for x in (text, " ".join(paragraphs)))
    assert all(said[w] >= n for w, n in wanted.items())
    assert all(n <= 100 + 60 for _, n in chunks) and all(c.startswith("[page: ") for c, _ in chunks)
    assert any("\n[page: 2]\n" in c for c, _ in chunks)
    assert split([(1, ["short", "text"])]) == [("[page: 1]\nshort\ntext", 2)]
    assert split([]) == []
    exact = " ".join(["w"] * 100)
    assert split([(1, [exact])], 100) == [(f"[page: 1]\n{exact}", 100)]


def test_chunks_overlap(spark):
    df = spark.createDataFrame([("u", "\n".join(f"paragraph {i} " + "x " * 30 for i in range(9)).strip()), ("e", ""), ("n", None)], "url string, text string")
    got = chunking.chunk(df, "url", "text", 70).orderBy("chunk_id").collect()
    assert {r.url for r in got} == {"u"} and [r.chunk_id for r in got] == list(range(len(got)))
    assert all("paragraph" in r.content for r in got)
    assert any(a.content.splitlines()[-1] == b.content.splitlines()[1] for a, b in itertools.pairwise(got))


@pytest.mark.parametrize("dialect", codecs.DIALECTS)
def test_codecs_round_trip(spark, dialect):
    render, parse = codecs.DIALECTS[dialect]
    df = spark.createDataFrame([([("f", '{"a":1}'), ("g", "{}")],), ([],)], f"c {codecs.CALL}")
    assert [r.c for r in df.collect()] == [r.c for r in df.select(parse(F.concat(F.lit("I call "), render(F.col("c")))).alias("c")).collect()]


def test_broken_calls_are_salvaged(spark):
    df = spark.createDataFrame([('<tool_call>\n{"name": "f", "arguments": {"a": }}\n</tool_call>',), ('<tool_call>{"name": "g", "arguments": {}}',), ("none",)], "s string")
    assert [[tuple(c) for c in r[0]] for r in df.select(codecs.parse_tags(F.col("s"))).collect()] == [[("f", '{"a": }')], [("g", "{}")], []]


def chunk_rows(spark, tokens):
    return spark.createDataFrame([("d", i, " ".join(["w"] * n), n) for i, n in enumerate(tokens)], "doc string, chunk_id int, text string, token int")


def test_budgets(spark):
    chunks = chunk_rows(spark, [5, 5, 5])
    cut = lambda b: [(r.chunk_id, r.used, r.cut) for r in retrieval.within_budget(chunks, ["doc"], [F.col("chunk_id")], b, text="text").orderBy("chunk_id").collect()]
    assert cut(5) == [(0, 5, False)] and cut(7) == [(0, 5, False), (1, 2, True)] and cut(0) == []
    assert [r.chunk_id for r in retrieval.front_pins(chunks, 20).collect()] == [0, 1] and retrieval.front_pins(chunks, 19).count() == 0


def test_search_decision(spark):
    chunks = chunk_rows(spark, [5, 5, 5]).withColumn("s", F.lit(1))
    score = spark.createDataFrame([(1, "d", 2, 3.0)], "s int, doc string, chunk_id int, score double")
    ids = lambda s, b: sorted(r.chunk_id for r in retrieval.search_sessions(chunks, s, "s", "doc", b).collect())
    assert ids(score, 15) == [0, 1, 2] and ids(score, 8) == [0, 2]
    assert ids(score.withColumn("score", F.lit(0.0)), 8) == [0, 1] and ids(score.limit(0), 8) == [0, 1]


def test_fusion_keeps_pins(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, rank int")
    b = spark.createDataFrame([("y", 1)], "k string, rank int")
    got = {r.k: r.score for r in retrieval.fuse([a, b], ["k"]).collect()}
    assert got == {"x": pytest.approx(1 / 61), "y": pytest.approx(1 / 62 + 1 / 61)}


def test_stop_words_alone_find_nothing(spark):
    docs = spark.createDataFrame([(1, "the quick fox"), (2, "a lazy dog")], "doc_id int, text string")
    queries = spark.createDataFrame([(1, "the of and"), (2, "fox fox")], "q int, text string")
    assert [(r.q, r.doc_id) for r in retrieval.bm25(docs, queries, ["doc_id"], "q").collect()] == [(2, 1)]


def test_grids_and_variations(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    weights = spark.createDataFrame([("a", 3), ("b", 0)], "k string, n int")
    assert rows(generators.prompt_grid(df, ["en"], weights, 1, "k").groupBy("k").count()) == [("a", 3)]
    reply = spark.createDataFrame([("<question>a</question>",), ("",), ("<variation_1 x='1'><QUESTION><!--c-->b</QUESTION></variation_1>",)], "s string")
    assert [r[0] for r in reply.select(generators.variations(F.col("s"))).collect()] == [["a"], [], ["b"]]
    people = spark.createDataFrame([(0, "p"), (1, "q")], "row_id bigint, name string")
    first, second = (rows(generators.augmentation_grid(df, ["m"], people, 5, "k")) for _ in range(2))
    assert first == second and len(first) == 10
    assert generators.augmentation_grid(df, ["m"], people.limit(0), 2, "k").count() == 4


def test_taxonomy(spark):
    df = spark.createDataFrame([("t", '{"a": {"b": {"description": "d", "examples": ["e"]}}, "c": {"description": "f"}}'), ("bad", "x")], "n string, v string")
    assert rows(generators.leaves(df, "n", "v").select("name", F.array_join("path", "/"), "description")) == [("t", "a/b", "d"), ("t", "c", "f")]


def test_files_and_headings(spark):
    one = spark.range(1)
    files = generators.distinct_files(F.array(F.lit("a.pdf"), F.lit("b.exe")), F.array(F.lit("a.pdf"), F.lit("c.TXT")), ["pdf", "txt"])
    assert one.select(files).first()[0] == ["a.pdf", "c.TXT"]
    assert one.select(generators.roman_headings(F.lit("I. a\nx\nIV. b"))).first()[0] == ["I. a", "IV. b"]


def test_record_gates(spark):
    env = "struct<question:string,answer:string,tool_document:string,tool_call_statement:string,code:string,tool_call_ans:string>"
    good = ("q", "42", '{"name": "n", "description": "d", "parameters": {}}', "f(1)", "c", "is 42")
    df = spark.createDataFrame([({"1": good, "2": None},), ({"1": (*good[:3], "get('http://x')", *good[4:])},), ({"1": (*good[:5], "none")},), ({"1": (*good[:2], "{}", *good[3:])},)], f"e map<string,{env}>")
    assert [r[0] for r in df.select(records.record_ok(F.col("e"))).collect()] == [True, False, False, False]
    servers = spark.createDataFrame([('{"mcpServers": {"a": {"command": "x", "args": ["y"]}}}',), ('{"mcpServers": {"a": {"command": "x"}}}',), ('{"mcpServers": {"a": {"url": "u"}}}',), ("{}",), ("bad",)], "s string")
    assert [r[0] for r in servers.select(records.valid_servers(F.col("s"))).collect()] == [True, False, True, False, False]
    chains = spark.createDataFrame([([("yes", ["a"], None, None), ("no", ["b"], None, None), ("yes", ["c"], "2", None), ("yes", ["d"], "1", ["e"])],)], "c array<struct<tool_graph_detect:string,tool_graph_detect_chain:array<string>,error_info:string,new_chain:array<string>>>")
    assert chains.select(records.usable_chains(F.col("c"))).first()[0] == [["a"], ["e"]]


def test_record_rendering(spark):
    df = spark.createDataFrame([([(1, 1, "q", False, None, "a", True), (2, 2, "r", True, [1], "b", False)],)], f"t {STEP}")
    assert df.select(records.compact_steps(F.col("t"))).first()[0] == "id=1 | hop=1 | parallel=false | dep=null | q=q | a=a\nid=2 | hop=2 | parallel=true | dep=[1] | q=r | a=b"
    assert df.select(F.size(records.needed_steps(F.col("t")))).first()[0] == 1
    assert df.select(records.steps_for_clustering(F.col("t"))).first()[0].startswith('[{"_uuid":1')
    one = spark.range(1)
    table = F.array(F.array(F.lit("a"), F.lit(None)), F.array(F.lit("b\nc"), F.lit("d")))
    assert one.select(records.rows_as_pipe_table(table)).first()[0] == "|a|None|\n|b c|d|"
    assert one.select(records.clean_parameters(F.lit('{"properties": {"a": {}}, "x": 1}'))).first()[0] == '{"type":"object","properties":{"a":{}},"required":[]}'
    raw = spark.createDataFrame([('{"mcp_info": {"base_info": {"group_info": {"server_name": "s"}, "tool_list": [{"name": "f"}]}}, "extra": 1}',), ('{"base_info": {"group_info": {"server_name": "t"}}}',), ("bad",)], "value string")
    got = records.normalise_tools(raw).select("server_name", F.size("tools"), F.expr("try_variant_get(record, '$.extra', 'int')"))
    assert rows(got) == [("s", 1, 1), ("t", 0, None)]


def test_order_statistics(spark, monkeypatch):
    monkeypatch.setattr(scores, "BINS", 8)
    monkeypatch.setattr(scores, "FEW", 4)
    random.seed(8)
    values = [random.choice([0.0, 1.5, -2.0]) for _ in range(60)] + [random.gauss(0, 1e-9) for _ in range(40)] + [1e308, -1e308, 1e300, 5e-324, float("inf")] + [1.5 + i * 2**-52 for i in range(9)]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan"), float("nan")]], "v double").cache()
    expected = sorted(values)
    for rank in (0, 1, 17, 50, 99, len(values) - 2, len(values) - 1):
        assert scores.order_statistic(df, "v", rank) == expected[rank]
    assert str(scores.order_statistic(df, "v", len(values))) == "nan" and scores.order_statistic(df, "v", len(values) + 2) is None
    monkeypatch.undo()
    rows_of = lambda xs, q: [r.v for r in scores.above_percentile(spark.createDataFrame([(float(x),) for x in xs], "v double"), "v", q).orderBy("v").collect()]
    assert rows_of(range(11), 0.9) == [9.0, 10.0] and rows_of([1, 2], 0.5) == [2.0] and rows_of([3, 3, 3], 0.9) == [3.0] * 3 and rows_of([], 0.9) == []
