"""Queries over whole tables, against brute force."""

from collections import defaultdict
from hashlib import sha256

from weftline.operators import retrieval
from weftline.plans import catalogue
from weftline.plans.retrieval import _chunks

DATA = "/root/testdata/sf0.001"


def orders(spark, *columns):
    out = defaultdict(list)
    for r in spark.read.parquet(f"{DATA}/lineitem.parquet").collect():
        out[r.l_orderkey].append(tuple(r[c] for c in columns))
    return {k: sorted(v) for k, v in out.items()}


def test_explode_all_with_ids(spark):
    lines = orders(spark, "l_linenumber", "l_partkey", "l_linestatus")
    want = sorted((k, i, x[2], sha256(f"{k}\0{i}".encode()).hexdigest()) for k, v in lines.items() for i, x in enumerate(v))
    assert any(k % 10 for k in lines)
    got = catalogue.QUERIES["explode_with_ids"](spark, DATA)
    assert sorted(tuple(r) for r in got.select("l_orderkey", "position", "fn", "item_id").collect()) == want


def test_step_rendering_all(spark):
    lines = orders(spark, "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus")
    step = lambda n, _, q, a: f"id={n} | hop=1 | parallel=false | dep=[{n - 1}] | q={q} | a={a}"
    part = lambda n, _, q, a: f'{{"_uuid":{n},"sub_question":"{q}","sub_answer":"{a}"}}'
    want = sorted((k, "\n".join(step(*x) for x in v), "[" + ",".join(part(*x) for x in v) + "]") for k, v in lines.items())
    assert any(k % 5 for k in lines)
    got = catalogue.QUERIES["step_rendering"](spark, DATA)
    assert sorted(tuple(r) for r in got.select("l_orderkey", "compact", "json").collect()) == want


def chunks(spark):
    out = defaultdict(list)
    for r in sorted(_chunks(lambda name: spark.read.parquet(f"{DATA}/{name}.parquet")).collect(), key=lambda r: r.chunk_id):
        out[r.doc_id].append((r.text, r.token))
    return out


def test_front_page_pin_all(spark):
    want = []
    for d, rows in chunks(spark).items():
        for i, (_, n) in enumerate(rows[:2]):
            if 4 * n > 2000:
                break
            want.append((d, i))
    got = catalogue.QUERIES["front_page_pin"](spark, DATA).collect()
    assert sorted(map(tuple, got)) == sorted(want) and len({d for d, _ in want}) > 1


def decided(sessions, budget, scored):
    """Of sessions {session: [(doc, chunk, text, token)]}."""
    out = []
    for rows in sessions.values():
        docs = sorted({r[0] for r in rows})
        hit = any(scored(r[2]) and r[3] for r in rows)
        if sum(r[3] for r in rows) <= budget:
            parts = [(sorted(rows), 10**9)]
        elif hit:
            parts = [(sorted(rows, key=lambda r: (-r[3] if scored(r[2]) else 0, r[0], r[1])), budget)]
        else:
            parts = [(sorted(r for r in rows if r[0] == d), budget // len(docs)) for d in docs]
        for part, left in parts:
            for d, c, _, n in part:
                if left <= 0:
                    break
                out.append((d, c, min(n, left)))
                left -= n
    return sorted(out)


def test_retrieval_decision_all(spark):
    sessions = {d: [(d, i, *x) for i, x in enumerate(rows)] for d, rows in chunks(spark).items()}
    want = decided(sessions, 400, lambda text: "the" in text.lower())
    got = catalogue.QUERIES["retrieval_decision"](spark, DATA).collect()
    assert sorted(map(tuple, got)) == want and len({d for d, _, _ in want}) > 5


def test_sessions_of_several_documents(spark):
    rows = [(s, s * 10 + d, c, "the x" if s == 1 and d == c else "x", 3 + d + c) for s in range(3) for d in range(3) for c in range(1 if s == 2 else 4)]
    df = spark.createDataFrame(rows, "session int, doc_id int, chunk_id int, text string, token int")
    scores = df.selectExpr("session", "doc_id", "chunk_id", "if(text like '%the%', token, 0) * 1d AS score")
    got = retrieval.search_sessions(df, scores, "session", "doc_id", 15).select("doc_id", "chunk_id", "used").collect()
    assert sorted(map(tuple, got)) == decided({s: [r[1:] for r in rows if r[0] == s] for s in range(3)}, 15, lambda t: "the" in t)


def test_regrouped_chunks_all(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((r.doc_id, r.text.replace("\n", "|")) for r in rows if r.text is not None)
    got = catalogue.QUERIES["regrouped_chunks"](spark, DATA).collect()
    assert sorted(map(tuple, got)) == want and any(t.count("|") > 2 for _, t in want)


def texts(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet").collect()


def test_whole_replies(spark):
    docs = [r for r in texts(spark) if r.text is not None]
    assert any(len(r.text) > 1000 for r in docs)
    got = catalogue.QUERIES["think_and_fence_strip"](spark, DATA).collect()
    bodies = {r.doc_id: (r.body, r.reasoning, r.score) for r in got}
    for r in docs:
        assert bodies[r.doc_id] == (f'{{"doc_id":{r.doc_id},"score":{r.n_chars}}}', r.text.strip(), float(r.n_chars))
    parsed = {r.doc_id: (r.action, r.input, r.agent) for r in catalogue.QUERIES["agent_reply_parsing"](spark, DATA).collect()}
    assert all(parsed[r.doc_id] == ("en", r.text.strip(), "en" if r.doc_id % 2 else r.lang) for r in docs)


def test_union_with_variations_all(spark):
    want = sorted((r.doc_id, v, q) for r in texts(spark) for v, q in enumerate((r.text, f"en {r.lang}", f"src {r.source}")))
    got = catalogue.QUERIES["union_with_variations"](spark, DATA).collect()
    assert sorted(map(tuple, got)) == want


def test_office_files_are_made_once_and_dealt_out(spark):
    """One small file of parts must not make one task of all packages, nor each parser build all of them again."""
    df = catalogue.QUERIES["office_documents"](spark, DATA)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("_office(") == 3
    assert df.rdd.getNumPartitions() >= 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
