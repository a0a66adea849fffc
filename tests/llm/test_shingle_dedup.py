"""The pipeline's near-dedup stage against Jaccard similarity by brute force."""

import random

import pytest

import corpus_pipeline
from weftline.llm import near_sets, shingle_dedup

SCHEMA = "doc_id bigint, text string"


def jaccard(a, b):
    a, b = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.lower().split(), b.lower().split()))
    return len(a & b) / len(a | b)


def edited(words, n):
    words = list(words)
    for i in random.sample(range(len(words)), n):
        words[i] = f"new{random.random()}"
    return " ".join(words)


@pytest.fixture(scope="module")
def corpus():
    random.seed(6)
    texts = []
    for _ in range(60):
        words = [f"w{random.randrange(5000)}" for _ in range(300)]
        texts += [" ".join(words), edited(words, 3), edited(words, 12)]
    return texts


def test_stage_drops_near_copies_and_nothing_else(spark, corpus):
    docs = spark.createDataFrame(list(enumerate(corpus)), SCHEMA)
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    copies = [i for i in range(0, len(corpus), 3)]
    assert kept >= set(copies)  # no original goes
    for i in copies:
        assert jaccard(corpus[i], corpus[i + 1]) >= 0.8 and i + 1 not in kept
        assert jaccard(corpus[i], corpus[i + 2]) >= 0.8 or i + 2 in kept


def test_a_large_group_of_near_copies(spark):
    random.seed(7)
    words = [f"w{random.randrange(5000)}" for _ in range(300)]
    docs = spark.createDataFrame([(i, edited(words, 3)) for i in range(150)] + [(900, "other text of seven words in all")], SCHEMA)
    assert {r.doc_id for r in shingle_dedup.drop(docs).collect()} == {0, 900}


def test_edges(docs, empty, spark):
    out = shingle_dedup.drop(docs)
    assert out.columns == docs.columns and out.filter("text IS NULL OR trim(text) = ''").count() == 1
    assert shingle_dedup.drop(empty).count() == 0
    short = spark.createDataFrame([(1, "a b"), (2, "A  b"), (3, "a c")], SCHEMA)
    assert {r.doc_id for r in shingle_dedup.drop(short).collect()} == {1, 3}


def test_fingerprint_blocks_find_copies_without_bands(spark, monkeypatch):
    """Copies with two of 900 words replaced differ in few bits: SimHash blocks alone find most, and no stranger."""
    random.seed(8)
    rows = []
    for _ in range(12):
        words = [f"w{random.randrange(5000)}" for _ in range(900)]
        rows += [" ".join(words), edited(words, 2)]
    docs = spark.createDataFrame(list(enumerate(rows)), SCHEMA)
    marks = docs.selectExpr("doc_id", "text", "xxhash64(text) t").mapInArrow(shingle_dedup._marked, "doc_id bigint, t bigint, fp bigint, keys array<bigint>").collect()
    fps = [r.fp & (1 << 64) - 1 for r in sorted(marks, key=lambda r: r.doc_id)]
    links, bands = near_sets.links, [k for r in marks for k in r["keys"]]
    monkeypatch.setattr(near_sets, "links", lambda keyed, *rest, **named: links(keyed.filter(~keyed.key.isin(bands)), *rest, **named))
    kept = {r.doc_id for r in shingle_dedup.drop(docs).collect()}
    shared = lambda x, y: sum((x ^ y) >> 16 * i & 0xFFFF == 0 for i in range(4)) >= 2
    want = {i for i in range(24) if i % 2 == 0 or not shared(fps[i], fps[i - 1])}
    assert kept == want and len(want) < 20
