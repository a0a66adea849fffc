"""Stems against published pairs; terms of Chinese and mixed texts; search by stems."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weftline.functions.stem import stem_word
from weftline.operators import lexicon, retrieval

PAIRS = """
consigned consign consistency consist consolatory consolatori consolation consol conspirators conspir constables constabl
knackeries knackeri knavish knavish kneeled kneel knightly knight knitted knit knives knive knocker knocker knots knot
generously generous skies sky dying die hopping hop hoping hope cry cri say say by by ties tie cries cri gas gas this this
gaps gap kiwis kiwi agreed agre feed feed flying fli relational relat happiness happi university univers news news
proceed proceed inning inning youth youth boyish boyish beds bed rational ration organization organ geology geolog
formative format adjustment adjust adoption adopt replacement replac controlling control electricity electr cat's cat
""".split()


@pytest.mark.parametrize("word,want", zip(PAIRS[::2], PAIRS[1::2]))
def test_stems(word, want):
    assert stem_word(word) == want


def test_other_words_stay():
    for word in ("", "a", "作者", "12.5%", "ß"):
        assert stem_word(word) == word


def found(df):
    return {(r[0], r.term): r.tf for r in df.collect()}


def test_terms(spark):
    rows = spark.createDataFrame([(1, "Running runs THE run"), (2, "深度学习 models 好"), (3, None), (4, ""), (5, "! the")], "id int, text string")
    assert found(retrieval.terms(rows, ["id"], "text")) == {(1, "run"): 3, (2, "深度"): 1, (2, "度学"): 1, (2, "学习"): 1, (2, "好"): 1, (2, "model"): 1}
    plain = found(retrieval.terms(rows, ["id"], "text", stemmed=False))
    assert plain[1, "running"] == plain[1, "runs"] == plain[1, "run"] == plain[2, "models"] == 1


def test_keyword_requests(spark):
    rows = spark.createDataFrame(
        [(1, '{"keywords_zh": ["作者"], "keywords_en": ["Authors", "the"], "text": "who wrote papers"}'), (2, '{"keywords_en": ["x"]}'), (3, '{"keywords_zh": "no list", "keywords_en": null, "text": "cats"}'), (4, "[1] cats"), (5, None)],
        "id int, text string",
    )
    got = found(retrieval.keyword_terms(rows, ["id"], "text"))
    assert {k: v for k, v in got.items() if k[0] == 1} == {(1, "作者"): 1, (1, "author"): 1, (1, "wrote"): 1}
    # Without a text the request is plain text; other lists add nothing.
    assert {k for k in got if k[0] == 2} == {(2, "keywords_en"), (2, "x")} and {k for k in got if k[0] == 3} == {(3, "cat")}
    assert {k for k in got if k[0] == 4} == {(4, "1"), (4, "cat")} and not {k for k in got if k[0] == 5}


def test_search_by_stems(spark):
    docs = spark.createDataFrame([(1, "the runner was running"), (2, "深度学习"), (3, "nothing here of note")], "doc_id int, text string")
    asked = spark.createDataFrame([(1, "run"), (2, "学习"), (3, '{"keywords_zh": [], "keywords_en": ["notes"], "text": ""}')], "q int, text string")
    got = retrieval.bm25(docs, asked, ["doc_id"], "q").collect()
    assert sorted((r.q, r.doc_id) for r in got) == [(1, 1), (2, 2), (3, 3)]


def test_best_path_is_the_best_of_all():
    rng = random.Random(2)
    for _ in range(60):
        weights = {"".join(rng.choices("甲乙丙", k=rng.randint(1, 3))): -rng.choice([1.0, 2.0, 2.5, 4.0]) for _ in range(9)}
        run = "".join(rng.choices("甲乙丙丁", k=rng.randint(0, 8)))

        def cuts(s):
            return [[s[:k], *rest] for k in range(1, min(3, len(s)) + 1) if k == 1 or s[:k] in weights for rest in cuts(s[k:])] if s else [[]]

        score = lambda words: round(sum(weights.get(w, -9.0) for w in words), 9)
        got = lexicon.best_path(run, weights, 3, -9.0)
        assert "".join(got) == run and score(got) == max(map(score, cuts(run)))
    assert lexicon.best_path("研究生命", {"研究": -2, "研究生": -3, "生命": -2.5, "命": -6}, 3, -9) == ["研究", "生命"]


def brute_lexicon(texts, longest, least, cohesion, entropy):
    runs = [r for t in texts if t for r in "".join(c if "一" <= c <= "鿿" else " " for c in t).split()]
    count, before, behind = Counter(), {}, {}
    for r in runs:
        for i in range(len(r)):
            for k in range(1, min(longest, len(r) - i) + 1):
                g = r[i : i + k]
                count[g] += 1
                before.setdefault(g, []).append(r[i - 1] if i else None)
                behind.setdefault(g, []).append(r[i + k] if i + k < len(r) else None)
    signs = sum(n for g, n in count.items() if len(g) == 1)

    def free(side):
        c = Counter(x if x else ("end", i) for i, x in enumerate(side))  # every end is one of its own
        return -sum(n / len(side) * math.log(n / len(side)) for n in c.values())

    out = {g: n for g, n in count.items() if len(g) == 1}
    for g, n in count.items():
        if len(g) > 1 and n >= least and min(math.log(n * signs / (count[g[:k]] * count[g[k:]])) for k in range(1, len(g))) >= cohesion and free(before[g]) >= entropy and free(behind[g]) >= entropy:
            out[g] = n
    return {(g, n, round(math.log(n / signs), 6)) for g, n in out.items()}


def test_discovery(spark):
    rng = random.Random(4)
    known = ["学习", "深度", "数据库", "我", "在", "的", "好"]
    texts = ["".join(rng.choices(known, k=rng.randint(3, 12))) + rng.choice(["", " and ", "。"]) + "".join(rng.choices(known, k=4)) for _ in range(120)] + [None, "", "none"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {(r.word, r.n, round(r.weight, 6)) for r in lexicon.discover(df, "text", 3, 5, 1.5, 0.8).collect()}
    assert got == brute_lexicon(texts, 3, 5, 1.5, 0.8)
    assert {w for w, _, _ in got} >= {"学习", "深度", "数据库"} and "习深" not in {w for w, _, _ in got}
    cut = lexicon.segmenter(lexicon.discover(df, "text", 3, 5, 1.5, 0.8))
    rows = spark.createDataFrame([(1, "我在学习 deep 深度学习的数据库"), (2, None), (3, "plain")], "id int, text string")
    assert {k: n for k, n in found(retrieval.terms(rows, ["id"], "text", stemmed=False, cut=cut)).items() if k[0] == 1} == {(1, "学习"): 2, (1, "在"): 1, (1, "深度"): 1, (1, "数据库"): 1, (1, "deep"): 1}


def test_pruned_search_equals_the_full_ranking(spark):
    """The same rows and scores, with fewer postings joined and pairs completed."""
    rng = random.Random(11)
    common, rare = [f"c{i}" for i in range(12)], [f"r{i}" for i in range(900)]
    words = lambda n: rng.choices(common, k=2 * n) + rng.choices(rare, k=n)
    docs = [(i, " ".join(words(rng.randint(3, 12)))) for i in range(400)] + [(400 + i, " ".join(common)) for i in range(20)] + [(500, ""), (501, None)]
    asked = [(q, " ".join(words(4) + docs[q][1].split()[-4:])) for q in range(15)] + [(90, "c1 c2"), (91, "nothing known"), (92, "the of"), (93, None)]
    d = spark.createDataFrame(docs, "doc_id int, text string").repartition(3)
    q = spark.createDataFrame(asked, "q int, text string")
    full = retrieval.bm25(d, q, ["doc_id"], "q", stemmed=False).withColumn("score", F.round("score", 6))
    expected = retrieval.top_k(full, ["q"], ["doc_id"], 5).collect()
    read = {}
    got = retrieval.bm25_top(d, q, ["doc_id"], "q", 5, stemmed=False, read=read).collect()
    assert sorted((r.q, r.doc_id, r.score, r["rank"]) for r in got) == sorted((r.q, r.doc_id, r.score, r["rank"]) for r in expected)
    assert read["postings"] < 0.7 * read["all_postings"] and read["completed"] < 0.35 * full.count(), (read, full.count())


def test_ranks_of_all_and_fusion_with_a_common_ranking(spark):
    rng = random.Random(3)
    scores = [(q, d, float(rng.randrange(6))) for q in range(4) for d in rng.sample(range(40), 25)]
    common = [(d, i + 1) for i, d in enumerate(rng.sample(range(40), 40))]
    ranked = retrieval.rank_all(spark.createDataFrame(scores, "q int, d int, score double"), ["q"], ["d"])
    by = {q: [d for _, d in sorted((-s, d) for p, d, s in scores if p == q)] for q in range(4)}
    assert {(r.q, r.d): r["rank"] for r in ranked.collect()} == {(q, d): i + 1 for q, ds in by.items() for i, d in enumerate(ds)}
    fused = retrieval.fuse_with_common(ranked, spark.createDataFrame(common, "d int, rank int"), spark.createDataFrame([(q,) for q in range(4)], "q int"), "q", "d", 5)
    got = {(r.q, r.d): round(r.score, 9) for r in retrieval.top_k(fused, ["q"], ["d"], 5).collect()}
    want = {}
    for q in range(4):
        total = {d: 1 / (60 + r) + (1 / (61 + by[q].index(d)) if d in by[q] else 0.0) for d, r in common}
        want |= {(q, d): round(total[d], 9) for d in sorted(total, key=lambda d: (-total[d], d))[:5]}
    assert got == want
