"""Links in groups of any size, and the SetSketch operator, by brute force."""

import random

import numpy as np
import pytest

from weftline.llm import near_sets, set_sketch, shingle_dedup

SCHEMA = "doc_id bigint, text string, t string, n int, g string, kept boolean"


def words_of(text):
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text):
    words = words_of(text)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def components(rows, over, under):
    """Smallest doc_id reachable, over all pairs."""
    sets, root = [shingle_set(r[1]) for r in rows], list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            x, y = sets[i], sets[j]
            if x and y and under * min(len(x), len(y)) >= over * max(len(x), len(y)):
                both = len(x & y)
                if under * both >= over * (len(x) + len(y) - both):
                    root[top(i)] = top(j)
    least = {}
    for i, r in enumerate(rows):
        key = (r[0] is None, r[0] or 0)
        least[top(i)] = min(least.get(top(i), key), key)
    return [None if least[top(i)][0] else least[top(i)][1] for i in range(len(rows))], sets


def template_pages(n, own, pairs, shared, size=604, seed=3):
    """Pages on one template, strangers just under the limit; planted pairs share most of their own words."""
    rng = random.Random(seed)
    template = [f"w{rng.randrange(9000)}" for _ in range(size)]
    at = list(range(10, size - 10, max((size - 20) // own, 1)))[:own]
    out = []
    for page in range(n):
        words = list(template)
        for k in at:
            words[k] = f"p{page}k{k}" if page >= 2 * pairs or k not in at[:shared] else f"q{page // 2}k{k}"
        out.append(" ".join(words))
    return out


def run(spark, texts, over, under):
    """Groups of texts by `near_sets` where all texts share keys, as bands of one cluster do."""
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").repartition(4)
    from pyspark.sql import functions as F

    from weftline.llm import _common as C

    keyed = df.select(F.xxhash64("text").alias("t"), F.explode(F.array(F.lit(1), F.lit(2)).cast("array<bigint>")).alias("key")).distinct()
    found = near_sets.links(keyed, lambda wanted: shingle_dedup.shingle_sets(df, wanted), over, under)
    roots = C.components(C.materialize(found, "near"))
    grouped = df.select("doc_id", F.xxhash64("text").alias("t")).join(roots.withColumnRenamed("node", "t"), "t", "left").select("doc_id", F.coalesce("root", "t").alias("root")).collect()
    least = {}
    for r in grouped:
        least[r.root] = min(least.get(r.root, r.doc_id), r.doc_id)
    return {r.doc_id: least[r.root] for r in grouped}


@pytest.mark.parametrize("shape", ["template", "copies", "mixed", "chain"])
def test_no_link_is_lost(spark, shape, monkeypatch):
    monkeypatch.setattr(near_sets, "CROWDED_LATER", 24)  # so that groups of this size take several levels
    rng = random.Random(9)
    base = [f"b{rng.randrange(9000)}" for _ in range(200)]

    def edited(words, k):
        words = list(words)
        for i in rng.sample(range(len(words)), k):
            words[i] = f"e{rng.random()}"
        return words

    if shape == "template":
        texts = template_pages(200, 14, 50, 5)
    elif shape == "copies":
        texts = [" ".join(edited(base, 2)) for _ in range(150)] + [" ".join(edited(base, 12)) for _ in range(60)]
    elif shape == "mixed":
        texts = template_pages(60, 14, 20, 5) + template_pages(60, 12, 10, 6, size=300, seed=4) + [" ".join(edited(base, rng.choice([0, 1, 5, 7]))) for _ in range(80)] + ["x y", "x  Y", "a b c"]
    else:
        texts, now = [], base
        for _ in range(90):
            now = edited(now, 3)
            texts.append(" ".join(now))
    expected, _ = components(list(enumerate(texts)), 4, 5)
    assert run(spark, texts, 4, 5) == dict(enumerate(expected))


def test_template_pages_in_the_stage(spark):
    """Strangers of similarity under 0.8, planted pairs above it: every pair is found."""
    texts = template_pages(200, 14, 100, 5)
    sets = [shingle_set(t) for t in texts[:4]]
    assert len(sets[0] & sets[2]) / len(sets[0] | sets[2]) < 0.8 < len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    kept = {r.doc_id for r in shingle_dedup.drop(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert len(kept) <= 101 and kept >= set(range(0, 200, 2))


def test_find_equals_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(40):
        words = [rng.choice("abcdefgh") + str(rng.randrange(900)) for _ in range(rng.choice([4, 20, 120, 300]))]
        rows.append(" ".join(words))
        for k in (1, 2, 4, 9):
            edit = list(words)
            for i in rng.sample(range(len(words)), min(k, len(words))):
                edit[i] = f"n{rng.random()}"
            rows.append(" ".join(edit))
    rows += [t for t in template_pages(50, 10, 20, 5)]
    rows += [rows[0], rows[0].upper(), rows[7].replace(" ", "\n  "), "", None, " \t", "one two", "ONE  two", "\x85a b\xa0c d e f g", " ".join(f"z{i}" for i in range(60_000)), " ".join(f"z{i}" for i in range(60_010))]
    table = [(i + 1, t, "t", 1, "g", True) for i, t in enumerate(rows)]
    table += [table[3], table[3], (None, rows[9], "", 0, "", False), (None, None, "", 0, "", False), (7, "another text under an id that is there already", "", 0, "", False)]
    found = set_sketch.find(spark.createDataFrame(table, SCHEMA).repartition(5)).collect()
    expected, sets = components(table, 85, 100)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted([tuple(r) for r in found], key=key) == sorted([(r[0], len(s), c if s else r[0], not s or r[0] == c) for r, c, s in zip(table, expected, sets)], key=key)


def test_empty(spark):
    assert set_sketch.find(spark.createDataFrame([], SCHEMA)).count() == 0
    assert set_sketch.find(spark.createDataFrame([(1, None, "", 0, "", True)], SCHEMA)).collect()[0].component_id == 1


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(5)
    for s in (0.3, 0.6, 0.85, 0.95):
        rows_a, rows_b, n_a, n_b = [], [], [], []
        for _ in range(200):
            both, one, two = (rng.integers(0, 1 << 63, size=k, dtype=np.uint64) for k in (round(600 * s), round(300 * (1 - s)), round(300 * (1 - s))))
            a, b = np.concatenate([both, one]), np.concatenate([both, two])
            rows_a.append(set_sketch.sketch(a))
            rows_b.append(set_sketch.sketch(b))
            n_a.append(len(a))
            n_b.append(len(b))
            assert (set_sketch.merged(rows_a[-1], rows_b[-1]) == set_sketch.sketch(np.union1d(a, b))).all()
        a, b, n_a, n_b = np.array(rows_a, np.int32), np.array(rows_b, np.int32), np.array(n_a, float), np.array(n_b, float)
        found = set_sketch.estimate((a > b).sum(1), (a < b).sum(1), n_a, n_b)
        assert abs(found.mean() - s) < 0.01 and np.abs(found - s).max() < 0.2
        keep = set_sketch.plausible(a, b, n_a, n_b)
        assert keep.all() if s >= 0.85 else keep.mean() < (0.01 if s == 0.3 else 0.35)


def test_groups_that_fit_one_call_are_not_opened(spark, monkeypatch):
    """200 pages of one template: neither their pairs nor what differs from a centre become rows."""
    monkeypatch.setattr(near_sets, "_split", None)
    texts = template_pages(200, 14, 50, 5)
    expected, _ = components(list(enumerate(texts)), 4, 5)
    assert run(spark, texts, 4, 5) == dict(enumerate(expected))
