"""Many patterns in many texts, both ways, by brute force."""

import random

import pytest

from weftline.operators import patterns


@pytest.mark.parametrize("limit", [patterns.AUTOMATON_BYTES, 200])
def test_equals_brute_force(spark, limit):
    rng = random.Random(5)
    text = lambda n: "".join(rng.choices("abcdé ", k=n))
    texts = [(i, text(rng.choice([0, 5, 60, 300]))) for i in range(40)] + [(90, None), (91, "x" * 3000), (92, "long pattern number one, long pattern")]
    known = [text(rng.choice([1, 2, 3, 8, 9, 12])) for _ in range(60)] + [t[i : i + 14] for _, t in texts[:20] if t for i in (0, 7)] + ["x" * 9, "long pattern", "", None, "long pattern", "😀"]
    df, words = spark.createDataFrame(texts, "id int, t string").repartition(3), spark.createDataFrame([(p,) for p in known], "p string")
    got = {(r.id, r.pattern): (r.n, r.first) for r in patterns.occurrences(df, "id", "t", words, "p", limit=limit).collect()}
    want = {}
    for i, t in texts:
        for p in {p for p in known if p}:
            at = [j for j in range(len(t or "")) if t.startswith(p, j)]
            if at:
                want[i, p] = (len(at), at[0])
    assert got == want


def test_nothing_to_find(spark):
    texts, none = spark.createDataFrame([(1, "a")], "id int, t string"), spark.createDataFrame([], "p string")
    assert patterns.occurrences(texts, "id", "t", none, "p").count() == 0
    assert patterns.occurrences(texts.limit(0), "id", "t", spark.createDataFrame([("a",)], "p string"), "p").count() == 0
