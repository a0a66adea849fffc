"""Vector codes against plain k-means in arbitrary-precision integers."""

import hashlib
import math
import random

import numpy as np
import pytest

from weftline.llm import vector_codes as V

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, v int"


def brute(rows, entries, rounds):
    kept = [(i, list(map(float, e)), label) for i, e, label, *_ in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    kept = [r for r in kept if r[1] and len(r[1]) % 4 == 0]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    whole = lambda x: math.floor(x * 1024) if math.isfinite(x * 1024) else int(x) * 1024
    points = [[whole(x) for x in e] for _, e, _ in kept]
    width = len(points[0]) // 4
    part = lambda p, j: p[j * width : (j + 1) * width]
    books = [[part(p, j) for p in points[:entries]] for j in range(4)]

    def assign(p, j):
        return min((sum((a - b) ** 2 for a, b in zip(part(p, j), c)), k) for k, c in enumerate(books[j]))

    for _ in range(rounds):
        codes = [[assign(p, j)[1] for j in range(4)] for p in points]
        for j in range(4):
            for k in range(len(books[j])):
                mine = [part(p, j) for p, c in zip(points, codes) if c[j] == k]
                if mine:
                    books[j][k] = [sum(x) // len(mine) for x in zip(*mine)]
    final = [[assign(p, j) for j in range(4)] for p in points]
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    errors = [min(sum(d for d, _ in f), V.LARGEST) for f in final]
    total = {}
    for (_, _, label), e in zip(kept, errors):
        total[label] = min(total.get(label, 0) + e, V.LARGEST)
    return sorted((i is None, i or 0, "".join(f"{k:02x}" for _, k in f), e, total[label], sha) for (i, _, label), f, e in zip(kept, final, errors))


def vectors(huge=False):
    rng = random.Random(2)
    centres = [[rng.uniform(-1, 1) for _ in range(8)] for _ in range(6)]
    rows = [(i, [float(np.float32(x + rng.gauss(0, 0.2))) for x in rng.choice(centres)], rng.choice([0, 1, 2, None])) for i in range(300)]
    rows += [(300 + i, rows[5][1], 1) for i in range(40)] + [rows[3]]  # ties and a repeated row
    rows += [(None, rows[7][1], 2), (-1, None, 1), (-2, [1.0, None] * 4, 1), (-3, [float("nan")] * 8, 1), (-4, [float("inf")] * 8, 1), (-5, [], 0), (-6, [1.0, 2.0, 3.0], 0), (999, [0.5] * 4, 0), (998, [0.0] * 8, 0), (997, [-0.0001] * 8, 3)]
    rows += [(996, [float(np.float32(3.0e38))] * 8, 3), (995, [-1e9] * 8, 3), (994, [float(np.float32(1e25))] * 8, 4)] if huge else []
    rng.shuffle(rows)
    return [(*r, "c", 1) for r in rows]


@pytest.mark.parametrize("huge", [False, True])
def test_codes_equal_brute_force(spark, huge):
    rows = vectors(huge)
    found = V.compress(spark.createDataFrame(rows, SCHEMA).repartition(4), entries=20).collect()
    assert sorted((r.vec_id is None, r.vec_id or 0, r.code, r.error, r.label_error, r.codebooks_sha256) for r in found) == brute(rows, 20, 4)


def test_only_the_annulus_is_evaluated():
    rng = np.random.default_rng(1)
    entries = (rng.normal(size=(256, 4)) * rng.uniform(10, 4000, size=(256, 1))).astype(np.int64)
    points = (rng.normal(size=(3000, 4)) * rng.uniform(10, 4000, size=(3000, 1))).astype(np.int64)
    book = V.Codebook(entries)
    code, best = book.nearest(points)
    exact = ((points[:, None] - entries[None]) ** 2).sum(2)
    assert (code == exact.argmin(1)).all() and (best.astype(np.int64) == exact.min(1)).all()
    assert book.evaluated < 0.7 * exact.size


def test_edges(spark):
    assert V.compress(spark.createDataFrame([], SCHEMA)).count() == 0
    assert V.compress(spark.createDataFrame([(1, None, 1, "", 1)], SCHEMA)).count() == 0
    two = V.compress(spark.createDataFrame([(2, [1.0] * 4, None, "", 1), (1, [0.0] * 4, None, "", 1)], SCHEMA)).orderBy("vec_id").collect()
    assert [(r.vec_id, r.code, r.error, r.label_error) for r in two] == [(1, "00000000", 0, 0), (2, "01010101", 0, 0)]
