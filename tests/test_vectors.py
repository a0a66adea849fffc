"""Nearest neighbours over the inverted file against a full search."""

import numpy as np
import pyarrow as pa
import pytest

from weftline.operators import vectors

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows, queries, k, places):
    kept = [(i, np.array(v, dtype=np.float64)) for i, v in rows if i is not None and v is not None]
    out = set()
    for q, asked in queries:
        score = [(round(float(np.sqrt(((v - np.array(asked)) ** 2).sum())), places), i) for i, v in kept]
        out |= {(q, i, s, rank + 1) for rank, (s, i) in enumerate(sorted(score)[:k])}
    return out


def found(spark, rows, queries, k, places=6, read=None):
    df = spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows], SCHEMA).repartition(4)
    asked = spark.createDataFrame([(q, [float(x) for x in v]) for q, v in queries], "query_id bigint, query array<float>")
    return {(r.query_id, r.vec_id, r.score, r.rank) for r in vectors.knn(df, asked, k, places=places, read=read).collect()}


def clusters(n, dim=8, spread=0.02, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dim))
    return [(i, np.float32(centres[i % 20] + spread * rng.normal(size=dim))) for i in range(n)]


def test_equal_vectors_come_by_id(spark):
    rows = [(i, [0.5, 0.25, -1.0]) for i in range(300)]
    assert sorted(i for _, i, _, _ in found(spark, rows, [(7, [0.5, 0.25, -1.0])], 10)) == list(range(10))


@pytest.mark.parametrize("shape", ["clusters", "ties", "far", "few"])
def test_equals_a_full_search(spark, shape, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 16)
    monkeypatch.setattr(vectors, "PACK", 8)
    rows = clusters(900)
    if shape == "ties":  # whole groups of equal vectors, more of them than k
        rows = [(i, rows[i % 60][1]) for i in range(700)]
    elif shape == "far":  # expanded squares cancel
        rows = [(i, np.float32(np.array(v) + 3000)) for i, v in rows]
    elif shape == "few":
        rows = rows[:6]
    rows += [(None, rows[0][1]), (5000, None)]
    queries = [(i, v) for i, v in rows[:40] if i is not None and v is not None] + [(-1, np.float32(np.zeros(8))), (-2, np.float32(np.full(8, 50.0)))]
    rng = np.random.default_rng(3)
    order = rng.permutation(len(rows))
    assert found(spark, [rows[i] for i in order], queries, 10) == brute(rows, queries, 10, 6)


def test_reads_a_share_of_the_pairs(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 32)
    read, rows = {}, clusters(3000)
    queries = rows[::20]
    assert found(spark, rows, queries, 10, read=read) == brute(rows, queries, 10, 6)
    assert read["all"] == 3000 * 150 and read["read"] < 0.15 * read["all"]


def test_empty(spark):
    assert found(spark, [(1, None)], [(1, [0.0])], 3) == set()


def test_a_query_gets_k_rows_a_split_and_not_a_block(spark, monkeypatch):
    """Vectors without clusters: nearly every block is read, but what leaves the tasks stays small."""
    monkeypatch.setattr(vectors, "BLOCK", 16)
    monkeypatch.setattr(vectors, "ASKED", 64, raising=False)
    monkeypatch.setattr(vectors, "HELD", 400, raising=False)
    rng = np.random.default_rng(8)
    rows = [(i, np.float32(rng.normal(size=24))) for i in range(1200)]
    queries = rows[::10]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], SCHEMA)
    asked = spark.createDataFrame([(q, [float(x) for x in v]) for q, v in queries], "query_id bigint, query array<float>")
    read = {}
    out = vectors.knn(df, asked, 10, places=6, read=read)
    assert {(r.query_id, r.vec_id, r.score, r.rank) for r in out.collect()} == brute(rows, queries, 10, 6) and read["read"] > 0.5 * read["all"]
    assert "FlatMapCoGroupsInArrow" in out._jdf.queryExecution().toString()
    nearest, data = vectors._nearest(np.zeros((1, 24)), 10, 6), np.array([v for _, v in rows], dtype=np.float64)
    packs = pa.table({"ids": [np.arange(5).tobytes()], "vectors": [data[:5].tobytes()], "reach": [np.full(5, np.inf).tobytes()]})
    blocks = pa.table({"cell": [0] * 50, "r_low": [0.0] * 50, "r_high": [99.0] * 50, "ids": [np.arange(i, i + 16).tobytes() for i in range(0, 800, 16)], "vectors": [data[i : i + 16].tobytes() for i in range(0, 800, 16)]})
    assert nearest(packs, blocks).num_rows == 50  # 5 queries, 10 each; not 10 of each of 50 blocks
