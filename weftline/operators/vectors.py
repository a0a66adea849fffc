"""Exact nearest neighbours over an inverted file.

Cells are the Voronoi cells of centroids that k-means finds on a bounded sample;
every vector is assigned to its nearest centroid c and kept with its distance r
from it, in blocks of neighbours by (cell, r). For a query at distance d from c,
no vector of the block can be nearer than

    max(0, d - r of the block's last, r of its first - d)

by the triangle inequality. Queries are laid into the same order as the vectors,
and the vectors beside a query bound its k-th distance (its reach) from above;
so do the sizes and radii of the cells. Only blocks whose bound does not exceed
the reach are read. What is left out cannot hold a neighbour, so the result
equals that of a full search, ties included.

Queries travel in packs of one cell; which blocks a pack can reach is found from
their numbers, ring slot by ring slot. Packs and blocks are dealt into groups of
ASKED queries and splits of HELD vectors. Each group meets each split that holds
a block for it once, in one call, which keeps the k best of every query as it
goes: these tighten the reach, so later blocks are left out or give few
candidates. Where the vectors have no clusters nearly all pairs are compared;
what is moved then grows with the pairs divided by ASKED and HELD, and what a
group gives is k rows a query and split, not a block."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weftline.scratch import materialize

#: Vectors of a block, queries of a pack, slots of a cell's radius by which packs and blocks meet.
BLOCK, PACK, SLOTS = 512, 128, 64
#: Queries of a group and vectors of a split that meet in one call, about; queries compared at a time.
ASKED, HELD, TILE = 4096, 16_384, 512
#: Rows that k-means learns from (those with the smallest hash of their id), its rounds, and the most cells.
SAMPLE, ROUNDS, CELLS = 16_384, 8, 1024

_LAID = "cell int, r_low double, r_high double, n bigint, ids binary, vectors binary, reach double"
_PACK = "ids binary, vectors binary, reach binary, cells array<int>, asks array<bigint>, d_low array<double>, d_high array<double>"
_FOUND = "query_id bigint, vec_id bigint, score double"


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All distances by expanded squares: good to about `_error`."""
    return np.sqrt(np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1) - 2 * a @ b.T, 0))


def _error(a: np.ndarray, b: np.ndarray) -> float:
    """How far `distances` may be off, cancellation included."""
    most = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    return float(np.sqrt(1e-13 * a.shape[1] * most * most) + 1e-12 * most)


def centroids(vectors: DataFrame, vec_id: str, vec: str) -> np.ndarray:
    """K-means on the sample: about the square root of the rows, CELLS at most."""
    n = vectors.count()
    some = vectors.orderBy(F.xxhash64(vec_id), vec_id).limit(SAMPLE).select(vec).collect()
    if not some:
        return np.zeros((0, 0))
    points = np.array([list(r[0]) for r in some], dtype=np.float64)
    points = np.unique(points, axis=0)
    k = max(1, min(CELLS, round(n**0.5), len(points)))
    centres = points[np.random.default_rng(0).permutation(len(points))[:k]]
    for _ in range(ROUNDS):
        cell = distances(points, centres).argmin(1)
        counts = np.bincount(cell, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, points)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _placed(centres: np.ndarray):
    """(id, vector, asks) with cell and r, the exact distance from its centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                some = batch.slice(at, 4096)
                points = _matrix(some.column(1))
                cell = distances(points, centres).argmin(1)
                r = np.sqrt(((points - centres[cell]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(r), *some.columns], ["cell", "r", "id", "vector", "asks"])

    return run


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Rows in order, cut where the first column changes and after `size`."""
    for batch in batches:
        keys = batch.column(0).to_numpy()
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else []
        for start, end in zip(starts, [*starts[1:], len(keys)]):
            for at in range(start, end, size):
                yield batch.slice(at, min(size, end - at))


def _row(values: list, names: list[str]) -> pa.RecordBatch:
    kinds = {int: pa.int64(), float: pa.float64(), bytes: pa.binary(), np.int32: pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array([v], kinds[type(v)]) for v in values], names)


def _laid(k: int):
    """(cell, r, id, vector, asks) in order of (cell, r) to blocks of vectors,
    and to queries with what the vectors beside them say of their reach."""
    names = [c.split(" ")[0] for c in _LAID.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _chunks(batches, BLOCK):
            cell, r, ids, points, asks = np.int32(some.column(0)[0].as_py()), some.column(1).to_numpy(), some.column(2).to_numpy(), _matrix(some.column(3)), some.column(4).to_numpy(zero_copy_only=False)
            own = np.flatnonzero(~asks)
            if len(own):
                yield _row([cell, float(r[own[0]]), float(r[own[-1]]), len(own), ids[own].tobytes(), points[own].tobytes(), 0.0], names)
            asked = np.flatnonzero(asks)
            reach = np.full(len(asked), np.inf)
            if len(asked) and len(own) >= k:
                reach = np.partition(distances(points[asked], points[own]), k - 1, axis=1)[:, k - 1] + _error(points, points)
            for q, far in zip(asked, reach):
                yield _row([cell, float(r[q]), float(r[q]), 0, ids[q : q + 1].tobytes(), points[q].tobytes(), float(far)], names)

    return run


def _packed(centres: np.ndarray, rings: list[tuple], k: int, slack: float):
    """(cell, r, id, vector, reach) in order of (cell, r) to packs with the cells
    that may hold a neighbour of so many of theirs; d_low and d_high span the rings that the
    pack's queries can reach there. `rings`: cell, least and greatest r, vectors."""
    cells, low, high, n = (np.array(c) for c in zip(*rings))
    types = [*[pa.binary()] * 3, pa.list_(pa.int32()), pa.list_(pa.int64()), *[pa.list_(pa.float64())] * 2]
    names = [c.split(" ")[0] for c in _PACK.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _chunks(batches, PACK):
            data = b"".join(some.column(3).to_pylist())
            points = np.frombuffer(data).reshape(some.num_rows, -1)
            d = distances(points, centres[cells])
            # The nearest cells that hold k vectors bound the reach, too.
            whole = d + high
            order = np.argsort(whole, axis=1)
            enough = np.minimum((np.cumsum(n[order], axis=1) < k).sum(1), len(cells) - 1)
            far = np.where(n.sum() >= k, np.take_along_axis(whole, order, 1)[np.arange(len(points)), enough], np.inf)
            reach = (np.minimum(some.column(4).to_numpy(), far) + 2 * _error(points, centres) + slack)[:, None]
            there = (d - reach <= high) & (d + reach >= low)
            first, last = np.where(there, d - reach, np.inf).min(0), np.where(there, d + reach, -np.inf).max(0)
            at = np.flatnonzero(there.any(0))
            row = [b"".join(some.column(2).to_pylist()), data, reach.tobytes(), cells[at].astype(np.int32), there.sum(0)[at], first[at], last[at]]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)

    return run


def _nearest(centres: np.ndarray, k: int, places: int | None):
    """A group's packs (ids, vectors, reach) and a split's blocks (cell, r_low,
    r_high, ids, vectors) to the k best of the split for each query."""
    slack = 0 if places is None else 10.0**-places

    def best(q_ids: np.ndarray, queries: np.ndarray, reach: np.ndarray, blocks: list[tuple]) -> tuple[np.ndarray, ...]:
        norms = (queries**2).sum(1)
        query, ids, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        bounds = []
        for cell, low, high, _, _ in blocks:
            d = np.sqrt(((queries - centres[cell]) ** 2).sum(1))
            bounds.append(np.maximum(d - high, low - d))
        # Blocks near many of the queries come first.
        for i in np.argsort([b.mean() for b in bounds], kind="stable"):
            asked = np.flatnonzero(bounds[i] <= reach)
            if not len(asked):
                continue
            _, _, _, of, vectors = blocks[i]
            off = _error(queries, vectors)
            squares = queries[asked] @ (-2 * vectors.T)
            squares += (vectors**2).sum(1)
            limit = (reach[asked] + 2 * off) ** 2 - norms[asked]
            if len(of) > k:  # the block's own k best bound the reach, too
                wide = np.flatnonzero((squares <= limit[:, None]).sum(1) > 4 * k)
                if len(wide):
                    kth = np.partition(squares[wide], k - 1, axis=1)[:, k - 1] + norms[asked[wide]]
                    limit[wide] = np.minimum(limit[wide], (np.sqrt(np.maximum(kth, 0)) + 4 * off + slack) ** 2 - norms[asked[wide]])
            a, v = np.nonzero(squares <= limit[:, None])
            if not len(a):
                continue
            exact = np.concatenate([np.sqrt(((vectors[v[j : j + 65536]] - queries[asked[a[j : j + 65536]]]) ** 2).sum(1)) for j in range(0, len(a), 65536)])
            exact = exact if places is None else np.round(exact, places)
            query, ids, score = np.concatenate([query, asked[a]]), np.concatenate([ids, of[v]]), np.concatenate([score, exact])
            by = np.lexsort((ids, score, query))
            query, ids, score = query[by], ids[by], score[by]
            first = np.searchsorted(query, np.arange(len(queries)))
            keep = np.arange(len(query)) - first[query] < k
            query, ids, score = query[keep], ids[keep], score[keep]
            first, count = np.searchsorted(query, np.arange(len(queries))), np.bincount(query, minlength=len(queries))
            full = np.flatnonzero(count >= k)
            reach[full] = np.minimum(reach[full], score[first[full] + k - 1] + 2 * off + slack)
        return q_ids[query], ids, score

    def run(packs: pa.Table, blocks: pa.Table) -> pa.Table:
        joined = lambda table, c, kind: np.frombuffer(b"".join(table[c].to_pylist()), kind)
        out = []
        if packs.num_rows and blocks.num_rows:
            q_ids, reach = joined(packs, "ids", np.int64), joined(packs, "reach", np.float64)
            queries = joined(packs, "vectors", np.float64).reshape(len(q_ids), -1)
            held = [(c, low, high, np.frombuffer(ids, np.int64), np.frombuffer(data).reshape(-1, queries.shape[1])) for c, low, high, ids, data in zip(*(blocks[c].to_pylist() for c in ("cell", "r_low", "r_high", "ids", "vectors")))]
            out = [best(q_ids[at : at + TILE], queries[at : at + TILE], reach[at : at + TILE].copy(), held) for at in range(0, len(q_ids), TILE)]
        columns = [np.concatenate(c) for c in zip(*out)] if out else [[], [], []]
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], ["query_id", "vec_id", "score"])

    return run


def _slots(low: str, high: str) -> Column:
    """The slots of the cell's radius, from 0, that [low, high] touches."""
    at = lambda c: F.least(F.greatest(F.floor((F.col(c) - F.col("r_min")) / F.col("width") * SLOTS), F.lit(0)), F.lit(SLOTS - 1)).cast("int")
    return F.sequence(at(low), at(high))


def _visits(packs: DataFrame, blocks: DataFrame, rings: DataFrame) -> DataFrame:
    """Group and split, and the rows of pack and block, of all blocks that a pack
    can reach: both meet by slots of the radius, once, in the first that they share."""
    rings = F.broadcast(rings.select("cell", "r_min", F.greatest(F.col("r_max") - F.col("r_min"), F.lit(1e-300)).alias("width")))
    asked = packs.select("g", F.explode(F.arrays_zip("cells", "asks", "d_low", "d_high")).alias("c")).select("g", F.col("c.asks").alias("queries"), F.col("c.cells").alias("cell"), "c.d_low", "c.d_high")
    asked = asked.join(rings, "cell").withColumn("slots", _slots("d_low", "d_high"))
    there = blocks.select("cell", "s", "r_low", "r_high", "n").join(rings, "cell").withColumn("slots", _slots("r_low", "r_high"))
    asked = asked.select("cell", "g", "d_low", "d_high", "queries", F.col("slots")[0].alias("q_slot"), F.explode("slots").alias("slot"))
    there = there.select("cell", "s", "r_low", "r_high", "n", F.col("slots")[0].alias("b_slot"), F.explode("slots").alias("slot"))
    return asked.join(there, ["cell", "slot"]).filter("r_high >= d_low AND r_low <= d_high AND slot = greatest(q_slot, b_slot)").select("g", "s", "queries", "n")


def knn(vectors: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id", vec: str = "embedding", query_id: str = "query_id", query_vec: str = "query", places: int | None = None, read: dict | None = None) -> DataFrame:
    """query_id, vec_id, score, rank: the k nearest by L2 distance (rounded to
    `places`), equal ones by vec_id. Null ids and vectors are left out. `read`,
    where given, is told how many pairs of query and vector were compared, and
    how many there are."""
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vec).cast("array<double>").alias("vector"), F.lit(False).alias("asks"))
    asked = queries.select(F.col(query_id).cast("bigint").alias("id"), F.col(query_vec).cast("array<double>").alias("vector"), F.lit(True).alias("asks"))
    both = rows.unionByName(asked).filter("vector IS NOT NULL AND id IS NOT NULL")
    centres = centroids(both.filter("NOT asks"), "id", "vector")
    if not len(centres):
        return asked.select(F.col("id").alias(query_id), F.col("id").alias(vec_id), F.lit(0.0).alias("score"), F.lit(0).alias("rank")).limit(0)
    n, n_asked = rows.count(), asked.count()
    placed = both.mapInArrow(_placed(centres), "cell int, r double, id bigint, vector array<double>, asks boolean")
    ordered = placed.repartitionByRange(max(1, -(-(n + n_asked) // HELD)), "cell", "r", "id").sortWithinPartitions("cell", "r", "id")
    laid = materialize(ordered.mapInArrow(_laid(k), _LAID).withColumn("s", F.spark_partition_id()), "blocks")
    blocks = laid.filter("n > 0")
    rings = materialize(blocks.groupBy("cell").agg(F.min("r_low").alias("r_min"), F.max("r_high").alias("r_max"), F.sum("n").alias("n")), "rings")
    slack = 0 if places is None else 2 * 10.0**-places
    reached = _packed(centres, [tuple(r) for r in rings.collect()], k, slack)  # CELLS rows at most
    alone = laid.filter("n = 0").select("cell", F.col("r_low").alias("r"), "ids", "vectors", "reach")
    packs = alone.repartitionByRange(max(1, -(-n_asked // ASKED)), "cell", "r", "ids").sortWithinPartitions("cell", "r", "ids").mapInArrow(reached, _PACK)
    packs = materialize(packs.withColumn("g", F.spark_partition_id()), "packs")
    visits = _visits(packs, blocks, rings)
    if read is not None:
        visits = materialize(visits, "visits")
        read |= {"read": visits.agg(F.sum(F.col("queries") * F.col("n"))).first()[0], "all": laid.filter("n = 0").count() * rings.agg(F.sum("n")).first()[0]}
    # A split's blocks and a group's packs go where they meet.
    meet = materialize(visits.select("g", "s").distinct(), "meet")
    left = packs.select("g", "ids", "vectors", "reach").join(meet, "g").groupBy("g", "s")
    right = blocks.select("s", "cell", "r_low", "r_high", "ids", "vectors").join(meet, "s").groupBy("g", "s")
    found = left.cogroup(right).applyInArrow(_nearest(centres, k, places), _FOUND)
    best = W.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).toDF(query_id, vec_id, "score", "rank")
