"""Vector compression: each of four parts of a vector becomes the index of the
nearest entry of that part's codebook, found by annular norm pruning.

Components are integers, floor(1024 * x), so that every distance, sum and mean
is exact and reruns agree bit by bit. The nearest entry of a point p lies, by
the triangle inequality, in the annulus ||p| - |c|| <= d around the origin, d
being the distance to any entry already seen. Entries are sorted by norm; the
WINDOW entries nearest by norm give a first d, and two binary searches give the
interval of norms, its ends included. Points with intervals alike form a block
that shares the union of them; only entries in it are evaluated, exactly.

Vectors are written once. Each round is one pass: every task sums
its points by entry, the sums are added by Spark, and what reaches the driver is
the codebooks, ENTRIES x dimension integers, whatever the number of vectors.

Defined cases: a vector that is null, or has a null or non-finite component, is
dropped; so is one whose length differs from that of the smallest kept vec_id
among those whose length is a positive multiple of four. With fewer than ENTRIES
vectors there are as many entries as vectors. A null vec_id sorts last; repeated
rows are vectors of their own; rows that tie on vec_id are ordered by their
components. Null labels are one label. Components beyond 2^24 are compared by
arbitrary-precision integers; an error beyond 64 bits is held at the largest
long. An empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm import _common as C

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Points of a block that share an annulus; entries that give the first distance.
BLOCK, WINDOW = 64, 24
#: Vectors taken from a batch at a time.
STEP = 4096
#: Components up to which 64-bit arithmetic is exact for up to 4,096 components a part.
EXACT = 1 << 24
LARGEST = (1 << 63) - 1
#: Sums travel as high * LIMB + low, which holds any float.
LIMB = 10**12


def finite(vector: Column) -> Column:
    """The components as doubles; null for a vector that is dropped."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~F.coalesce(bad, F.lit(True)), x)


def _floored(vectors: pa.ListArray) -> np.ndarray:
    """Rows of exact integers: int64 where they are within EXACT, else objects."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
    with np.errstate(over="ignore"):
        scaled = x * SCALE
    if not x.size or np.abs(scaled).max() <= EXACT:
        return np.floor(scaled).astype(np.int64)
    return np.array([[math.floor(v * SCALE) if math.isfinite(v * SCALE) else int(v) * SCALE for v in row] for row in x.tolist()], dtype=object)


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to all entries."""
    if points.dtype == object or entries.dtype == object:
        points, entries = points.astype(object), entries.astype(object)
    elif len(points) and len(entries):
        most = max(int(np.abs(points).max()), int(np.abs(entries).max()))
        if 4 * most * most * points.shape[1] < 1 << 53:  # sums of doubles are exact then
            points, entries = points.astype(np.float64), entries.astype(np.float64)
    rough = (points**2).sum(1)[:, None] + (entries**2).sum(1)[None, :] - 2 * (points @ entries.T)
    return rough if rough.dtype == object else rough.astype(np.int64)


class Codebook:
    """Entries of one part, sorted by norm for the annulus search."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.norms = np.sqrt((entries.astype(np.float64) ** 2).sum(1))
        self.by_norm = np.argsort(self.norms, kind="stable")
        self.sorted_norms, self.sorted_entries = self.norms[self.by_norm], entries[self.by_norm]
        self.evaluated = 0

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and its exact squared distance for every
        point; equal distances go to the lower index."""
        norms = np.sqrt((points.astype(np.float64) ** 2).sum(1))
        code, best = np.zeros(len(points), dtype=np.int64), np.zeros(len(points), dtype=object)
        reach = np.zeros(len(points))
        by_norm = np.argsort(norms, kind="stable")
        for at in range(0, len(points), BLOCK):
            some = by_norm[at : at + BLOCK]
            middle = int(np.searchsorted(self.sorted_norms, norms[some[len(some) // 2]]))
            near = self.sorted_entries[max(0, min(middle - WINDOW // 2, len(self.entries) - WINDOW)) :][:WINDOW]
            reach[some] = np.sqrt(squared(points[some], near).min(1).astype(np.float64))
        slack = 1e-9 * (norms + reach + 1)  # norms are rounded; the annulus must not lose its rim
        low = np.searchsorted(self.sorted_norms, norms - reach - slack, "left")
        high = np.searchsorted(self.sorted_norms, norms + reach + slack, "right")
        starts = np.empty(len(points), dtype=np.int64)
        starts[np.argsort(low, kind="stable")] = np.arange(len(points)) // (8 * BLOCK)
        by_annulus = np.lexsort((high, starts))  # alike at both ends
        for at in range(0, len(points), BLOCK):
            some = by_annulus[at : at + BLOCK]
            inside = np.sort(self.by_norm[low[some].min() : high[some].max()])  # by index: the first least distance is the one of the lowest index
            self.evaluated += len(inside) * len(some)
            found = squared(points[some], self.entries[inside])
            first = found.argmin(1)
            code[some], best[some] = inside[first], found[np.arange(len(some)), first]
        return code, best


def _books(codebooks: np.ndarray) -> list[Codebook]:
    return [Codebook(part) for part in codebooks]


def _parts(points: np.ndarray) -> list[np.ndarray]:
    return np.split(points, PARTS, axis=1)


def _sums(codebooks: np.ndarray):
    """Batches of vectors to (part, entry, position, sum, n): one set a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, width = _books(codebooks), codebooks.shape[2]
        sums, counts = np.zeros(codebooks.shape, dtype=object if codebooks.dtype == object else np.int64), np.zeros(codebooks.shape[:2], dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                for p, mine in enumerate(_parts(_floored(batch.column(0).slice(at, STEP)))):
                    code, _ = books[p].nearest(mine)
                    if mine.dtype == object and sums.dtype != object:
                        sums = sums.astype(object)
                    np.add.at(sums[p], code, mine)
                    counts[p] += np.bincount(code, minlength=counts.shape[1])
        part, entry = np.nonzero(counts)
        cells = [divmod(int(x), LIMB) for x in sums[part, entry].reshape(-1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(part, width), pa.int32()), pa.array(np.repeat(entry, width), pa.int32()), pa.array(np.tile(np.arange(width), len(part)), pa.int32()),
             pa.array([Decimal(h) for h, _ in cells], pa.decimal128(38, 0)), pa.array([low for _, low in cells], pa.int64()), pa.array(np.repeat(counts[part, entry], width), pa.int64())],
            ["part", "entry", "position", "high", "low", "n"],
        )

    return run


def _coded(codebooks: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = _books(codebooks)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                rows = batch.slice(at, STEP)
                found = [books[p].nearest(mine) for p, mine in enumerate(_parts(_floored(rows.column(0))))]
                codes = np.stack([code for code, _ in found], axis=1).astype(np.uint8)
                errors = [min(sum(int(best[i]) for _, best in found), LARGEST) for i in range(rows.num_rows)]
                yield pa.RecordBatch.from_arrays([rows.column(1), rows.column(2), pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(errors, pa.int64())], ["vec_id", "label", "code", "error"])

    return run


def _lean_pass(vectors: DataFrame, function, schema: str) -> DataFrame:
    return vectors.mapInArrow(C.lean(function), schema)


def codebooks(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """(PARTS, entries, dimension / PARTS) integers after the rounds; None
    without vectors. `vectors` has v, vec_id and label."""
    first = vectors.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).select("v").collect()
    if not first:
        return None
    books = np.stack(_parts(_floored(pa.array([r.v for r in first], pa.list_(pa.float64())))))
    for _ in range(rounds):
        sums = _lean_pass(vectors.select("v"), _sums(books), "part int, entry int, position int, high decimal(38,0), low bigint, n bigint")
        total = sums.groupBy("part", "entry", "position").agg(F.sum("high").alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low"), F.sum("n").alias("n"))
        new = books.astype(object)
        for r in total.collect():  # at most entries x dimension rows
            new[r.part, r.entry, r.position] = (int(r.high) * LIMB + int(r.low)) // r.n
        books = new.astype(np.int64) if max(abs(int(x)) for x in new.flat) <= EXACT else new
    return books


def digest(books: np.ndarray | None) -> str:
    cells = [] if books is None else books.flat
    return hashlib.sha256(",".join(str(int(x)) for x in cells).encode()).hexdigest()


def prepared(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """v (doubles), vec_id, label of the vectors that are kept, written once."""
    v = finite(F.col(vector))
    label = F.col("label") if "label" in rows.columns else F.lit(None)
    kept = rows.select(v.alias("v"), F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("string").alias("label")).filter((F.size("v") > 0) & (F.size("v") % PARTS == 0))
    written = C.materialize(kept, "vectors")
    head = written.orderBy(F.asc_nulls_last("vec_id"), "v").select(F.size("v").alias("n")).first()
    return written.filter(F.size("v") == (head.n if head else 0))


def compress(rows: DataFrame, vector: str = "embedding", entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256."""
    vectors = prepared(rows, vector)
    books = codebooks(vectors, entries, rounds)
    if books is None:
        coded = vectors.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("bigint").alias("error"))
    else:
        coded = C.materialize(_lean_pass(vectors.select("v", "vec_id", "label"), _coded(books), "vec_id bigint, label string, code string, error bigint"), "codes")
    coded = coded.select("vec_id", "code", "error", F.isnull("label").alias("no_label"), F.coalesce("label", F.lit("")).alias("label"))
    whole = F.sum(F.col("error").cast("decimal(38,0)"))
    labels = coded.groupBy("no_label", "label").agg(F.least(whole, F.lit(LARGEST).cast("decimal(38,0)")).cast("bigint").alias("label_error"), F.count("*").alias("n"))
    found = C.lookup(coded, labels, ["no_label", "label"], "n", max(coded.count(), 1))
    return found.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
