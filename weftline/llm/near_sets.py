"""Links between sets whose Jaccard similarity is over / under or more, without
loss in groups of any size and without pairing a group with itself.

Sets come with keys; sets that may be similar share one. Up to CROWDED sets of
a key are paired and verified; up to CROWDED_LATER sets meet in one call, which
counts what all of them share and links each to one of its component, no pairs.
The sets of a key with more are a group:

1. Every set is held against one of the group. With the links found so far, a
   group whose sets are all in one component is done; this settles most groups of
   copies. Of the others, those outside the component that most sets are in are
   far; only pairs with a far set are still of interest.
2. The group gets a centre T: the elements that half its sets have.
   Against T a set x is its residue R(x): d elements of T that it lacks and o
   elements of its own. With W(x) = under * d + over * o, two sets are similar
   exactly if
       (over + under) * |R(x) & R(y)| >= W(x) + W(y) - (under - over) * |T|.
   So sets of W(x) + W(m) <= (under - over) * |T|, m having the least W, are
   similar to m whatever their residues are: they are linked to m, and pairs of
   them need no more.
3. Any other pair must share a number of residual elements that is known from W.
   By the prefix filter it shares one among the rarest |R| - number + 1 elements
   of each, so these become the keys of the next level. An element of a residue
   belongs to half the group at most, so groups shrink to CROWDED_LATER within
   log2(size) levels.

Nothing is dropped on the way: for all pairs that share a key of the first
level, the links given join x and y if and only if a chain of similar pairs
does. Work is a few passes over the sets of crowded keys, not their squares."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import _common as C

#: Sets under one key up to which pairs are made, at the first level; and up to which
#: a key's sets are compared in one call, at any level.
CROWDED, CROWDED_LATER = 32, 512
#: Elements that are counted at a time, which bounds memory.
COUNTED = 4096
#: Rounds in which groups that share sets become one; not all need to.
MERGES = 4


def similar(a: np.ndarray, b: np.ndarray, over: int, under: int) -> bool:
    """Whether two sets, sorted, have Jaccard similarity over / under or more."""
    if under * min(len(a), len(b)) < over * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return under * both >= over * (len(a) + len(b) - both)


def _set(cell: pa.Scalar) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), np.int64)


def _verdicts(over: int, under: int):
    """(a, b, set of a, set of b) to (a, b, near)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = pa.array([similar(_set(x), _set(y), over, under) for x, y in zip(batch.column(2), batch.column(3))], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), near], ["a", "b", "near"])

    return run


def tree(sets: list[np.ndarray], over: int, under: int) -> list[tuple[int, int]]:
    """Links (i, j), i the first of its component, that join all of the sets which a
    chain of similar ones joins."""
    m, sizes = len(sets), np.array([len(s) for s in sets], dtype=np.int64)
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row, several = np.repeat(np.arange(m), sizes), times[at] > 1
    row, at = row[several], np.unique(at[several], return_inverse=True)[1]
    by = np.argsort(at, kind="stable")
    row, at = row[by], at[by]
    shared = np.zeros((m, m), dtype=np.float64)
    for start in range(0, int(at[-1]) + 1 if len(at) else 0, COUNTED):
        low, high = np.searchsorted(at, [start, start + COUNTED])
        holds = np.zeros((m, COUNTED), dtype=np.float32)
        holds[row[low:high], at[low:high] - start] = 1
        shared += holds @ holds.T
    near = under * shared >= over * (sizes[:, None] + sizes - shared)
    out, waiting = [], np.ones(m, dtype=bool)
    for i in range(m):
        reached = [i] if waiting[i] else []
        waiting[i] = False
        for j in reached:
            fresh = np.flatnonzero(near[j] & waiting)
            waiting[fresh] = False
            out += [(i, int(x)) for x in fresh]
            reached += fresh.tolist()
    return out


def _trees(over: int, under: int):
    """(g, t, set), sorted by g, to links (a, b) of each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked() -> pa.RecordBatch:
            found = [sorted((ids[i], ids[j])) for i, j in tree([np.frombuffer(s, np.int64) for s in sets], over, under)]
            return pa.RecordBatch.from_arrays([pa.array([x[c] for x in found], pa.int64()) for c in (0, 1)], ["a", "b"])

        now, ids, sets = None, [], []
        for batch in batches:
            for g, t, s in zip(*(c.to_pylist() for c in batch.columns)):
                if g != now and ids:
                    yield linked()
                    ids, sets = [], []
                now = g
                ids.append(t)
                sets.append(s)
        if ids:
            yield linked()

    return run


def _residues(over: int, under: int):
    """(g, t, far, set, centre) to (g, t, far, w, c, residue)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, c, residue = [], [], []
            for x, y in zip(batch.column(3), batch.column(4)):
                own, centre = _set(x), np.array(y.as_py(), dtype=np.int64)
                lacks, more = np.setdiff1d(centre, own, assume_unique=True), np.setdiff1d(own, centre, assume_unique=True)
                w.append(under * len(lacks) + over * len(more))
                c.append((under - over) * len(centre))
                residue.append(np.concatenate([lacks, more]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(w, pa.int64()), pa.array(c, pa.int64()), pa.array(residue, pa.list_(pa.int64()))], ["g", "t", "far", "w", "c", "residue"])

    return run


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(g, t, set) to (g, element), one row an element."""
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            some = batch.slice(at, 64)
            sets = [_set(x) for x in some.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(some.column(0).to_numpy(), [len(s) for s in sets])), pa.array(np.concatenate(sets))], ["g", "f"])


def _groups(keyed: DataFrame, total: int, first: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sets (t, key, u) to pairs (a, b) of keys with few sets, at the `first`
    level; members (g, t) of groups that fit one call; and members of larger
    ones. All need a set with u. Keys of equal members are one group; at the
    first level, so are crowded ones that share sets, so that a set is in few
    groups, mostly in one."""
    few, crowded = (CROWDED, max(CROWDED, CROWDED_LATER)) if first else (1, CROWDED_LATER)
    least, sums = F.min("t").alias("least"), F.sum(F.xxhash64("t").cast("decimal(38,0)")).alias("sums")
    counts = keyed.groupBy("key").agg(F.count("*").alias("n"), F.max("u").alias("any_u"), least, sums).filter("n > 1 AND any_u").drop("any_u")
    equal = F.xxhash64("n", "sums")
    counts = counts.select("key", "n", (F.when(F.col("n") > crowded, F.col("least")).otherwise(equal) if first else equal).alias("g"))
    shared = C.materialize(C.lookup(keyed, counts, "key", "n", total), "keys")
    some = shared.filter(F.col("n") <= few)
    pairs = some.select("key", F.col("t").alias("a")).join(some.select("key", F.col("t").alias("b")), "key").filter("a < b").select("a", "b").distinct()
    fits = shared.filter((F.col("n") > few) & (F.col("n") <= crowded)).select("g", "t").distinct()
    members = shared.filter(F.col("n") > crowded).select("g", "t").distinct()
    return pairs, fits, _merged(members) if first else members


def _merged(members: DataFrame) -> DataFrame:
    """Members (g, t) of fewer, larger groups: each takes the least name that a
    group sharing a set with it has, round by round."""
    now, before = C.materialize(members, "members"), -1
    rows = now.count()
    for _ in range(MERGES):
        if rows == before:
            break
        least = now.groupBy("t").agg(F.min("g").alias("least"))
        names = now.join(least, "t").groupBy("g").agg(F.min("least").alias("name"), F.count("*").alias("n"))
        now = C.materialize(C.lookup(now, names, "g", "n", max(rows, 1)).select(F.col("name").alias("g"), "t").distinct(), "members")
        before, rows = rows, now.count()
    return now


def _with_sets(pairs: DataFrame, sets: DataFrame, total: int) -> DataFrame:
    """a, b, set of a, set of b."""
    a_of, b_of = (pairs.groupBy(F.col(c).alias("t")).agg(F.count("*").alias("n")) for c in "ab")
    x = a_of.join(sets, "t").select(F.col("t").alias("a"), F.col("shingles").alias("x"), "n")
    y = b_of.join(sets, "t").select(F.col("t").alias("b"), F.col("shingles").alias("y"), "n")
    return C.lookup(C.lookup(pairs, x, "a", "n", total).drop("n"), y, "b", "n", total).select("a", "b", "x", "y")


def _near(pairs: DataFrame, sets: DataFrame, over: int, under: int) -> DataFrame:
    return _with_sets(pairs, sets, max(pairs.count(), 1)).mapInArrow(C.lean(_verdicts(over, under)), "a bigint, b bigint, near boolean")


def links(keyed: DataFrame, sets_of: Callable[[DataFrame], DataFrame], over: int, under: int, likely: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Links (a, b) among sets `keyed` (t, key). `sets_of` gives t and shingles
    (64-bit integers as bytes) for a frame of ids t; `likely` may drop pairs
    (a, b) that are surely not similar before their sets are fetched."""
    level = C.materialize(keyed.select("t", "key", F.lit(True).alias("u")), "keyed")
    edges, sets = None, None
    while level is not None:
        first = sets is None
        pairs, fits, members = _groups(level, max(level.count(), 1), first)
        fits, members = C.materialize(fits, "fits"), C.materialize(members, "members")
        if first:
            pairs = C.materialize(likely(pairs) if likely else pairs, "pairs")
            wanted = pairs.select(F.col("a").alias("t")).unionByName(pairs.select(F.col("b").alias("t"))).unionByName(fits.select("t")).unionByName(members.select("t"))
            sets = C.materialize(sets_of(C.materialize(wanted.distinct(), "wanted")), "shingles")
            edges = C.materialize(_near(pairs, sets, over, under).filter("near").select("a", "b"), "near")
        trees = fits.join(sets, "t").select("g", "t", "shingles").repartition("g").sortWithinPartitions("g").mapInArrow(C.lean(_trees(over, under)), "a bigint, b bigint")
        edges = edges.unionByName(C.materialize(trees, "trees").distinct())
        edges, level = (edges, None) if members.isEmpty() else _split(members, sets, over, under, edges)
    return edges


def _split(members: DataFrame, sets: DataFrame, over: int, under: int, edges: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Links that hold all `edges` and those of groups (g, t) to one of their
    own; keys for the pairs that are left, if there are any."""
    sizes = C.materialize(members.groupBy("g").agg(F.count("*").alias("n"), F.min("t").alias("b")), "sizes")
    rows = max(members.count(), 1)
    star = C.lookup(members, sizes, "g", "n", rows).filter("t <> b").select(F.col("t").alias("a"), "b").distinct()
    near = C.materialize(_near(star, sets, over, under).filter("near").select("a", "b"), "stars")
    roots = C.materialize(C.components(edges.unionByName(near)), "components")
    edges = roots.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    placed = members.join(roots.withColumnRenamed("node", "t"), "t", "left").select("g", "t", F.coalesce("root", "t").alias("root"))
    placed = C.materialize(placed, "placed")
    shares = placed.groupBy("g", "root").agg(F.count("*").alias("k"))
    several = shares.groupBy("g").agg(F.max_by("root", "k").alias("most"), F.count("*").alias("parts"), F.sum("k").alias("n")).filter("parts > 1").drop("parts")
    several = C.materialize(several, "open")
    if several.isEmpty():
        return edges, None
    inside = C.lookup(placed, several, "g", "n", rows).select("g", "t", (F.col("root") != F.col("most")).alias("far"))
    inside = C.materialize(inside.join(sets, "t").select("g", "t", "far", "shingles"), "inside")
    counts = inside.select("g", "shingles").mapInArrow(C.lean(_opened), "g bigint, f bigint").groupBy("g", "f").agg(F.count("*").alias("k"))
    common = counts.join(several, "g").filter("2 * k >= n").groupBy("g").agg(F.collect_list("f").alias("centre"))
    centres = several.join(common, "g", "left").select("g", "n", F.coalesce("centre", F.array().cast("array<bigint>")).alias("centre"))
    centred = C.lookup(inside, C.materialize(centres, "centres"), "g", "n", rows).select("g", "t", "far", "shingles", "centre")
    residues = C.materialize(centred.mapInArrow(C.lean(_residues(over, under)), "g bigint, t bigint, far boolean, w bigint, c bigint, residue array<bigint>"), "residues")
    least = residues.groupBy("g").agg(F.min(F.struct("w", "t")).alias("m"), F.count("*").alias("n"))
    with_m = C.lookup(residues.drop("residue"), least, "g", "n", rows).select("g", "t", "far", "w", "c", F.col("m.w").alias("w_m"), F.col("m.t").alias("m"), "n")
    marked = C.materialize(with_m.withColumn("s", F.col("w") + F.col("w_m") <= F.col("c")), "marked")
    edges = edges.unionByName(marked.filter("s AND t <> m").select(F.col("t").alias("a"), F.col("m").alias("b")))
    # Sets linked to m are near where one of them is; the others' least W tells how many elements a pair must share.
    facts = marked.groupBy("g").agg(F.first("n").alias("n"), F.min(F.when(~F.col("s"), F.col("w"))).alias("w_u"), F.coalesce(F.bool_or(F.col("s") & ~F.col("far")), F.lit(False)).alias("joined"))
    lack = F.when(F.col("s"), F.col("w") + F.col("w_u")).otherwise(F.col("w") + F.col("w_m")) - F.col("c")
    need = C.lookup(marked.drop("n"), facts.filter("w_u IS NOT NULL"), "g", "n", rows)
    need = need.select(F.col("g").alias("of_g"), F.col("t").alias("of_t"), F.greatest(F.ceil(lack / (over + under)), F.lit(1)).cast("bigint").alias("need"), (F.col("far") & ~(F.col("s") & F.col("joined"))).alias("u"))
    need = C.materialize(need, "need")
    wanted = need.filter("u").groupBy("of_g").agg(F.count("*").alias("k"))
    left = C.lookup(residues.select("g", "t", "residue"), wanted.withColumnRenamed("of_g", "g"), "g", "k", rows).drop("k").join(need, F.expr("g = of_g AND t = of_t")).select("g", "t", "u", "need", "residue")
    left = C.materialize(left, "far")
    # Elements of no far set, or of one set alone, are shared by no pair of interest: they come first in every set.
    opened = left.select("g", "t", "u", F.explode("residue").alias("f"))
    shared = opened.groupBy("g", "f").agg(F.count("*").alias("k"), F.max("u").alias("any_u")).filter("k > 1 AND any_u").drop("any_u")
    ranked = C.lookup(opened, shared, ["g", "f"], "k", max(left.agg(F.sum(F.size("residue"))).first()[0] or 1, 1))
    listed = ranked.groupBy(F.col("g").alias("of_g"), F.col("t").alias("of_t")).agg(F.sort_array(F.collect_list(F.struct("k", "f"))).alias("ks"))
    prefix = F.size("residue") - F.col("need") + 1 - (F.size("residue") - F.size("ks"))
    taken = left.join(listed, F.expr("g = of_g AND t = of_t")).select("g", "t", "u", F.slice("ks", F.lit(1), F.greatest(prefix, F.lit(0)).cast("int")).alias("ks"))
    keys = taken.select("g", "t", "u", F.explode("ks.f").alias("f"))
    return edges, C.materialize(keys.select("t", F.xxhash64("g", "f").alias("key"), "u"), "keyed")
