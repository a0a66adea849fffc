"""Near copies by SetSketch registers.

A sketch has M registers. Register i holds floor(1 - log_b h), cut to 0 ..
LIMIT, of the least of exponentially distributed hashes h_i over the set, so its
values are spaced exponentially: two bytes a register. The sketch of a union is
the greater register of both, so sketches merge in any order (`merged`). Equal
sets have equal sketches, and registers of sets of similarity s agree with
probability near s, as b is close to 1: bands of register values are the keys
under which near sets meet. Sets of similarity 0.85 share none of BANDS bands of
ROWS registers in one of 90,000 cases.

Pairs that share a band are first judged by both sketches together: the counts
of registers that are greater, smaller and equal have a likelihood that is a
concave function of the similarity. Pairs for which SIMILARITY is less likely
than the best estimate by exp(DOUBT) or more are dropped; that happens to one
truly similar pair in ten million or less. All others are verified on their
whole sets. Groups of any size go through `near_sets`, which loses no link.

Defined cases: a text without words, or null, has an empty set, links to nothing
and is a component of its own; fewer words than a shingle are one shingle; a
very long text is sketched as a whole, in steps; repeated rows are copies; a
null doc_id is never the smallest of a component that has others, and a
component of null ids alone has a null id and keeps all its rows; an empty table
gives an empty result; other columns are ignored, whatever their names."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import _common as C
from weftline.llm import near_sets
from weftline.llm.shingle_dedup import shingle_sets, shingles

#: Least similarity as a fraction.
SIMILARITY = (85, 100)
BANDS, ROWS = 24, 6
M = BANDS * ROWS
#: Base of the registers' spacing, rate of the hashes, greatest register.
BASE, RATE, LIMIT = 1.001, 20.0, (1 << 16) - 1
#: Log-likelihood that a pair may lack.
DOUBT = 16.0
#: Shingles sketched at a time, which bounds memory on very long texts.
STEP = 1 << 9

_seeds = np.random.default_rng(11)
_FACTORS, _TERMS = (_seeds.integers(0, 1 << 64, M, dtype=np.uint64) for _ in range(2))
_FACTORS |= np.uint64(1)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Registers (uint16) of a set of 64-bit hashes; all zero of an empty one."""
    if not len(hashes):
        return np.zeros(M, dtype=np.uint16)
    least = np.full(M, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), STEP):
        np.minimum(least, (hashes[at : at + STEP, None] * _FACTORS + _TERMS).min(axis=0), out=least)
    # The least of exponential values belongs to the least of uniform ones.
    h = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(h) / np.log(BASE)), 0, LIMIT).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union."""
    return np.maximum(a, b)


def band_keys(registers: np.ndarray) -> list[int]:
    """Signed 64-bit keys of the bands."""
    return [xxhash.xxh64_intdigest(band.tobytes(), i) - (1 << 63) for i, band in enumerate(registers.reshape(BANDS, ROWS))]


def likelihood(greater: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Log-likelihood of similarity s for pairs of sets of n_a and n_b elements
    of which so many registers are greater and smaller in a; the rest is equal."""
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    # The probability that one's register exceeds the other's, whose elements of its own are a share x of the union's weight.
    exceeds = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    p, q = exceeds(u - v * s), exceeds(v - u * s)
    parts = ((greater, p), (smaller, q), (M - greater - smaller, 1 - p - q))
    return sum(np.where(k > 0, k * np.log(np.maximum(x, 1e-300)), 0.0) for k, x in parts)


def estimate(greater: np.ndarray, smaller: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The likeliest similarity of each pair, by golden sections."""
    low, high = np.zeros(len(n_a)), np.minimum(n_a / n_b, n_b / n_a)
    ratio = (5**0.5 - 1) / 2
    for _ in range(30):
        x, y = high - ratio * (high - low), low + ratio * (high - low)
        up = likelihood(greater, smaller, n_a, n_b, x) < likelihood(greater, smaller, n_a, n_b, y)
        low, high = np.where(up, x, low), np.where(up, high, y)
    return (low + high) / 2


def plausible(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Which pairs of sketches (rows of a and b) may have SIMILARITY."""
    over, under = SIMILARITY
    greater, smaller = (a > b).sum(1), (a < b).sum(1)
    best = estimate(greater, smaller, n_a, n_b)
    lack = likelihood(greater, smaller, n_a, n_b, best) - likelihood(greater, smaller, n_a, n_b, np.full(len(n_a), over / under))
    return (under * np.minimum(n_a, n_b) >= over * np.maximum(n_a, n_b)) & ((best >= over / under) | (lack <= DOUBT))


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, t) to (doc_id, t, n, registers); n is 0 without words."""
    for batch in batches:
        n, out = [], []
        for text in batch.column(1):
            words = text.as_py()
            found = shingles(words) if words and words.encode("utf-8", "surrogatepass").split() else np.zeros(0, dtype=np.uint64)
            n.append(len(found))
            out.append(sketch(found).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(out, pa.binary())], ["doc_id", "t", "n", "registers"])


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = pa.array([band_keys(np.frombuffer(r.as_buffer(), np.uint16)) for r in batch.column(1)], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column(0), keys], ["t", "keys"])


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, n of a, n of b, registers of a, registers of b) to plausible (a, b)."""
    for batch in batches:
        if batch.num_rows:
            n_a, n_b = (batch.column(i).to_numpy().astype(np.float64) for i in (2, 3))
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, M).astype(np.int32) for i in (4, 5))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(plausible(a, b, n_a, n_b))) for c in batch.columns[:2]], ["a", "b"])


def _likely(texts: DataFrame, total: int):
    """A filter of pairs (a, b) by the sketches of `texts`."""

    def run(pairs: DataFrame) -> DataFrame:
        pairs = C.materialize(pairs, "candidates")
        for c in "ab":
            of = pairs.groupBy(F.col(c).alias("t")).agg(F.count("*").alias("times"))
            side = of.join(texts, "t").select(F.col("t").alias(c), "times", F.col("n").alias(f"n_{c}"), F.col("registers").alias(f"registers_{c}"))
            pairs = C.lookup(pairs, side, c, "times", total).drop("times")
        return pairs.select("a", "b", "n_a", "n_b", "registers_a", "registers_b").mapInArrow(C.lean(_judged), "a bigint, b bigint")

    return run


def find(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    text = F.col("text").cast("string")
    read = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("t"))
    rows = C.materialize(read.mapInArrow(C.lean(_sketched), "doc_id bigint, t bigint, n bigint, registers binary"), "sketches")
    alone = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    worded = rows.filter("n > 0")
    total = max(worded.count(), 1)
    least = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id")).alias("first")
    texts = C.materialize(worded.groupBy("t").agg(least, F.count("*").alias("times"), F.any_value("n").alias("n"), F.any_value("registers").alias("registers")), "texts")
    keyed = texts.select("t", "registers").mapInArrow(C.lean(_banded), "t bigint, keys array<bigint>").select("t", F.explode("keys").alias("key"))
    found = near_sets.links(keyed, lambda wanted: shingle_sets(docs, wanted), *SIMILARITY, likely=_likely(texts.select("t", "n", "registers"), total))
    roots = C.components(C.materialize(found, "near"))
    joined = texts.select("t", "first", "times").join(roots.withColumnRenamed("node", "t"), "t", "left")
    joined = C.materialize(joined.select("t", "first", "times", F.coalesce("root", "t").alias("root")), "roots")
    smallest = joined.groupBy("root").agg(F.min("first").alias("first"), F.count("*").alias("members"))
    groups = C.lookup(joined.drop("first"), smallest, "root", "members", total).select("t", "times", F.col("first.doc_id").alias("component_id"))
    out = C.lookup(worded.select("doc_id", "t", F.col("n").alias("n_shingles")), groups, "t", "times", total)
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")).unionByName(alone)
