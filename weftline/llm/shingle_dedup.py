"""SimHash near copies, verified by the Jaccard similarity of word shingles, for
pipelines.

Each text gets the SimHash fingerprint of its distinct five-word shingles. Its
64 bits are cut into four blocks, as in `simhash`, and texts that share one of
the six pairs of blocks are candidates: all within two bits, and many beyond.
At similarity 0.8, however, about 10 bits differ, more than a set of pigeonhole
blocks can serve, so bands of min-hashes over the same shingles give further
candidates: texts at similarity s agree in one of BANDS bands of ROWS with
probability 1 - (1 - s^ROWS)^BANDS (0.992 at 0.8, 0.9999 at 0.88).

Candidate pairs of either kind whose fingerprints differ in more than FAR bits
are dropped before their sets are read; at 0.8 or more that happens to one pair
in ten million or less. All others are verified: texts that share a key go to
`near_sets`, which compares the whole sets of shingle hashes and loses no link
in groups of any size.

Defined cases: a text of fewer words than a shingle is one shingle; texts
without words (null, too) have the empty shingle and are copies of each other;
a null doc_id is never the smallest of a component that has others; repeated
rows are copies; a very long text is read as a whole, in steps; an empty table
gives an empty result; other columns are carried along, whatever their names."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import _common as C
from weftline.llm import near_sets, simhash

#: Words a shingle; least similarity as a fraction.
SHINGLE_WORDS, SIMILARITY = 5, (4, 5)
BANDS, ROWS = 16, 6
#: Bits in which the fingerprints of a pair may differ, of 64.
FAR = 30
#: Shingles min-hashed at a time, which bounds memory on very long texts.
STEP = 1 << 9

_seeds = np.random.default_rng(42)
_FACTORS, _TERMS = (_seeds.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64) for _ in range(2))
_FACTORS |= np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """Distinct shingle hashes of the whole text, in order."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    grams = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE_WORDS)))) if len(words) >= SHINGLE_WORDS else [b" ".join(words)]
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(42)), dtype=np.uint64))


def band_keys(hashes: np.ndarray) -> list[int]:
    """Signed 64-bit keys of the BANDS bands."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), STEP):
        np.minimum(least, (hashes[at : at + STEP, None] * _FACTORS + _TERMS).min(axis=0), out=least)
    return [xxhash.xxh64_intdigest(band.tobytes(), i) - (1 << 63) for i, band in enumerate(least.reshape(BANDS, ROWS))]


def fingerprint(hashes: np.ndarray) -> int:
    """Signed SimHash: the bits that over half of the shingle hashes have."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), simhash.STEP):
        ones += np.unpackbits(hashes[at : at + simhash.STEP].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big", signed=True)


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, t) to (doc_id, t, fp, keys of the bands)."""
    for batch in batches:
        fps, keys = [], []
        for text in batch.column(1):
            hashes = shingles(text.as_py())
            fps.append(fingerprint(hashes))
            keys.append(band_keys(hashes))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "t", "fp", "keys"])


def _within(texts: DataFrame, total: int):
    """A filter of pairs (a, b) by the fingerprints of `texts`."""

    def run(pairs: DataFrame) -> DataFrame:
        pairs = C.materialize(pairs, "candidates")
        for c in "ab":
            of = pairs.groupBy(F.col(c).alias("t")).agg(F.count("*").alias("times"))
            side = of.join(texts, "t").select(F.col("t").alias(c), "times", F.col("fp").alias(f"fp_{c}"))
            pairs = C.lookup(pairs, side, c, "times", total).drop("times")
        return pairs.filter(F.bit_count(F.col("fp_a").bitwiseXOR(F.col("fp_b"))) <= FAR).select("a", "b")

    return run


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = pa.array([shingles(t.as_py()).tobytes() for t in batch.column(1)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), found], ["t", "shingles"])


def shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """t, shingles of the texts whose hash t is wanted. Only rows that a Bloom
    filter takes for one of them are shuffled; what it can't hold is dealt to
    ranges, each with a filter of its own."""
    text = F.col("text").cast("string")
    maybe = C.possible(docs.select(F.xxhash64(text).alias("t"), text.alias("text")), wanted, "t")
    whole = maybe.groupBy("t").agg(F.any_value("text").alias("text")).join(wanted, "t", "left_semi")
    return whole.mapInArrow(C.lean(_sets), "t bigint, shingles binary")


def grouped(docs: DataFrame) -> DataFrame:
    """doc_id, t (a hash of the text), first: the component's smallest (no id, doc_id, t)."""
    text = F.col("text").cast("string")
    read = docs.select(F.col("doc_id").cast("bigint"), text, F.xxhash64(text).alias("t"))
    rows = C.materialize(read.mapInArrow(C.lean(_marked), "doc_id bigint, t bigint, fp bigint, keys array<bigint>"), "fingerprints")
    total = max(rows.count(), 1)
    least = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "t")).alias("first")
    texts = C.materialize(rows.groupBy("t").agg(least, F.count("*").alias("n"), F.any_value("fp").alias("fp"), F.any_value("keys").alias("keys")), "texts")
    blocks = texts.select("t", F.explode(simhash.block_keys("fp")).alias("block")).select("t", F.xxhash64("block").alias("key"))
    keyed = blocks.unionByName(texts.select("t", F.explode("keys").alias("key")))
    found = near_sets.links(keyed, lambda wanted: shingle_sets(docs, wanted), *SIMILARITY, likely=_within(texts.select("t", "fp"), total))
    roots = C.components(C.materialize(found, "near"))
    joined = texts.join(roots.withColumnRenamed("node", "t"), "t", "left")
    joined = C.materialize(joined.select("t", "first", "n", F.coalesce("root", "t").alias("root")), "roots")
    smallest = joined.groupBy("root").agg(F.min("first").alias("first"), F.count("*").alias("members"))
    groups = C.lookup(joined.drop("first"), smallest, "root", "members", total).select("t", "n", "first")
    return C.lookup(rows.drop("fp", "keys"), groups, "t", "n", total)


def drop(docs: DataFrame) -> DataFrame:
    """One document of each component of similar texts, as `simhash.drop`."""
    return simhash.drop(docs, grouped)
