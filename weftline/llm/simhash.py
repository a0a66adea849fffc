"""SimHash near-duplicates by pigeonhole blocks.

A fingerprint of 64 bits is cut into four blocks of 16. Two fingerprints that
differ in at most two bits agree in at least two blocks, so they share one of
the six pairs of blocks: distinct fingerprints are joined on those 32-bit keys
and verified by Hamming distance. Where a key is crowded (a cluster of near
copies), pairs would grow with the square of the cluster; there the search
goes on by masks instead: rows of a crowded key that agree once two of the 32
free bits are cleared lie within distance two of each other, so each takes one
link to the smallest of them. That is linear in the rows and loses no
component.

Defined cases: a null text has no words; texts without words have fingerprint
zero and link like any other; equal fingerprints always share a component; a
null doc_id is never the smallest of a component that has others; repeated
rows each get a result row; an empty table gives an empty result; other
columns are ignored by `find` and carried along by `drop`."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.llm import _common as C

SHINGLE_WORDS, MAX_DISTANCE = 3, 2
#: Rows under one block key up to which they are joined pair by pair.
CROWDED = 64
#: Shingles hashed at a time, which bounds memory on very long texts.
STEP = 1 << 16


def fingerprint(text: str | None) -> int:
    """Unsigned SimHash of the whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and ASCII space only
    if not words:
        return 0
    ones, n = np.zeros(64, dtype=np.int64), max(1, len(words) - SHINGLE_WORDS + 1)
    for at in range(0, n, STEP):
        part = words[at : at + STEP + SHINGLE_WORDS - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(SHINGLE_WORDS)))) if len(words) >= SHINGLE_WORDS else [b" ".join(words)]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(42)), dtype=np.uint64)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.fromiter((fingerprint(t.as_py()) for t in batch.column(1)), dtype=np.uint64, count=batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found.view(np.int64))], ["doc_id", "t", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, t (a hash of the text), fp (signed 64 bits)."""
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint"), text, F.xxhash64(text)).mapInArrow(_fingerprints, "doc_id bigint, t bigint, fp bigint")


def block_keys(fp: str) -> Column:
    """The six keys of a fingerprint: which two blocks, and their 32 bits."""
    block = [f"(shiftrightunsigned({fp}, {48 - 16 * i}) & 65535)" for i in range(4)]
    both = [(block[i], block[j]) for i in range(4) for j in range(i + 1, 4)]
    return F.array(*[F.expr(f"{k}L << 32 | {p} << 16 | {q}") for k, (p, q) in enumerate(both)])


def _keyed(fps: DataFrame) -> DataFrame:
    """Six rows a fingerprint: key (which two blocks, and their 32 bits) and
    rest (the other 32 bits)."""
    block = [f"(shiftrightunsigned(fp, {48 - 16 * i}) & 65535)" for i in range(4)]
    rows, k = [], 0
    for i in range(4):
        for j in range(i + 1, 4):
            p, q = (x for x in range(4) if x not in (i, j))
            rows.append(f"named_struct('key', {k}L << 32 | {block[i]} << 16 | {block[j]}, 'rest', {block[p]} << 16 | {block[q]})")
            k += 1
    return fps.select("fp", F.expr(f"inline(array({', '.join(rows)}))"))


def links(fps: DataFrame) -> DataFrame:
    """Distinct fingerprints `fp` to links (a, b): every pair within the
    distance is joined by links, directly or through others."""
    keyed = _keyed(fps)
    counts = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = C.materialize(keyed.join(counts, "key"), "blocks")
    few = shared.filter(F.col("n") <= CROWDED)
    left, right = few.select("key", F.col("fp").alias("a")), few.select("key", F.col("fp").alias("b"))
    near = left.join(right, (left["key"] == right["key"]) & (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_DISTANCE))
    free = [(i, j) for i in range(32) for j in range(i)]
    masks = F.array(*[F.lit(~(1 << i | 1 << j) & 0xFFFFFFFF) for i, j in free])
    crowded = shared.filter(F.col("n") > CROWDED).select("fp", "key", "rest", F.explode(masks).alias("mask")).select("fp", "key", "mask", F.expr("rest & mask").alias("kept"))
    cell = ["key", "mask", "kept"]
    least = crowded.groupBy(*cell).agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1").drop("n")
    masked = crowded.join(least, cell).select(F.col("fp").alias("a"), "b").filter("a <> b")
    return near.select("a", "b").unionByName(masked).distinct()


def _grouped(docs: DataFrame) -> DataFrame:
    """doc_id, t, fp, links, first: the component's smallest (no id, doc_id, t)."""
    rows = C.materialize(fingerprints(docs), "fingerprints")
    total = max(rows.count(), 1)
    least = F.min(F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "t")).alias("first")
    distinct = C.materialize(rows.groupBy("fp").agg(least, F.count("*").alias("n")), "distinct")
    found = C.materialize(links(distinct.select("fp")), "near")
    roots = C.components(found)
    degree = found.select(F.col("a").alias("fp")).unionByName(found.select(F.col("b").alias("fp"))).groupBy("fp").agg(F.count("*").alias("links"))
    joined = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").join(degree, "fp", "left")
    joined = C.materialize(joined.select("fp", "first", "n", F.coalesce("root", "fp").alias("root"), F.coalesce("links", F.lit(0)).alias("links")), "roots")
    smallest = joined.groupBy("root").agg(F.min("first").alias("first"), F.count("*").alias("members"))
    groups = C.lookup(joined.drop("first"), smallest, "root", "members", total).select("fp", "n", "first", "links")
    return C.lookup(rows, groups, "fp", "n", total)


def find(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id, links (how many
    other fingerprints its own was linked to by the search)."""
    return _grouped(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id"), "links")


def drop(docs: DataFrame, grouped: Callable[[DataFrame], DataFrame] = _grouped) -> DataFrame:
    """One document of each component, the one with the smallest doc_id (of
    several rows with that id, one), with the columns it came with. Only rows
    that a Bloom filter takes for copies are shuffled. `grouped` gives doc_id,
    t and first of every row."""
    rows = C.materialize(grouped(docs).select("doc_id", "t", (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & F.col("t").eqNullSafe(F.col("first.t"))).alias("stays")), "grouped")
    pairs = rows.groupBy("doc_id", "t", "stays").agg(F.count("*").alias("n")).filter("NOT stays OR n > 1")
    pairs = C.materialize(pairs.select(F.col("doc_id").alias("of_id"), F.col("t").alias("of_t"), "stays"), "copies")
    bits = C.bloom_bits(pairs.count())
    bitmaps = C.materialize(C.bloom_build(pairs, ["of_id", "of_t"], bits, least=1), "bloom")
    columns = C.columns_of(docs)
    keyed = docs.select(F.struct(*columns).alias("whole"), F.col("doc_id").cast("bigint").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("t"), F.xxhash64(*columns).alias("rank"))
    flagged = C.bloom_flag(keyed, ["id", "t"], bits, bitmaps, "maybe")
    marked = flagged.filter("maybe").join(pairs, F.expr("id <=> of_id AND t = of_t"), "left")
    several = marked.filter("stays").groupBy("id", "t").agg(F.min_by("whole", "rank").alias("whole"))
    return C.union_all([flagged.filter("NOT maybe").select("whole.*"), marked.filter("stays IS NULL").select("whole.*"), several.select("whole.*")])
