"""Removal of repeated passages by bucket-pointer refinement.

Every byte goes that lies in a LENGTH-byte string which starts anywhere else.

1. Initial buckets. Each window of LENGTH bytes falls into the bucket of one
   GRAM-byte gram inside it, the one of least hash (the leftmost of equals).
   Equal windows have equal grams at equal places, so a window can be equal only
   to others of its bucket. Neighbouring windows with the same gram are one run;
   grams that occur once are done with.
2. Equal runs (128-bit digests of all their bytes) become one example with a
   count, so that a passage that a third of all documents hold is refined once.
3. Buckets whose examples exceed BUCKET_BYTES are refined by rows: a run is cut
   by the place of its gram, each part gets the identifier of the longer string
   that all its windows share as its new bucket, equal parts merge, and so on
   until a bucket fits or its windows are down to one string.
4. The suffixes of a bucket's examples are sorted in one task. They start in
   buckets of q-grams; a bucket of common depth d is sorted by the pointers, d
   bytes later, to those suffixes' buckets, which adds the depth of these. Its
   parts are refined recursively at once, and each new pointer is used by every
   refinement after it. An example that stands for several rows counts for all.
   Windows in a bucket of two or more repeat; suffixes that a jump beyond LENGTH
   has separated are compared with their neighbours byte by byte.

All removed bytes come from step 4. Rows are told apart by doc_id and a 128-bit
hash of doc_id and text.

Defined cases: a null text is empty; a null doc_id is a value like others; texts
under LENGTH bytes lose nothing; a very long text is read in blocks of BLOCK
bytes; rows with equal doc_id and text get equal results and count as repeats of
each other; an empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import _common as C

LENGTH, GRAM = 400, 128
#: Bytes hashed at a time; bytes of a bucket's examples that one sort may hold;
#: bytes that one sort takes of several buckets, at least.
BLOCK, BUCKET_BYTES, SORT_BYTES = 1 << 18, 1 << 20, 1 << 17
#: Bits of the gram's place that the parts of a run share, by steps of refinement.
LEVELS = (6, 3, 0)
#: Bytes of the first buckets' codes; suffixes refined together.
Q, GROUP = 7, 1 << 15
_BASE, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xFF51AFD7ED558CCD)

_powers: list[np.ndarray] = []


def _tables() -> list[np.ndarray]:
    """Powers of the rolling hash's base and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) <= BLOCK + LENGTH:
        bases = (_BASE, pow(_BASE, -1, 1 << 64))
        _powers[:] = [np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(BLOCK + LENGTH, b, dtype=np.uint64)])) for b in bases]
    return _powers


def _finish(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """data: joined texts, at most BLOCK bytes and one LENGTH; ends: where each
    ends. Runs of windows as (text, first start, end of starts, place of the
    gram behind the first start, gram)."""
    n, width = len(data), LENGTH - GRAM + 1
    if n < LENGTH:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    power, back = _tables()
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    grams = _finish((sums[GRAM:] - sums[: n - GRAM + 1]) * back[: n - GRAM + 1])
    del sums
    least = (grams >> np.uint64(24) << np.uint64(24)) | np.arange(len(grams), dtype=np.uint64)
    step = 1
    while 2 * step <= width:  # least[i]: the least of `step` grams from i on
        least, step = np.minimum(least[:-step], least[step:]), 2 * step
    if step < width:
        least = np.minimum(least[: len(least) - (width - step)], least[width - step :])
    place = (least & np.uint64((1 << 24) - 1)).astype(np.int32)  # of each window's gram
    del least
    ends = np.minimum(ends, n)
    text = np.repeat(np.arange(len(ends), dtype=np.int32), np.diff(ends, prepend=0))[: len(place)]
    new = np.ones(len(place), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    # Windows that leave their text are the last of it, so a run loses its end.
    last = np.minimum(np.append(first[1:], len(place)), ends[text[first]] - LENGTH + 1)
    good = last > first
    first, last = first[good], last[good]
    at = place[first]
    return text[first], first, last, at - first, grams[at].view(np.int64)


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A binary column as one array of bytes, without a copy, and where each
    value ends in it; nulls are empty."""
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    edges = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, dtype=np.uint8), edges[1:] - edges[0]
    return np.frombuffer(data, dtype=np.uint8)[edges[0] : edges[-1]], edges[1:] - edges[0]


def _digests(data: memoryview, starts: list[int], ends: list[int], seeds: list[int]) -> np.ndarray:
    """128-bit digests of spans of `data`, as rows of two signed numbers."""
    return np.frombuffer(b"".join(xxhash.xxh3_128_digest(data[a:b], s) for a, b, s in zip(starts, ends, seeds)), dtype=np.int64).reshape(-1, 2)


#: A row of a text; a run of windows from lo to hi with its gram `a` bytes behind
#: lo; the bucket q; the digest of the run's bytes.
_KEY, _CLASS = ["d", "h1", "h2"], ["q", "s1", "s2"]
_MARKS = "d bigint, h1 bigint, h2 bigint, lo int, hi int, a int, q bigint, s1 bigint, s2 bigint"


def _marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:3]]
        data, ends = _texts(batch.column(3))
        view = memoryview(data)
        for at in range(0, max(0, len(data) - LENGTH + 1), BLOCK):
            from_text = int(np.searchsorted(ends, at, side="right"))
            upto = int(np.searchsorted(ends, at + BLOCK + LENGTH - 1, side="left")) + 1
            text, lo, hi, a, q = anchors(data[at : at + BLOCK + LENGTH - 1], ends[from_text:upto] - at)
            if not len(text):
                continue
            text = text + from_text
            lo, hi = lo + at, hi + at
            digest = _digests(view, lo.tolist(), (hi + LENGTH - 1).tolist(), a.tolist())
            start = np.append(0, ends)[text]
            columns = [*(k[text] for k in keys), (lo - start).astype(np.int32), (hi - start).astype(np.int32), a.astype(np.int32), q, digest[:, 0], digest[:, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], [*_KEY, "lo", "hi", "a", *_CLASS])


# -- refinement in one task -----------------------------------------------------


def repeated(data: bytes, ends: np.ndarray, stands_for: np.ndarray | None = None) -> np.ndarray:
    """Joined texts, where each ends, and how many each stands for (else one): a
    mask over all positions, true where a string of LENGTH bytes starts, within
    its text, that also starts elsewhere in them."""
    n = len(data)
    out = np.zeros(n, dtype=bool)
    if not n:
        return out
    left = (np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(n)).astype(np.int32)  # bytes to the text's end
    # Codes: Q bytes, and how many of them the text still has. They sort as the
    # suffixes do; a suffix that is shorter than Q has a bucket of its own.
    raw = np.frombuffer(data + bytes(Q), dtype=np.uint8)
    code = np.zeros(n, dtype=np.uint64)
    for i in range(Q):
        code = code << np.uint64(8) | np.where(left > i, raw[i : i + n], np.uint8(0))
    code = code << np.uint64(8) | np.minimum(left, Q).astype(np.uint64)
    order = np.argsort(code).astype(np.int32)
    new = np.ones(n, dtype=bool)
    new[1:] = (code[order[1:]] != code[order[:-1]]) | (left[order[1:]] < Q)
    # A pointer is the place in `order` where a suffix's bucket begins.
    pointer = np.empty(n, dtype=np.int32)
    pointer[order] = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), np.int32(0)))
    depth = np.full(n, Q, dtype=np.int32)  # by pointer: bytes that a bucket's suffixes have in common

    def refine(members: np.ndarray) -> np.ndarray:
        """Sorts buckets by the buckets of later offsets; returns those of their
        suffixes that are not alone in the new buckets, nor done."""
        p = pointer[members]
        d = depth[p]
        ended = left[members] <= d
        later = np.where(ended, -1 - members, pointer[np.where(ended, 0, members + d)])
        common = d + np.where(ended, Q, depth[later])
        key = (p.astype(np.int64) << 32) + (later + np.int64(n))
        by = np.argsort(key)
        members, key, p, common = members[by], key[by], p[by], common[by]
        fresh, outer = np.ones(len(by), dtype=bool), np.ones(len(by), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        outer[1:] = p[1:] != p[:-1]
        rank = np.arange(len(by), dtype=np.int32)
        shift = p - np.maximum.accumulate(np.where(outer, rank, 0))
        order[rank + shift] = members
        start = (np.maximum.accumulate(np.where(fresh, rank, 0)) + shift).astype(np.int32)
        pointer[members] = start
        depth[start[fresh]] = common[fresh]
        alone = fresh & np.append(fresh[1:], True)
        return members[~alone & (common < LENGTH)]

    many = np.flatnonzero(~(new & np.append(new[1:], True)))
    starts = np.flatnonzero(new[many])
    cuts = starts[np.unique(np.searchsorted(starts, np.arange(0, len(many), GROUP)).clip(max=max(0, len(starts) - 1)))] if len(starts) else []
    for a, b in zip(cuts, [*cuts[1:], len(many)]):
        members = order[many[a:b]]
        while len(members):
            members = refine(members)
    # Buckets of two or more have a depth of LENGTH by now.
    weights = None if stands_for is None else np.repeat(np.minimum(stands_for, 2), np.diff(ends, prepend=0))
    size = np.bincount(pointer, weights, minlength=n)
    windows = np.flatnonzero(left >= LENGTH)
    out[windows] = size[pointer[windows]] > 1
    # Alone, but separated from others by bytes that may lie beyond LENGTH.
    unsure = windows[~out[windows] & (depth[pointer[windows]] > LENGTH)]
    for side in (-1, 1):
        place = pointer[unsure] + side
        have = (place >= 0) & (place < n)
        mine, other = unsure[have], order[place[have]]
        same = left[other] >= LENGTH
        mine, other = mine[same], other[same]
        for at in (*range(LENGTH - Q, 0, -Q), 0):
            same = code[mine + at] == code[other + at]
            mine, other = mine[same], other[same]
        out[mine] = True
    return out


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(mask.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


_SPANS = "array<struct<start:bigint,end:bigint>>"
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_FOUND = f"q bigint, s1 bigint, s2 bigint, n bigint, spans {_SPANS}"


def _sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Examples (q, s1, s2, n, bytes), sorted by q, to those that hold repeated
    bytes, with their spans. Sorts whole buckets, some MB at a time."""

    def sort(rows: list[tuple]) -> pa.RecordBatch:
        ends = np.cumsum([len(r[4]) for r in rows])
        starts, stops = _runs(repeated(b"".join(r[4] for r in rows), ends, np.array([r[3] for r in rows])))
        row = np.searchsorted(ends, starts, side="right")
        found: dict[int, list[dict]] = {}
        for i, a, b in zip(row.tolist(), starts.tolist(), stops.tolist()):
            shift = int(ends[i]) - len(rows[i][4])
            found.setdefault(i, []).append({"start": a - shift, "end": b - 1 + LENGTH - shift})
        keys = [pa.array([rows[i][j] for i in found], pa.int64()) for j in range(4)]
        return pa.RecordBatch.from_arrays([*keys, pa.array(list(found.values()), _SPAN_TYPE)], [*_CLASS, "n", "spans"])

    waiting, size = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if size >= SORT_BYTES and row[0] != waiting[-1][0]:
                yield sort(waiting)
                waiting, size = [], 0
            waiting.append(row)
            size += len(row[4])
    if waiting:
        yield sort(waiting)


# -- refinement by rows ------------------------------------------------------------


def _parts(level: int):
    """Examples (q, s1, s2, n, a, bytes) to parts whose gram lies in one range
    of 2^level places: the example, where the part begins in it, and the part as
    an example of the bucket that the common bytes of all such windows name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for q, s1, s2, n, a, data in zip(*(c.to_pylist() for c in batch.columns)):
                farthest, nearest = a, a - (len(data) - LENGTH)  # of the gram from a window's start
                for part in range(nearest >> level, (farthest >> level) + 1):
                    low, high = part << level, (part + 1 << level) - 1
                    begin, end = a - min(high, farthest), a - max(low, nearest) + LENGTH
                    # What every window of the range covers, also those that this run lacks.
                    high = min(high, LENGTH - GRAM)
                    core = xxhash.xxh3_64_intdigest(data[a - low : a - high + LENGTH], seed=part) - (1 << 63)
                    own = np.frombuffer(xxhash.xxh3_128_digest(data[begin:end], a - begin), dtype=np.int64).tolist()
                    rows.append((q, s1, s2, begin, core, *own, n, a - begin, data[begin:end]))
            types = [pa.int64()] * 9 + [pa.binary()]
            columns = zip(*rows) if rows else [[]] * 10
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["of_q", "of_s1", "of_s2", "begin", *_CLASS, "n", "a", "bytes"])

    return run


_EXAMPLE = "q bigint, s1 bigint, s2 bigint, n bigint, a bigint, bytes binary"


def refine(examples: DataFrame, step: int = 0) -> DataFrame:
    """Examples (q, s1, s2, n, a, bytes), no two alike, to those that hold
    repeated bytes: q, s1, s2, n, spans."""
    size = F.octet_length("bytes").cast("bigint")
    sizes = C.materialize(examples.groupBy("q").agg(F.sum(size).alias("size"), F.count("*").alias("rows"), F.sum("n").alias("all")).filter("all > 1"), "buckets")
    total, largest = sizes.agg(F.coalesce(F.sum("all"), F.lit(1)), F.coalesce(F.max("size"), F.lit(0))).first()
    joined = C.lookup(examples, sizes.drop("all"), ["q"], "rows", total)
    # After the last step all windows of a bucket are equal: one example each.
    crowded = step < len(LEVELS) and largest > BUCKET_BYTES
    fits = F.col("size") <= BUCKET_BYTES if crowded else F.lit(True)
    found = joined.filter(fits).select(*_CLASS, "n", "bytes").repartition("q").sortWithinPartitions("q").mapInArrow(_sorted, _FOUND)
    if not crowded:
        return found
    many = joined.filter(~fits).select(*_CLASS, "n", "a", "bytes")
    parts = C.materialize(many.mapInArrow(_parts(LEVELS[step]), "of_q bigint, of_s1 bigint, of_s2 bigint, begin bigint, " + _EXAMPLE), "parts")
    merged = parts.groupBy(*_CLASS).agg(F.sum("n").alias("n"), F.first("a").alias("a"), F.first("bytes").alias("bytes"))
    inner = C.materialize(refine(C.materialize(merged, "merged"), step + 1), "found")
    back = C.lookup(parts.select("of_q", "of_s1", "of_s2", "begin", *_CLASS, F.col("n").alias("own")), inner, _CLASS, "n", total)
    shifted = F.transform("spans", lambda x: F.struct((x["start"] + F.col("begin")).alias("start"), (x["end"] + F.col("begin")).alias("end")))
    outer = back.groupBy(F.col("of_q").alias("q"), F.col("of_s1").alias("s1"), F.col("of_s2").alias("s2"))
    return found.unionByName(outer.agg(F.first("own").alias("n"), F.flatten(F.collect_list(shifted)).alias("spans")))


# -- from documents to spans -----------------------------------------------------


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the runs wanted of them to (q, s1, s2, n, a, bytes)."""
    for batch in batches:
        for text, wanted in zip(batch.column(0), batch.column(1)):
            data, rows = memoryview(text.as_buffer()), wanted.values
            lo, hi = (rows.field(c).to_pylist() for c in ("lo", "hi"))
            parts = [bytes(data[a : b + LENGTH - 1]) for a, b in zip(lo, hi)]
            yield pa.RecordBatch.from_arrays([*(rows.field(c) for c in (*_CLASS, "n", "a")), pa.array(parts, pa.binary())], [*_CLASS, "n", "a", "bytes"])


def _only(docs: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """docs cut in two by a Bloom filter of the distinct `keys`: those that may
    be among them, and the rest, which stay where they are."""
    bits = C.bloom_bits(keys.count())
    bitmaps = C.materialize(C.bloom_build(keys, _KEY, bits, least=1), "bloom")
    flagged = C.bloom_flag(docs, _KEY, bits, bitmaps, "maybe")
    return flagged.filter("maybe").drop("maybe"), flagged.filter("NOT maybe").drop("maybe")


def spans(rows: DataFrame) -> DataFrame:
    """rows: d, h1, h2, text. One row for each text that loses bytes: d, h1, h2,
    spans, which may overlap. The list is bounded by the text's own length."""
    marks = C.materialize(rows.select(*_KEY, F.col("text").cast("binary")).mapInArrow(_marks, _MARKS), "marks")
    twice = C.materialize(marks.groupBy("q").agg(F.count("*").alias("n")).filter("n > 1"), "grams")
    bits = C.bloom_bits(twice.count())
    maybe = C.bloom_flag(marks, ["q"], bits, C.materialize(C.bloom_build(twice, ["q"], bits, least=1), "bloom"), "maybe").filter("maybe").drop("maybe")
    # Equal rows of the table are one text with a count.
    runs = C.materialize(maybe.groupBy(*maybe.columns).agg(F.count("*").alias("c")), "runs")
    kinds = C.materialize(runs.groupBy(*_CLASS).agg(F.sum("c").alias("n"), *[F.first(c).alias(c) for c in (*_KEY, "lo", "hi", "a")]), "kinds")
    total = max(1, kinds.count())
    grams = kinds.groupBy("q").agg(F.count("*").alias("kinds"), F.sum("n").alias("all")).filter("all > 1").drop("all")
    wanted = C.materialize(C.lookup(kinds, grams, ["q"], "kinds", total).select(*_KEY, F.struct(*_CLASS, "n", F.col("a").cast("bigint").alias("a"), "lo", "hi").alias("w")), "wanted")
    lists = wanted.groupBy(*_KEY).agg(F.collect_list("w").alias("wanted"))
    texts, _ = _only(rows.select(*_KEY, F.col("text").cast("binary").alias("text")), wanted.select(*_KEY).distinct())
    texts = texts.groupBy(*_KEY).agg(F.first("text").alias("text")).join(lists, _KEY).select("text", "wanted")
    found = C.materialize(refine(C.materialize(texts.mapInArrow(_examples, _EXAMPLE), "examples")), "found")
    placed = C.lookup(runs.select(*_KEY, "lo", *_CLASS), found, _CLASS, "n", max(1, marks.count()))
    moved = F.transform("spans", lambda x: F.struct((x["start"] + F.col("lo")).alias("start"), (x["end"] + F.col("lo")).alias("end")))
    return placed.groupBy(*_KEY).agg(F.flatten(F.collect_list(moved)).alias("spans"))


def merged(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(starts, ends)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_CUT = f"doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, spans {_SPANS}, kept binary, kept_sha256 string"


def _cut(whole: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text, lists in zip(batch.column(2), batch.column(3)):
                data = memoryview(text.as_buffer())
                cuts = merged(lists.values.field("start").to_pylist(), lists.values.field("end").to_pylist()) if len(lists) else []
                edges = [0, *(x for s in cuts for x in s), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                found.append((sum(b - a for a, b in cuts), len(cuts), [{"start": a, "end": b} for a, b in cuts], kept if whole else None, sha256(kept).hexdigest()))
            types = [pa.int64(), pa.int64(), _SPAN_TYPE, pa.binary(), pa.string()]
            columns = [pa.array(c, t) for c, t in zip(zip(*found), types)] if found else [pa.array([], t) for t in types]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept", "kept_sha256"])

    return run


def find(docs: DataFrame, texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, spans, kept (the bytes that stay,
    with `texts`; else null), kept_sha256."""
    doc_id, text = F.col("doc_id").cast("bigint"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(doc_id.alias("doc_id"), text.alias("text"), F.coalesce(doc_id, F.lit(0)).alias("d"), F.xxhash64(doc_id.isNull(), doc_id, text).alias("h1"), F.xxhash64(text, doc_id, doc_id.isNull()).alias("h2"))
    lost = C.materialize(spans(rows), "spans")
    some, none = _only(rows, lost.select(*_KEY))
    data, size, zero = F.col("text").cast("binary"), F.octet_length("text").cast("bigint").alias("n_bytes"), F.lit(0).cast("bigint")
    empty = F.array().cast(_SPANS)
    whole = none.select("doc_id", size, zero.alias("n_removed"), zero.alias("n_spans"), empty.alias("spans"), (data if texts else F.lit(None).cast("binary")).alias("kept"), F.sha2(data, 256).alias("kept_sha256"))
    cut = some.join(lost, _KEY, "left").select("doc_id", size, data, F.coalesce("spans", empty).alias("spans")).mapInArrow(_cut(texts), _CUT)
    return whole.unionByName(cut)
