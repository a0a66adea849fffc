"""Quality rules whose thresholds adapt to language and source.

Each document is reduced to counts. Five ratios per 1000 get a quantile sketch
per (language, source): a histogram over integer values kept to ten leading
bits, so a quantile is exact to 1/512 of itself, sketches merge by adding
counts, and reruns agree. A group's upper limit for a ratio is its third
quartile plus REACH times its upper half-spread. Where that spread is next to
nothing (most documents have no symbol and no repeat at all), a small guard
takes its place: about what one event makes in a short document. A group's limit
is drawn towards its language's, as if PRIOR more documents had that, and a
language's towards that of everything, so groups of any size are treated alike
and small ones borrow. The limits are then joined to the documents.

Defined cases: a null text has no words; a very long text is counted as a whole; documents without words fail the base
rules and enter no sketch, nor does any other that fails them; null language
or source are groups of their own; repeated rows count each; an empty table
gives an empty result; other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from weftline.llm import _common as C

#: Fixed limits of the base rules: least words, most repeated words per 100.
MIN_WORDS, MAX_REPEATED = 50, 50
#: Documents that the wider group counts for; half-spreads above the third quartile.
PRIOR, REACH = 20, 3
#: Leading bits that a sketch keeps of a value.
SKETCH_BITS = 10
#: Ratio -> (numerator, denominator, least half-spread per 1000).
RATIOS = {
    "symbols": ("n_symbols", "n_words", 20),
    "capitals": ("n_capitals", "word_chars", 2),
    "repeats": ("n_repeat_words", "n_words", 40),
    "word_length": ("word_chars", "n_words", 20),
    "dup_lines": ("n_dup_lines", "n_lines", 40),
}

_SPACE, _SYMBOLS, _CAPITALS = b" \t\n\x0b\x0c\r", b"#*$%&|<>", bytes(range(65, 91))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals", "n_lines")


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    seq = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=len(words))
    _, pairs = np.unique(seq[:-1] * len(ids) + seq[1:], return_inverse=True)
    _, place, count = np.unique(pairs[:-1] * len(ids) + seq[2:], return_inverse=True, return_counts=True)
    again = count[place] > 1
    covered = np.zeros(len(words), dtype=bool)
    for i in range(3):
        covered[i : i + len(again)] |= again
    return int(covered.sum())


def counts(text: str | None) -> tuple[int, ...]:
    """The COUNTS of one whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    without = lambda chars: len(raw) - len(raw.translate(None, chars))
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (len(words), len(text) - without(_SPACE), without(_SYMBOLS), len(lines) - len(set(lines)), repeat_words(words), without(_CAPITALS), len(lines))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([counts(t.as_py()) for t in batch.column(3)], dtype=np.int64).reshape(-1, len(COUNTS))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], *map(pa.array, found.T)], ["doc_id", "lang", "source", *COUNTS])


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, COUNTS, base_failed."""
    rows = docs.select(F.col("doc_id").cast("bigint"), *[F.col(c).cast("string") for c in ("lang", "source", "text")])
    out = rows.mapInArrow(_count, "doc_id bigint, lang string, source string, " + ", ".join(f"{c} bigint" for c in COUNTS))
    return out.withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words"))


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, ratio, value, n: the histogram sketch of every group."""
    passed = measured.filter(~F.col("base_failed"))
    values = F.array(*[F.struct(F.lit(k).alias("ratio"), F.expr(f"1000 * {a} div greatest({b}, 1)").alias("v")) for k, (a, b, _) in RATIOS.items()])
    rows = passed.select("lang", "source", F.inline(values))
    drop = F.greatest(F.length(F.bin("v")) - SKETCH_BITS, F.lit(0))
    return rows.groupBy("lang", "source", "ratio", F.expr("v").alias("v")).agg(F.count("*").alias("n")).select("lang", "source", "ratio", "n", drop.alias("drop"), "v").select("lang", "source", "ratio", F.expr("shiftleft(shiftright(v, drop), drop)").alias("value"), "n").groupBy("lang", "source", "ratio", "value").agg(F.sum("n").alias("n"))


def limits(sketch: DataFrame) -> DataFrame:
    """Merged sketches (any grouping columns, ratio, value, n) to one row a
    group: its documents `size` and a limit for each ratio."""
    by = [c for c in sketch.columns if c not in ("ratio", "value", "n")]
    merged = sketch.groupBy(*by, "ratio", "value").agg(F.sum("n").alias("n"))
    group = W.partitionBy(*by, "ratio")
    upto = F.sum("n").over(group.orderBy("value").rowsBetween(W.unboundedPreceding, 0))
    rows = merged.select(*by, "ratio", "value", upto.alias("upto"), F.sum("n").over(group).alias("size"))
    at = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("size") * q, F.col("value")))
    quartiles = rows.groupBy(*by, "ratio").agg(F.max("size").alias("size"), at(2).alias("mid"), at(3).alias("high"))
    floor = F.coalesce(*[F.when(F.col("ratio") == k, f) for k, (_, _, f) in RATIOS.items()])
    quartiles = quartiles.withColumn("limit", F.col("high") + REACH * F.greatest(F.col("high") - F.col("mid"), floor))
    return quartiles.groupBy(*by).agg(F.max("size").alias("size"), *[F.max(F.when(F.col("ratio") == k, F.col("limit"))).alias(f"max_{k}") for k in RATIOS])


def _key(*columns: str):
    return F.concat_ws("\x00", *[F.coalesce(F.concat(F.lit("="), c), F.lit("")) for c in columns])


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, COUNTS, base_failed, the limits that applied, kept."""
    measured = C.materialize(measure(docs), "counts")
    sketch = C.materialize(sketches(measured).withColumn("lang", _key("lang")).withColumn("source", _key("source")), "sketches")
    names = [f"max_{k}" for k in RATIOS]
    fine, by_lang = limits(sketch), limits(sketch.drop("source"))
    # One row: the limits of everything together.
    overall = limits(sketch.drop("source").withColumn("lang", F.lit(0))).first() or dict.fromkeys(names, 0)
    drawn = lambda own, wider: F.expr(f"(size * {own} + {PRIOR} * {wider}) div (size + {PRIOR})")
    coarse = by_lang.select("lang", *[drawn(c, overall[c]).alias(f"lang_{c}") for c in names])
    groups = fine.join(coarse, "lang").select("size", F.concat_ws("\x01", "lang", "source").alias("group"), *[drawn(c, f"lang_{c}").alias(c) for c in names])
    keyed = measured.withColumn("group", F.concat_ws("\x01", _key("lang"), _key("source")))
    passed = C.lookup(keyed.filter(~F.col("base_failed")), groups, "group", "size", measured.count())
    good = [F.expr(f"1000 * {a} div greatest({b}, 1)") <= F.col(f"max_{k}") for k, (a, b, _) in RATIOS.items()]
    verdict = good[0]
    for g in good[1:]:
        verdict = verdict & g
    failed = keyed.filter("base_failed").select("doc_id", *COUNTS, "base_failed", *[F.lit(None).cast("bigint").alias(c) for c in names], F.lit(False).alias("kept"))
    return passed.select("doc_id", *COUNTS, "base_failed", *[F.col(c).cast("bigint") for c in names], verdict.alias("kept")).unionByName(failed)
