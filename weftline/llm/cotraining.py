"""Quality classifier by co-training.

Two logistic classifiers see two views of a document: its text (hashed four-byte
grams of the whole text, and how its words and lines repeat) and its metadata
(language, source, length class). Both start from labelled documents. In each
round, each view scores all documents without a label, in a distributed pass,
and those that it is sure of, by calibrated probability, become training examples
of the other view. There is no cap on them: their gradients are summed up where
the documents are, so what the driver gets does not grow with the input; by class
they weigh as much as the labels do, at most. In the end a third logistic fit on
the calibrated log-odds combines the views; a view that tells nothing gets no
weight. All documents are scored by the combination.

Labelled documents are a bounded sample, at most MAX_LABELLED, those with the
smallest hash of doc_id. Three fifths of them train, one fifth calibrates, one
fifth fits the combination. Views are extracted once and written (about 0.5 KB a
document); rounds read those.

Defined cases: a null text is the empty text; a very long text is read in steps;
null metadata are values of their own; of labelled rows with equal doc_id one is
trained on, and each is scored; rows without doc_id are scored; without labels
of both classes all documents score 0.5 and are kept; an empty table gives an
empty result; other columns are ignored by `score` and carried along by `keep`,
whatever their names."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.llm import _common as C

MAX_LABELLED, SEED = 10_000, 11
#: Rounds of exchange, steps of the fit in each, least probability of a pseudo-label.
ROUNDS, STEPS, SURE = 4, 2, 0.97
#: Least combined score of a document that is kept.
THRESHOLD = 0.5
GRAMS, TEXT_WIDTH, META_WIDTH = 256, 256 + 8, 64 + 32 + 32
#: Bytes of a text that are hashed at a time; documents whose views are in memory
#: as matrices at a time.
STEP, ROWS = 1 << 20, 500


def text_view(raw: bytes) -> np.ndarray:
    """Shares (their roots) of hashed four-byte grams, and eight statistics of
    the words and lines of the whole text."""
    out = np.zeros(TEXT_WIDTH, dtype=np.float16)
    data, count = np.frombuffer(raw, dtype=np.uint8), np.zeros(GRAMS, dtype=np.int64)
    for at in range(0, max(0, len(data) - 3), STEP):
        part = data[at : at + STEP + 3].astype(np.uint32)
        grams = part[:-3] | part[1:-2] << np.uint32(8) | part[2:-1] << np.uint32(16) | part[3:] << np.uint32(24)
        count += np.bincount((grams * np.uint32(2654435761)) >> np.uint32(24), minlength=GRAMS)
    out[:GRAMS] = np.sqrt(count / max(1, len(raw) - 3))
    words = raw.split()
    n = len(words)
    if n:
        lines = raw.split(b"\n")
        twice = sum(map(bytes.__eq__, words, words[1:]))
        out[GRAMS:] = (np.log1p(n), np.log1p(len(raw)) - np.log1p(n), len(set(words)) / n, twice / n, len(set(lines)) / len(lines), min(600, n / len(lines) / 100), min(600, len(set(words)) / np.sqrt(n)), 1)
    return out


def meta_view(lang: str | None, source: str | None, n_chars: float | None) -> list[int]:
    """Columns that are one: source (hashed), language (hashed), length class."""
    known = n_chars is not None and n_chars == n_chars
    return [
        crc32(("s" + source).encode("utf-8", "surrogatepass")) % 64 if isinstance(source, str) else 0,
        64 + (crc32(("l" + lang).encode("utf-8", "surrogatepass")) % 32 if isinstance(lang, str) else 0),
        96 + (min(31, 1 + int(min(1e18, max(0, n_chars))).bit_length()) if known else 0),
    ]


def _matrices(texts: list[bytes], metas: list[bytes]) -> list[np.ndarray]:
    """The stored views of some documents as two matrices."""
    meta = np.zeros((len(metas), META_WIDTH), dtype=np.float32)
    np.put_along_axis(meta, np.frombuffer(b"".join(metas), dtype=np.int16).reshape(-1, 3).astype(np.int64), 1, axis=1)
    return [np.frombuffer(b"".join(texts), dtype=np.float16).reshape(-1, TEXT_WIDTH).astype(np.float32), meta]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _p(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


@dataclass
class Logistic:
    """Ridge logistic regression on standardised columns, fitted step by step."""

    ridge: float = 1.0
    mean: np.ndarray = field(default=None)
    scale: np.ndarray = field(default=None)
    weights: np.ndarray = field(default=None)

    def design(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x.astype(np.float64) - self.mean) / self.scale, -8, 8)
        return np.hstack([z, np.ones((len(z), 1))])

    def step(self, z: np.ndarray, y: np.ndarray, gradient: np.ndarray | None = None, gram: np.ndarray | None = None) -> float:
        """A Newton step on the rows z. With the `gradient` and the Gram matrix
        of further examples, a quarter of the Gram matrices takes the curvature's
        place: it is the most that it can be, so such steps don't overshoot."""
        penalty = np.append(np.full(z.shape[1] - 1, self.ridge), 1e-6)
        p = _p(z @ self.weights)
        if gradient is None:
            gradient, bend = 0, (z * (p * (1 - p) + 1e-6)[:, None]).T @ z
        else:
            bend = (z.T @ z + gram) / 4
        step = np.linalg.solve(bend + np.diag(penalty), z.T @ (p - y) + penalty * self.weights + gradient)
        self.weights = self.weights - step
        return np.abs(step).max()

    def fit(self, x: np.ndarray, y: np.ndarray) -> Logistic:
        self.mean, self.scale = x.mean(0, dtype=np.float64), np.maximum(x.std(0, dtype=np.float64), 1e-3)
        self.weights = np.zeros(x.shape[1] + 1)
        z = self.design(x)
        for _ in range(30):
            if self.step(z, y) < 1e-6:
                break
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.design(x) @ self.weights, -30, 30)


@dataclass
class Model:
    """Two views, their calibrations, the combination, and how many documents
    the text and the metadata view labelled in each round."""

    views: list[Logistic]
    calibrations: list[Logistic]
    combined: Logistic = None
    rounds: list[tuple[int, int]] = field(default_factory=list)

    def logits(self, xs: list[np.ndarray]) -> list[np.ndarray]:
        """Calibrated log-odds by text and by metadata."""
        return [c.logit(v.logit(x)[:, None]) for v, c, x in zip(self.views, self.calibrations, xs)]

    def scores(self, xs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probability of good quality by text, by metadata, by both."""
        logits = self.logits(xs)
        return _p(logits[0]), _p(logits[1]), _p(self.combined.logit(np.stack(logits, axis=1)))


def lessons(teacher: Model, students: list[Logistic], xs: list[np.ndarray], weights: list[list[float]], gram: bool) -> list[np.ndarray]:
    """For each view, over the documents that the other view is sure of: how many
    are bad and good, the gradient of the view's fit with `weights` by class,
    and, if asked for, the upper triangle of their Gram matrix."""
    out: list[np.ndarray] = [None, None]
    for me, logit in enumerate(teacher.logits(xs)):
        p, other = _p(logit), 1 - me
        sure = (p >= SURE) | (p <= 1 - SURE)
        label = (p[sure] >= 0.5).astype(np.float64)
        z = students[other].design(xs[other][sure])
        weight = np.where(label > 0, weights[other][1], weights[other][0])
        parts = [[len(label) - label.sum(), label.sum()], ((_p(z @ students[other].weights) - label) * weight) @ z]
        if gram:
            parts.append(((z * weight[:, None]).T @ z)[np.triu_indices(z.shape[1])])
        out[other] = np.concatenate(parts)
    return out


def _pass(teacher: Model, students: list[Logistic], weights: list[list[float]], gram: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[np.ndarray | float] = [0.0, 0.0]
        for batch in _slices(batches):
            for view, found in enumerate(lessons(teacher, students, _matrices(batch.column(0).to_pylist(), batch.column(1).to_pylist()), weights, gram)):
                total[view] = total[view] + found
        for view, found in enumerate(total):
            if np.ndim(found):
                columns = (np.full(len(found), view, np.int32), np.arange(len(found), dtype=np.int32), found)
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["view", "i", "value"])

    return run


def taught(pool: DataFrame, teacher: Model, students: list[Logistic], weights: list[list[float]], gram: bool) -> list[np.ndarray]:
    """`lessons` over all rows of `pool`, summed up in Spark. What is collected
    has as many rows as the views have columns, or pairs of them."""
    rows = pool.select("text_view", "meta_view").mapInArrow(C.lean(_pass(teacher, students, weights, gram)), "view int, i int, value double").groupBy("view", "i").agg(F.sum("value").alias("value")).toArrow()
    out = []
    for view, width in enumerate((TEXT_WIDTH + 1, META_WIDTH + 1)):
        sums = np.zeros(2 + width + gram * width * (width + 1) // 2)
        own = rows.column("view").to_numpy() == view
        sums[rows.column("i").to_numpy()[own]] = rows.column("value").to_numpy()[own]
        out.append(sums)
    return out


def _square(triangle: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((width, width))
    out[np.triu_indices(width)] = triangle
    return out + np.triu(out, 1).T


def train(xs: list[np.ndarray], y: np.ndarray, pool: DataFrame) -> Model | None:
    """xs: labelled documents' text and metadata views; y: labels; pool: views
    (text_view, meta_view) of all documents without a label. None without
    examples of both classes."""
    if len(set(y)) < 2:
        return None
    part = np.arange(len(y)) % 5
    parts = [part < 3, part == 3, part == 4]
    if any(len(set(y[p])) < 2 for p in parts):
        parts = [part >= 0] * 3  # too few labels to set any aside
    own, check, last = parts
    views = [Logistic().fit(x[own], y[own]) for x in xs]

    def calibrated() -> Model:
        return Model(views, [Logistic(0.01).fit(v.logit(x[check])[:, None], y[check]) for v, x in zip(views, xs)])

    model, history = calibrated(), []
    designs = [v.design(x[own]) for v, x in zip(views, xs)]
    labelled = [max(1, int((y[own] == c).sum())) for c in (0, 1)]
    widths = [z.shape[1] for z in designs]
    for _ in range(ROUNDS):
        counts = [found[:2] for found in taught(pool, model, views, [[0.0, 0.0]] * 2, False)]
        history.append((int(counts[1].sum()), int(counts[0].sum())))  # what one view labels is the other's
        if not sum(history[-1]):
            break
        weights, grams = [[min(1.0, labelled[c] / max(1.0, n[c])) for c in (0, 1)] for n in counts], None
        for step in range(STEPS):
            found = taught(pool, model, views, weights, not step)
            if not step:
                grams = [_square(f[2 + w :], w) for f, w in zip(found, widths)]
            views = [Logistic(v.ridge, v.mean, v.scale, v.weights) for v in views]
            for view, z, f, w, g in zip(views, designs, found, widths, grams):
                view.step(z, y[own], f[2 : 2 + w], g)
        model = calibrated()
    logits = np.stack(model.logits([x[last] for x in xs]), axis=1)
    return Model(model.views, model.calibrations, Logistic(0.01).fit(logits, y[last]), history)


def labelled(docs: DataFrame, labels: DataFrame, most: int | None = None) -> DataFrame:
    """doc_id, quality of the bounded sample of labelled documents."""
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.col("quality").cast("int")).alias("quality"))
    have = docs.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    return known.join(have, "doc_id", "left_semi").orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(MAX_LABELLED if most is None else most)


def _columns() -> list:
    return [F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), F.col("n_chars").cast("double").alias("n_chars")]


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        texts = [text_view(t.as_py()).tobytes() for t in batch.column(2)]
        metas = [np.array(meta_view(*r), dtype=np.int16).tobytes() for r in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(5).to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.binary()), pa.array(metas, pa.binary())], ["doc_id", "quality", "text_view", "meta_view"])


def views(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, quality (null: not in the sample), text_view, meta_view of every row."""
    sample = F.broadcast(C.materialize(labelled(docs, labels), "labelled"))  # MAX_LABELLED rows at most
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), *_columns()).join(sample, "doc_id", "left")
    return C.materialize(rows.select("doc_id", "quality", "text", "lang", "source", "n_chars").mapInArrow(C.lean(_extract), "doc_id bigint, quality int, text_view binary, meta_view binary"), "views")


def fit(seen: DataFrame) -> Model | None:
    """Trains on `views`. The driver gets one row for each labelled document."""
    both = F.struct("quality", "text_view", "meta_view")
    rows = seen.filter("quality IS NOT NULL").groupBy("doc_id").agg(F.min_by(both, F.xxhash64("text_view", "meta_view")).alias("v")).select("doc_id", "v.*").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: crc32(b"%d" % r["doc_id"]))
    y = np.array([r["quality"] > 0 for r in rows], dtype=np.float64)
    return train(_matrices([r["text_view"] for r in rows], [r["meta_view"] for r in rows]), y, seen.filter("quality IS NULL"))


def _scores(model: Model | None, xs: list[np.ndarray]) -> list[np.ndarray]:
    n = len(xs[0])
    return [np.round(p, 6) for p in model.scores(xs)] if model is not None and n else [np.full(n, 0.5)] * 3


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, p_text, p_meta, score, kept of every document."""
    seen = views(docs, labels)
    model = fit(seen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            found = _scores(model, _matrices(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found)], ["doc_id", "p_text", "p_meta", "score"])

    return seen.select("doc_id", "text_view", "meta_view").mapInArrow(run, "doc_id bigint, p_text double, p_meta double, score double").withColumn("kept", F.col("score") >= THRESHOLD)


def keep(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score at least THRESHOLD, with the columns they came
    with. Their views are computed once more, so that no text is shuffled."""
    model = fit(views(docs, labels))

    @F.arrow_udf("double")
    def own(parts: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in parts:
            found = []
            for text, *meta in (b.columns for b in _slices([pa.RecordBatch.from_arrays(list(columns), list("tlsn"))])):
                metas = [np.array(meta_view(*r), dtype=np.int16).tobytes() for r in zip(*(c.to_pylist() for c in meta))]
                found.append(_scores(model, _matrices([text_view(t.as_py()).tobytes() for t in text], metas))[2])
            yield pa.array(np.concatenate([*found, np.zeros(0)]), pa.float64())

    return docs.select(F.struct(*C.columns_of(docs)).alias("whole"), own(*_columns()).alias("score")).filter(F.col("score") >= THRESHOLD).select("whole.*")
