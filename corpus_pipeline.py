"""From raw documents to token ids in five stages, each an operator of
weftline.llm. `run` applies them one after the other; each stage's result is
written as Parquet to the shared folder and read again by the next.

The pipeline is an application: it sets the session's Arrow batches to 500 rows,
as whole texts go through Python in its first and last stage, and Spark's 10,000
do not fit executors of 3 GB. The operators change no setting that outlasts them.

Defined cases hold for every stage: an empty table gives an empty result; extra
columns are carried along, whatever their names, up to the last stage, which
returns ids; a very long text is one row like others."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weftline.llm import _common, cotraining, exact_dedup, mixing, queries, sentencepiece_codec, shingle_dedup


def _settled(spark: SparkSession) -> None:
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= _common.BATCH_ROWS:
        spark.conf.set(name, str(_common.BATCH_ROWS))


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts. A null text is scored as
    an empty one; without labels of both classes all are kept."""
    _settled(spark)
    return cotraining.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the smallest
    doc_id, null last; of equal rows one. Null texts equal empty ones."""
    _settled(spark)
    return exact_dedup.drop(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts whose five-word shingles have
    Jaccard similarity 0.8 or more, found by SimHash fingerprints and, for pairs too
    far apart for their blocks, min-hash bands; texts without words are copies of
    each other."""
    _settled(spark)
    return shingle_dedup.drop(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: a document taken twice is two rows;
    one without words is never taken. A null source is one of its own."""
    _settled(spark)
    return mixing.select(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, checked against the reference library and by
    decoding. A null text has none."""
    _settled(spark)
    return sentencepiece_codec.encode(docs, queries.model_path())


STAGES = [("quality classifier", classify), ("exact dedup", dedup), ("SimHash near-dedup", near_dedup), ("source mixing", mix), ("SentencePiece encoding", encode)]

#: Training and tokenizing are not SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = _common.materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
