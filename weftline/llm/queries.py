"""One query for each operator of this subpackage, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.llm import _common, conversation_repair, cotraining, exact_dedup, mixing, oracles, quality_rules, sentencepiece_codec, set_sketch, sharding, simhash, suffix_dedup, token_counts, vector_codes, zip_warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def model_path() -> str:
    """The tokenizer of the queries, from the installed package of public ones."""
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op1_cotraining_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _common.scratch_path(spark, "warc")
    zip_warc.write(_table(spark, sf_dir, "pages"), root)
    return zip_warc.read(spark, root, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.find(_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.find(_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(_table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepiece_codec.encode(_table(spark, sf_dir, "documents"), model_path())
    return coded.select("doc_id", "ids", F.size("ids").alias("n_tokens"), "agree", "round_trip", "decoded_sha256")


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op8_kd_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.assign(_table(spark, sf_dir, "documents"), shards=16)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.sums(token_counts.histogram(_table(spark, sf_dir, "documents"), model_path()))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find(_table(spark, sf_dir, "documents"))


def op11_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_sketch.find(_table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(_table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.report(_table(spark, sf_dir, "conversations"))


#: DuckDB's `\s` is [\t\n\f\r ]; the class is written out as it also holds \v.
ORACLES = {
    "op2_zip_warc": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        f AS (
            SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first
            FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to
        FROM f
    """,
    "op10_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)
    """,
    "op11_setsketch_near_dedup": oracles.NEAR_DEDUP,
    "op12_vector_codes": oracles.vector_codes_sql(),
    "op13_conversation_repair": oracles.REPAIR,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
