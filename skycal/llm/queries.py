"""Registered queries of this folder, one for each operator, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skycal.llm import decontamination, divergence, language, licenses, packing, piece_spans, prefix_trie, quality, simhash, substrings, toxicity, vectors, warc
from skycal.llm.shared import table


def op1_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_repeated: the bytes of 400-byte strings and of passages of 51 words that occur twice; the latter stay in the text."""
    return substrings.deduplicated(table(spark, sf_dir, "documents"), words=51)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "overlap", "cosine", "answer_found", "at")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumn("kept", F.col("score") >= 0.5)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP7_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest,
                  strlen(coalesce(html, '')) AS payload_bytes FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest HAVING count(*) > 1)
SELECT p.page_id, payload_bytes, p.payload_digest,
       CASE WHEN first IS NOT NULL AND p.page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), 0.98).withColumnRenamed("component", "component_id")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op12_piece_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_source_bytes: the bytes of the text that the pieces' spans cover together, which is all of them."""
    found = piece_spans.encode(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        (F.element_at("ends", -1) - F.element_at("starts", 1)).alias("n_source_bytes"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations")).drop("node")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substrings": op1_substrings,
    "op2_packing": op2_packing,
    "op3_licenses": op3_licenses,
    "op4_language": op4_language,
    "op5_decontamination": op5_decontamination,
    "op6_quality": op6_quality,
    "op7_warc": op7_warc,
    "op8_simhash": op8_simhash,
    "op9_toxicity": op9_toxicity,
    "op10_near_vectors": op10_near_vectors,
    "op11_divergence": op11_divergence,
    "op12_piece_spans": op12_piece_spans,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = {
    "op3_licenses": licenses.scan_sql(),
    "op7_warc": OP7_SQL,
    "op11_divergence": divergence.DIVERGENCE_SQL,
    "op13_prefix_trie": prefix_trie.PREFIX_TRIE_SQL,
}
