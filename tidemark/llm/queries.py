"""The queries of the numbered operators, and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fingerprint, html_text, infill, kneser_ney, merkle, minhash, mixing, oracles, packing, pitman_yor, quality_rules, rabit, secrets, warc
from .tables import table


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.judge(docs).select("doc_id", *quality_rules.MEASURES, "base_failed", "kept")


QUERIES = {"op2_quality_rules": op2_quality_rules}
ORACLES: dict[str, str] = {}


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("kept"))


QUERIES["op1_minhash_near_dedup"] = op1_minhash_near_dedup


def op4_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixing.in_order(mixed.select("doc_id", "size", "source_size", "target", "taken", "first_position", "second_position"))


def op10_length_bucket_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES["op4_curriculum_mix"] = op4_curriculum_mix
QUERIES["op10_length_bucket_packing"] = op10_length_bucket_packing


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("found")


QUERIES["op9_secret_scan"] = op9_secret_scan


def op7_site_template_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


QUERIES["op7_site_template_removal"] = op7_site_template_removal


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("url")


QUERIES["op5_warc"] = op5_warc
ORACLES["op5_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest AS d, max(page_id) AS first_id FROM p WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NOT NULL AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id IS NOT NULL AND page_id <> first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f ON payload_digest = d AND payload_bytes >= 1000
"""


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES["op3_fingerprints"] = op3_fingerprints


def op6_pitman_yor_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.scores(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES["op6_pitman_yor_scoring"] = op6_pitman_yor_scoring


def op8_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return kneser_ney.classify(docs, table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


QUERIES["op8_kneser_ney_quality"] = op8_kneser_ney_quality
ORACLES["op2_quality_rules"] = oracles.QUALITY
ORACLES["op4_curriculum_mix"] = oracles.MIX


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda c: F.sha2(c, 256)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(infill.restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


QUERIES["op12_fill_in_middle"] = op12_fill_in_middle
ORACLES["op12_fill_in_middle"] = oracles.INFILL


def op13_one_bit_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return rabit.nearest(vectors, F.col("vec_id") % 20 == 0)


QUERIES["op13_one_bit_neighbours"] = op13_one_bit_neighbours


def merkle_audit(docs: DataFrame) -> DataFrame:
    """Every row of docs against the manifest of all, with the text of every fifth, by a checksum of its id, in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.translate("text", upper, upper.lower())).otherwise(F.col("text"))
    leaf = lambda text: merkle.leaf([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text])
    found = merkle.manifest(docs, leaf(F.col("text")), claim=leaf(lowered))
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_audit(table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text"))


QUERIES["op11_merkle_manifest"] = op11_merkle_manifest
ORACLES["op11_merkle_manifest"] = oracles.MERKLE
