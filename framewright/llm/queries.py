"""The thin queries of the operators of this subpackage and what SQL can say of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, html, lm, neighbours, packing, quality, simhash, suffix, toxicity, warc
from .common import crc_remainder, load


def held_out(column: str, n: int, remainder: int) -> Column:
    """Nothing is learned from rows without an id, so they are held out too."""
    return F.coalesce(crc_remainder(column, n) == remainder, F.lit(True)).alias("held_out")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    model = toxicity.train(docs, toxicity.learnable(labels))
    return toxicity.score(docs, model).select("doc_id", held_out("doc_id", 4, 2), "score", "predicted", "n_located", "worst")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels")
    model = quality.train(docs, quality.learnable(labels))
    return quality.score(docs, model).select("doc_id", held_out("doc_id", 3, 1), "score", "predicted")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op1_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(load(spark, sf_dir, "documents"))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(load(spark, sf_dir, "pages"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(load(spark, sf_dir, "embeddings"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.write_archive(load(spark, sf_dir, "pages"), warc.archive_path(spark))
    found = warc.read_archive(spark, path)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long").alias("refers_to"))


def op9_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeats(load(spark, sf_dir, "documents"))


OP8_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS payload_digest, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS response FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN response END AS refers_to
FROM m
"""


QUERIES = {
    "op1_lm": op1_lm,
    "op2_html": op2_html,
    "op3_neighbours": op3_neighbours,
    "op4_packing": op4_packing,
    "op5_decontaminate": op5_decontaminate,
    "op6_simhash": op6_simhash,
    "op7_toxicity": op7_toxicity,
    "op8_warc": op8_warc,
    "op9_suffix": op9_suffix,
    "op10_quality": op10_quality,
}

ORACLE_SQL: dict[str, str] = {
    "op8_warc": OP8_SQL,
}
