"""Cleans ``documents`` for training: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framewright.llm import decontaminate, packing, simhash, suffix, toxicity
from framewright.llm.common import load, written

#: Words of the shortest passage that goes where it repeats.
REPEATED_WORDS = 51

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; all columns stay."""
    model = toxicity.train(docs, toxicity.learnable(load(spark, sf_dir, "labels")))
    return toxicity.screen(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of SimHash near-duplicates the document with the smallest id stays."""
    return simhash.keep_one(docs)


def strip_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words that repeat go from the texts, wherever they stand; every
    document stays, with its new n_chars. (In words, as they differ in length: 400 bytes, as
    in the query of that operator, would leave half of such passages.)"""
    return suffix.stripped(docs, REPEATED_WORDS, "words").withColumn("n_chars", F.length("text").cast("long"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of any benchmark item go; all columns stay."""
    return decontaminate.screen(docs, load(spark, sf_dir, "benchmark"), min_items=1)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", strip_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]

#: SQL can't express the stages (a trained model, hashed fingerprints, a packing search).
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows are written and read again."""
    docs = load(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{name}")
    return docs
