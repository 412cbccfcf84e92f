"""Older analyses that compare annotation chains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as txt


def merge_chains(worklist: DataFrame, chains: dict[str, DataFrame], key: str = "id") -> DataFrame:
    """``worklist`` with one optional struct for each chain: null if missing or failed. Each
    chain has one row a key: compact it first."""
    out = worklist
    for name, chain in chains.items():
        own = [c for c in chain.columns if c not in (key, "error")]
        ok = chain.where("error is null") if "error" in chain.columns else chain
        out = out.join(ok.select(key, F.struct(*own).alias(name)), key, "left")
    return out


def lexical_recall(rows: DataFrame, gold: str, predicted: str) -> DataFrame:
    """n, recall (mean share of the gold text's nouns found), extra (mean number of others)."""
    pairs = rows.select(txt.nouns(F.col(gold)).alias("g"), F.when(F.col(predicted).isNotNull(), txt.nouns(F.col(predicted))).alias("p")).where("size(g) > 0 and p is not null")
    return pairs.agg(F.count(F.lit(1)).alias("n"), F.avg(F.size(F.array_intersect("g", "p")) / F.size("g")).alias("recall"), F.avg(F.size(F.array_except("p", "g"))).alias("extra"))


def vocabulary(rows: DataFrame, labels: Column) -> DataFrame:
    """label, n for the labels (an array) of all rows."""
    return rows.select(F.explode(labels).alias("label")).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def top(vocab: DataFrame, n: int) -> DataFrame:
    return vocab.orderBy(F.desc("n"), "label").limit(n)


def coverage(worklist: DataFrame, chain: DataFrame, key: str = "id", seconds: str = "dt_s") -> DataFrame:
    """n_work, n_ok, median_s."""
    ok = chain.where("error is null").select(key, F.col(seconds).alias("s"))
    return worklist.select(key).join(ok.withColumn("ok", F.lit(1)), key, "left").agg(F.count(F.lit(1)).alias("n_work"), F.count("ok").alias("n_ok"), F.median("s").alias("median_s"))


def crossfeed(rows: DataFrame) -> DataFrame:
    """Of two ways to get phrases (words_a, phrases_a, boxes_a; _b; truncated): means, how
    often a wins, median gain, share truncated."""
    means = [F.avg(f"{what}_{way}").alias(f"{what}_{way}") for what in ("words", "phrases", "boxes") for way in ("a", "b")]
    gain = F.col("phrases_a") - F.col("phrases_b")
    return rows.agg(F.count(F.lit(1)).alias("n"), *means, F.count_if(gain > 0).alias("wins"), F.median(gain).alias("median_gain"), F.count_if("truncated").alias("n_truncated"))


def jaccard(rows: DataFrame, a: str, b: str) -> DataFrame:
    """mean Jaccard of two phrase lists; two empty lists agree."""
    union = F.size(F.array_union(a, b))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.avg(F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)).alias("jaccard"))


def review_rows(merged: DataFrame, crossfed: DataFrame, verified: DataFrame, key: str = "id") -> DataFrame:
    """``merged`` with the crossfed row and the verdicts by phrase, if any."""
    said = verified.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("phrase", "verdict"))).alias("verdicts"))
    cross = crossfed.select(key, F.struct(*(c for c in crossfed.columns if c != key)).alias("crossfeed"))
    return merged.join(cross, key, "left").join(said, key, "left")


def variants_side_by_side(tables: dict[str, DataFrame], key: str = "path") -> DataFrame:
    """Rows that all variants have, with each one's phrases."""
    out = None
    for name, t in tables.items():
        own = t.select(key, F.transform("kept", lambda c: c["phrase"]).alias(name))
        out = own if out is None else out.join(own, key)
    return out
