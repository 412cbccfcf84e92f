"""Verdicts aligned with boxes: one slot for each box, null where nothing was audited.
Only first boxes are audited, so slot 0 has the verdict of (path, phrase)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .reconcile import index


def sidecar(cleaned: DataFrame, verified: DataFrame, seq: str | None = "seq") -> DataFrame:
    """path, n_pair, n_audited, verdict (phrase, slots) for each cleaned row, by one join on
    path. ``verified`` (path, phrase, verdict) may repeat keys: the last by ``seq`` counts."""
    # one shuffle, by path, serves the index by (path, phrase), the collection and the join
    dealt = verified.repartition("path")
    last = index(dealt, "path", "phrase", value="verdict", seq=seq) if seq else dealt.select("path", "phrase", "verdict")
    by_path = last.groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("phrase", "verdict"))).alias("said"))
    joined = cleaned.select("path", "kept").join(by_path, "path", "left")
    said = lambda c: F.try_element_at("said", c["phrase"])
    slots = F.transform("kept", lambda c: F.struct(c["phrase"], F.transform(c["boxes"], lambda b, j: F.when(j == 0, said(c))).alias("slots")))
    rows = joined.select("path", slots.alias("verdict"))
    count = lambda f: F.aggregate("verdict", F.lit(0), lambda n, c: n + f(c))
    return rows.select("path", count(lambda c: F.size(c["slots"])).alias("n_pair"), count(lambda c: F.size(F.filter(c["slots"], lambda s: s.isNotNull()))).alias("n_audited"), "verdict")


def flat_slots(side: DataFrame) -> DataFrame:
    """path, k, phrase, j, verdict: one row for each box."""
    return side.select("path", F.posexplode("verdict").alias("k", "c")).select("path", "k", F.col("c.phrase").alias("phrase"), F.posexplode("c.slots").alias("j", "verdict"))


def totals(side: DataFrame) -> DataFrame:
    """kind, value, n: images, box slots, audited and null slots; audited by verdict, k and box index."""
    entry = lambda kind, value, n: F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value"), n.cast("long").alias("n"))
    none, one = F.lit(""), F.lit(1)
    head = F.array(entry("img", none, one), entry("pair", none, F.col("n_pair")), entry("audited", none, F.col("n_audited")), entry("null", none, F.col("n_pair") - F.col("n_audited")))

    def of_phrase(c: Column, k: Column) -> Column:
        slots = F.filter(F.transform(c["slots"], lambda v, j: F.struct(v.alias("v"), j.alias("j"))), lambda s: s["v"].isNotNull())
        return F.flatten(F.transform(slots, lambda s: F.array(entry("verdict", s["v"], one), entry("k", k, one), entry("box", s["j"], one))))

    # one pass: each row gives its counts, which meet in each task before the shuffle
    entries = F.concat(head, F.flatten(F.transform("verdict", of_phrase)))
    rows = side.select(F.explode(entries).alias("e")).select("e.*")
    zero = side.sparkSession.createDataFrame([(kind, "", 0) for kind in ("img", "pair", "audited", "null")], "kind string, value string, n long")
    return rows.unionByName(zero).groupBy("kind", "value").agg(F.sum("n").alias("n"))


def unmatched(cleaned: DataFrame, verified: DataFrame) -> DataFrame:
    """n: audited (path, phrase) that the cleaned rows don't have."""
    have = cleaned.select("path", F.explode("kept.phrase").alias("phrase")).distinct()
    return verified.select("path", "phrase").distinct().join(have, ["path", "phrase"], "left_anti").agg(F.count(F.lit(1)).alias("n"))


def aligned(left: DataFrame, right: DataFrame, key: str = "path") -> DataFrame:
    """Two tables of the same rows side by side; they need no common order."""
    return left.join(right, key)
