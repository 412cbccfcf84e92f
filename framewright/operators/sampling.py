"""Samples that do not depend on the order of rows: rows are ranked by a hash of their
key and a seed, so that any engine and any partitioning choose the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geometry as geo
from ..functions import text as txt
from ..plans.shared import stored


def rank(seed: int, *keys: str) -> Column:
    return F.md5(F.concat_ws("|", *(F.col(k).cast("string") for k in keys), F.lit(str(seed))))


def sample(df: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """n rows; each task keeps its n best before they meet."""
    return df.orderBy(rank(seed, *keys), *keys).limit(n)


def stratified(df: DataFrame, stratum: str, n: int, seed: int, *keys: str) -> DataFrame:
    """n rows of each stratum; tasks keep their n best of each before the shuffle."""
    place = F.row_number().over(Window.partitionBy(stratum).orderBy(rank(seed, *keys), *keys))
    return df.withColumn("_place", place).where(F.col("_place") <= n).drop("_place")


def extremes_and_random(df: DataFrame, score: str, n: int, seed: int, pool: int, *keys: str) -> DataFrame:
    """Half of n by the largest ``score``, the rest at random from the next ``pool - n // 2`` rows."""
    top = df.orderBy(F.desc(score), *keys).limit(max(pool, n // 2 + 1))
    place = F.row_number().over(Window.orderBy(F.desc(score), *keys))  # of at most ``pool`` rows
    top = top.withColumn("_place", place)
    half = top.where(F.col("_place") <= n // 2)
    rest = top.where(F.col("_place") > n // 2)
    return half.unionByName(sample(rest, n - n // 2, seed, *keys)).drop("_place")


def verify_tasks(cleaned: DataFrame, *ids: str, max_phrases: int = 12, vague_takes_place: bool = True) -> DataFrame:
    """ids, k, phrase, box, n_box: the first box of each of the first phrases that are not
    vague. A vague phrase takes a place among the first, or (the older way) does not."""
    entries = F.filter(F.transform("kept", lambda c, k: F.struct(k.alias("k"), c["phrase"], c["boxes"])), lambda c: F.size(c["boxes"]) > 0)
    fits = (lambda xs: F.slice(xs, 1, max_phrases)) if max_phrases else (lambda xs: xs)
    clear = lambda xs: F.filter(xs, lambda c: ~txt.is_vague(txt.strip(c["phrase"])))
    chosen = clear(fits(entries)) if vague_takes_place else fits(clear(entries))
    c = F.col("c")
    return cleaned.select(*ids, F.explode(chosen).alias("c")).select(*ids, c["k"].alias("k"), c["phrase"].alias("phrase"), c["boxes"][0].alias("box"), F.size(c["boxes"]).alias("n_box"))


def crops(tasks: DataFrame, pad: float = 0.1) -> DataFrame:
    """``tasks`` (box, img_w, img_h) with crop_frac, the padded crop, and TOO_SMALL where it is too small to judge."""
    rows = tasks.withColumn("crop_frac", geo.area_fraction(F.col("box"), F.col("img_w"), F.col("img_h")))
    rows = rows.withColumn("crop", geo.crop(F.col("box"), F.col("img_w"), F.col("img_h"), pad))
    return rows.withColumn("verdict", F.when(geo.too_small(F.col("crop")), "TOO_SMALL"))


def waterfall(raw: DataFrame, max_phrases: int = 12, phrases: str = "grounding") -> DataFrame:
    """n_img, n_phrase, n_capped_img, n_cut, n_vague, n_task: what sampling takes away at each step."""
    head = F.slice(phrases, 1, max_phrases)
    n = F.size(phrases)
    vague = F.size(F.filter(head, lambda c: txt.is_vague(txt.strip(c["phrase"]))))
    each = raw.select(n.alias("n"), F.greatest(n - max_phrases, F.lit(0)).alias("cut"), vague.alias("vague"), F.size(head).alias("head"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return each.agg(F.count(F.lit(1)).alias("n_img"), total("n").alias("n_phrase"), total(F.when(F.col("cut") > 0, 1).otherwise(0)).alias("n_capped_img"), total("cut").alias("n_cut"), total("vague").alias("n_vague"), total(F.col("head") - F.col("vague")).alias("n_task"))


def nearest_ranks(df: DataFrame, value: str, ps: list[float]) -> DataFrame:
    """p, value at index floor(n p) of the sorted values. Values are counted first, so what
    is ranked is the distinct values, not the rows; they are dealt to ranges, each summed up in
    its task, after the sums of the ranges before it."""
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written, as ranges are drawn from a sample and might differ if they were worked out twice
    dealt = stored(counts.repartitionByRange(ranges, "v").withColumn("part", F.spark_partition_id()), "ranges")
    sums = dealt.groupBy("part").agg(F.sum("n").alias("own"))  # a row for each range
    of_all = Window.partitionBy(F.lit(0))
    sums = sums.select("part", (F.sum("own").over(of_all.orderBy("part")) - F.col("own")).alias("before"), F.sum("own").over(of_all).alias("total"))
    upto = F.sum("n").over(Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = dealt.withColumn("own", upto).join(F.broadcast(sums), "part").select("v", (F.col("own") + F.col("before")).alias("upto"), "total")
    at = lambda p: F.least(F.floor(F.col("total") * p), F.col("total") - 1)
    row = ranked.agg(*(F.min(F.when(F.col("upto") > at(p), F.col("v"))).alias(f"v{i}") for i, p in enumerate(ps)))
    return row.selectExpr(f"stack({len(ps)}, " + ", ".join(f"{float(p)}D, v{i}" for i, p in enumerate(ps)) + ") as (p, value)").where("value is not null")


def truncation_bias(raw: DataFrame, max_phrases: int = 12, phrases: str = "grounding") -> DataFrame:
    """kept_words, cut_words: mean content words of the phrases in and beyond the first ones."""
    rows = raw.select(F.posexplode(phrases).alias("k", "c"))
    words = F.size(txt.content_words(txt.norm_phrase(F.col("c.phrase"))))
    return rows.agg(F.avg(F.when(F.col("k") < max_phrases, words)).alias("kept_words"), F.avg(F.when(F.col("k") >= max_phrases, words)).alias("cut_words"))
