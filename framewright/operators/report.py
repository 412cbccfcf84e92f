"""Statistics of each stage. Every section is one aggregation over its input; only its few
rows reach the driver, where ``markdown`` formats them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as txt

# fixed values: the buckets of the report
AREA = [("<0.5%", 0.0, 0.005), ("0.5-2%", 0.005, 0.02), ("2-10%", 0.02, 0.1), ("10-40%", 0.1, 0.4), (">=40%", 0.4, 1.01)]
WORDS = [("1", 1, 2), ("2-3", 2, 4), ("4-6", 4, 7), ("7+", 7, 99)]
RULES = [("none", 0.0, 1), ("area>=0.5%", 0.005, 1), ("area>=2%", 0.02, 1), ("words>=2", 0.0, 2), ("area>=0.5%,words>=2", 0.005, 2), ("area>=2%,words>=2", 0.02, 2), ("area>=2%,words>=4", 0.02, 4)]


def _yes() -> Column:
    return F.sum(F.when(F.col("verdict") == "YES", 1).otherwise(0)).cast("long")


def _judged() -> Column:
    return F.col("verdict").isin("YES", "NO")


def caption_stats(captions: DataFrame) -> DataFrame:
    """n, missing, and median and mean words of short and dense captions; null if all failed."""
    missing = F.col("error").isNotNull() | (F.coalesce("gemma_dense", F.lit("")) == "")
    count = lambda c: F.when(~missing, txt.word_count(F.col(c)))
    rows = captions.select(missing.alias("missing"), count("gemma_short").alias("s"), count("gemma_dense").alias("d"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("missing").alias("missing"), F.median("s").alias("short_median"), F.avg("s").alias("short_mean"), F.median("d").alias("dense_median"), F.avg("d").alias("dense_mean"))


def density(records: DataFrame) -> DataFrame:
    """n, errors, median and mean of phrases and boxes, share of rows without phrases."""
    good = F.col("error").isNull() if "error" in records.columns else F.lit(True)
    only = lambda c: F.when(good, F.coalesce(c, F.lit(0)))
    rows = records.select(good.alias("good"), only("n_phrase").alias("p"), only("n_box").alias("b"))
    zero = F.try_divide(F.count_if(F.col("p") == 0), F.count("p"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("good")).alias("errors"), F.median("p").alias("phrase_median"), F.avg("p").alias("phrase_mean"), F.median("b").alias("box_median"), F.avg("b").alias("box_mean"), zero.alias("zero_share"))


def verdict_distribution(verified: DataFrame) -> DataFrame:
    return verified.groupBy("verdict").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "verdict")


def precision(verified: DataFrame, *by: str | Column) -> DataFrame:
    """by, yes, n, precision = YES / (YES + NO)."""
    return verified.where(_judged()).groupBy(*by).agg(_yes().alias("yes"), F.count(F.lit(1)).alias("n")).withColumn("precision", F.try_divide(F.col("yes").cast("double"), F.col("n")))


def _bucket(value: Column, buckets: list[tuple]) -> Column:
    out = F.lit(None).cast("string")
    for name, low, high in reversed(buckets):
        out = F.when((value >= low) & (value < high), name).otherwise(out)
    return out


def precision_by_area(verified: DataFrame) -> DataFrame:
    return precision(verified.where("crop_frac is not null"), _bucket(F.col("crop_frac"), AREA).alias("bucket")).where("bucket is not null")


def precision_by_words(verified: DataFrame) -> DataFrame:
    return precision(verified.where("crop_frac is not null"), _bucket(txt.word_count(F.col("phrase")), WORDS).alias("bucket")).where("bucket is not null")


def tradeoff(verified: DataFrame) -> DataFrame:
    """rule, yes, n, total: what each pair of thresholds keeps; one pass, two sums a rule."""
    ok = verified.where(_judged() & F.col("crop_frac").isNotNull()).select("verdict", "crop_frac", txt.word_count(F.col("phrase")).alias("words"))
    fits = [(F.col("crop_frac") >= area) & (F.col("words") >= words) for _, area, words in RULES]
    row = ok.agg(F.count(F.lit(1)).alias("total"), *(F.count_if(t).alias(f"n{i}") for i, t in enumerate(fits)), *(F.count_if(t & (F.col("verdict") == "YES")).alias(f"y{i}") for i, t in enumerate(fits)))
    names = ", ".join(f"'{name}', y{i}, n{i}, total" for i, (name, _, _) in enumerate(RULES))
    return row.selectExpr(f"stack({len(RULES)}, {names}) as (rule, yes, n, total)").where("n > 0")


def top_rejected(verified: DataFrame, n: int = 10) -> DataFrame:
    return verified.where("verdict = 'NO'").groupBy("phrase").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "phrase").limit(n)


def yes_per_image(verified: DataFrame) -> DataFrame:
    """n_img, mean_yes, share_with_yes."""
    each = verified.groupBy("path").agg(_yes().alias("yes"))
    return each.agg(F.count(F.lit(1)).alias("n_img"), F.avg("yes").alias("mean_yes"), F.avg((F.col("yes") > 0).cast("double")).alias("share_with_yes"))


def box_counts(cleaned: DataFrame) -> DataFrame:
    """n_box, n: how many phrases have how many boxes."""
    return cleaned.select(F.explode("kept").alias("c")).groupBy(F.size("c.boxes").alias("n_box")).agg(F.count(F.lit(1)).alias("n"))


def ablation(summaries: dict[str, DataFrame]) -> DataFrame:
    """variant, n_img, n_in, n_out, and the counters, for cleaned tables by profile."""
    from .clean import BOX_RULES, PHRASE_RULES

    out = None
    for name, cleaned in summaries.items():
        count = lambda f: F.sum(F.aggregate("cells", F.lit(0).cast("long"), lambda n, c: n + f(c)))
        sums = [count(lambda c, r=r: F.coalesce(c[f"n_{r}"], F.lit(0)).cast("long")).alias(r) for r in BOX_RULES] + [count(lambda c, r=r: F.when(c["rule"] == r, 1).otherwise(0).cast("long")).alias(r) for r in PHRASE_RULES]
        row = cleaned.agg(F.lit(name).alias("variant"), F.count(F.lit(1)).alias("n_img"), F.sum(F.size("cells")).cast("long").alias("n_in"), F.sum(F.size("kept")).cast("long").alias("n_out"), *sums)
        out = row if out is None else out.unionByName(row)
    return out


def effective(densities: DataFrame, precisions: DataFrame, first: str) -> DataFrame:
    """variant, density, precision, effective = density x precision, and the change of both
    against variant ``first``: points, absolute and percent."""
    rows = densities.join(precisions, "variant").withColumn("effective", F.col("density") * F.col("precision"))
    of_first = lambda c: F.max(F.when(F.col("variant") == first, F.col(c))).over(Window.partitionBy(F.lit(0)))  # noqa: E731  a few rows
    both = rows.withColumns({"p0": of_first("precision"), "e0": of_first("effective")})
    return both.select("variant", "density", "precision", "effective", (100 * (F.col("precision") - F.col("p0"))).alias("points"), (F.col("effective") - F.col("e0")).alias("gain"), (100 * (F.try_divide("effective", "e0") - 1)).alias("gain_pct"))


def markdown(rows: DataFrame, head: list[str] | None = None) -> str:
    """A small aggregate as a Markdown table."""
    columns = head or rows.columns
    lines = ["| " + " | ".join(columns) + " |", "|" + "---|" * len(columns)]
    lines += ["| " + " | ".join("" if v is None else f"{v:.4g}" if isinstance(v, float) else str(v) for v in r) + " |" for r in rows.collect()]
    return "\n".join(lines)


def rule_hits(attributed: DataFrame, *ids: str) -> DataFrame:
    """ids, rule, n: how often each rule was to blame; phrases that stay don't count."""
    return attributed.where("rule <> 'kept'").groupBy(*ids, "rule").agg(F.count(F.lit(1)).alias("n"))


def review_order(attributed: DataFrame) -> DataFrame:
    """``attributed`` with ``place``: 1 for the rule that took most in all, and so on; phrases
    that stay come last. The rules are few, so their ranks are sent to the rows."""
    total = rule_hits(attributed)  # a dozen rows
    place = total.select("rule", F.row_number().over(Window.orderBy(F.desc("n"), "rule")).alias("place"))
    return attributed.join(F.broadcast(place), "rule", "left").withColumn("place", F.coalesce("place", F.lit(99)))
