"""Human answers on a stratified sample restore the true precision of automatic verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo


def calibration(answers: DataFrame, n_yes, n_no, *by: str, strict: bool = True) -> DataFrame:
    """``answers`` (auto, human) and the population's numbers of both verdicts (numbers or
    columns) -> by, a and b with Wilson intervals, precision, low, high, accuracy, and text.
    UNSURE and missing answers don't count. A stratum without answers fails, as nothing can be
    restored from it; not ``strict``: gives null."""
    ok = answers.where("human in ('YES', 'NO')")
    yes, true = F.col("auto") == "YES", F.col("human") == "YES"
    sums = ok.groupBy(*by).agg(F.count_if(yes & true).alias("ay"), F.count_if(yes).alias("ny"), F.count_if(~yes & true).alias("an"), F.count_if(~yes).alias("nn"))
    if strict:
        empty = F.raise_error(F.lit("no answers to verdicts of one kind: nothing to restore the precision from")).cast("long")
        sums = sums.withColumn("ny", F.when((F.col("ny") == 0) | (F.col("nn") == 0), empty).otherwise(F.col("ny")))
    numbers = lambda n: n if not isinstance(n, (int, float)) else F.lit(float(n))
    py, pn = numbers(n_yes), numbers(n_no)
    a, b = F.try_divide(F.col("ay").cast("double"), F.col("ny")), F.try_divide(F.col("an").cast("double"), F.col("nn"))
    (la, ha), (lb, hb) = geo.wilson(F.col("ay"), F.col("ny")), geo.wilson(F.col("an"), F.col("nn"))
    mixed = lambda x, y: (py * x + pn * y) / (py + pn)
    rows = sums.select(*by, "ay", "ny", "an", "nn", a.alias("a"), la.alias("a_low"), ha.alias("a_high"), b.alias("b"), lb.alias("b_low"), hb.alias("b_high"), mixed(a, b).alias("precision"), mixed(la, lb).alias("low"), mixed(ha, hb).alias("high"), mixed(a, 1 - b).alias("accuracy"), (py / (py + pn)).alias("auto_precision"))
    delta = 100 * (F.col("precision") - F.col("auto_precision"))
    return rows.withColumn("reading", F.when(delta > 2, "conservative").when(delta < -2, "lenient").otherwise("usable"))
