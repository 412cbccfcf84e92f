"""Append logs: compaction to one row a key, what is left to do, repeated keys.

A log row has a key, an order ``seq`` (file order, then line) and ``ok`` (no error). All
work is by hash aggregation on the key with partial results in each task, so a key with
many retries is no hot spot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def compact(log: DataFrame, *keys: str, seq: str = "seq", ok: str = "ok") -> DataFrame:
    """One row a key: the last that succeeded, else the last error. It stays what it was,
    its shard and place included; order by ``seq`` within a shard to write it back."""
    rest = [c for c in log.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(F.col(ok), F.col(seq))).alias("r")
    return log.groupBy(*keys).agg(best).select(*keys, "r.*").select(*log.columns)


def compact_report(log: DataFrame, *keys: str, by: str | None = None, seq: str = "seq", ok: str = "ok") -> DataFrame:
    """part, lines, kept, ok_rows, missing, missing_pct: for each ``by`` (the shard of a key's
    winner; lines count where they are) and in total."""
    part = F.col(by).cast("string") if by else F.lit("all")
    lines = log.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("lines"))
    won = compact(log, *keys, seq=seq, ok=ok).groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("kept"), F.sum(F.col(ok).cast("long")).alias("ok_rows"))
    rows = lines.join(won, "part", "left").select("part", "lines", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("kept", "ok_rows")))
    if by:
        rows = rows.unionByName(rows.agg(F.lit("total").alias("part"), *(F.sum(c).alias(c) for c in ("lines", "kept", "ok_rows"))))
    missing = F.col("kept") - F.col("ok_rows")
    return rows.withColumn("missing", missing).withColumn("missing_pct", F.round(100 * missing / F.greatest(F.lit(1), F.col("kept")), 2))


def pending(work: DataFrame, done: DataFrame, *keys: str, ok: str | None = "ok") -> DataFrame:
    """Rows of ``work`` whose key has no successful row in ``done``; ``ok=None``: no row at all."""
    finished = done.where(F.col(ok)) if ok else done
    return work.join(finished.select(*keys).distinct(), list(keys), "left_anti")


def repeated_keys(log: DataFrame, *keys: str) -> DataFrame:
    """n_rows, n_keys, n_repeats."""
    each = log.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return each.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"), F.count(F.lit(1)).alias("n_keys")).withColumn("n_repeats", F.col("n_rows") - F.col("n_keys"))


def index(log: DataFrame, *keys: str, value: str, seq: str = "seq") -> DataFrame:
    """keys, value: the last written of each key."""
    return log.groupBy(*keys).agg(F.max_by(value, seq).alias(value))
