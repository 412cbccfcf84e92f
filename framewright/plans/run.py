"""All stages one after another: caption, compact, once more what failed, ground, clean,
verify, report. Each stage's output is a table that the next one reads, and each skips what
an earlier run has done, so that a run that was stopped goes on where it was."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clean, infer, reconcile, report, sampling
from .profiles import PROFILES, Profile
from .shared import exists


def ready(test: Callable[[], bool], tries: int = 60, every: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> bool:
    """Whether ``test`` holds within ``tries`` attempts, ``every`` seconds apart."""
    for k in range(tries):
        if test():
            return True
        if k + 1 < tries:
            sleep(every)
    return False


def has_rows(spark: SparkSession, *paths: str) -> bool:
    """Whether all these tables are there and none is empty: what a stage waits for."""
    return all(exists(spark, p) and not spark.read.parquet(p).isEmpty() for p in paths)


def _append(rows: DataFrame, path: str, run: int) -> None:
    """Add to a log with the number of the run as order; later runs win."""
    rows.withColumn("seq", F.lit(run)).withColumn("ok", F.col("error").isNull()).write.mode("append").parquet(path)


def _left(spark: SparkSession, work: DataFrame, log: str, *keys: str) -> tuple[DataFrame, int]:
    """What has no successful row in the log yet, and the number of this run."""
    if not exists(spark, log):
        return work, 0
    done = spark.read.parquet(log)
    return reconcile.pending(work, done, *keys), done.agg(F.max("seq")).first()[0] + 1


def run_all(spark: SparkSession, worklist: DataFrame, sizes: DataFrame, out: str, backend: Callable = infer.StubBackend, detect: Callable = infer.grounding_stub, profile: Profile | str = "rec", sample: int = 0, retries: int = 1, workers: int = 16, free: Callable[[], bool] = lambda: True, tries: int = 60, every: float = 60.0) -> dict[str, DataFrame]:
    """``worklist`` (id, shard, path, gt_caption) and ``sizes`` (path, img_w, img_h) -> the
    sections of the report; all tables lie under ``out``. ``sample``: images to verify, 0 for all.
    Verification waits until there are cleaned rows and ``free`` says that its devices are, for
    ``tries`` times ``every`` seconds at most."""
    captions, grounds, checks = f"{out}/caption", f"{out}/ground", f"{out}/verify"
    for _ in range(1 + retries):
        work, run = _left(spark, worklist, captions, "path")
        _append(infer.caption(work, backend, workers), captions, run)
    caps = reconcile.compact(spark.read.parquet(captions), "path")
    work, run = _left(spark, caps.where("ok").select("path", "gemma_dense"), grounds, "path")
    _append(infer.ground(work, detect), grounds, run)
    ground = reconcile.compact(spark.read.parquet(grounds), "path").drop("seq", "ok").join(sizes, "path", "left")
    rule = PROFILES[profile] if isinstance(profile, str) else profile
    clean.clean(clean.with_captions(ground, caps), rule).write.mode("overwrite").parquet(f"{out}/clean")
    cleaned = spark.read.parquet(f"{out}/clean")
    if not ready(lambda: has_rows(spark, f"{out}/clean") and free(), tries, every):
        raise TimeoutError("nothing to verify, or nothing free to verify it with")
    chosen = sampling.sample(cleaned, sample, 0, "path") if sample else cleaned
    work, run = _left(spark, sampling.verify_tasks(chosen, "path", "img_w", "img_h"), checks, "path", "phrase")
    _append(infer.verify(work, backend, workers), checks, run)
    verified = reconcile.compact(spark.read.parquet(checks), "path", "phrase")
    return {
        "captions": report.caption_stats(caps),
        "grounds": report.density(ground.select(F.size("grounding").alias("n_phrase"), F.aggregate("grounding", F.lit(0), lambda n, g: n + F.size(g["boxes"])).alias("n_box"), "error")),
        "cleaned": report.density(clean.output(cleaned)),
        "counters": clean.counters(cleaned),
        "verdicts": report.verdict_distribution(verified),
        "by_area": report.precision_by_area(verified),
        "by_words": report.precision_by_words(verified),
        "tradeoff": report.tradeoff(verified),
        "rejected": report.top_rejected(verified),
    }
