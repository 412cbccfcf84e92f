"""Sinks. Rows are written by the executors; only small aggregates reach the driver."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reconcile import compact
from ..plans.shared import stored
from .readers import numbered_lines


def as_record(cleaned: DataFrame) -> DataFrame:
    """The JSON form: img_wh, and the grounding as a map in its order."""
    wh = F.array("img_w", "img_h")
    grounding = F.map_from_entries(F.transform("grounding", lambda g: F.struct(g["phrase"], g["boxes"])))
    rest = [c for c in cleaned.columns if c not in ("img_w", "img_h", "grounding")]
    return cleaned.select(*rest, wh.alias("img_wh"), grounding.alias("grounding"))


def append_json(df: DataFrame, path: str) -> None:
    """Add to a log; files of earlier runs stay."""
    df.write.mode("append").option("ignoreNullFields", "true").json(path)


def overwrite_json(df: DataFrame, path: str, by: str | None = None) -> None:
    """Replace the output, a folder for each value of ``by`` if given."""
    out = df.write.mode("overwrite").option("ignoreNullFields", "true")
    (out.partitionBy(by) if by else out).json(path)


def replace_json(df: DataFrame, path: str) -> bool:
    """Write beside ``path``, then swap, so that a failure leaves the old output; ``df`` may
    read ``path``. Returns False and touches nothing if the rows are the same as before."""
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    df.write.option("ignoreNullFields", "true").json(staging)
    hadoop = spark._jvm.org.apache.hadoop.fs
    old, new = hadoop.Path(path), hadoop.Path(staging)
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    digest = lambda p: spark.read.text(p).agg(F.count(F.lit(1)), F.sum(F.xxhash64("value").cast("decimal(38,0)"))).first()
    if fs.exists(old) and digest(path) == digest(staging):
        fs.delete(new, True)
        return False
    aside = hadoop.Path(f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    if fs.exists(old):
        fs.rename(old, aside)
    fs.rename(new, old)
    fs.delete(aside, True)
    return True


def save_json(spark: SparkSession, document: dict, path: str, count: int = 0, every: int = 20) -> None:
    """Save a small document so that a reader sees the old one or the new one, never half of it;
    when ``count`` has come to a multiple of ``every``, a copy stays beside it as ``path``.<count>."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    raw = json.dumps(document, ensure_ascii=False, indent=1).encode("utf-8")
    targets = [path] + ([f"{path}.{count:04d}"] if count and count % every == 0 else [])
    for target in targets:
        temporary, final = hadoop.Path(f"{target}.tmp-{uuid.uuid4().hex}"), hadoop.Path(target)
        fs = final.getFileSystem(spark._jsc.hadoopConfiguration())
        out = fs.create(temporary, True)
        try:
            out.write(raw)
        finally:
            out.close()
        context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration()) if final.toUri().getScheme() else spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(spark._jsc.hadoopConfiguration())
        options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
        context.rename(temporary, final, options)


def rewrite_shards(spark: SparkSession, path: str, schema: str, key: str = "path", dry: bool = False) -> DataFrame:
    """Compact an append log, a folder of JSON lines for each shard under ``path``, in place:
    the winning line of each key stays in its own shard, at its own place, as it was written.
    Only shards that lose lines are rewritten, each swapped in as a whole. Returns shard, lines,
    kept, changed; ``dry``: writes nothing."""
    lines = numbered_lines(spark, f"{path}/*").select("file", "line", "value", F.from_json("value", schema).alias("r"))
    lines = lines.select(F.regexp_extract("file", "([^/]+)/[^/]+$", 1).alias("shard"), F.struct("file", "line").alias("seq"), "value", F.col(f"r.{key}").alias("key"), F.col("r.error").isNull().alias("ok"))
    rows = lines.where("key is not null")
    won = compact(rows, "key")
    report = lines.groupBy("shard").agg(F.count(F.lit(1)).alias("lines")).join(won.groupBy("shard").agg(F.count(F.lit(1)).alias("kept")), "shard", "left")
    report = stored(report.select("shard", "lines", F.coalesce("kept", F.lit(0)).alias("kept")).withColumn("changed", F.col("lines") != F.col("kept")), "compaction")
    if dry:
        return report
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    changed = report.where("changed")
    left = won.join(changed.select("shard"), "shard", "left_semi").withColumn("part", F.md5("shard"))
    left.repartitionByRange("part", "seq").sortWithinPartitions("part", "seq").select("part", "value").write.partitionBy("part").text(staging)
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for r in changed.select("shard", "kept", F.md5("shard").alias("part")).toLocalIterator():  # a rename for each shard
        new, old, aside = hadoop.Path(f"{staging}/part={r['part']}"), hadoop.Path(f"{path}/{r['shard']}"), hadoop.Path(f"{staging}/old-{r['part']}")
        if r["kept"] and not fs.exists(new):
            raise FileNotFoundError(f"the compacted rows of {r['shard']} are missing; nothing of it is touched")
        if not fs.rename(old, aside) or not (fs.rename(new, old) if r["kept"] else fs.mkdirs(old)):
            raise OSError(f"{r['shard']} could not be swapped; its old rows are in {aside}")
    fs.delete(hadoop.Path(staging), True)
    return report
