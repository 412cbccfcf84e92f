"""The same operators on streams: cleaning is stateless, so it runs as it is; the latest
successful row of each key is merged by foreachBatch, so that a repeated batch does no harm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import clean
from ..operators.reconcile import compact
from ..plans.profiles import Profile


def clean_stream(ground: DataFrame, profile: Profile, out: str, checkpoint: str) -> StreamingQuery:
    """Clean a stream of groundings with captions and append the results as Parquet."""
    return clean(ground, profile).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def latest_stream(log: DataFrame, keys: list[str], out: str, checkpoint: str, seq: str = "seq", ok: str = "ok") -> StreamingQuery:
    """Keep at ``out``/v<batch> one row a key of all that has come: compaction of the last
    version and the new batch. Compaction is associative, so batches may be cut anyhow."""

    def merge(batch: DataFrame, number: int) -> None:
        rows = batch
        if number > 0:
            rows = batch.sparkSession.read.parquet(f"{out}/v{number - 1}").unionByName(batch)
        compact(rows, *keys, seq=seq, ok=ok).write.mode("overwrite").parquet(f"{out}/v{number}")

    return log.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest(spark: SparkSession, out: str) -> DataFrame:
    """The newest version."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(out)
    names = [s.getPath().getName() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)]
    return spark.read.parquet(f"{out}/v{max(int(n[1:]) for n in names if n[:1] == 'v' and n[1:].isdigit())}")


def first_seen(log: DataFrame, key: str, time: str, delay: str) -> DataFrame:
    """One row a key within the watermark; a TIMESTAMP_NTZ time becomes TIMESTAMP (session zone UTC)."""
    return log.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
