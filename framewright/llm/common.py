"""What the operators of this subpackage share: the shared folder, written tables that cut
lineage, and small helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines see: spark.checkpoint.dir; where it is unset and all runs
    on one machine (tests), a temporary folder that is then set for the session."""
    conf = spark.sparkContext.getConf()
    path = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines see")
        path = tempfile.mkdtemp(prefix="framewright-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back. This cuts the lineage
    and outlives any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/framewright/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


def text_bytes(df: DataFrame, text: str = "text") -> tuple[int, int]:
    """Rows of ``df`` and bytes of their texts, from one scan of that column."""
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("b")).first()
    return row["n"], row["b"] or 0


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: a bijection that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def doc_rows(batch, key: str, text: str) -> Iterator[tuple]:
    """(key, bytes of the text) of each row; a null text is empty."""
    for k, t in zip(batch.column(key).to_pylist(), batch.column(text).to_pylist()):
        yield k, b"" if t is None else t.encode("utf-8")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def crc_remainder(column: str, n: int):
    """crc32 of the id's decimal text, modulo n; null for a null id."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))

