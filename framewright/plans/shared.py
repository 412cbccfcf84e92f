"""Folders that all machines see, and tables in them."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir; where that is unset and all runs on one machine,
    under a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines see")
        base = tempfile.mkdtemp(prefix="framewright-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/framewright/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a new folder and read back."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
