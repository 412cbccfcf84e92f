"""A content-addressed archive of WARC records.

An archive is two tables in one folder. ``payloads`` holds each distinct payload once
under its address, the SHA-256 of its bytes. ``records`` holds the exact header bytes of
each record, with the address of its payload and nothing else of it. ``records_of`` joins
the two by address and returns the original records; it fails if a payload's bytes don't
hash to its address or to the SHA-1 that the header names.

Of records with equal payloads of at least ``MIN_BYTES`` bytes, that with the largest id
is a response; the others are revisits that refer to it. Smaller ones are all responses.

Defined results: a null payload is empty. If several rows share the largest id, one of
them is the response and the others revisit it. A null id is below all others; a
revisit of a record without an id refers to null. A null address of the page is an empty
target. An empty table gives empty tables. Further columns are not archived.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shared_dir, written

MIN_BYTES = 1000
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def records(pages: DataFrame) -> DataFrame:
    """page_id, address, header: one WARC header for each row of ``pages`` (page_id, url, html)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", F.sha2(payload, 256).alias("address"), F.sha1(payload).alias("sha1"), F.octet_length(payload).cast("long").alias("size"))
    # written, so that the join has a shuffle of its own on either side and a payload that many
    # pages share is dealt to several tasks
    shared = rows.where(F.col("size") >= MIN_BYTES).groupBy("address").agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = written(shared, "shared-payloads")
    rows = rows.join(shared, "address", "left").withColumn("may_be_first", F.col("n").isNull() | F.col("page_id").eqNullSafe(F.col("first_id")))
    # of rows that share payload and largest id, one is the response
    several = rows.where("may_be_first and n is not null").withColumn("place", F.row_number().over(Window.partitionBy("address").orderBy("url")))
    rows = rows.where("not (may_be_first and n is not null)").withColumn("place", F.lit(1)).unionByName(several)
    revisit = ~F.col("may_be_first") | (F.col("place") > 1)
    target = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A")
    header = F.concat(
        F.lit("WARC/1.1" + CRLF),
        _header("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _header("WARC-Record-ID", _record_id(F.col("page_id"))),
        _header("WARC-Target-URI", target),
        _header("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(_header("WARC-Profile", F.lit(PROFILE)), _header("WARC-Refers-To", _record_id(F.col("first_id"))))).otherwise(F.lit("")),
        _header("Content-Type", F.lit("text/html; charset=utf-8")),
        _header("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("size").cast("string"))),
        F.lit(CRLF),
    )
    return rows.select("page_id", "address", header.cast("binary").alias("header"))


def payloads(pages: DataFrame) -> DataFrame:
    """address, payload: each distinct payload once. Equal ones meet in each task before the shuffle."""
    rows = pages.select(F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    return rows.select(F.sha2("payload", 256).alias("address"), "payload").groupBy("address").agg(F.first("payload").alias("payload"))


def write_archive(pages: DataFrame, path: str) -> str:
    """Write the archive of ``pages`` to a folder that all machines see."""
    payloads(pages).write.option("compression", "zstd").parquet(f"{path}/payloads")
    records(pages).write.option("compression", "zstd").parquet(f"{path}/records")
    return path


def archive_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/framewright/warc-{uuid.uuid4().hex}"


def header_value(name: str) -> Column:
    """A field of the header; null where the record has no such field."""
    line = F.regexp_extract(F.decode("header", "UTF-8"), rf"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(F.decode("header", "UTF-8").contains(f"{CRLF}{name}: "), line)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """page_id, header, payload, record_type, payload_digest, refers_to: each record with
    its full payload, whose digests are verified."""
    kept = spark.read.parquet(f"{path}/payloads")
    good = F.sha2("payload", 256) == F.col("address")
    kept = kept.withColumn("payload", F.when(good, F.col("payload")).otherwise(F.raise_error(F.lit("a payload does not match its address")))).withColumn("sha1", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    rows = spark.read.parquet(f"{path}/records").join(kept, "address", "left")
    digest = F.substring_index(header_value("WARC-Payload-Digest"), "sha1:", -1)
    digest = F.when(digest == F.col("sha1"), digest).otherwise(F.raise_error(F.lit("a payload is missing or does not match its record")))
    refers = F.nullif(F.regexp_extract(header_value("WARC-Refers-To"), "<urn:page:(.*)>", 1), F.lit(""))
    return rows.select("page_id", "header", "payload", "payload_bytes", header_value("WARC-Type").alias("record_type"), digest.alias("payload_digest"), refers.alias("refers_to"))


def record_bytes(archive: DataFrame) -> DataFrame:
    """page_id, record: the original WARC records, byte for byte."""
    body = F.when(F.col("record_type") == "revisit", F.lit("").cast("binary")).otherwise(F.col("payload"))
    return archive.select("page_id", F.concat("header", body, F.lit(CRLF + CRLF).cast("binary")).alias("record"))
