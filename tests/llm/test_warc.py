import hashlib

import pytest

from framewright.llm import warc

BIG = "x" * 1200


def cases():
    rows = [(1, "http://a/1", BIG), (2, "http://a/2", BIG), (9, "http://a/9", BIG), (3, None, "small"), (4, "http://b", "small"), (5, "http://c\r\nX: y", None), (6, "u", ""), (7, "é", "é" * 500), (8, "é", "é" * 500), (None, "n", BIG), (9, "http://a/9b", BIG), (20, "only", "y" * 5000), (21, "r", "z" * 3000), (21, "r", "z" * 3000), (None, "p", "w" * 2000), (None, "q", "w" * 2000)]
    return rows


def plain(rows):
    groups = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000:
            groups.setdefault(b, []).append(i)
    out, taken = [], set()
    for i, _, h in rows:
        b = (h or "").encode()
        first = max((x for x in groups.get(b, []) if x is not None), default=None)
        revisit = b in groups and len(groups[b]) > 1 and (i != first or (b, i) in taken)
        if b in groups and i == first:
            taken.add((b, i))
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", str(first) if revisit and first is not None else None))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as address", "1 as size", "2 as n")


def test_round_trip(spark, tmp_path):
    rows = cases()
    path = warc.write_archive(table(spark, rows), f"{tmp_path}/archive")
    found = warc.read_archive(spark, path)
    got = found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted((tuple(r) for r in got), key=str) == plain(rows)
    assert spark.read.parquet(f"{path}/payloads").count() == len({r[2] or "" for r in rows})
    payloads = sorted((r["page_id"] or -1, bytes(r["payload"]).decode()) for r in found.collect())
    assert payloads == sorted((r[0] or -1, r[2] or "") for r in rows)


def test_records_are_whole_and_parse(spark, tmp_path):
    path = warc.write_archive(table(spark, cases()), f"{tmp_path}/archive")
    for r in warc.record_bytes(warc.read_archive(spark, path)).collect():
        head, _, rest = bytes(r["record"]).partition(b"\r\n\r\n")
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n")
        assert int(fields[b"Content-Length"]) == len(rest) - 4
        assert (b"WARC-Refers-To" in fields) == (fields[b"WARC-Type"] == b"revisit")


def test_damaged_payload_is_found(spark, tmp_path):
    from pyspark.sql import functions as F

    path = warc.write_archive(table(spark, cases()), f"{tmp_path}/archive")
    other = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.concat("payload", F.lit("!").cast("binary")))
    other.write.parquet(f"{tmp_path}/damaged/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{tmp_path}/damaged/records")
    with pytest.raises(Exception, match="does not match"):
        warc.read_archive(spark, f"{tmp_path}/damaged").collect()


def test_empty_table(spark, tmp_path):
    path = warc.write_archive(table(spark, []), f"{tmp_path}/archive")
    assert warc.read_archive(spark, path).count() == 0
