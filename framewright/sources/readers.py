"""Readers of worklists, append logs and documents.

Files are split by lines and read in parallel. Where the order of lines matters, each line
gets its number within its file: splits count their lines, and the sums of the splits before
give where each begins, so that a file of any size is read by many tasks; everything inside
the engine is Parquet with an explicit ``seq``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as txt
from . import schemas


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 0), value: the lines that aren't blank."""
    split = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    # rows of a split are numbered one after another, whatever came before it in its task
    rows = spark.read.text(path).select(*split, F.monotonically_increasing_id().alias("at"), "value")
    splits = rows.groupBy("file", "start").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("start")) - F.col("n")
    splits = splits.select("file", "start", "first", before.alias("before"))
    return rows.join(splits, ["file", "start"]).select("file", (F.col("at") - F.col("first") + F.col("before")).cast("int").alias("line"), "value").where("trim(value) <> ''")


def of_shard(rows: DataFrame, number: str, shard: int, shards: int) -> DataFrame:
    """One of several equal parts, by an id or a line number."""
    return rows.where(F.pmod(F.col(number), F.lit(shards)) == shard)


def worklist(spark: SparkSession, path: str, limit_per_file: int = 0, shard: int = 0, shards: int = 1) -> DataFrame:
    """path, gt_caption, id (the line), shard (the file's number): lines are cut at the first
    tab; without one the caption is empty. ``shard`` of ``shards``: only its lines, by their numbers."""
    lines = numbered_lines(spark, path)
    if shards > 1:
        lines = of_shard(lines, "line", shard, shards)
    if limit_per_file:
        lines = lines.where(F.col("line") < limit_per_file)
    parts = F.split("value", "\t", 2)
    return lines.select(parts[0].alias("path"), F.coalesce(F.get(parts, 1), F.lit("")).alias("gt_caption"), F.col("line").cast("long").alias("id"), txt.file_number(F.col("file")).alias("shard"))


def json_lines(spark: SparkSession, path: str, schema: str, strict: bool = False, needs: str = "path") -> DataFrame:
    """JSON lines with a fixed schema. A line that can't be read and has no ``needs`` is
    dropped (``strict``: fails); a line with one field of a wrong type keeps the others."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    rows = spark.read.schema(f"{schema}, {schemas.CORRUPT} STRING").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", schemas.CORRUPT).json(path)
    return rows.where(F.col(schemas.CORRUPT).isNull() | F.col(needs).isNotNull()).drop(schemas.CORRUPT)


def corrupt_count(spark: SparkSession, path: str, schema: str, needs: str = "path") -> DataFrame:
    """n_lines, n_dropped. The lines are parsed as text, as Spark doesn't count from the corrupt column alone."""
    parsed = F.from_json("value", schema)
    rows = spark.read.text(path).where("trim(value) <> ''").select(parsed[needs].isNull().alias("bad"))
    return rows.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if("bad").alias("n_dropped"))


def log_lines(spark: SparkSession, path: str, schema: str, needs: str = "path") -> DataFrame:
    """An append log in its order: the record's fields, shard_file, seq (file order, then line), ok."""
    rows = numbered_lines(spark, path).select("file", "line", F.from_json("value", schema).alias("r")).where(F.col(f"r.{needs}").isNotNull())
    return rows.select("r.*", F.col("file").alias("shard_file"), F.struct("file", "line").alias("seq"), F.col("r.error").isNull().alias("ok"))


def prefiltered(spark: SparkSession, path: str, schema: str, wanted: DataFrame, column: str = "path") -> DataFrame:
    """Records whose ``column`` is in ``wanted``, by a semi join on its parsed value. (A test of
    the raw line would miss values that JSON writes with escapes.)"""
    return spark.read.text(path).select(F.from_json("value", schema).alias("r")).select("r.*").join(wanted.select(column).distinct(), column, "left_semi")


def ordered_entries(grounding: Column) -> Column:
    """A parsed MAP as ARRAY<STRUCT<phrase, boxes>>; a repeated key has its first place and last value."""
    entries = F.map_entries(grounding)
    names = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    return F.transform(names, lambda n: F.struct(n.alias("phrase"), F.element_at(F.filter(entries, lambda e: e["key"] == n), -1)["value"].alias("boxes")))


def groundings(spark: SparkSession, path: str) -> DataFrame:
    """Grounding records in the engine's form: id, shard, path, img_w, img_h, grounding, error."""
    rows = json_lines(spark, path, schemas.GROUND)
    return rows.select("id", "shard", "path", F.coalesce(F.get("img_wh", F.lit(0)), F.lit(0)).alias("img_w"), F.coalesce(F.get("img_wh", F.lit(1)), F.lit(0)).alias("img_h"), ordered_entries(F.col("grounding")).alias("grounding"), "error")


def adjudication(spark: SparkSession, path: str) -> DataFrame:
    """n_yes, n_no, path, phrase, auto, human, crop_frac from one JSON document."""
    return spark.read.schema(schemas.ADJUDICATION).json(path, multiLine=True).select(F.col("N_YES").alias("n_yes"), F.col("N_NO").alias("n_no"), F.explode("answers").alias("a")).select("n_yes", "n_no", "a.*")


def _jpeg_frame(content: Column) -> Column:
    """Height and width of the first frame header of a JPEG, as 8 hexadecimal digits; empty
    if there is none. Segments are skipped by their lengths, so frames of thumbnails inside
    them don't count, and a frame may lie at any place."""
    number = lambda x: F.conv(x, 16, 10).cast("int")
    state = lambda at, frame: F.struct(at.cast("int").alias("at"), frame.alias("frame"))
    end = state(F.lit(0), F.lit(""))

    def step(acc: Column) -> Column:
        at = acc["at"]
        m = F.hex(F.substring(content, at, F.lit(9)))
        on = lambda n: state(at + n, F.lit(""))
        return (
            F.when(at == 0, acc)
            .when(F.length(m) < 8, end)
            .when(~m.startswith("FF") | m.startswith("FFFF"), on(1))
            .when(m.rlike("^FF(0[01]|D[0-8])"), on(2))
            .when(m.rlike("^FF(C[0-35-79-BD-F])"), state(F.lit(0), F.substring(m, 11, 8)))
            .when(m.rlike("^FFD[9A]"), end)
            .otherwise(on(2 + number(F.substring(m, 5, 4))))
        )

    # as many steps as there are bytes suffice; in two levels, so that few are idle
    steps = F.sequence(F.lit(1), F.ceil(F.sqrt(F.length(content))).cast("int") + 1)
    return F.aggregate(steps, state(F.lit(3), F.lit("")), lambda acc, _: F.when(acc["at"] == 0, acc).otherwise(F.aggregate(steps, acc, lambda own, _: step(own))))["frame"]


def image_sizes(spark: SparkSession, path: str) -> DataFrame:
    """path, img_w, img_h from the headers of PNG, GIF and JPEG files, by expressions on
    their bytes; 0 for other files. JPEG: the first frame header, wherever it lies."""
    content = F.col("content")
    raw = spark.read.format("binaryFile").load(path)
    raw = raw.select("path", F.hex(F.substring(content, 1, 32)).alias("x"), F.when(F.hex(F.substring(content, 1, 2)) == "FFD8", _jpeg_frame(content)).otherwise("").alias("frame"))
    word = lambda at, n, swap=False: F.conv(F.concat(*(F.substring("x", 2 * at + 1 + 2 * i, 2) for i in (reversed(range(n)) if swap else range(n)))), 16, 10).cast("int")
    part = lambda a: F.conv(F.substring("frame", a, 4), 16, 10).cast("int")
    png, gif, jpg = F.col("x").startswith("89504E47"), F.col("x").startswith("47494638"), F.length("frame") == 8
    w = F.when(png, word(16, 4)).when(gif, word(6, 2, True)).when(jpg, part(5)).otherwise(0)
    h = F.when(png, word(20, 4)).when(gif, word(8, 2, True)).when(jpg, part(1)).otherwise(0)
    return raw.select("path", w.alias("img_w"), h.alias("img_h"))
