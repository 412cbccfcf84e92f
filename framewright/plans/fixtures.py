"""Groundings, captions, verdicts and answers derived from the test tables by integer
arithmetic, so that any engine gets the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import text as txt
from ..operators.clean import clean, let, with_facts
from .profiles import PROFILES, Profile
from .shared import exists, folder

W, H = 640, 480


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_STORED: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A derived input, written by the first query of a session that reads it: queries run on
    stored rows, as they would on real inputs."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED or not exists(spark, f"{_STORED[key]}/_SUCCESS"):
        path = folder(spark, f"fixture-{name}")
        build().write.parquet(path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, shard, path, gt_caption, gemma_short (the first sentence), gemma_dense, error; short texts are errors."""
    short = F.col("n_chars") < 200
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        (F.col("doc_id") % 576).cast("int").alias("shard"),
        F.concat(F.lit("doc/"), F.col("doc_id")).alias("path"),
        F.col("source").alias("gt_caption"),
        F.when(~short, F.regexp_extract("text", "^[^.!?]*", 0)).alias("gemma_short"),
        F.when(~short, F.col("text")).alias("gemma_dense"),
        F.when(short, "ShortDoc").alias("error"),
    )


def grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, path, img_w, img_h, caption, grounding: one row for each document."""
    return _once(spark, sf_dir, "grounding", lambda: _grounding(spark, sf_dir))


#: Words of a caption that its phrases can take: 3 k and 3 k + 1 for k of at most 14.
WORDS = 44


def _grounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    # dealt by id first, as a table in few large row groups would be read by few tasks; all
    # the rest is done inside the row
    docs = table(spark, sf_dir, "documents").where("doc_id is not null").select("doc_id", "text").repartition("doc_id")
    docs = docs.select("doc_id", txt.norm_phrase(F.col("text")).alias("caption"))
    d = F.col("doc_id")

    def phrases(w):
        word = lambda i: F.coalesce(F.get(w, i.cast("int")), F.lit(""))
        base = lambda i: F.concat(word(3 * i), F.lit(" "), word(3 * i + 1))

        def entry(k):
            again = ((d + k) % 7 == 0) & (k > 0)
            phrase = (
                F.when((d + k) % 13 == 0, "the entire image")
                .when((d + k) % 11 == 0, F.concat(F.substr(base(k), F.lit(2)), F.lit("q")))
                .when((d + k) % 17 == 0, F.concat(base(k), F.lit(" lighting")))
                .when(again, F.upper(base(k - 1)))
                .otherwise(base(k))
            )
            return F.struct(k.alias("k"), F.when(again, k - 1).otherwise(k).alias("kk"), phrase.alias("phrase"))

        return F.filter(F.transform(F.sequence(F.lit(0).cast("long"), 3 + d % 12), entry), lambda e: F.trim(e["phrase"]) != "")

    def boxes(k, kk):
        def box(j):
            half = F.floor(j / 2)
            x0 = (d * 37 + kk * 53 + half * 101) % 500 + j % 2
            y0 = (d * 41 + kk * 29 + half * 67) % 380
            x1 = F.least(F.lit(W), x0 + 8 + (d * 13 + kk * 17 + half * 31) % 220)
            y1 = F.least(F.lit(H), y0 + 8 + (d * 11 + kk * 23) % 150)
            thin = (d + k) % 29 == 0
            corners = (F.when(thin, 0).otherwise(x0), y0, F.when(thin, 10).otherwise(x1), y1)
            return F.when((d + k) % 23 == 0, F.array(F.lit(0.0), F.lit(0.0), F.lit(float(W)), F.lit(float(H)))).otherwise(F.array(*(v.cast("double") for v in corners)))

        return F.transform(F.sequence(F.lit(0).cast("long"), (d + kk) % 3), box)

    def firsts(own):
        """Of equal phrases the first, which has the least k and kk."""
        names = F.transform(own, lambda e: e["phrase"])
        return let(names, lambda all_names: F.filter(own, lambda e, i: F.array_position(all_names, e["phrase"]) == i + 1))

    named = let(F.split("caption", " ", WORDS + 1), lambda w: let(phrases(w), firsts))
    grounding = F.transform(named, lambda e: F.struct(e["phrase"].alias("phrase"), boxes(e["k"], e["kk"]).alias("boxes")))
    rows = docs.select(d, F.concat(F.lit("doc/"), d).alias("path"), F.lit(W).alias("img_w"), F.lit(H).alias("img_h"), "caption", grounding.alias("grounding"))
    return rows.where(F.size("grounding") > 0)


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grounding with the facts that all profiles share, stored, without the caption."""
    return _once(spark, sf_dir, "judged", lambda: with_facts(grounding(spark, sf_dir)).drop("caption"))


def fresh(spark: SparkSession, sf_dir: str, profile: Profile | str = "rec") -> DataFrame:
    """The grounding, cleaned here and now."""
    return clean(grounding(spark, sf_dir), PROFILES[profile] if isinstance(profile, str) else profile)


def cleaned(spark: SparkSession, sf_dir: str, profile: Profile | str = "rec") -> DataFrame:
    """The output of the cleaning stage, an input of the later ones: stored for the named profiles,
    without the caption, which no later stage reads."""
    if not isinstance(profile, str):
        return fresh(spark, sf_dir, profile)
    return _once(spark, sf_dir, f"cleaned-{profile}", lambda: fresh(spark, sf_dir, profile).drop("caption"))


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, path, k, phrase, box, n_box, crop_frac, verdict: the first 12 phrases'
    first boxes of the cleaned grounding, with a verdict by arithmetic. Stored, as the output of
    the verification stage would be."""
    return _once(spark, sf_dir, "verdicts", lambda: _verdicts(spark, sf_dir))


def _verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c")
    rows = cleaned(spark, sf_dir).select("doc_id", "path", "img_w", "img_h", F.posexplode("kept").alias("k", "c")).where("k < 12")
    v = (F.col("doc_id") * 7 + F.col("k") * 3) % 20
    verdict = F.when(v == 0, "ERROR").when(v == 1, "TOO_SMALL").when(v == 2, "UNPARSED").when(v <= 8, "NO").otherwise("YES")
    box = c["boxes"][0]
    return rows.select("doc_id", "path", "k", c["phrase"].alias("phrase"), box.alias("box"), F.size(c["boxes"]).alias("n_box"), geo.area_fraction(box, F.col("img_w"), F.col("img_h")).alias("crop_frac"), verdict.alias("verdict"))


def answers(spark: SparkSession, sf_dir: str, n: int = 50, seed: int = 11) -> DataFrame:
    """auto, human of ``n`` verdicts of each kind, chosen by a hash."""
    from ..operators.sampling import stratified

    chosen = stratified(verdicts(spark, sf_dir).where("verdict in ('YES', 'NO')"), "verdict", n, seed, "path", "phrase")
    flip = F.when(F.col("verdict") == "YES", "NO").otherwise("YES")
    human = F.when(F.col("k") % 11 == 0, "UNSURE").when(F.col("k") % 7 == 0, flip).otherwise(F.col("verdict"))
    return chosen.select("doc_id", "path", "phrase", "k", "crop_frac", F.col("verdict").alias("auto"), human.alias("human"))


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """seq, path, ok, payload: ``events`` as an append log with retries."""
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.col("user_id").alias("path"), (F.col("event_type") != "error").alias("ok"), F.col("value").alias("payload"))
