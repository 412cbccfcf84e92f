"""The registry: each query with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import text as txt
from ..operators import calibrate, clean, legacy, reconcile, report, sampling, verdicts
from ..streaming import incremental
from . import fixtures as fx
from . import oracle as sql
from .profiles import ABLATION, PROFILES, Profile

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register; whole numbers come out as BIGINT."""

    def register(f: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = f(spark, sf_dir)
            return df.select(*(F.col(c).cast("bigint").alias(c) if t in ("int", "smallint", "tinyint") else F.col(c) for c, t in df.dtypes))

        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return f

    return register


# --- append logs

_LOG = "WITH log AS (SELECT event_id AS seq, user_id AS path, event_type <> 'error' AS ok, value AS payload FROM events)"


@query("compact_latest_ok", f"{_LOG} SELECT seq, path, ok, payload FROM log QUALIFY row_number() OVER (PARTITION BY path ORDER BY ok DESC, seq DESC) = 1")
def _(spark, d):
    return reconcile.compact(fx.log(spark, d), "path")


_REPORT = f"""{_LOG}, l AS (SELECT *, CAST(path % 4 AS VARCHAR) AS part FROM log), k AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY path ORDER BY ok DESC, seq DESC) = 1),
r AS (SELECT part, count(*) AS lines FROM l GROUP BY part), q AS (SELECT part, count(*) AS kept, sum(CAST(ok AS BIGINT)) AS ok_rows FROM k GROUP BY part),
a AS (SELECT part, lines, kept, ok_rows FROM r JOIN q USING (part) UNION ALL SELECT 'total', sum(lines), sum(kept), sum(ok_rows) FROM r JOIN q USING (part))
SELECT part, CAST(lines AS BIGINT) AS lines, CAST(kept AS BIGINT) AS kept, CAST(ok_rows AS BIGINT) AS ok_rows, CAST(kept - ok_rows AS BIGINT) AS missing, round(100.0::DOUBLE * (kept - ok_rows) / greatest(1, kept), 2) AS missing_pct FROM a"""


@query("compact_report", _REPORT)
def _(spark, d):
    return reconcile.compact_report(fx.log(spark, d).withColumn("part", F.col("path") % 4), "path", by="part")


_WORK = f"{_LOG}, work AS (SELECT DISTINCT path FROM log), done AS (SELECT * FROM log WHERE payload > 40)"


@query("resume_pending", f"{_WORK} SELECT path FROM work WHERE path NOT IN (SELECT path FROM done WHERE ok)")
def _(spark, d):
    log = fx.log(spark, d)
    return reconcile.pending(log.select("path").distinct(), log.where("payload > 40"), "path")


@query("resume_pending_legacy", f"{_WORK} SELECT path FROM work WHERE path NOT IN (SELECT path FROM done)")
def _(spark, d):
    log = fx.log(spark, d)
    return reconcile.pending(log.select("path").distinct(), log.where("payload > 40"), "path", ok=None)


@query("resume_pending_pairs", "SELECT DISTINCT user_id AS path, event_type AS phrase FROM events e WHERE NOT EXISTS (SELECT 1 FROM events f WHERE f.user_id = e.user_id AND f.event_type = e.event_type AND f.value > 20)")
def _(spark, d):
    e = fx.table(spark, d, "events").select(F.col("user_id").alias("path"), F.col("event_type").alias("phrase"), "event_id", (F.col("value") > 20).alias("ok"))
    return reconcile.pending(e.select("path", "phrase").distinct(), e.where("value > 15"), "path", "phrase")


@query("dup_key_audit", "SELECT count(*) AS n_rows, count(DISTINCT (user_id, event_type)) AS n_keys, count(*) - count(DISTINCT (user_id, event_type)) AS n_repeats FROM events")
def _(spark, d):
    return reconcile.repeated_keys(fx.table(spark, d, "events"), "user_id", "event_type")


@query("verdict_index", "SELECT user_id AS path, event_type AS phrase, arg_max(value, event_id) AS value FROM events GROUP BY ALL")
def _(spark, d):
    e = fx.table(spark, d, "events").select(F.col("user_id").alias("path"), F.col("event_type").alias("phrase"), F.col("event_id").alias("seq"), "value")
    return reconcile.index(e, "path", "phrase", value="value")


# --- texts


@query("worklist_ids", "SELECT 'doc/' || doc_id AS path, source AS gt_caption, doc_id AS id, CAST(doc_id % 576 AS BIGINT) AS shard, CAST(doc_id % 8 AS BIGINT) AS part FROM documents QUALIFY row_number() OVER (PARTITION BY doc_id % 576 ORDER BY doc_id) <= 2")
def _(spark, d):
    from pyspark.sql.window import Window

    rows = fx.captions(spark, d).withColumn("place", F.row_number().over(Window.partitionBy("shard").orderBy("id"))).where("place <= 2")
    return rows.select("path", "gt_caption", "id", "shard", F.pmod("id", F.lit(8)).alias("part"))


@query("norm_text", f"SELECT doc_id, {sql.norm('text')} AS norm FROM documents")
def _(spark, d):
    return fx.table(spark, d, "documents").select("doc_id", txt.norm_phrase(F.col("text")).alias("norm"))


@query("content_word_counts", f"WITH n AS (SELECT doc_id, {sql.norm('text')} AS n FROM documents) SELECT doc_id, CAST(len({sql.content('n')}) AS BIGINT) AS n_content FROM n")
def _(spark, d):
    return fx.table(spark, d, "documents").select("doc_id", txt.norm_phrase(F.col("text")).alias("n")).select("doc_id", F.size(txt.content_words(F.col("n"))).alias("n_content"))


@query("raw_word_counts", f"SELECT conv_id, turn, {sql.words('text')} AS n_words FROM conversations")
def _(spark, d):
    return fx.table(spark, d, "conversations").select("conv_id", "turn", txt.word_count(F.col("text")).alias("n_words"))


_MARKS = """WITH s AS (SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN ' <think>' || text || '</think> ' ELSE '' END || CASE WHEN conv_id % 2 = 0 THEN 'Yes ' ELSE 'no, ' END || text || '</s>rest</s> ' AS s FROM conversations)
SELECT conv_id, turn, trim(CASE WHEN instr(s, '</think>') > 0 THEN substr(s, instr(s, '</think>') + 8) ELSE s END, chr(32) || chr(9) || chr(10) || chr(13)) AS answer, CASE WHEN instr(substr(s, 6), '</s>') > 0 THEN substr(s, 1, instr(substr(s, 6), '</s>') + 8) ELSE s END AS cut,
CASE WHEN lower(s) LIKE 'yes%' THEN 'YES' WHEN lower(s) LIKE 'no%' THEN 'NO' ELSE 'UNPARSED' END AS verdict, 'is it ' || trim(role) || '?' AS prompt FROM s JOIN conversations USING (conv_id, turn)"""


def _markers(spark, d, thought, said):
    think = F.when(F.col("turn") % 3 == 0, F.concat(F.lit(" <think>"), thought, F.lit("</think> "))).otherwise("")
    s = F.concat(think, F.when(F.col("conv_id") % 2 == 0, "Yes ").otherwise("no, "), said, F.lit("</s>rest</s> "))
    return fx.table(spark, d, "conversations").select("conv_id", "turn", "role", s.alias("s")).select("conv_id", "turn", txt.after_thinking(F.col("s")).alias("answer"), txt.until_end_mark(F.col("s")).alias("cut"), txt.parse_verdict(F.col("s")).alias("verdict"), txt.prompt("is it {p}?", F.col("role")).alias("prompt"))


@query("text_markers", _MARKS)
def _(spark, d):
    return _markers(spark, d, F.col("text"), F.col("text"))


_FIRST = "regexp_extract(text, '^[^.!?]*')"
_CAPTION = f"""WITH c AS (SELECT n_chars < 200 AS missing, CASE WHEN n_chars >= 200 THEN {sql.words(_FIRST)} END AS s, CASE WHEN n_chars >= 200 THEN {sql.words('text')} END AS d FROM documents)
SELECT count(*) AS n, count(*) FILTER (WHERE missing) AS missing, median(s) AS short_median, round(avg(s), 6) AS short_mean, median(d) AS dense_median, round(avg(d), 6) AS dense_mean FROM c"""


@query("caption_stats", _CAPTION)
def _(spark, d):
    return report.caption_stats(fx.captions(spark, d)).withColumns({c: F.round(c, 6) for c in ("short_mean", "dense_mean")})


@query("lexical_recall", f"WITH p AS (SELECT {sql.nouns('text')} AS g, {sql.nouns("replace(text, 'th', 'd')")} AS p FROM documents) SELECT count(*) AS n, round(avg(len(list_intersect(g, p)) / len(g)), 6) AS recall, round(avg(len(list_filter(p, lambda x: NOT list_contains(g, x)))), 6) AS extra FROM p WHERE len(g) > 0")
def _(spark, d):
    rows = fx.table(spark, d, "documents").select(F.col("text").alias("gold"), F.replace("text", F.lit("th"), F.lit("d")).alias("said"))
    return legacy.lexical_recall(rows, "gold", "said").withColumns({c: F.round(c, 6) for c in ("recall", "extra")})


@query("vocab_topk", f"WITH v AS (SELECT unnest({sql.nouns('text')}) AS label FROM documents) SELECT label, count(*) AS n FROM v GROUP BY label ORDER BY n DESC, label LIMIT 20")
def _(spark, d):
    return legacy.top(legacy.vocabulary(fx.table(spark, d, "documents"), txt.nouns(F.col("text"))), 20)


@query("token_sets", f"WITH s AS (SELECT conv_id, turn, {sql.nouns('text')} AS a, {sql.nouns('reverse(role) || text')} AS b FROM conversations) SELECT conv_id, turn, CAST(len(list_intersect(a, b)) AS BIGINT) AS n_both, CAST(len(list_filter(a, lambda x: NOT list_contains(b, x))) AS BIGINT) AS n_left FROM s")
def _(spark, d):
    rows = fx.table(spark, d, "conversations").select("conv_id", "turn", txt.nouns(F.col("text")).alias("a"), txt.nouns(F.concat(F.reverse("role"), F.col("text"))).alias("b"))
    return rows.select("conv_id", "turn", F.size(F.array_intersect("a", "b")).alias("n_both"), F.size(F.array_except("a", "b")).alias("n_left"))


# --- boxes

_BOX16 = "b16 AS (SELECT vec_id, i, [least(x[1], x[3]), least(x[2], x[4]), greatest(x[1], x[3]), greatest(x[2], x[4])] AS b FROM (SELECT vec_id, i, list_transform(embedding[4 * i + 1 : 4 * i + 4], lambda v: CAST(v AS DOUBLE) * 1000) AS x FROM (SELECT vec_id, embedding, unnest(range(0, 16)) AS i FROM embeddings)))"


def _boxes16(spark, d):
    x = F.transform(F.slice("embedding", 4 * F.col("i") + 1, 4), lambda v: v.cast("double") * 1000)
    rows = fx.table(spark, d, "embeddings").select("vec_id", "embedding", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("i")).select("vec_id", "i", x.alias("x"))
    c = F.col("x")
    return rows.select("vec_id", "i", F.array(F.least(c[0], c[2]), F.least(c[1], c[3]), F.greatest(c[0], c[2]), F.greatest(c[1], c[3])).alias("b"))


@query("box_geometry", f"WITH {_BOX16} SELECT vec_id, i, round((b[3] - b[1]) * (b[4] - b[2]), 6) AS area, round(least(abs(b[3] - b[1]), abs(b[4] - b[2])), 6) AS short_side, {sql.rounded('(b[3] - b[1]) * (b[4] - b[2]) / 307200', 4)} AS fraction FROM b16")
def _(spark, d):
    b = F.col("b")
    return _boxes16(spark, d).select("vec_id", "i", F.round(geo.area(b), 6).alias("area"), F.round(geo.short_side(b), 6).alias("short_side"), geo.area_fraction(b, F.lit(640), F.lit(480)).alias("fraction"))


@query("iou_pairs", f"WITH {_BOX16} SELECT vec_id, p.i AS i, q.i AS j, round({sql.iou('p.b', 'q.b')}, 9) AS iou FROM b16 p JOIN b16 q USING (vec_id) WHERE p.i < q.i AND {sql.iou('p.b', 'q.b')} > 0")
def _(spark, d):
    own = _boxes16(spark, d).groupBy("vec_id").agg(F.sort_array(F.collect_list(F.struct("i", "b"))).alias("bs"))  # 16 a row
    pairs = F.flatten(F.transform("bs", lambda p: F.transform(F.filter("bs", lambda q: q["i"] > p["i"]), lambda q: F.struct(p["i"].alias("i"), q["i"].alias("j"), geo.iou(p["b"], q["b"]).alias("iou")))))
    return own.select("vec_id", F.explode(pairs).alias("p")).where("p.iou > 0").select("vec_id", F.col("p.i").alias("i"), F.col("p.j").alias("j"), F.round("p.iou", 9).alias("iou"))


@query("label_boxes", f"WITH {_BOX16}, n AS (SELECT vec_id, i, CASE WHEN i % 5 = 0 THEN '' ELSE 'l' || (i % 3) END AS l, [round(b[1], 1), round(b[2], 1), round(b[3], 1), round(b[4], 1)] AS b FROM b16) SELECT vec_id, l AS phrase, count(*) AS n_box, list(b ORDER BY i)[1][1] AS x0, min(i) AS first_at FROM n WHERE l <> '' GROUP BY ALL")
def _(spark, d):
    rows = _boxes16(spark, d).groupBy("vec_id").agg(F.sort_array(F.collect_list(F.struct("i", "b"))).alias("bs"))
    labels = F.transform("bs", lambda x: F.when(x["i"] % 5 == 0, " ").otherwise(F.concat(F.lit("l"), x["i"] % 3)))
    found = rows.select("vec_id", labels.alias("labels"), txt.boxes_by_label(labels, F.col("bs.b")).alias("g")).select("vec_id", "labels", F.explode("g").alias("g"))
    return found.select("vec_id", F.col("g.phrase").alias("phrase"), F.size("g.boxes").alias("n_box"), F.col("g.boxes")[0][0].alias("x0"), (F.array_position("labels", F.col("g.phrase")) - 1).alias("first_at"))


@query("box_dedup", f"WITH {sql.FIXTURE} SELECT doc_id, k, CAST(len(boxes) AS BIGINT) AS n_before, CAST(len({sql.dedup('boxes')}) AS BIGINT) AS n_after FROM fx")
def _(spark, d):
    rows = fx.grounding(spark, d).select("doc_id", F.posexplode("grounding").alias("k", "g"))
    return rows.select("doc_id", "k", F.size("g.boxes").alias("n_before"), F.size(clean.without_repeats(F.col("g.boxes"))).alias("n_after"))


# --- cleaning

for _name in ("default", "rec", "c", "old", "new"):
    query(f"clean_{_name}", f"WITH {sql.FIXTURE}, {sql.cleaned(_name)} {sql.FLAT.format(p='')}")(lambda spark, d, name=_name: clean.flat(fx.fresh(spark, d, name), "doc_id"))

_IN = "SELECT doc_id, k, CAST(cap <> '' AND norm <> '' AND contains(cap, norm) AS BOOLEAN) AS inside, CAST(cap <> '' AND norm <> '' AND contains(' ' || cap || ' ', ' ' || norm || ' ') AS BOOLEAN) AS whole"


@query("phrase_in_source", f"WITH {sql.FIXTURE}, n AS (SELECT doc_id, k, cap, {sql.norm('phrase')} AS norm FROM fx JOIN docs USING (doc_id)) {_IN} FROM n")
def _(spark, d):
    rows = fx.grounding(spark, d).select("doc_id", "caption", F.posexplode("grounding").alias("k", "g")).select("doc_id", "k", "caption", txt.norm_phrase(F.col("g.phrase")).alias("n"))
    some = (F.col("caption") != "") & (F.col("n") != "")
    return rows.select("doc_id", "k", (some & txt.in_caption(F.col("n"), F.col("caption"), False)).alias("inside"), (some & txt.in_caption(F.col("n"), F.col("caption"), True)).alias("whole"))


_FEW = Profile(abstract=True, whole_words=True, min_words=2, max_boxes=2, min_area=0.01, min_px=24, max_ratio=4.0, max_cover=0.95, edge=True, xdup=True)
_COUNT = " UNION ALL ".join([f"SELECT '{r}' AS rule, 'box' AS unit, CAST(sum(n_{r}) AS BIGINT) AS n FROM cells" for r in clean.BOX_RULES] + [f"SELECT '{r}', 'phrase', count(*) FILTER (WHERE rule = '{r}') FROM cells" for r in clean.PHRASE_RULES])


@query("rule_counters", f"{sql.rec()} SELECT * FROM ({_COUNT}) WHERE n > 0")
def _(spark, d):
    return clean.counters(fx.cleaned(spark, d))


@query("rule_counters_all_rules", f"WITH {sql.FIXTURE}, {sql.cleaned(_FEW)} SELECT * FROM ({_COUNT}) WHERE n > 0")
def _(spark, d):
    return clean.counters(fx.cleaned(spark, d, _FEW))


@query("why_dropped", f"{sql.rec()} SELECT doc_id, k, phrase, coalesce(rule, 'kept') AS rule, blamed FROM cells")
def _(spark, d):
    return clean.attribution(fx.cleaned(spark, d), "doc_id").drop("note").withColumnRenamed("by", "blamed")


@query("why_dropped_all_rules", f"WITH {sql.FIXTURE}, {sql.cleaned(_FEW)} SELECT doc_id, k, phrase, coalesce(rule, 'kept') AS rule, blamed FROM cells")
def _(spark, d):
    return clean.attribution(fx.cleaned(spark, d, _FEW), "doc_id").drop("note").withColumnRenamed("by", "blamed")


@query("drop_matrix", f"WITH {sql.FIXTURE}, {sql.cleaned('c', 'c_')}, {sql.cleaned('rec', 'r_')} SELECT doc_id, a.k AS k, a.phrase AS phrase, coalesce(a.rule, 'kept') AS c, coalesce(b.rule, 'kept') AS rec FROM c_cells a JOIN r_cells b USING (doc_id, k)")
def _(spark, d):
    base = fx.judged(spark, d)
    rows = None
    for name in ("c", "rec"):  # both profiles over one input; the join is on the phrase's place
        own = clean.attribution(clean.clean(base, PROFILES[name]), "doc_id").select("doc_id", "k", "phrase", F.lit(name).alias("variant"), "rule")
        rows = own if rows is None else rows.unionByName(own)
    return rows.groupBy("doc_id", "k", "phrase").pivot("variant", ["c", "rec"]).agg(F.first("rule"))


def _summary(name: str) -> str:
    sums = [f"coalesce(CAST(sum(n_{r}) AS BIGINT), 0) AS \"{r}\"" for r in clean.BOX_RULES] + [f"count(*) FILTER (WHERE rule = '{r}') AS \"{r}\"" for r in clean.PHRASE_RULES]
    return f"SELECT '{name}' AS variant, count(DISTINCT doc_id) AS n_img, count(*) AS n_in, (SELECT count(*) FROM {name}_kept) AS n_out, {', '.join(sums)} FROM {name}_cells"


_ALL = f"WITH {sql.FIXTURE}, " + ", ".join(sql.cleaned(n, f"{n}_") for n in ABLATION)


@query("ablation_profiles", _ALL.replace("all_", "every_") + " " + " UNION ALL ".join(_summary(n) for n in ABLATION).replace("all_", "every_"))
def _(spark, d):
    base = fx.judged(spark, d)
    return report.ablation({n: clean.clean(base, PROFILES[n]) for n in ABLATION})


_PREC = "SELECT '{n}' AS variant, (SELECT count(*) FROM {n}_kept) / (SELECT count(DISTINCT doc_id) FROM {n}_cells) AS density, count(*) FILTER (WHERE (7 * doc_id + 3 * k) % 20 >= 9) / count(*) FILTER (WHERE (7 * doc_id + 3 * k) % 20 >= 3) AS precision FROM {n}_kept WHERE k < 12"


@query("profile_delta", f"WITH {sql.FIXTURE}, {sql.cleaned('old', 'old_')}, {sql.cleaned('new', 'new_')}, {sql.cleaned('c', 'c_')}, p AS ({' UNION ALL '.join(_PREC.format(n=n) for n in ('old', 'new', 'c'))}), e AS (SELECT *, density * precision AS effective FROM p) SELECT variant, round(density, 6) AS density, round(precision, 6) AS precision, round(effective, 6) AS effective, round(100 * (precision - (SELECT precision FROM e WHERE variant = 'old')), 6) AS points, round(effective - (SELECT effective FROM e WHERE variant = 'old'), 6) AS gain, round(100 * (effective / (SELECT effective FROM e WHERE variant = 'old') - 1), 6) AS gain_pct FROM e")
def _(spark, d):
    base, dens, prec = fx.judged(spark, d), None, None
    for name in ("old", "new", "c"):
        t = clean.clean(base, PROFILES[name])
        a = t.agg(F.lit(name).alias("variant"), (F.sum(F.size("kept")) / F.count(F.lit(1))).alias("density"))
        v = (F.col("doc_id") * 7 + F.col("k") * 3) % 20
        said = clean.entries(t, "kept", "doc_id").where("k < 12").select(F.when(v >= 9, "YES").when(v >= 3, "NO").alias("verdict"))
        b = report.precision(said).select(F.lit(name).alias("variant"), "precision")
        dens, prec = (a, b) if dens is None else (dens.unionByName(a), prec.unionByName(b))
    out = report.effective(dens, prec, "old")
    return out.select("variant", *(F.round(c, 6).alias(c) for c in out.columns if c != "variant"))


@query("density_report", f"{sql.rec()}, r AS (SELECT doc_id, (SELECT count(*) FROM kept q WHERE q.doc_id = d.doc_id) AS p, (SELECT coalesce(sum(len(boxes)), 0) FROM kept q WHERE q.doc_id = d.doc_id) AS b FROM (SELECT DISTINCT doc_id FROM fx) d) SELECT count(*) AS n, CAST(0 AS BIGINT) AS errors, median(p) AS phrase_median, round(avg(p), 6) AS phrase_mean, CAST(median(b) AS DOUBLE) AS box_median, round(avg(b), 6) AS box_mean, round(count(*) FILTER (WHERE p = 0) / count(*), 6) AS zero_share FROM r")
def _(spark, d):
    out = report.density(clean.output(fx.cleaned(spark, d)))
    return out.withColumns({c: F.round(c, 6) for c in ("phrase_mean", "box_mean", "zero_share")})


# --- sampling

_TASK = "SELECT doc_id, k, phrase, boxes[1][1] AS x0, boxes[1][4] AS y1, CAST(len(boxes) AS BIGINT) AS n_box"


def _tasks(df):
    return df.select("doc_id", "k", "phrase", F.col("box")[0].alias("x0"), F.col("box")[3].alias("y1"), "n_box")


def _uncleaned(spark, d):
    """Without the rule on vague phrases, so that they are there to be skipped."""
    return fx.cleaned(spark, d, Profile(vague=False, dup=False))


_RAW = f"WITH {sql.FIXTURE}, {sql.cleaned(Profile(vague=False, dup=False))}"


@query("verify_tasks", f"{_RAW} {_TASK} FROM kept WHERE k < 5 AND NOT {sql.vague('phrase')}")
def _(spark, d):
    return _tasks(sampling.verify_tasks(_uncleaned(spark, d), "doc_id", max_phrases=5))


@query("verify_tasks_legacy", f"{_RAW} {_TASK} FROM kept WHERE NOT {sql.vague('phrase')} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY k) <= 5")
def _(spark, d):
    return _tasks(sampling.verify_tasks(_uncleaned(spark, d), "doc_id", max_phrases=5, vague_takes_place=False))


_CROP = "greatest(0.0::DOUBLE, b[1] - (b[3] - b[1]) * 0.1::DOUBLE) AS x0, greatest(0.0::DOUBLE, b[2] - (b[4] - b[2]) * 0.1::DOUBLE) AS y0, least(640.0::DOUBLE, b[3] + (b[3] - b[1]) * 0.1::DOUBLE) AS x1, least(480.0::DOUBLE, b[4] + (b[4] - b[2]) * 0.1::DOUBLE) AS y1"


@query("crop_rect", f"{sql.rec()}, c AS (SELECT doc_id, k, boxes[1] AS b FROM kept WHERE k < 12), r AS (SELECT doc_id, k, b, {_CROP} FROM c) SELECT doc_id, k, round(x0, 6) AS x0, round(y0, 6) AS y0, round(x1, 6) AS x1, round(y1, 6) AS y1, {sql.rounded('(b[3] - b[1]) * (b[4] - b[2]) / 307200', 4)} AS crop_frac, round_even(x1, 0) - round_even(x0, 0) < 8 OR round_even(y1, 0) - round_even(y0, 0) < 8 AS small FROM r")
def _(spark, d):
    rows = sampling.verify_tasks(fx.cleaned(spark, d), "doc_id", "img_w", "img_h")
    c = F.col("crop")
    return sampling.crops(rows).select("doc_id", "k", *(F.round(c[i], 6).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))), "crop_frac", F.col("verdict").isNotNull().alias("small"))


@query("sample_images", "SELECT doc_id, 'doc/' || doc_id AS path FROM documents ORDER BY md5('doc/' || doc_id || '|7'), path LIMIT 100")
def _(spark, d):
    return sampling.sample(fx.table(spark, d, "documents").select("doc_id", F.concat(F.lit("doc/"), "doc_id").alias("path")), 100, 7, "path")


@query("stratified_sample", f"{sql.rec(sql.VERDICTS)} SELECT doc_id, k, phrase, verdict FROM vf QUALIFY row_number() OVER (PARTITION BY verdict ORDER BY md5(path || '|' || phrase || '|3'), path, phrase) <= 20")
def _(spark, d):
    return sampling.stratified(fx.verdicts(spark, d), "verdict", 20, 3, "path", "phrase").select("doc_id", "k", "phrase", "verdict")


@query("extreme_sample", "WITH r AS (SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS place FROM documents) SELECT doc_id, n_chars FROM r WHERE place <= 10 UNION ALL (SELECT doc_id, n_chars FROM r WHERE place > 10 AND place <= 300 ORDER BY md5(doc_id || '|5'), doc_id LIMIT 10)")
def _(spark, d):
    return sampling.extremes_and_random(fx.table(spark, d, "documents").select("doc_id", "n_chars"), "n_chars", 20, 5, 300, "doc_id")


_SUMS = "CAST(coalesce(sum(n), 0) AS BIGINT) AS n_phrase, count(*) FILTER (WHERE n > 5) AS n_capped_img, CAST(coalesce(sum(greatest(n - 5, 0)), 0) AS BIGINT) AS n_cut, CAST(sum(v) AS BIGINT) AS n_vague, CAST(sum(least(n, 5) - v) AS BIGINT) AS n_task"


@query("sampling_waterfall", f"WITH {sql.FIXTURE}, r AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE k < 5 AND {sql.vague('trim(phrase)')}) AS v FROM fx GROUP BY doc_id) SELECT count(*) AS n_img, {_SUMS} FROM r")
def _(spark, d):
    return sampling.waterfall(fx.grounding(spark, d), 5)


@query("quantiles_nearest", f"WITH {sql.FIXTURE}, r AS (SELECT count(*) AS n FROM fx GROUP BY doc_id), s AS (SELECT list(n ORDER BY n) AS l FROM r) SELECT p, l[least(len(l) - 1, CAST(floor(len(l) * p) AS BIGINT)) + 1] AS value FROM s, (SELECT unnest([0.5, 0.75, 0.9, 0.99]::DOUBLE[]) AS p)")
def _(spark, d):
    return sampling.nearest_ranks(fx.grounding(spark, d).select(F.size("grounding").alias("n")), "n", [0.5, 0.75, 0.9, 0.99])


@query("truncation_bias", f"WITH {sql.FIXTURE}, n AS (SELECT k, {sql.norm('phrase')} AS n FROM fx), c AS (SELECT k, len({sql.content('n')}) AS w FROM n) SELECT round(avg(w) FILTER (WHERE k < 5), 6) AS kept_words, round(avg(w) FILTER (WHERE k >= 5), 6) AS cut_words FROM c")
def _(spark, d):
    return sampling.truncation_bias(fx.grounding(spark, d), 5).select(F.round("kept_words", 6).alias("kept_words"), F.round("cut_words", 6).alias("cut_words"))


# --- verdicts and reports

_VF = sql.rec(sql.VERDICTS)
_YN = "CAST(count(*) FILTER (WHERE verdict = 'YES') AS BIGINT) AS yes, count(*) AS n, count(*) FILTER (WHERE verdict = 'YES') / count(*) AS precision FROM vf WHERE verdict IN ('YES', 'NO')"


def _case(value: str, buckets) -> str:
    return "CASE " + " ".join(f"WHEN {value} >= {lo} AND {value} < {hi} THEN '{n}'" for n, lo, hi in buckets) + " END"


@query("verdict_distribution", f"{_VF} SELECT verdict, count(*) AS n FROM vf GROUP BY verdict")
def _(spark, d):
    return report.verdict_distribution(fx.verdicts(spark, d))


@query("precision_overall", f"{_VF} SELECT {_YN}")
def _(spark, d):
    return report.precision(fx.verdicts(spark, d))


@query("precision_by_area", f"{_VF} SELECT {_case('crop_frac', report.AREA)} AS bucket, {_YN} GROUP BY 1")
def _(spark, d):
    return report.precision_by_area(fx.verdicts(spark, d))


@query("precision_by_words", f"{_VF} SELECT {_case(sql.words('phrase'), report.WORDS)} AS bucket, {_YN} GROUP BY 1")
def _(spark, d):
    return report.precision_by_words(fx.verdicts(spark, d))


@query("precision_by_k", f"{_VF} SELECT k, {_YN} GROUP BY k")
def _(spark, d):
    return report.precision(fx.verdicts(spark, d), "k")


@query("precision_by_nbox", f"{_VF} SELECT least(n_box, 4) AS n_box, {_YN} GROUP BY 1")
def _(spark, d):
    return report.precision(fx.verdicts(spark, d), F.least("n_box", F.lit(4)).alias("n_box"))


_TRADE = " UNION ALL ".join(f"SELECT '{n}' AS rule, count(*) FILTER (WHERE t AND verdict = 'YES') AS yes, count(*) FILTER (WHERE t) AS n, count(*) AS total FROM (SELECT verdict, crop_frac >= {a} AND {sql.words('phrase')} >= {w} AS t FROM vf WHERE verdict IN ('YES', 'NO'))" for n, a, w in report.RULES)


@query("rule_tradeoff", f"{_VF} SELECT * FROM ({_TRADE}) WHERE n > 0")
def _(spark, d):
    return report.tradeoff(fx.verdicts(spark, d))


@query("top_rejected", f"{_VF} SELECT phrase, count(*) AS n FROM vf WHERE verdict = 'NO' GROUP BY phrase ORDER BY n DESC, phrase LIMIT 10")
def _(spark, d):
    return report.top_rejected(fx.verdicts(spark, d))


@query("yes_per_image", f"{_VF}, im AS (SELECT path, count(*) FILTER (WHERE verdict = 'YES') AS yes FROM vf GROUP BY path) SELECT count(*) AS n_img, round(avg(yes), 6) AS mean_yes, round(avg(CASE WHEN yes > 0 THEN 1.0 ELSE 0.0 END), 6) AS share_with_yes FROM im")
def _(spark, d):
    return report.yes_per_image(fx.verdicts(spark, d)).withColumns({c: F.round(c, 6) for c in ("mean_yes", "share_with_yes")})


@query("nbox_distribution", f"{sql.rec()} SELECT CAST(len(boxes) AS BIGINT) AS n_box, count(*) AS n FROM kept GROUP BY 1")
def _(spark, d):
    return report.box_counts(fx.cleaned(spark, d))


def _verified(spark, d):
    """Verdicts with a retry: an ERROR is followed by a later row."""
    v = fx.verdicts(spark, d).select("path", "phrase", "verdict", F.col("k").cast("long").alias("seq"))
    retried = v.where("verdict = 'ERROR' and seq % 2 = 0").select("path", "phrase", F.lit("YES").alias("verdict"), (F.col("seq") + 100).alias("seq"))
    return v.unionByName(retried)


_SIDE = f"{_VF}, said AS (SELECT doc_id, phrase, CASE WHEN verdict = 'ERROR' AND k % 2 = 0 THEN 'YES' ELSE verdict END AS verdict FROM vf), slots AS (SELECT q.doc_id, q.k, q.phrase, j - 1 AS j, CASE WHEN j = 1 THEN s.verdict END AS verdict FROM (SELECT *, unnest(range(1, len(boxes) + 1)) AS j FROM kept) q LEFT JOIN said s ON s.doc_id = q.doc_id AND s.phrase = q.phrase)"


@query("verdict_sidecar", f"{_SIDE} SELECT 'doc/' || doc_id AS path, k, phrase, j, verdict FROM slots")
def _(spark, d):
    return verdicts.flat_slots(verdicts.sidecar(fx.cleaned(spark, d), _verified(spark, d)))


@query("sidecar_totals", f"{_SIDE} SELECT 'img' AS kind, '' AS value, (SELECT count(DISTINCT doc_id) FROM fx) AS n UNION ALL SELECT 'pair', '', count(*) FROM slots UNION ALL SELECT 'audited', '', count(verdict) FROM slots UNION ALL SELECT 'null', '', count(*) - count(verdict) FROM slots UNION ALL SELECT 'verdict', verdict, count(*) FROM slots WHERE verdict IS NOT NULL GROUP BY verdict UNION ALL SELECT 'k', CAST(k AS VARCHAR), count(*) FROM slots WHERE verdict IS NOT NULL GROUP BY k UNION ALL SELECT 'box', CAST(j AS VARCHAR), count(*) FROM slots WHERE verdict IS NOT NULL GROUP BY j")
def _(spark, d):
    return verdicts.totals(verdicts.sidecar(fx.cleaned(spark, d), _verified(spark, d)))


@query("sidecar_unmatched", f"WITH {sql.FIXTURE}, {sql.cleaned('rec')}, {sql.cleaned('c', 'c_')}, {sql.VERDICTS} SELECT count(*) AS n FROM (SELECT DISTINCT doc_id, phrase FROM vf) v WHERE NOT EXISTS (SELECT 1 FROM c_kept q WHERE q.doc_id = v.doc_id AND q.phrase = v.phrase)")
def _(spark, d):
    return verdicts.unmatched(fx.cleaned(spark, d, "c"), fx.verdicts(spark, d))


@query("aligned_zip", f"{_SIDE} SELECT 'doc/' || d.doc_id AS path, (SELECT count(*) FROM kept q WHERE q.doc_id = d.doc_id) AS n_phrase, (SELECT count(verdict) FROM slots s WHERE s.doc_id = d.doc_id) AS n_audited FROM (SELECT DISTINCT doc_id FROM fx) d")
def _(spark, d):
    t = fx.cleaned(spark, d)
    return verdicts.aligned(clean.output(t).select("path", "n_phrase"), verdicts.sidecar(t, _verified(spark, d)).select("path", "n_audited"))


def _wilson(k: str, n: str, sign: str) -> str:
    return f"(CASE WHEN {n} = 0 THEN {'0.0' if sign == '-' else '1.0'} ELSE (({k} / {n} + 3.8416::DOUBLE / (2 * {n})) {sign} 1.96::DOUBLE * sqrt(({k} / {n}) * (1 - {k} / {n}) / {n} + 3.8416::DOUBLE / (4 * {n} * {n}))) / (1 + 3.8416::DOUBLE / {n}) END)"


def _calibrated(source: str, by: str, py: str, pn: str) -> str:
    group = f"GROUP BY {by}" if by else ""
    first = f"{by}, " if by else ""
    mixed = lambda x, y: f"({py} * {x} + {pn} * {y}) / ({py} + {pn})"
    la, ha, lb, hb = _wilson("ay", "ny", "-"), _wilson("ay", "ny", "+"), _wilson("an", "nn", "-"), _wilson("an", "nn", "+")
    a, b = "(ay / nullif(ny, 0))", "(an / nullif(nn, 0))"
    columns = {"a": a, "a_low": la, "a_high": ha, "b": b, "b_low": lb, "b_high": hb, "precision": mixed(a, b), "low": mixed(la, lb), "high": mixed(ha, hb), "accuracy": mixed(a, f"(1 - {b})"), "auto_precision": f"{py} / ({py} + {pn})"}
    delta = f"100 * ({columns['precision']} - {columns['auto_precision']})"
    return f"c AS (SELECT {first}count(*) FILTER (WHERE auto = 'YES' AND human = 'YES') AS ay, count(*) FILTER (WHERE auto = 'YES') AS ny, count(*) FILTER (WHERE auto <> 'YES' AND human = 'YES') AS an, count(*) FILTER (WHERE auto <> 'YES') AS nn FROM {source} WHERE human IN ('YES', 'NO') {group}) SELECT {first}ay, ny, an, nn, {', '.join(f'round({e}, 6) AS {n}' for n, e in columns.items())}, CASE WHEN {delta} > 2 THEN 'conservative' WHEN {delta} < -2 THEN 'lenient' ELSE 'usable' END AS reading FROM c"


def _rounded(df):
    return df.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


@query("calibration", f"{sql.rec(sql.VERDICTS, sql.ANSWERS)}, {_calibrated('an', '', '7425.0::DOUBLE', '3165.0::DOUBLE')}")
def _(spark, d):
    return _rounded(calibrate.calibration(fx.answers(spark, d), 7425, 3165))


@query("calibration_by_bucket", f"{sql.rec(sql.VERDICTS, sql.ANSWERS)}, bk AS (SELECT *, {_case('crop_frac', report.AREA)} AS bucket FROM an), {_calibrated('bk', 'bucket', '7425.0::DOUBLE', '3165.0::DOUBLE')}")
def _(spark, d):
    rows = fx.answers(spark, d).withColumn("bucket", report._bucket(F.col("crop_frac"), report.AREA))
    return _rounded(calibrate.calibration(rows, 7425, 3165, "bucket", strict=False))  # a bucket may lack verdicts of one kind


@query("human_restore", f"{sql.rec(sql.VERDICTS, sql.ANSWERS)} SELECT v.path, v.phrase, v.verdict, a.human FROM vf v LEFT JOIN an a ON a.path = v.path AND a.phrase = v.phrase")
def _(spark, d):
    return fx.verdicts(spark, d).select("path", "phrase", "verdict").join(fx.answers(spark, d).select("path", "phrase", "human"), ["path", "phrase"], "left")


# --- older analyses

#: Over whole texts; what a chain lacks, it lacks for the length of the document.
_CHAINS = "fl AS (SELECT doc_id AS id, text AS caption, n_chars / 100.0::DOUBLE AS dt_s, CASE WHEN n_chars < 200 THEN 'ShortDoc' END AS error FROM documents), qw AS (SELECT doc_id AS id, upper(lang) || ' ' || text AS short, n_chars / 50.0::DOUBLE AS dt_s, CASE WHEN n_chars > 3000 THEN 'LongDoc' END AS error FROM documents)"


def _chains(spark, d):
    docs = fx.table(spark, d, "documents").withColumnRenamed("doc_id", "id")
    fl = docs.select("id", F.col("text").alias("caption"), (F.col("n_chars") / 100.0).alias("dt_s"), F.when(F.col("n_chars") < 200, "ShortDoc").alias("error"))
    qw = docs.select("id", F.concat(F.upper("lang"), F.lit(" "), F.col("text")).alias("short"), (F.col("n_chars") / 50.0).alias("dt_s"), F.when(F.col("n_chars") > 3000, "LongDoc").alias("error"))
    return docs.select("id"), fl, qw


@query("merge_chains", f"WITH {_CHAINS} SELECT d.doc_id AS id, f.caption AS caption, q.short AS short, f.id IS NOT NULL AND q.id IS NOT NULL AS both_ok FROM documents d LEFT JOIN fl f ON f.id = d.doc_id AND f.error IS NULL LEFT JOIN qw q ON q.id = d.doc_id AND q.error IS NULL")
def _(spark, d):
    work, fl, qw = _chains(spark, d)
    return legacy.merge_chains(work, {"fl": fl, "qw": qw}).select("id", "fl.caption", "qw.short", (F.col("fl").isNotNull() & F.col("qw").isNotNull()).alias("both_ok"))


@query("chain_coverage", f"WITH {_CHAINS} SELECT (SELECT count(*) FROM documents) AS n_work, count(*) AS n_ok, median(dt_s) AS median_s FROM fl WHERE error IS NULL")
def _(spark, d):
    work, fl, _ = _chains(spark, d)
    return legacy.coverage(work, fl)


@query("all_chains_sample", f"WITH {_CHAINS} SELECT f.id AS id FROM fl f JOIN qw q USING (id) WHERE f.error IS NULL AND q.error IS NULL ORDER BY id LIMIT 6")
def _(spark, d):
    work, fl, qw = _chains(spark, d)
    return legacy.merge_chains(work, {"fl": fl, "qw": qw}).where("fl is not null and qw is not null").orderBy("id").limit(6).select("id")


_CF = "cf AS (SELECT n_chars % 200 AS wa, n_chars % 90 AS wb, doc_id % 24 AS pa, doc_id % 9 AS pb, doc_id % 40 AS ba, doc_id % 11 AS bb, n_chars > 3000 AS truncated FROM documents)"


@query("crossfeed_stats", f"WITH {_CF} SELECT count(*) AS n, round(avg(wa), 6) AS words_a, round(avg(wb), 6) AS words_b, round(avg(pa), 6) AS phrases_a, round(avg(pb), 6) AS phrases_b, round(avg(ba), 6) AS boxes_a, round(avg(bb), 6) AS boxes_b, count(*) FILTER (WHERE pa > pb) AS wins, median(pa - pb) AS median_gain, count(*) FILTER (WHERE truncated) AS n_truncated FROM cf")
def _(spark, d):
    names = {"words_a": ("n_chars", 200), "words_b": ("n_chars", 90), "phrases_a": ("doc_id", 24), "phrases_b": ("doc_id", 9), "boxes_a": ("doc_id", 40), "boxes_b": ("doc_id", 11)}
    rows = fx.table(spark, d, "documents").select(*((F.col(c) % n).alias(k) for k, (c, n) in names.items()), (F.col("n_chars") > 3000).alias("truncated"))
    return _rounded(legacy.crossfeed(rows))


@query("variants_side_by_side", f"WITH {sql.FIXTURE}, {sql.cleaned('c', 'c_')}, {sql.cleaned('rec', 'r_')} SELECT 'doc/' || d.doc_id AS path, (SELECT count(*) FROM c_kept q WHERE q.doc_id = d.doc_id) AS n_c, (SELECT count(*) FROM r_kept q WHERE q.doc_id = d.doc_id) AS n_rec FROM (SELECT DISTINCT doc_id FROM fx) d")
def _(spark, d):
    base = fx.grounding(spark, d)
    both = legacy.variants_side_by_side({n: clean.clean(base, PROFILES[n]) for n in ("c", "rec")})
    return both.select("path", F.size("c").alias("n_c"), F.size("rec").alias("n_rec"))


@query("phrase_jaccard", f"WITH {sql.FIXTURE}, {sql.cleaned('c', 'c_')}, {sql.cleaned('rec', 'r_')}, j AS (SELECT doc_id, (SELECT coalesce(list(phrase), []) FROM c_kept q WHERE q.doc_id = d.doc_id) AS a, (SELECT coalesce(list(phrase), []) FROM r_kept q WHERE q.doc_id = d.doc_id) AS b FROM (SELECT DISTINCT doc_id FROM fx) d) SELECT count(*) AS n, round(avg(CASE WHEN len(a) + len(b) = 0 THEN 1.0 ELSE len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) END), 6) AS jaccard FROM j")
def _(spark, d):
    base = fx.grounding(spark, d)
    both = legacy.variants_side_by_side({n: clean.clean(base, PROFILES[n]) for n in ("c", "rec")})
    return _rounded(legacy.jaccard(both, "c", "rec"))


@query("needed_captions", f"WITH {sql.FIXTURE} SELECT 'doc/' || doc_id AS path, n_chars < 200 AS failed FROM documents WHERE doc_id IN (SELECT doc_id FROM fx)")
def _(spark, d):
    return clean.needed_captions(fx.captions(spark, d), fx.grounding(spark, d)).select("path", F.col("error").isNotNull().alias("failed"))


_HITS = f"{sql.rec()}, h AS (SELECT doc_id, k, phrase, rule FROM cells)"


@query("rule_hits_per_image", f"{_HITS} SELECT doc_id, rule, count(*) AS n FROM h WHERE rule IS NOT NULL GROUP BY ALL")
def _(spark, d):
    return report.rule_hits(clean.attribution(fx.cleaned(spark, d), "doc_id"), "doc_id")


@query("review_order", f"{_HITS}, t AS (SELECT rule, row_number() OVER (ORDER BY count(*) DESC, rule) AS place FROM h WHERE rule IS NOT NULL GROUP BY rule) SELECT doc_id, k, coalesce(h.rule, 'kept') AS rule, coalesce(place, 99) AS place FROM h LEFT JOIN t ON t.rule = h.rule")
def _(spark, d):
    rows = clean.attribution(fx.cleaned(spark, d), "doc_id").select("doc_id", "k", "rule")
    return report.review_order(rows).select("doc_id", "k", "rule", "place")


@query("sample_verified_only", f"{_VF} SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM vf WHERE verdict = 'YES') ORDER BY md5(doc_id || '|2'), doc_id LIMIT 40")
def _(spark, d):
    seen = fx.verdicts(spark, d).where("verdict = 'YES'").select("doc_id").distinct()
    return sampling.sample(fx.table(spark, d, "documents").select("doc_id").join(seen, "doc_id", "left_semi"), 40, 2, "doc_id")


@query("review_rows", f"WITH {sql.FIXTURE}, {sql.cleaned('rec')}, {sql.VERDICTS}, {_CHAINS} SELECT d.doc_id AS id, f.caption AS caption, (SELECT count(*) FROM vf v WHERE v.doc_id = d.doc_id) AS n_verdicts, (SELECT max(v.verdict) FROM vf v WHERE v.doc_id = d.doc_id AND v.phrase = q.phrase) AS first_verdict FROM documents d LEFT JOIN fl f ON f.id = d.doc_id AND f.error IS NULL LEFT JOIN kept q ON q.doc_id = d.doc_id AND q.k = 0")
def _(spark, d):
    work, fl, _ = _chains(spark, d)
    v = fx.verdicts(spark, d)
    said = v.select(F.col("doc_id").alias("id"), "phrase", "verdict")
    first = v.where("k = 0").select(F.col("doc_id").alias("id"), F.col("phrase").alias("first"))
    rows = legacy.review_rows(legacy.merge_chains(work, {"fl": fl}), first, said)
    return rows.select("id", "fl.caption", F.greatest(F.size(F.coalesce("verdicts", F.create_map().cast("map<string,string>"))), F.lit(0)).alias("n_verdicts"), F.try_element_at("verdicts", F.col("crossfeed.first")).alias("first_verdict"))


# --- streams


@query("stream_latest", f"{_LOG} SELECT seq, path, ok, payload FROM log QUALIFY row_number() OVER (PARTITION BY path ORDER BY ok DESC, seq DESC) = 1")
def _(spark, d):
    from .shared import folder

    log = spark.readStream.schema(fx.table(spark, d, "events").schema).parquet(f"{d}/events.parquet*").select(F.col("event_id").alias("seq"), F.col("user_id").alias("path"), (F.col("event_type") != "error").alias("ok"), F.col("value").alias("payload"))
    out = folder(spark, "latest")
    incremental.latest_stream(log, ["path"], out, f"{out}-state").awaitTermination()
    return incremental.latest(spark, out)


@query("stream_clean", f"WITH {sql.FIXTURE}, {sql.cleaned('rec')} {sql.FLAT.format(p='')}")
def _(spark, d):
    from .shared import folder

    out = folder(spark, "stream")
    fx.grounding(spark, d).write.parquet(f"{out}/in")
    rows = spark.readStream.schema(spark.read.parquet(f"{out}/in").schema).parquet(f"{out}/in")
    incremental.clean_stream(rows, PROFILES["rec"], f"{out}/out", f"{out}/state").awaitTermination()
    return clean.flat(spark.read.parquet(f"{out}/out"), "doc_id")
