"""Cleaning of groundings: rules on phrases and boxes, attribution, de-duplication.

A grounding is an ARRAY<STRUCT<phrase, boxes ARRAY<ARRAY<DOUBLE>>>>; its order matters.
All rules run inside the row, on arrays, so cleaning shuffles nothing; only the join with
captions does, on path. One ordered CASE decides both what stays and which rule is blamed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as geo
from ..functions import text as txt
from ..plans.profiles import Profile

BOX_RULES = ["dup", "area", "minpx", "ratio", "fullimg", "edge"]
PHRASE_RULES = ["vague", "abstract", "garbled", "words", "nbox", "empty", "xdup"]
NO_BOXES = "array<array<double>>"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def without_repeats(boxes: Column) -> Column:
    """Greedy in order: a box stays if its IoU with every box kept so far is at most 0.9."""
    return F.aggregate(boxes, F.array().cast(NO_BOXES), lambda kept, b: F.when(F.forall(kept, lambda k: geo.iou(b, k) <= geo.SAME), F.concat(kept, F.array(b))).otherwise(kept))


def box_steps(p: Profile, w: Column, h: Column) -> list[tuple[str, object]]:
    """The active rules on boxes, in order: (name, boxes -> boxes)."""
    total = F.coalesce(w, F.lit(0)) * F.coalesce(h, F.lit(0))
    sized = lambda test: lambda b: (total == 0) | test(b)

    def sliver(b):
        touches = (b[0] <= 2) | (b[1] <= 2) | (b[2] >= w - 2) | (b[3] >= h - 2)
        return touches & ((geo.width(b) <= w * 0.06) | (geo.height(b) <= h * 0.06))

    tests = []
    if p.min_area:
        tests.append(("area", sized(lambda b: F.try_divide(geo.area(b), total) >= p.min_area)))
    if p.min_px:
        tests.append(("minpx", lambda b: geo.short_side(b) >= p.min_px))
    if p.max_ratio:
        tests.append(("ratio", lambda b: (geo.short_side(b) > 0) & (F.try_divide(F.greatest(geo.width(b), geo.height(b)), geo.short_side(b)) <= p.max_ratio)))
    if p.max_cover:
        tests.append(("fullimg", sized(lambda b: F.try_divide(geo.area(b), total) <= p.max_cover)))
    if p.edge:
        tests.append(("edge", sized(lambda b: ~sliver(b))))
    keeping = lambda test: lambda boxes: F.filter(boxes, test)
    steps = [(name, keeping(test)) for name, test in tests]
    return [("dup", without_repeats), *steps] if p.dup else steps


def facts(grounding: Column, caption: Column) -> Column:
    """What the rules of any profile ask of each phrase: k, phrase, norm, cw, raw, own (the boxes
    without repeats), and whether it is vague, abstract, and not in the caption: as a string
    (absent), as whole words (apart)."""

    def found(text):
        def compared(c):
            some = (caption != "") & (c["norm"] != "")
            return F.struct(c["k"], c["phrase"], c["norm"], c["cw"], c["raw"], (some & ~text.contains(txt.padded(c["norm"]))).alias("apart"))

        return F.transform(out, compared)

    def judged(c):
        absent = F.when(c["apart"], ~caption.contains(c["norm"])).otherwise(c["apart"])  # whole words are a string, too
        return F.struct(*(c[x] for x in ("k", "phrase", "norm", "cw", "raw")), without_repeats(c["raw"]).alias("own"), txt.is_vague(c["phrase"]).alias("vague"), txt.is_abstract(c["norm"], c["cw"]).alias("abstract"), absent.alias("absent"), c["apart"])

    out = F.transform(grounding, lambda g, k: F.struct(k.alias("k"), txt.strip(g["phrase"]).alias("phrase"), g["boxes"].alias("raw")))
    out = F.transform(out, lambda c: F.struct(c["k"], c["phrase"], txt.norm_phrase(c["phrase"]).alias("norm"), c["raw"]))
    out = F.transform(out, lambda c: F.struct(c["k"], c["phrase"], c["norm"], txt.content_words(c["norm"]).alias("cw"), c["raw"]))
    return F.transform(let(txt.padded(caption), found), judged)


def with_facts(ground: DataFrame) -> DataFrame:
    """``ground`` with ``facts``, for several profiles over one input."""
    return ground.withColumn("facts", facts(F.col("grounding"), F.coalesce("caption", F.lit(""))))


def phrase_rule(c: Column, p: Profile) -> Column:
    """The first rule on phrases that the entry of ``facts`` breaks, or null."""
    rules = []
    if p.vague:
        rules.append(("vague", c["vague"]))
    if p.abstract:
        rules.append(("abstract", c["abstract"]))
    if p.garbled:
        rules.append(("garbled", c["apart"] if p.whole_words else c["absent"]))
    rules.append(("words", F.size(c["cw"]) < p.min_words))
    if p.max_boxes:
        rules.append(("nbox", F.size(c["raw"]) > p.max_boxes))
    return reduce(lambda case, rule: case.when(rule[1], rule[0]), rules[1:], F.when(rules[0][1], rules[0][0]))


def cells(facts: Column, w: Column, h: Column, p: Profile) -> Column:
    """One entry for each phrase: k, phrase, norm, cw, raw, rule, by, boxes and n_<rule> for
    each rule on boxes. ``by``: for rule "empty", the rule that took the last box."""
    steps = dict(box_steps(p, w, h))
    no_name = F.lit(None).cast("string")

    def begun(c):
        """Only what the steps change: each of them copies all that it hands on."""
        free = phrase_rule(c, p).isNull()
        if not p.dup:
            return F.struct(F.when(free, c["raw"]).alias("after"), no_name.alias("by"))
        lost = F.coalesce(F.when(free, F.size(c["raw"]) - F.size(c["own"])), F.lit(0))
        return F.struct(lost.alias("n_dup"), F.when(free, c["own"]).alias("after"), F.when(free & (F.size(c["own"]) == 0), "dup").otherwise(no_name).alias("by"))

    def take(name, done):
        """The step of one rule: what it leaves, how many it took, whether it took the last."""

        def stepped(c):
            return F.struct(*(c[f"n_{d}"] for d in done), c["after"].alias("before"), steps[name](c["after"]).alias("after"), c["by"])

        def counted(c):
            lost = F.coalesce(F.size(c["before"]) - F.size(c["after"]), F.lit(0))
            by = F.when(c["by"].isNull() & (F.size(c["after"]) == 0), name).otherwise(c["by"])
            return F.struct(*(c[f"n_{d}"] for d in done), lost.alias(f"n_{name}"), c["after"], by.alias("by"))

        return stepped, counted

    out, names = F.transform(facts, begun), list(steps)
    for i, name in enumerate(names):  # each step reads what the one before has left, once
        if name != "dup":
            stepped, counted = take(name, names[:i])
            out = F.transform(F.transform(out, stepped), counted)

    def finished(ends):
        def entry(c, i):
            rule, end = phrase_rule(c, p), F.get(ends, i)
            empty = rule.isNull() & (F.size(end["after"]) == 0)
            counts = [(end[f"n_{r}"] if r in steps else F.lit(0)).alias(f"n_{r}") for r in BOX_RULES]
            return F.struct(c["k"], c["phrase"], c["norm"], c["cw"], c["raw"], F.when(empty, "empty").otherwise(rule).alias("rule"), F.when(empty, end["by"]).alias("by"), end["after"].alias("boxes"), *counts)

        return F.transform(facts, entry)

    return let(out, finished)


def survivors(of: Column) -> Column:
    """Entries that no rule takes, as k, phrase, cw, boxes. If stripping has made two
    phrases one, it has the place of the first and the boxes of the last."""

    def merged(own, names):
        def of_name(name):
            def entry(same):
                first, last = F.element_at(same, 1), F.element_at(same, -1)
                return F.struct(first["k"].alias("k"), name.alias("phrase"), first["cw"].alias("cw"), last["boxes"].alias("boxes"))

            return let(F.filter(own, lambda c: c["phrase"] == name), entry)

        return F.when(F.size(names) == F.size(own), own).otherwise(F.transform(names, of_name))

    free = F.transform(F.filter(of, lambda c: c["rule"].isNull()), lambda c: F.struct(c["k"], c["phrase"], c["cw"], c["boxes"]))
    return let(free, lambda own: let(F.array_distinct(F.transform(own, lambda c: c["phrase"])), lambda names: merged(own, names)))


def without_synonyms(of: Column) -> Column:
    """Of phrases with one set of content words and boxes that nearly coincide, the most
    complete stays. Groups come in order of their first phrase, and so do results."""

    def repeats(kept, c):
        return F.exists(kept, lambda k: F.exists(k["boxes"], lambda q: F.exists(c["boxes"], lambda b: geo.iou(b, q) > geo.SAME)))

    def order(x, y):
        return F.when(x["a"] != y["a"], x["a"] - y["a"]).when(x["b"] != y["b"], x["b"] - y["b"]).otherwise(x["k"] - y["k"])

    def folded(same):
        none = F.filter(same, lambda c: F.lit(False))
        fold = F.aggregate(F.array_sort(same, order), none, lambda kept, c: F.when(repeats(kept, c), kept).otherwise(F.concat(kept, F.array(c))))
        return F.when(F.size(same) == 1, same).otherwise(fold)

    def chosen(keyed, keys):
        best = lambda key: let(F.filter(keyed, lambda c: c["key"] == key), folded)
        return F.when(F.size(keys) == F.size(keyed), keyed).otherwise(F.flatten(F.transform(keys, best)))

    keyed = F.transform(of, lambda c: F.struct(F.concat_ws(" ", F.array_sort(F.array_distinct(c["cw"]))).alias("key"), (-F.size(c["cw"])).alias("a"), (-F.length(c["phrase"])).alias("b"), c["k"], c["phrase"], c["cw"], c["boxes"]))
    picked = let(keyed, lambda own: let(F.array_distinct(F.transform(own, lambda c: c["key"])), lambda keys: chosen(own, keys)))
    return F.transform(picked, lambda c: F.struct(c["k"], c["phrase"], c["cw"], c["boxes"]))


def clean(ground: DataFrame, p: Profile, limit: int = 0) -> DataFrame:
    """``ground`` (path, grounding, img_w, img_h, caption: normalised, "" if none) -> the
    same with ``cells`` and ``kept`` (k, phrase, cw, boxes in final order). Rows with an
    error or without phrases go; rows that lose all phrases stay, with none. ``facts`` that are
    there already (``with_facts``) are taken, and go."""
    if "error" in ground.columns:
        ground = ground.where("error is null")
    rows = ground.where(F.size("grounding") > 0)
    if limit:
        rows = rows.orderBy(*(c for c in ("shard_file", "seq", "path") if c in rows.columns)).limit(limit)
    rows = rows if "facts" in rows.columns else with_facts(rows)
    rows = rows.withColumn("cells", cells(F.col("facts"), F.col("img_w"), F.col("img_h"), p)).drop("facts")
    rows = rows.withColumn("kept", survivors(F.col("cells")))
    if not p.xdup:
        return rows
    before = F.transform("kept", lambda c: c["phrase"])
    rows = rows.withColumn("before", before).withColumn("kept", without_synonyms(F.col("kept")))
    lost = F.array_except("before", F.transform("kept", lambda c: c["phrase"]))
    # worked out once a row: inside the lambda it would be once a phrase, with all that it is made of
    blamed = let(lost, lambda gone: F.transform("cells", lambda c: F.when(c["rule"].isNull() & F.array_contains(gone, c["phrase"]), c.withField("rule", F.lit("xdup"))).otherwise(c)))
    return rows.withColumn("cells", blamed).drop("before")


def with_captions(ground: DataFrame, captions: DataFrame) -> DataFrame:
    """Left join of the normalised caption on path; none: "", which turns rule garbled off.
    ``captions`` has one row a path: compact it first."""
    own = captions.where("gemma_dense is not null and gemma_dense <> ''").select("path", txt.norm_phrase(F.col("gemma_dense")).alias("caption"))
    return ground.join(own, "path", "left").withColumn("caption", F.coalesce("caption", F.lit("")))


def output(cleaned: DataFrame) -> DataFrame:
    """The record for the sink: grounding, n_phrase, n_box."""
    grounding = F.transform("kept", lambda c: F.struct(c["phrase"], c["boxes"]))
    n_box = F.aggregate("kept", F.lit(0), lambda n, c: n + F.size(c["boxes"]))
    keep = [c for c in ("id", "shard", "path", "img_w", "img_h") if c in cleaned.columns]
    return cleaned.select(*keep, grounding.alias("grounding"), F.size("kept").alias("n_phrase"), n_box.alias("n_box"))


def entries(cleaned: DataFrame, column: str, *ids: str) -> DataFrame:
    """ids, k, c: one row for each entry of an array. From an inner explode Spark would derive a
    filter on the array's size, which works out the whole array, and so the cleaning, once more."""
    return cleaned.select(*ids, F.posexplode_outer(column).alias("k", "c")).where("k is not null")


def flat(cleaned: DataFrame, *ids: str) -> DataFrame:
    """ids, k, phrase, j, x0, y0, x1, y1: one row for each box that stays; k is the new ordinal."""
    rows = entries(cleaned, "kept", *ids).select(*ids, "k", F.col("c.phrase").alias("phrase"), F.posexplode("c.boxes").alias("j", "b"))
    return rows.select(*ids, "k", "phrase", "j", *(F.col("b")[i].alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))))


def attribution(cleaned: DataFrame, *ids: str) -> DataFrame:
    """ids, k, phrase, rule (or "kept"), by, note for each phrase of the input. ``by`` names
    the rule on boxes behind "empty"; ``note`` says what it has found."""
    c = F.col("c")
    total = F.col("img_w") * F.col("img_h")
    most = lambda f: F.array_max(F.transform(c["raw"], f))
    least = lambda f: F.array_min(F.transform(c["raw"], f))
    percent = lambda x, n: F.format_number(F.round(x * 100, n), n)
    why = F.coalesce(c["by"], c["rule"])
    note = (
        F.when((why == "abstract") & (F.size(c["cw"]) > 0), F.concat(F.lit("head word "), F.element_at(c["cw"], -1)))
        .when(why == "words", F.concat(F.size(c["cw"]).cast("string"), F.lit(" content words")))
        .when(why == "area", F.concat(F.lit("largest box covers "), percent(F.try_divide(most(geo.area), total), 2), F.lit(" %")))
        .when(why == "minpx", F.concat(F.lit("longest short side "), most(geo.short_side).cast("long").cast("string"), F.lit(" px")))
        .when(why == "fullimg", F.concat(F.lit("box covers "), percent(F.try_divide(least(geo.area), total), 0), F.lit(" %")))
        .when(why == "xdup", F.lit("a more complete phrase stays"))
        .otherwise(F.lit(""))
    )
    return entries(cleaned, "cells", *ids, "img_w", "img_h").select(*ids, c["k"].alias("k"), c["phrase"].alias("phrase"), F.coalesce(c["rule"], F.lit("kept")).alias("rule"), c["by"].alias("by"), note.alias("note"))


def counters(cleaned: DataFrame) -> DataFrame:
    """rule, unit, n: boxes taken by the rules on boxes, phrases by the others; most common
    first. Partial sums leave each task, one row for each rule."""
    count = lambda f: F.sum(F.aggregate("cells", F.lit(0).cast("long"), lambda n, c: n + f(c)))
    sums = [count(lambda c, r=r: F.coalesce(c[f"n_{r}"], F.lit(0)).cast("long")).alias(r) for r in BOX_RULES]
    sums += [count(lambda c, r=r: F.when(c["rule"] == r, 1).otherwise(0).cast("long")).alias(r) for r in PHRASE_RULES]
    row = cleaned.agg(*sums)
    units = ", ".join(f"'{r}', '{'box' if r in BOX_RULES else 'phrase'}', coalesce({r}, 0L)" for r in [*BOX_RULES, *PHRASE_RULES])
    return row.selectExpr(f"stack({len(BOX_RULES) + len(PHRASE_RULES)}, {units}) as (rule, unit, n)").where("n > 0").orderBy(F.desc("n"), "rule")


def needed_captions(captions: DataFrame, ground: DataFrame) -> DataFrame:
    """Captions of the paths that ``ground`` has; the keys meet their like before the join."""
    return captions.join(ground.select("path").distinct(), "path", "left_semi")
