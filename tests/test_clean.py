"""Rules, folds and attribution against plain replays, and hand-written edge rows."""

import random

from pyspark.sql import functions as F

from framewright.operators import clean, report
from framewright.plans import fixtures
from framewright.plans.profiles import PROFILES, Profile

SCHEMA = "path string, img_w int, img_h int, caption string, grounding array<struct<phrase: string, boxes: array<array<double>>>>"


def run(spark, entries, profile, caption="", w=640, h=480):
    df = spark.createDataFrame([("p", w, h, caption, entries)], SCHEMA)
    row = clean.clean(df, profile).collect()[0]
    return [(c["phrase"], [list(b) for b in c["boxes"]]) for c in row["kept"]], {c["phrase"]: c["rule"] for c in row["cells"]}, row


def overlap(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    if w <= 0 or h <= 0:
        return 0.0
    both = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - w * h
    return w * h / both if both > 0 else 0.0


def test_dedup_replay(spark):
    rng = random.Random(1)
    cases = []
    for _ in range(300):
        base = [[float(rng.randint(0, 20)), float(rng.randint(0, 20)), float(rng.randint(100, 120)), float(rng.randint(100, 120))] for _ in range(3)]
        cases.append([[x + rng.choice([0, 0, 1, 2, 5]) for x in rng.choice(base)] for _ in range(rng.randint(0, 8))])
    cases.append([[0.0, 0.0, 10.0, 10.0], [0.0, 0.0, 10.0, 9.0], [0.0, 0.0, 10.0, 8.9]])  # exactly 0.9, and just under
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, boxes array<array<double>>")
    for r in df.select("i", clean.without_repeats(F.col("boxes")).alias("kept")).collect():
        kept = []
        for b in cases[r["i"]]:
            if all(overlap(b, k) <= 0.9 for k in kept):
                kept.append(b)
        assert [list(b) for b in r["kept"]] == kept


def test_synonyms_replay(spark):
    rng = random.Random(2)
    words = ["red", "car", "the", "dog", "a", "Dog", "old"]
    rows = []
    for i in range(150):
        names = list(dict.fromkeys(" ".join(rng.choice(words) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 9))))
        boxes = lambda: [[float(rng.choice([0, 200])), 0.0, float(rng.choice([100, 300, 400])), float(rng.choice([90, 95, 100]))] for _ in range(rng.randint(1, 3))]
        rows.append((str(i), 640, 480, "", [(n, boxes()) for n in names]))
    p = Profile(vague=False, garbled=False, min_words=0, dup=False, xdup=True)
    stop = "a an the of in on at to for with and or its his her their this that these those".split()
    content = lambda s: [w for w in s.lower().split() if w not in stop]
    got = {r["path"]: [c["phrase"] for c in r["kept"]] for r in clean.clean(spark.createDataFrame(rows, SCHEMA), p).collect()}
    for path, _, _, _, entries in rows:
        table, groups, want = dict(entries), {}, []
        for name in table:
            groups.setdefault(frozenset(content(name)), []).append(name)
        for own in groups.values():
            if len(own) > 1:
                own.sort(key=lambda s: (-len(content(s)), -len(s)))
            seen = []
            for name in own:
                if not any(overlap(b, k) > 0.9 for b in table[name] for k in seen):
                    want.append(name)
                    seen += table[name]
        assert got[path] == want


def test_golden_counters_of_the_fixture(spark):
    df = fixtures.cleaned(spark, "/root/testdata/sf0.01")
    n = {r["rule"]: r["n"] for r in clean.counters(df).collect()}
    assert n == {"vague": 712, "abstract": 471, "garbled": 796, "words": 268, "dup": 4553, "fullimg": 313, "edge": 427, "empty": 600, "xdup": 554}


def test_edge_rows(spark):
    box = [[10.0, 10.0, 100.0, 100.0]]
    kept, rules, _ = run(spark, [("  the moon ", box), ("!!", box), ("the of", box), ("The Image", box), ("theimage", box), ("studio shot", box), ("close-up", box), ("gone", []), ("a view", box)], Profile(abstract=True))
    assert kept == [("the moon", box)]
    assert rules == {"the moon": None, "!!": "words", "the of": "words", "The Image": "vague", "theimage": "vague", "studio shot": "abstract", "close-up": "abstract", "gone": "empty", "a view": "vague"}
    # stripping makes two phrases one: the first place, the last boxes
    other = [[0.0, 0.0, 50.0, 60.0]]
    kept, _, _ = run(spark, [("dog", box), ("cat", box), ("dog ", other)], Profile())
    assert kept == [("dog", other), ("cat", box)]
    # no size of the image turns area, cover and edge off, but not the shortest side
    strip = [[0.0, 0.0, 640.0, 5.0]]
    assert run(spark, [("line", strip)], PROFILES["rec"], w=0, h=0)[0] and not run(spark, [("line", strip)], PROFILES["rec"])[0]
    assert not run(spark, [("line", strip)], PROFILES["minpx"], w=0, h=0)[0]
    # captions: in it, in it as part of a word, empty
    assert run(spark, [("oat", box)], Profile(), "a boat")[0] and not run(spark, [("oat", box)], Profile(whole_words=True), "a boat")[0]
    assert run(spark, [("oat", box)], Profile(whole_words=True), "")[0]
    # inverted and flat boxes have no area and no overlap
    odd = [[50.0, 50.0, 10.0, 10.0], [5.0, 5.0, 5.0, 5.0]]
    assert run(spark, [("odd", odd)], Profile())[0] == [("odd", odd)]
    assert run(spark, [("odd", odd)], Profile(max_ratio=8.0))[0] == [("odd", odd[:1])]


def test_kept_and_dropped_add_up(spark):
    for name in ("rec", "all", "old"):
        for r in fixtures.cleaned(spark, "/root/testdata/sf0.001", name).select("grounding", "cells", "kept").limit(60).collect():
            assert len(r["cells"]) == len(r["grounding"])
            assert sum(c["rule"] is None for c in r["cells"]) >= len(r["kept"])


def test_failed_and_empty_rows_go_rows_without_phrases_stay(spark):
    rows = [("a", 1, 1, "", [], None), ("b", 1, 1, "", [("the image", [[0.0, 0.0, 1.0, 1.0]])], None), ("c", 1, 1, "", [("dog", [[0.0, 0.0, 1.0, 1.0]])], "E")]
    out = clean.output(clean.clean(spark.createDataFrame(rows, SCHEMA + ", error string"), PROFILES["rec"])).collect()
    assert [(r["path"], r["n_phrase"], r["n_box"]) for r in out] == [("b", 0, 0)]


def test_published_calibration(spark):
    from framewright.operators.calibrate import calibration

    rows = [("YES", "YES")] * 48 + [("YES", "NO")] * 2 + [("NO", "YES")] * 21 + [("NO", "NO")] * 29 + [("NO", "UNSURE"), ("YES", None)]
    r = calibration(spark.createDataFrame(rows, "auto string, human string"), 7425, 3165).collect()[0]
    assert [round(100 * r[c], 2) for c in ("precision", "accuracy", "low", "high", "a_low", "a_high", "b_low", "b_high")] == [79.86, 84.64, 69.45, 86.01, 86.54, 98.9, 29.37, 55.77]
    assert r["reading"] == "conservative"


def test_markdown(spark):
    assert report.markdown(spark.createDataFrame([("a", 1.5), (None, 2.0)], "x string, y double")) == "| x | y |\n|---|---|\n| a | 1.5 |\n|  | 2 |"
