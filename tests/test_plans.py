"""What the optimizer makes of the cleaning: nothing costly is worked out more than once a row."""

from pyspark.sql import functions as F

from framewright.functions import text as txt
from framewright.operators import clean, infer
from framewright.plans import edge_queries, fixtures
from framewright.plans.profiles import PROFILES

SF = "/root/testdata/sf0.001"

SCHEMA = "doc_id long, path string, img_w int, img_h int, caption string, grounding array<struct<phrase: string, boxes: array<array<double>>>>"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def grounded(spark, tmp_path):
    out = str(tmp_path / "ground")
    spark.createDataFrame([(1, "p", 640, 480, "a red car", [("red car", [[1.0, 1.0, 200.0, 200.0]])])], SCHEMA).write.parquet(out)
    return spark.read.parquet(out)


def test_lost_phrases_are_found_once_a_row(spark, tmp_path):
    rows = clean.attribution(clean.clean(grounded(spark, tmp_path), PROFILES["rec"]), "doc_id").select("doc_id", "k", "rule")
    assert [tuple(r) for r in rows.collect()] == [(1, 0, "kept")]
    plan = optimized(rows)
    assert "array_except(" in plan and "array_contains(array_except(" not in plan


def test_no_filter_cleans_once_more(spark, tmp_path):
    cleaned = clean.clean(grounded(spark, tmp_path), PROFILES["rec"])
    for rows in (clean.flat(cleaned, "doc_id"), clean.attribution(cleaned, "doc_id")):
        assert rows.count() == 1
        assert not [line for line in optimized(rows).splitlines() if "Filter" in line and "lambda" in line]


def test_fixture_is_made_inside_the_row(spark):
    plan = optimized(fixtures._grounding(spark, SF))
    assert "Join" not in plan and "Aggregate" not in plan and plan.count("Repartition") == 1


def test_normalised_in_one_pass(spark):
    texts = ["", "  ", "A  b", " \n\tA-b__C9 ", "Été à l'İzmir", "x\u2028y", "é", "a\U0001f600b", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    twice = F.trim(F.regexp_replace(F.regexp_replace(F.lower("t"), "[^a-z0-9 ]", " "), " +", " "))
    assert all(r["a"] == r["b"] for r in df.select(txt.norm_phrase(F.col("t")).alias("a"), twice.alias("b")).collect())
    assert optimized(df.select(txt.norm_phrase(F.col("t")).alias("n"))).count("regexp_replace(") == 1


def test_stored_cleaning_leaves_the_caption(spark):
    assert "caption" not in fixtures.cleaned(spark, SF).columns


def test_profiles_share_the_facts(spark):
    plan = optimized(edge_queries.QUERIES["ablation_profiles"](spark, SF))
    assert "regexp_replace" not in plan


def test_length_order_deals_no_texts(spark):
    plan = optimized(edge_queries.QUERIES["length_order"](spark, SF))
    upper = plan[: plan.index("RepartitionByExpression")]
    assert "text" not in upper and "gemma_dense" not in upper


def test_parts_by_length_are_bounded_in_bytes(spark, monkeypatch):
    monkeypatch.setattr(infer, "PART", 20_000)
    rows = [(f"p{i}", None if i == 5 else " ".join(["word"] * (3 if i % 4 else 1 + i))) for i in range(1500)]
    df = spark.createDataFrame(rows, "path string, gemma_dense string")
    got = [(r["part"], r["path"], r["gemma_dense"]) for r in infer.by_length(df, 2).withColumn("part", F.spark_partition_id()).collect()]
    assert sorted((p, t) for _, p, t in got) == sorted(rows, key=lambda r: r[0])
    of_part, words = {}, {}
    for part, _, t in got:
        of_part[part] = of_part.get(part, 0) + len(t or "")
        words.setdefault(part, []).append(len((t or "").split()))
    assert len(of_part) > 2 and max(of_part.values()) <= 40_000
    assert all(w == sorted(w) for w in words.values())
    edges = [(min(w), max(w)) for _, w in sorted(words.items())]
    assert all(a[1] <= b[0] * 1.02 for a, b in zip(edges, edges[1:]))
    few = infer.by_length(df.limit(3), 2).withColumn("part", F.spark_partition_id()).collect()
    assert len({r["part"] for r in few}) <= 3
    assert infer.by_length(df.limit(0), 2).count() == 0
