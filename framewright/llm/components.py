"""Connected components of a graph given as an edge table, by alternating large-star
and small-star steps. Each step is an aggregation and a join; nothing is collected,
and each round's edges are written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def _least(rows: DataFrame) -> DataFrame:
    """Written, so that the join that follows has a shuffle of its own on either side: only
    such a join can have the edges of a hub dealt to several tasks."""
    return written(rows, "least")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every edge has u > v here."""
    least = _least(edges.groupBy("u").agg(F.min("v").alias("m")))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) edges -> (node, component): the smallest node that each node of an edge
    reaches. Loops and repeated or reversed edges do no harm; nulls are dropped."""
    edges = edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = written(edges, "edges")
    before = _signature(edges)
    while before[0]:
        edges = written(_small_star(_large_star(edges)), "edges")
        after = _signature(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def with_least(rows: DataFrame, component: str, value: str) -> DataFrame:
    """``rows`` with ``name``, the least non-null ``value`` of their component. Parts of a
    component meet in each task before the shuffle; the names are written, as in ``_least``, so
    that the rows of a large component are dealt to several tasks."""
    names = written(rows.groupBy(component).agg(F.min(value).alias("name")), "names")
    return rows.join(names, component)
