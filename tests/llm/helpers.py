"""Small tables and plain re-computations, row by row, to hold the operators against."""

from __future__ import annotations

import random

#: Cases that every operator on texts must take: null ids and texts, empty and long
#: texts, ties, repeated rows.
WORDS = "the river ran over stones while old ships waited for morning tide and nobody spoke of rain again".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + (rng.choice("abcdefgh") if rng.random() < 0.6 else "") for _ in range(n))


def edge_rows() -> list[tuple]:
    rng = random.Random(5)
    long_text = sentence(rng, 4000)
    return [(1, None), (2, ""), (3, "   \n\t "), (4, "One"), (5, "Éa ñandú straße 漢字 🙂 word"), (6, long_text), (7, long_text), (7, long_text), (None, "no id at all here"), (None, None), (8, "a b c d"), (9, "A B  C\nD"), (-3, "a b c d e")]


def frame(spark, rows, schema="doc_id long, text string", clash=True):
    """With a column of the name of an inner one, to see that it does no harm."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, schema)
    return df.withColumns({"key": F.lit("x"), "chunk": F.lit(1), "_id": F.lit(None).cast("string"), "n": F.lit(2)}) if clash else df


def plain_components(nodes, linked) -> dict:
    """node -> smallest node reachable, by comparing all pairs."""
    nodes = sorted(nodes)
    parent = {x: x for x in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                ra, rb = root(a), root(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {x: root(x) for x in nodes}
