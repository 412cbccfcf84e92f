import hashlib
import random
import re

from pyspark.sql import functions as F

from framewright.llm import decontaminate

from .helpers import edge_rows, frame, sentence


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items):
    windows = {}
    for item, text in items:
        w = plain_words(text)
        if item is None or not w:
            continue
        size = min(8, len(w))
        for i in range(len(w) - size + 1):
            windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for k, text in docs:
        w = plain_words(text)
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                own = windows.get(tuple(w[i : i + size]))
                if own:
                    found |= own
                    hit |= set(range(i, i + size))
        out.append((k, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(found) >= 2))
    return out


def cases():
    rng = random.Random(4)
    items = [(i, sentence(rng, rng.randint(5, 40))) for i in range(30)]
    items += [(50, "Tiny Item"), (51, "word"), (52, None), (53, " .,; "), (None, "no id at all here"), (54, "a b c d e f g h"), (54, "h g f e d c b a"), (55, "漢字 🙂"), (56, items[0][1])]
    docs = edge_rows()
    for k in range(60):
        text = sentence(rng, rng.randint(0, 120))
        for _ in range(k % 4):
            w = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(0, len(w) - 9))
            text += " " + "; ".join(w[a : a + rng.randint(4, 30)]).upper() + " " + sentence(rng, 5)
        docs.append((200 + k, text))
    return docs, items


def key(row):
    return str(row)


def test_matches_brute_force_by_broadcast_and_by_shuffle(spark):
    docs, items = cases()
    want = sorted(plain(docs, items), key=key)
    assert sum(r[5] for r in want) > 5
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("size", F.lit("x"))
    for broadcast_bytes in (1 << 20, 0):
        got = decontaminate.contamination(frame(spark, docs), bench, broadcast_bytes=broadcast_bytes).collect()
        assert sorted((tuple(r) for r in got), key=key) == want


def test_a_large_benchmark_is_not_collected(spark, monkeypatch):
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "_by_broadcast", None)
    monkeypatch.setattr(decontaminate, "Index", None)
    got = decontaminate.screen(frame(spark, docs), bench, min_items=1, broadcast_bytes=100)
    assert got.count() == sum(r[3] == 0 for r in plain(docs, items))


def test_columns_of_any_name(spark):
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = frame(spark, docs).withColumns({c: F.lit(f"own {c}") for c in ("_items", "_hit", "_n_words", "items", "row", "uid", "n_hit")})
    clean = [r[0] for r in plain(docs, items) if r[3] == 0]
    for broadcast_bytes in (1 << 20, 0):
        got = decontaminate.screen(df, bench, min_items=1, broadcast_bytes=broadcast_bytes)
        assert got.columns == df.columns
        rows = got.collect()
        assert len(rows) == len(clean) and all(r[c] == f"own {c}" for r in rows for c in ("_items", "_hit", "_n_words", "items", "row", "uid", "n_hit"))


def test_empty_tables_and_screen(spark):
    docs, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    none = bench.where("false")
    for broadcast_bytes in (1 << 20, -1):
        assert {r["n_items"] for r in decontaminate.contamination(frame(spark, docs), none, broadcast_bytes=broadcast_bytes).collect()} == {0}
        assert decontaminate.contamination(frame(spark, []), bench, broadcast_bytes=broadcast_bytes).count() == 0
    df = frame(spark, docs)
    kept = decontaminate.screen(df, bench)
    assert kept.columns == df.columns
    bad = [r[0] for r in plain(docs, items) if r[5]]
    assert kept.count() == len(docs) - len(bad)
