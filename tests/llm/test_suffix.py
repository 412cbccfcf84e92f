import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from framewright.llm import suffix

from .helpers import edge_rows, frame, sentence


def plain(texts):
    """(bytes, removed, runs, digest of the rest) of each, by a table of all strings."""
    texts = [(t or "").encode() for t in texts]
    starts = {}
    for d, t in enumerate(texts):
        for i in range(len(t) - 399):
            starts.setdefault(t[i : i + 400], []).append((d, i))
    gone = [np.zeros(len(t), bool) for t in texts]
    for places in starts.values():
        if len(places) > 1:
            for d, i in places:
                gone[d][i : i + 400] = True
    out = []
    for t, g in zip(texts, gone):
        runs = int(g[0]) + int(np.count_nonzero(g[1:] & ~g[:-1])) if len(g) else 0
        out.append((len(t), int(g.sum()), runs, hashlib.sha256(np.frombuffer(t, np.uint8)[~g].tobytes()).hexdigest()))
    return out


def cases():
    rng = random.Random(2)
    passages = [sentence(rng, n) for n in (60, 75, 90, 200, 500)]
    rows = edge_rows()
    for k in range(70):
        parts = [sentence(rng, rng.randint(0, 150))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            a, b = sorted(rng.sample(range(len(p)), 2))
            parts += [p if rng.random() < 0.5 else p[a:b], sentence(rng, rng.randint(0, 60))]
        rows.append((100 + k, " ".join(parts)))
    base = sentence(rng, 500)
    for k in range(12):  # near copies: one word changed
        words = base.split()
        words[rng.randrange(len(words))] = f"changed{k}"
        rows.append((300 + k, " ".join(words)))
    rows += [(400, "ab" * 900), (401, "x" * 399), (402, "y" * 400), (403, "y" * 401), (404, "é" * 300), (405, "z" + "é" * 300), (406, passages[4]), (407, passages[4] + passages[4])]
    return rows


def test_matches_table_of_all_strings(spark, monkeypatch):
    rows = cases()
    want = sorted(str((k, *p)) for (k, _), p in zip(rows, plain([t for _, t in rows])))
    assert sum(p[1] > 0 for p in plain([t for _, t in rows])) > 30
    monkeypatch.setattr(suffix, "CHUNK_BYTES", 40_000)
    monkeypatch.setattr(suffix, "TOGETHER", 9_000)
    got = suffix.repeats(frame(spark, rows)).collect()
    assert sorted(str(tuple(r)) for r in got) == want


def plain_words(texts, length):
    """Texts without words that a string of ``length`` words covers that starts anywhere else too."""
    found = [list(re.finditer(rb"[^\x20\x09-\x0d]+", (t or "").encode())) for t in texts]
    starts = {}
    for d, ms in enumerate(found):
        words = tuple(m[0] for m in ms)
        for i in range(len(words) - length + 1):
            starts.setdefault(words[i : i + length], []).append((d, i))
    gone = [set() for _ in texts]
    for places in starts.values():
        if len(places) > 1:
            for d, i in places:
                gone[d].update(range(i, i + length))
    out = []
    for t, ms, g in zip(texts, found, gone):
        b = (t or "").encode()
        edges = [m.start() for m in ms] + [len(b)]
        out.append((b[: edges[0]] + b"".join(b[edges[k] : edges[k + 1]] for k in range(len(ms)) if k not in g)).decode())
    return out


def test_words_match_table_of_all_runs(spark, monkeypatch):
    monkeypatch.setattr(suffix, "CHUNK_BYTES", 40_000)
    monkeypatch.setattr(suffix, "TOGETHER", 1_500)
    rows = cases() + [(500, "a b c d " * 40), (501, "  x\n" + "b c d a " * 13), (502, " ".join(map(str, range(51)))), (503, "u\t" + "\n".join(map(str, range(51))) + " v"), (504, " ".join(map(str, range(50))))]
    for length in (51, 4, 7):
        want = plain_words([t for _, t in rows], length)
        got = suffix.stripped(frame(spark, rows), length, "words").select("doc_id", "text").collect()
        assert sorted(str((k, w if t is not None else None)) for (k, t), w in zip(rows, want)) == sorted(str(tuple(r)) for r in got)
    assert dict(zip((k for k, _ in rows), plain_words([t for _, t in rows], 51)))[503] == "u\tv"


def test_columns_of_any_name(spark):
    text = "x" * 500
    df = spark.createDataFrame([(1, text, 7, "c"), (2, text, 8, "d"), (3, "y", 9, "e")], "doc_id long, text string, _chunk int, row string").withColumn("chunk", F.lit("k"))
    got = {r["doc_id"]: r for r in suffix.stripped(df).collect()}
    assert {k: (r["text"], r["_chunk"], r["row"], r["chunk"]) for k, r in got.items()} == {1: ("", 7, "c", "k"), 2: ("", 8, "d", "k"), 3: ("y", 9, "e", "k")}


def test_stripped_keeps_columns_and_nulls(spark):
    rows = cases()
    df = frame(spark, rows)
    got = suffix.stripped(df)
    assert got.columns == df.columns
    out = got.collect()
    assert len(out) == len(rows)
    kept = dict((r["doc_id"], r["text"]) for r in out if r["doc_id"] is not None)
    assert kept[1] is None and kept[2] == "" and kept[402] == "" and kept[401] == "x" * 399
    assert "�" not in "".join(t or "" for t in kept.values())


def test_empty_table(spark):
    assert suffix.repeats(frame(spark, [])).count() == 0
