import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from framewright.llm import simhash
from framewright.llm.components import connected_components

from .helpers import edge_rows, frame, plain_components, sentence


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def check(spark, rows):
    got = [(r["doc_id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash.components(frame(spark, rows)).collect()]
    assert sorted(g[:2] for g in got if g[0] is not None) == sorted((k, plain_fingerprint(t)) for k, t in rows if k is not None)
    least = {}
    for k, t in rows:
        if k is not None:
            fp = plain_fingerprint(t)
            least[fp] = min(k, least.get(fp, k))
    comp = plain_components({plain_fingerprint(t) for _, t in rows}, lambda a, b: (a ^ b).bit_count() <= 4)
    name = {}
    for fp, c in comp.items():
        if fp in least:
            name[c] = min(least[fp], name.get(c, least[fp]))
    assert all(c == name.get(comp[fp]) for _, fp, c in got)
    assert len(got) == len(rows)
    return got


def test_edges_and_near_copies(spark):
    rng = random.Random(1)
    rows = edge_rows()
    for g in range(6):
        base = sentence(rng, 300).split()
        for k in range(8):
            words = list(base)
            for _ in range(k % 3):
                words[rng.randrange(len(words))] = "swapped"
            rows.append((100 + 10 * g + k, " ".join(words)))
    got = check(spark, rows)
    assert len({c for _, _, c in got}) < len(got)


def test_empty_table(spark):
    assert simhash.components(frame(spark, [])).count() == 0


def test_keep_one(spark):
    rows = [(3, "a b c d"), (5, "A b c d"), (9, "quite another text of words"), (None, "a b c d")]
    docs = frame(spark, rows).withColumns({"_kept": F.lit(1), "row": F.lit(2), "fp": F.lit("x"), "component_id": F.lit(5)})
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 3, 9]


def test_variants_meet_exactly_within_four_bits():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**64, 300, dtype=np.uint64)
    for bits in range(0, 5):
        b = a.copy()
        for i in range(len(b)):
            for bit in rng.choice(64, bits, replace=False):
                b[i] ^= np.uint64(1) << np.uint64(bit)
        va, vb = simhash.variants(a), simhash.variants(b)
        met = va == vb
        assert met.any(axis=1).all()
        assert (simhash.first_meeting(a, b) == met.argmax(axis=1)).all()


def test_dense_bucket_is_cut_into_blocks(spark, monkeypatch):
    """A bucket over BLOCK, read in small batches, gives the same components."""
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**64, 3, dtype=np.uint64) & np.uint64(0xFFFFF_FFFFF_C00000)
    fps = np.unique(np.concatenate([c ^ (np.uint64(1) << rng.integers(22, 64, 90, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(22, 64, 90, dtype=np.uint64)) for c in centres]))
    import pyarrow as pa

    monkeypatch.setattr(simhash, "BLOCK", 32)
    keys = simhash.variants(fps)
    rows = sorted(zip(keys.ravel().tolist(), np.repeat(fps.view(np.int64), 64).tolist()))
    batches = [pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows[i : i + 50]]), pa.array([r[1] for r in rows[i : i + 50]])], ["key", "fp"]) for i in range(0, len(rows), 50)]
    edges, members = set(), {}
    for out in simhash._near_in_buckets(iter(batches)):
        for r in out.to_pylist():
            if r["key"] is None:
                edges.add((r["u"], r["v"]))
            else:
                members.setdefault(r["key"], {}).setdefault(r["block"], []).append(r["u"])
    assert members
    for blocks in members.values():
        assert all(len(b) <= 32 for b in blocks.values())
        for i in blocks:
            for j in blocks:
                if i <= j:
                    t = simhash._near_in_blocks(pa.table({"u": blocks[i] + blocks[j]}))
                    edges |= set(zip(t.column("u").to_pylist(), t.column("v").to_pylist()))
    want = plain_components(fps.view(np.int64).tolist(), lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 4)
    got = plain_components(fps.view(np.int64).tolist(), lambda a, b: (a, b) in edges or (b, a) in edges)
    assert got == want
    df = spark.createDataFrame(sorted(edges), "u long, v long")
    comp = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert all(comp.get(k, k) == v for k, v in want.items())


def test_long_chain(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 101)], "u long, v long")
    comp = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert {comp[i] for i in range(61)} == {0} and comp[101] == 100
    assert connected_components(df.where(F.lit(False))).count() == 0
