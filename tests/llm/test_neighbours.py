import numpy as np
import pytest

from framewright.llm import neighbours

from .helpers import plain_components


def plain(rows, least=0.9):
    good = {}
    for k, (i, v) in enumerate(rows):
        if v and None not in v and np.isfinite(v).all() and np.any(v):
            x = np.array(v, float)
            good[k] = x / np.linalg.norm(x)
    hit = lambda a, b: len(good[a]) == len(good[b]) and float(good[a] @ good[b]) >= least
    comp = plain_components(good, hit)
    out = []
    for k, (i, _) in enumerate(rows):
        n = sum(hit(k, j) for j in good if j != k) if k in good else 0
        ids = [rows[j][0] for j in good if k in good and comp[j] == comp[k] and rows[j][0] is not None]
        c = (min(ids) if ids else None) if k in good else i
        out.append((i, n, c, i is not None and i == c))
    return sorted(out, key=str)


def cases():
    rng = np.random.default_rng(4)
    rows = [(k, rng.normal(size=24).tolist()) for k in range(300)]
    for g in range(12):
        base = rng.normal(size=24)
        for k in range(15):
            rows.append((1000 + 20 * g + k, (base + rng.normal(size=24) * 0.1 * (k % 5)).tolist()))
    hot = rng.normal(size=24)
    rows += [(2000 + k, hot.tolist()) for k in range(60)] + [(2100 + k, (hot * (k + 1)).tolist()) for k in range(5)]
    rows += [(-1, None), (-2, []), (-3, [0.0] * 24), (-4, [None, *[1.0] * 23]), (-5, [float("nan")] * 24), (-6, [float("inf"), *[1.0] * 23]), (-7, [1.0] * 5), (-8, [1.0] * 5), (None, hot.tolist()), (None, None), (-9, [1e-30] * 24), (-10, [1e30] * 24), (5, rows[5][1]), (5, rows[5][1])]
    return rows


def test_matches_brute_force(spark, monkeypatch):
    rows = cases()
    monkeypatch.setattr(neighbours, "MEMBERS", 16)
    monkeypatch.setattr(neighbours, "QUERIES", 32)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as label", "'x' as list", "0 as cls")
    got = sorted((tuple(r) for r in neighbours.near_duplicates(df).collect()), key=str)
    want = plain(rows)
    found, all_links = sum(r[1] for r in got), sum(r[1] for r in want)
    assert len(got) == len(want) and 0.97 * all_links <= found <= all_links
    assert sum(a == b for a, b in zip(got, want)) >= 0.97 * len(want)
    # groups of equal directions, and rows that have none, are exact
    exact = {r[0] for r in rows if r[0] is not None and (r[0] < 0 or r[0] >= 2000)}
    assert [r for r in got if r[0] in exact] == [r for r in want if r[0] in exact]


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.near_duplicates(df).count() == 0


def test_spanning_connects_what_is_linked():
    rng = np.random.default_rng(1)
    for density in (0.02, 0.2, 0.9):
        hit = rng.random((40, 30)) < density
        nodes = [("r", i) for i in range(40)] + [("c", j) for j in range(30)]
        pairs = set(neighbours.spanning(hit))
        assert len(pairs) <= 70 and all(hit[i, j] for i, j in pairs)
        both = lambda m: plain_components(nodes, lambda a, b: a[0] != b[0] and m(*((b[1], a[1]) if a[0] == "c" else (a[1], b[1]))))
        assert both(lambda i, j: hit[i, j]) == both(lambda i, j: (i, j) in pairs)


def linked_pairs(rng, n, width, cosine=0.92, spectrum=1.0):
    """n random unit vectors, and for each of the first n // 10 one at that cosine."""
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    x = unit(rng.normal(size=(n, width)) * spectrum)
    z = rng.normal(size=(n // 10, width)) * spectrum
    z = unit(z - (z * x[: n // 10]).sum(1, keepdims=True) * x[: n // 10])
    return x, cosine * x[: n // 10] + np.sqrt(1 - cosine**2) * z


def recall(x, q, index):
    """Of the links between x and q by brute force, the shares that probes and codes leave; the
    share of (query, member) pairs that is read, and that of these compared exactly."""
    of, codes, reach = index.encode(x)
    i, j = np.nonzero(q @ x.T >= 0.9)
    read = np.zeros((len(q), int(of.max()) + 1), bool)
    row, k = index.probes(q)
    inside = k <= of.max()
    read[row[inside], k[inside]] = True
    passes = q.astype(np.float32) @ index.decode(of, codes).T >= reach
    return read[i, of[j]].mean(), passes[i, j].mean(), read[:, of].mean(), passes.mean()


SPECTRA = {"even": lambda w: 1.0, "few dimensions": lambda w: np.arange(w) < 16, "skewed": lambda w: 1 / np.arange(1, w + 1) ** 0.5, "steep": lambda w: 1 / np.arange(1, w + 1)}


@pytest.mark.parametrize("sublists", [False, True])
@pytest.mark.parametrize("spectrum", SPECTRA)
def test_recall_of_probes_and_codes(monkeypatch, sublists, spectrum):
    if sublists:
        monkeypatch.setattr(neighbours, "LIST", 8)
    rng = np.random.default_rng(9)
    for width in (64, 128, 384, 768):
        x, q = linked_pairs(rng, 2000, width, spectrum=SPECTRA[spectrum](width))
        index = neighbours.Index(x, len(x), 0.9)
        assert (index.parts > 1) == sublists
        probes, codes, _, _ = recall(x, q, index)
        assert probes >= 0.99 and codes >= 0.99, (width, probes, codes)


def test_links_in_one_direction_that_data_lack():
    """Noise of single components, and along one that all vectors share."""
    rng = np.random.default_rng(3)
    x, _ = linked_pairs(rng, 2000, 128)
    for component in (rng.integers(0, 128, 400), np.full(400, 5)):
        q = 0.93 * x[:400]
        q[np.arange(400), component] += np.sqrt(1 - 0.93**2) * rng.choice([-1, 1], 400)
        q /= np.linalg.norm(q, axis=1, keepdims=True)
        probes, codes, _, _ = recall(x, q, neighbours.Index(x, len(x), 0.9))
        assert probes >= 0.97 and codes >= 0.97


def test_less_is_read_of_long_vectors():
    """Where vectors fill their dimensions, most lists and members are left out."""
    rng = np.random.default_rng(4)
    x, q = linked_pairs(rng, 4000, 768)
    _, _, read, compared = recall(x, q, neighbours.Index(x, 4000, 0.9))
    assert compared < 0.02 and read < 0.3


def test_links_against_brute_force():
    rng = np.random.default_rng(8)
    x, q = linked_pairs(rng, 1000, 128)
    index = neighbours.Index(x, len(x), 0.9)
    of, codes, reach = index.encode(x)
    hit = index.links(q, x, index.decode(of, codes), reach)
    exact = q @ x.T >= 0.9
    assert not (hit & ~exact).any() and (hit & exact).sum() >= 0.99 * exact.sum()


@pytest.mark.parametrize("dims", [64, 256])
def test_sublists_match_brute_force(spark, monkeypatch, dims):
    """Many sub-lists and small blocks: recall over whole tables, none below the least cosine."""
    rng = np.random.default_rng(10)
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate(linked_pairs(rng, 900, dims)))]
    hot = rng.normal(size=dims)
    rows += [(5000 + k, (hot + rng.normal(size=dims) * 0.2).tolist()) for k in range(80)]
    for name, value in (("LIST", 8), ("MEMBERS", 50), ("QUERIES", 200)):
        monkeypatch.setattr(neighbours, name, value)
    got = sorted(tuple(r) for r in neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    want = sorted(plain(rows))
    assert [r[0] for r in got] == [r[0] for r in want] and all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(r[1] for r in got) >= 0.98 * sum(r[1] for r in want)
    assert sum(g == w for g, w in zip(got, want)) >= 0.95 * len(want)


def test_mixed_lengths(spark, monkeypatch):
    """Rows of other lengths take nothing from the links of the short ones."""
    rng = np.random.default_rng(10)
    rows = []
    for width, n in ((64, 600), (128, 200), (1024, 1)):
        for v in np.concatenate(linked_pairs(rng, n, width)):
            rows.append((len(rows), v.tolist()))
    monkeypatch.setattr(neighbours, "MEMBERS", 100)
    monkeypatch.setattr(neighbours, "QUERIES", 200)
    got = sorted(tuple(r) for r in neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == sorted(plain(rows)) and sum(r[1] for r in got) >= 2 * 80
