import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from framewright.llm import lm

from .helpers import edge_rows, frame, sentence


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def plain(rows):
    """A walk through the automaton, token by token, for each mu and nu; the best ones' scores."""
    held = [zlib.crc32(str("" if k is None else k).encode()) % 10 == 0 for k, _ in rows]
    uni, pair, triple, starts = Counter(), Counter(), Counter(), 0
    for (_, t), h in zip(rows, held):
        if not h:
            starts += 1
            read = ["<s>", *tokens(t)]
            uni.update(read[1:])
            pair.update(zip(read, read[1:]))
            triple.update(zip(read, read[1:], read[2:]))
    n, v = sum(uni.values()), len(uni)
    n1, n2 = sum(c == 1 for c in uni.values()), sum(c == 2 for c in uni.values())
    d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    seen = {("<s>",): starts} | {(w,): c for w, c in uni.items()} | dict(pair)

    def walk(text, mu, nu, less):
        total, state = 0.0, ("<s>",)
        for w in tokens(text):
            weight, at = 1.0, state
            while at:  # fail as long as there is no arc
                arc = max(0, (triple if len(at) == 2 else pair)[*at, w] - less)
                out = max(0, seen[at] - less)
                if arc:
                    break
                weight *= (nu if len(at) == 2 else mu) / (out + (nu if len(at) == 2 else mu))
                at = at[1:]
            c = max(0, uni[w] - less)
            p = (max(c - d, 1e-12) if c else d * v) / max(1, n - less)
            if at:  # the arc's weight has those of the states below in it
                below = max(0, pair[at[-1], w] - less), max(0, seen[at[-1:]] - less)
                p = (below[0] + mu * p) / (below[1] + mu)
                if len(at) == 2:
                    p = (arc + nu * p) / (out + nu)
            total += math.log10(weight * p)
            state = (state[-1:] + (w,)) if state and pair[state[-1], w] else (w,) if uni[w] else ()
        return total

    best = max(((mu, nu) for mu in lm.MUS for nu in lm.NUS), key=lambda x: sum(walk(t, *x, 1) for (_, t), h in zip(rows, held) if not h))
    out = []
    for (k, t), h in zip(rows, held):
        ws = tokens(t)
        base = sum(math.log10((uni[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        out.append((k, h, len(ws), sum(uni[w] > 0 for w in ws), n, base, walk(t, *best, 0)))
    return out


@pytest.mark.parametrize("packed", [True, False])
def test_matches_plain_walk(spark, monkeypatch, packed):
    rng = random.Random(8)
    rows = edge_rows() + [(100 + k, sentence(rng, rng.randint(0, 200))) for k in range(80)] + [(300, sentence(rng, 120))] * 3
    monkeypatch.setattr(lm, "CHUNK", 9_000)
    monkeypatch.setattr(lm, "SHARD_BYTES", 15_000)
    monkeypatch.setattr(lm, "PIECE", 100)
    got = sorted((tuple(r) for r in lm.scores(frame(spark, rows), packed).collect()), key=str)
    want = sorted(plain(rows), key=str)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5]
        assert math.isclose(g[5], w[5], rel_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=1e-9)
    held = [g for g in got if g[1] and g[2] > 50]
    assert sum(g[6] for g in held) > sum(g[5] for g in held)
    # a text that was read three times in training is likelier by far than its words are
    assert all(g[6] > 0.8 * g[5] for g in got if g[0] == 300 and not g[1])


def test_probabilities_of_each_state_sum_to_one():
    """Over all words and the unknown one, after nothing, a word, a pair, an unknown word."""
    rng = random.Random(4)
    texts = [sentence(rng, 30) for _ in range(6)]
    known = sorted({w for t in texts for w in tokens(t)[:-1]})
    pack = lm.Pack(pa.int64())
    ids = [k for k in range(1, 40) if not lm.held_out(k)][:6]
    for k, t in zip(ids, texts):
        pack.add(k, t.encode())
    held = [k for k in range(1, 5000) if lm.held_out(k)]
    starts = ["", texts[0].split()[0], " ".join(texts[0].split()[:2]), "unheard", texts[1].split()[3] + " unheard"]
    for s in starts:
        for w in [*known, "zzz"]:
            pack.add(held.pop(), f"{s} {w}".encode())
        pack.add(held.pop(), s.encode())  # the end
    chunk = lm.Chunk(pack.row(0).to_pylist()[0])
    counts = [chunk.counts(k) for k in range(3)]
    c = counts[0]
    model = lm.Automaton(chunk, counts, [int(c.sum()), int((c > 0).sum()), int((c == 1).sum()), int((c == 2).sum())], 6)
    p = 10 ** model.logs(4.0, 2.0, model.root(), model.path())
    at = np.cumsum(chunk.sizes) - 1  # the end of each text, and the token before
    for k, s in enumerate(starts):
        own = range(6 + k * (len(known) + 2), 6 + (k + 1) * (len(known) + 2))
        total = sum(p[at[i] - 1] for i in own[:-1]) + p[at[own[-1]]]
        assert abs(total - 1) < 1e-9, s


def test_no_training_rows_and_empty_table(spark):
    got = lm.scores(frame(spark, [(None, "a b"), (None, None)])).collect()
    assert [r["train_tokens"] for r in got] == [0, 0] and all(r["held_out"] for r in got)
    assert lm.scores(frame(spark, [])).count() == 0
