import math
import random

import numpy as np
from pyspark.sql import functions as F

from framewright.llm import quality, queries, toxicity

from .helpers import edge_rows, frame, sentence


def toxic_rows(n=400):
    rng, docs, labels = random.Random(3), [], []
    for k in range(n):
        text = ". ".join(sentence(rng, 12) for _ in range(rng.randint(3, 12)))
        bad = k % 4 == 0
        if bad:
            text += f". You {rng.choice(['grumblet', 'snorkface', 'dimwitz'])}{rng.choice(['', 's', 'ish'])} of a neighbour. " + sentence(rng, 10)
        docs.append((k, text))
        labels.append((k, int(bad)))
    return docs, labels


def test_toxicity_is_learned_and_located(spark):
    docs, labels = toxic_rows()
    train = spark.createDataFrame(labels[:300] + [(None, 1), (5000, None)], "doc_id long, toxic int").selectExpr("*", "1 as quality", "'x' as text")
    df = frame(spark, docs)
    model = toxicity.train(df, train)
    got = {r["doc_id"]: r for r in toxicity.score(df, model).collect()}
    held = labels[300:]
    assert sum(got[k]["predicted"] == y for k, y in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    spots = toxicity.locate(df, model).collect()
    hit = [r for r in spots if "You " in r["sentence"]]
    assert len(hit) >= 0.9 * len(spots) and len({r["doc_id"] for r in hit}) >= 90
    kept = toxicity.screen(df, model)
    assert kept.columns == df.columns and kept.count() == sum(r["predicted"] == 0 for r in got.values())


def test_scores_are_the_noisy_or_of_the_sentences(spark):
    """Against the formula, written out: each feature of a sentence counts once, in training and in scoring."""
    docs, labels = toxic_rows(120)
    docs += [(900, "You dimwitz dimwitz DIMWITZ dimwitzen. fine words here"), (901, None), (902, "")]
    df = frame(spark, docs)
    model = toxicity.train(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.score(df, model).collect()}
    for k, text in docs:
        clean, own = 1 - model.leak, []
        for s in toxicity.sentences(text or ""):
            features = {f for w in toxicity.WORD.findall(s.lower()) for f in toxicity.word_features(w)}
            z = sum(model.weights.get(f, 0.0) for f in features)
            p = 1 / (1 + math.exp(-(z + model.bias)))
            clean *= 1 - p
            own += [(p, s.strip())] if p >= 0.3 and features & set(model.weights) else []
        assert math.isclose(got[k]["score"], 1 - clean, rel_tol=1e-9, abs_tol=1e-12)
        assert got[k]["n_located"] == len(own) and (got[k]["worst"] in {s for p, s in own if p == max(own)[0]} if own else got[k]["worst"] is None)
    # training sees the very same features
    (row,) = toxicity.bags(frame(spark, [(1, docs[-3][1])]).selectExpr("text", "1 as label")).collect()
    of, ends = np.frombuffer(row["features"], np.uint32).tolist(), np.frombuffer(row["ends"], np.int32).tolist()
    parts = [set(of[a:b]) for a, b in zip([0, *ends], ends)]
    assert parts == [{f for w in toxicity.WORD.findall(s.lower()) for f in toxicity.word_features(w)} for s in toxicity.sentences(docs[-3][1])]


def test_features_are_chosen_by_their_documents(spark):
    docs, labels = toxic_rows(120)
    bags = toxicity.bags(spark.createDataFrame([(t, y) for (_, t), (_, y) in zip(docs, labels)], "text string, label int"))
    n1 = sum(y for _, y in labels)
    n0 = len(labels) - n1
    has = [({f for w in toxicity.WORD.findall(t.lower()) for f in toxicity.word_features(w)}, y) for (_, t), (_, y) in zip(docs, labels)]
    want = []
    for f in set().union(*(x for x, _ in has)):
        pos, neg = sum(y for x, y in has if f in x), sum(1 - y for x, y in has if f in x)
        odds = math.log((pos + 0.5) / (n1 + 1)) - math.log((neg + 0.5) / (n0 + 1))
        if pos >= 4 and odds >= 2:
            want.append(f)
    assert len(want) > 5
    assert toxicity.chosen_features(bags, n1, n0).tolist() == sorted(want)


def test_rows_without_ids_are_held_out(spark, tmp_path):
    docs, labels = toxic_rows(80)
    frame(spark, [*docs, (None, "You dimwitz"), (None, None)]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, y, 1 - y) for k, y in [*labels, (None, 1)]], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for query in (queries.op7_toxicity, queries.op10_quality):
        rows = query(spark, str(tmp_path)).collect()
        assert len(rows) == 82 and all(r["held_out"] for r in rows if r["doc_id"] is None)
        assert {r["held_out"] for r in rows} == {True, False}


def clashing(df):
    """With columns of the names that the operators use."""
    return df.withColumns({c: F.lit(f"own {c}") for c in ("label", "features", "ends", "score", "predicted", "worst", "n_located", "toxic", "quality", "x", "feature", "pos")})


def test_columns_of_any_name(spark):
    docs, labels = toxic_rows(60)
    df, marked = clashing(frame(spark, docs)), spark.createDataFrame([(k, y, 1 - y) for k, y in labels], "doc_id long, toxic int, quality int")
    marked = marked.withColumns({c: F.lit("x") for c in ("label", "text", "features", "x")})
    model = toxicity.train(df, marked)
    plain_model = toxicity.train(frame(spark, docs), marked.select("doc_id", "toxic"))
    assert model == plain_model
    kept = toxicity.screen(df, model)
    assert kept.columns == df.columns and {r["worst"] for r in kept.collect()} == {"own worst"}
    assert toxicity.score(df, model).count() == 60
    other = quality.train(df, marked)
    assert np.array_equal(other.weights, quality.train(frame(spark, docs), marked.select("doc_id", "quality")).weights)
    assert quality.score(df, other).count() == 60


def test_toxicity_edges(spark):
    docs, labels = toxic_rows(80)
    df = frame(spark, edge_rows())
    model = toxicity.train(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert toxicity.score(df, model).count() == len(edge_rows())
    assert toxicity.score(frame(spark, []), model).count() == 0
    for y in ([], [(1, 1)], [(1, 0), (2, 0)]):  # nothing, or one label only
        m = toxicity.train(df, spark.createDataFrame(y, "doc_id long, toxic int"))
        assert all(0 <= r["score"] <= 1 for r in toxicity.score(df, m).collect())


def quality_rows(n=300):
    rng, docs, labels = random.Random(9), [], []
    for k in range(n):
        text = ". ".join(sentence(rng, 12) for _ in range(8))
        bad = k % 5 == 0
        if bad:
            text = [text.upper().replace(" ", "!! "), text.replace(" ", " | "), " ".join(w for w in text.split()[:20] for _ in range(15))][k % 3]
        docs.append((k, text))
        labels.append((k, int(not bad)))
    return docs, labels


def test_quality_is_learned(spark):
    docs, labels = quality_rows()
    df = frame(spark, docs)
    model = quality.train(df, spark.createDataFrame(labels[:200], "doc_id long, quality int").selectExpr("*", "1 as toxic"))
    got = {r["doc_id"]: r["predicted"] for r in quality.score(df, model).collect()}
    assert sum(got[k] == y for k, y in labels[200:]) >= 95


def test_quality_edges(spark):
    df = frame(spark, edge_rows())
    docs, labels = quality_rows(60)
    model = quality.train(frame(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int"))
    out = quality.score(df, model).collect()
    assert len(out) == len(edge_rows()) and all(0 <= r["score"] <= 1 for r in out)
    assert quality.score(frame(spark, []), model).count() == 0
    for y in ([], [(1, 1)], [(1, 0), (2, 0)]):
        m = quality.train(df, spark.createDataFrame(y, "doc_id long, quality int"))
        assert all(0 <= r["score"] <= 1 for r in quality.score(df, m).collect())


def test_the_cut_is_the_quantile_of_label_0():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1000, len(quality.FEATURES)))
    y = (x[:, 0] > -0.8).astype(float)
    model = quality.fit(x, y)
    assert abs((model.scores(x) < 0.5).mean() - (y == 0).mean()) < 0.002


def test_quality_features_by_plain_counts():
    for text in ("Some WORDS, some 12 words!\nSome WORDS, some 12 words!\n|#% end.", "a", "  ", "Ünï çödé | pipes || here"):
        words, lines = text.split(), [x for x in text.split("\n") if x.strip()]
        got = dict(zip(quality.FEATURES, quality.features(text)))
        if not words:
            assert set(got.values()) == {0.0}
            continue
        size = len(text.encode())
        assert math.isclose(got["log_words"], math.log(1 + len(words))) and math.isclose(got["mean_word"], sum(len(w.encode()) for w in words) / len(words))
        assert math.isclose(got["digit"], sum(c in "0123456789" for c in text) / size) and math.isclose(got["bang"], text.count("!") / len(words)) and math.isclose(got["pipe"], text.count("|") / len(words))
        assert math.isclose(got["top_word"], max(words.count(w) for w in words) / len(words)) and math.isclose(got["repeated_lines"], 1 - len(set(lines)) / len(lines))
        letters = [c for c in text if c.isascii() and c.isalpha()]
        assert math.isclose(got["upper"], sum(c.isupper() for c in letters) / max(1, len(letters))) and math.isclose(got["high_bytes"], sum(b > 127 for b in text.encode()) / size)


def test_quality_scores_and_weights(spark):
    """Scores against the formula; the weights are where the pairwise loss has its least value."""
    docs, labels = quality_rows(120)
    df = frame(spark, docs)
    model = quality.train(df, spark.createDataFrame(labels, "doc_id long, quality int"))
    for r in quality.score(df, model).collect():
        z = sum(w * min(8.0, max(-8.0, (f - m) / s)) for w, f, m, s in zip(model.weights, quality.features(dict(docs)[r["doc_id"]]), model.mean, model.scale))
        assert math.isclose(r["score"], 1 / (1 + math.exp(-(z - model.cut))), rel_tol=1e-9)
    x, y = np.array([quality.features(t) for _, t in docs]), np.array([q for _, q in labels], float)
    z = np.clip((x - x.mean(0)) / (x.std(0) + 1e-6), -8, 8)

    def loss(w):  # over all pairs of a better and a worse document
        d = (z[y == 1] @ w)[:, None] - (z[y == 0] @ w)[None, :]
        return np.logaddexp(0, -d).mean() + 5e-4 * w @ w

    rng = np.random.default_rng(1)
    assert all(loss(model.weights) < loss(model.weights + step) for step in rng.normal(size=(40, len(model.weights))))
