"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is a logistic function of
weights of its words and of their beginnings; the document's is the noisy-or of
its sentences, 1 - prod(1 - p). Only documents have labels, so the noisy-or's
gradient decides which sentences are to blame. Words only add to a score: the
features are those clearly commoner under label 1, with weights of zero or more.
``locate`` returns the sentences
that carry the score; ``score`` has the worst of them.

The model is fitted on a bounded sample of labelled rows (``max_train``, the
smallest by a hash of the id; a sample of labels, all rows of which are read
whole); scoring covers every row and every whole text.

Defined results: a null text is empty and has the model's score of no sentence,
the leak of the noisy-or. Rows with null ids are scored, never trained on (the query calls
them held out). A
repeated row is scored each time. A document with several label rows counts once
for each of them in training; null labels are skipped. An empty or one-sided
training set gives a model that returns the share of label 1. Further columns of
either table, of any name, are ignored.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_remainder, written

MAX_TRAIN = 8_000
N_FEATURES = 6_000
SENTENCE = re.compile(r"[.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)
CACHE = 300_000


def word_features(word: str) -> list[int]:
    """32-bit numbers of a lower-cased word and of its beginnings."""
    out = [zlib.crc32(word.encode())]
    out += [zlib.crc32(b"^" + word[:k].encode()) for k in PREFIXES if len(word) > k]
    return out


def sentences(text: str) -> list[str]:
    return [s for s in SENTENCE.split(text) if s.strip()]


@dataclass
class Model:
    weights: dict[int, float] = field(default_factory=dict)
    bias: float = -8.0
    leak: float = 0.01

    def scorer(self):
        """text -> (score, [(sentence, its own probability)] of the sentences with any weight)."""
        weights, cache = self.weights, {}

        def of_word(w: str) -> tuple[int, ...]:
            v = cache.get(w)
            if v is None:
                if len(cache) >= CACHE:
                    cache.clear()
                v = cache[w] = tuple(f for f in word_features(w) if f in weights)
            return v

        def score(text: str | None) -> tuple[float, list[tuple[str, float]]]:
            log_clean, found = np.log1p(-self.leak), []
            base = float(np.logaddexp(0.0, self.bias))
            for s in sentences(text or ""):
                own = set().union(*map(of_word, WORD.findall(s.lower())))  # each feature once, as in training
                if own:
                    soft = float(np.logaddexp(0.0, sum(weights[f] for f in sorted(own)) + self.bias))
                    log_clean -= soft
                    found.append((s.strip(), 1.0 - float(np.exp(-soft))))
                else:
                    log_clean -= base
            return float(-np.expm1(log_clean)), found

        return score


def bags(df: DataFrame) -> DataFrame:
    """(text, label) -> (label, features, ends): the features of the distinct words
    of each sentence, packed, and where each sentence ends."""

    def pack(batches):
        for batch in batches:
            rows = []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                feats, ends = [], []
                for s in sentences(text or ""):
                    own = {f for w in set(WORD.findall(s.lower())) for f in word_features(w)}
                    feats += own
                    ends.append(len(feats))
                rows.append((label, np.array(feats, np.uint32).tobytes(), np.array(ends, np.int32).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary())], ["label", "features", "ends"])

    return df.mapInArrow(pack, "label int, features binary, ends binary")


def frequencies(packed: DataFrame) -> DataFrame:
    """feature, pos, neg: documents of either label that have each feature."""

    def count(batches):
        for batch in batches:
            own = [np.unique(np.frombuffer(f, np.uint32)) for f in batch.column("features").to_pylist()]
            if not own:
                continue
            label = np.repeat(batch.column("label").to_numpy().astype(float), [len(x) for x in own])
            ids, of = np.unique(np.concatenate(own), return_inverse=True)
            pos = np.bincount(of, weights=label).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int64)), pa.array(pos), pa.array(np.bincount(of) - pos)], ["feature", "pos", "neg"])

    return packed.mapInArrow(count, "feature long, pos long, neg long").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def chosen_features(packed: DataFrame, n1: int, n0: int, n_features: int = N_FEATURES) -> np.ndarray:
    """Those clearly commoner under label 1, sorted; at most ``n_features``."""
    odds = F.log((F.col("pos") + 0.5) / (n1 + 1)) - F.log((F.col("neg") + 0.5) / (n0 + 1))
    rows = frequencies(packed).where((F.col("pos") >= 4) & (odds >= 2.0)).orderBy(F.desc(F.round(odds * F.sqrt("pos"), 9)), "feature").limit(n_features).select("feature").collect()
    return np.sort(np.array([r[0] for r in rows], np.uint32))


def entries(packed: DataFrame, chosen: np.ndarray) -> DataFrame:
    """label, n (sentences), sentence and feature (packed; places of ``chosen``): what the documents have of the chosen features."""
    shared = packed.sparkSession.sparkContext.broadcast(chosen)

    def over(batches):
        chosen = shared.value
        for batch in batches:
            rows = []
            for label, feats, ends in zip(*(batch.column(c).to_pylist() for c in ("label", "features", "ends"))):
                f, e = np.frombuffer(feats, np.uint32), np.frombuffer(ends, np.int32)
                at = np.searchsorted(chosen, f)
                at[at == len(chosen)] = 0
                hit = np.flatnonzero(chosen[at] == f)
                order = np.lexsort((at[hit], of := np.searchsorted(e, hit, side="right")))
                rows.append((label, len(e), of[order].astype(np.int32).tobytes(), at[hit][order].astype(np.int32).tobytes()))
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))], ["label", "n", "sentence", "feature"])

    return packed.mapInArrow(over, "label int, n int, sentence binary, feature binary")


def fit(rows: list[tuple[int, int, bytes, bytes]], chosen: np.ndarray, epochs: int = 150, l2: float = 0.001) -> Model:
    """Fit by gradient descent on the noisy-or's log loss. ``rows`` as of ``entries``; sentences
    without a chosen feature only count."""
    if not rows:
        return Model(leak=0.5)
    y = np.array([r[0] for r in rows], float)
    if y.min() == y.max() or not len(chosen):
        return Model(leak=float(np.clip(y.mean(), 0.01, 0.99)))
    entry_sentence, entry_feature, sentence_doc, plain = [], [], [], np.zeros(len(rows))
    n_sentences = 0
    for d, (_, n, of, feature) in enumerate(rows):
        used, local = np.unique(np.frombuffer(of, np.int32), return_inverse=True)
        entry_sentence.append(local + n_sentences)
        entry_feature.append(np.frombuffer(feature, np.int32))
        sentence_doc.append(np.full(len(used), d))
        n_sentences += len(used)
        plain[d] = n - len(used)
    es, ef, sd = map(np.concatenate, (entry_sentence, entry_feature, sentence_doc))
    w, b, leak = np.zeros(len(chosen)), -5.0, -4.0
    m, v = np.zeros(len(chosen) + 2), np.zeros(len(chosen) + 2)
    for step in range(1, epochs + 1):
        z = np.bincount(es, weights=w[ef], minlength=n_sentences) + b
        soft = np.logaddexp(0.0, z)
        total = np.bincount(sd, weights=soft, minlength=len(y)) + plain * np.logaddexp(0.0, b) + np.logaddexp(0.0, leak)
        total = np.maximum(total, 1e-9)
        # loss: y=1: -log(1-exp(-total)); y=0: total
        slope = np.where(y > 0, -1.0 / np.expm1(np.minimum(total, 500.0)), 1.0) / len(y)
        ds = slope[sd] / (1.0 + np.exp(-z))
        gw = np.bincount(ef, weights=ds[es], minlength=len(w)) + l2 * w / len(w)
        gb = ds.sum() + (slope * plain).sum() / (1.0 + np.exp(-b))
        g = np.concatenate([gw, [gb, slope.sum() / (1.0 + np.exp(-leak))]])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, b, leak = np.maximum(0.0, w - move[:-2]), b - move[-2], leak - move[-1]
    return Model(weights={int(k): float(x) for k, x in zip(chosen, w) if x}, bias=float(b), leak=float(np.clip(1 / (1 + np.exp(-leak)), 1e-6, 0.99)))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_train: int = MAX_TRAIN) -> Model:
    """Fit on at most ``max_train`` labelled rows, those of the smallest hash of the id.
    ``labels`` holds only what may be learned from. The features are counted and chosen by
    the executors; only what the documents have of the chosen ones comes to the driver."""
    marked = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label")).where("_id is not null and label is not null")
    sampled = marked.orderBy(F.xxhash64("_id"), "_id", "label").limit(max_train)
    packed = written(bags(sampled.join(docs.select(F.col("doc_id").alias("_id"), "text"), "_id").select("text", "label")), "bags")
    numbers = {r["label"]: r["count"] for r in packed.groupBy("label").count().collect()}
    chosen = chosen_features(packed, numbers.get(1, 0), sum(numbers.values()) - numbers.get(1, 0)) if len(numbers) > 1 else np.zeros(0, np.uint32)
    rows = entries(packed, chosen).collect() if len(chosen) else packed.select("label", F.lit(0).alias("n"), F.lit(b"").alias("sentence"), F.lit(b"").alias("feature")).collect()
    return fit(sorted((r["label"], r["n"], bytes(r["sentence"]), bytes(r["feature"])) for r in rows), chosen)


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted of every row; n_located, the sentences whose own probability
    reaches ``threshold``, and worst, the one of them that carries most (null if there is none)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def over(batches):
        fn = shared.value.scorer()
        for batch in batches:
            scores, located, worst = [], [], []
            for t in batch.column("text").to_pylist():
                s, found = fn(t)
                own = [x for x in found if x[1] >= threshold]
                scores.append(s)
                located.append(len(own))
                worst.append(max(own, key=lambda x: x[1])[0] if own else None)
            s = np.array(scores, float)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32)), pa.array(located, pa.int64()), pa.array(worst, pa.string())], ["doc_id", "score", "predicted", "n_located", "worst"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(over, f"doc_id {kind}, score double, predicted int, n_located long, worst string")


def screen(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, all columns as they are."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def over(batches):
        fn = shared.value.scorer()
        for batch in batches:
            yield batch.filter(pa.array([fn(t)[0] < threshold for t in batch.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(over, docs.schema)


def locate(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, sentence, score: the sentences with any weight whose own probability reaches ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def over(batches):
        fn = shared.value.scorer()
        for batch in batches:
            rows = [(k, s, p) for k, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()) for s, p in fn(t)[1] if p >= threshold]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], batch.schema.field("doc_id").type), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.float64())], ["doc_id", "sentence", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(over, f"doc_id {kind}, sentence string, score double")


def learnable(labels: DataFrame) -> DataFrame:
    """The label rows that may be learned from: crc32(doc_id) mod 4 is not 2."""
    return labels.where(crc_remainder("doc_id", 4) != 2)
