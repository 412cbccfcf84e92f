"""Quality by pairwise ranking (Bradley-Terry).

A document's score is a linear function of standardised features of its text.
Preference pairs (a row labelled 1, a row labelled 0) are drawn from the labelled
sample; the logistic loss of the difference of features teaches the weights. The
cut is a quantile of the scores of the training rows: the one at which as many
rows fall below it as are labelled 0. ``score`` maps the cut to 0.5.

The model is fitted on a bounded sample of labelled rows (``max_train``, the
smallest by a hash of the id) and ``n_pairs`` pairs; scoring covers every row.

Defined results: a null text is empty; an empty text has features of zero and a
score like any other. Rows with null ids are scored, never trained on (the query calls them
held out). A repeated
row is scored each time. Null labels are skipped. An empty or one-sided training
set gives weights of zero and the share of label 1 as score. Further columns of
either table are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_remainder

MAX_TRAIN = 20_000
N_PAIRS = 60_000
UPPER, LOWER, DIGIT, SPACE = (bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58)), b" \t\n\r\x0b\x0c")
MARKS = b".,;:?'\"-()"
BRACKETS = b"|#%&$*!@^~<>{}[]=+_\\/`"

FEATURES = ["log_words", "mean_word", "upper", "digit", "marks", "symbols", "bang", "pipe", "distinct", "top_word", "repeated", "repeated_lines", "short_words", "log_lines", "high_bytes", "odd_ends"]


def features(text: str | None) -> list[float]:
    """Shares and counts of the whole text."""
    b = (text or "").encode("utf-8")
    words = b.split()
    n, size = len(words), max(1, len(b))
    if not n:
        return [0.0] * len(FEATURES)
    upper, lower = len(b) - len(b.translate(None, UPPER)), len(b) - len(b.translate(None, LOWER))
    counts = Counter(words)
    lines = [x for x in b.split(b"\n") if x.strip()]
    follows = sum(map(bytes.__eq__, words, words[1:])) / max(1, n - 1)
    symbols = size - len(b.translate(None, BRACKETS))
    high = len(b.translate(None, bytes(range(128))))
    ends = sum(w[-1] in BRACKETS for w in words) / n
    return [
        float(np.log1p(n)),
        min(30.0, sum(map(len, words)) / n),
        upper / max(1, upper + lower),
        (len(b) - len(b.translate(None, DIGIT))) / size,
        (len(b) - len(b.translate(None, MARKS))) / size,
        symbols / size,
        b.count(b"!") / n,
        b.count(b"|") / n,
        len(counts) / n**0.8,
        max(counts.values()) / n,
        follows,
        1.0 - len(set(lines)) / max(1, len(lines)),
        sum(len(w) <= 3 for w in words) / n,
        float(np.log1p(len(lines))),
        high / size,
        ends,
    ]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(x) - self.cut, -500, 500)))


def fit(x: np.ndarray, y: np.ndarray, n_pairs: int = N_PAIRS, epochs: int = 300, l2: float = 1e-3, seed: int = 7) -> Model:
    k = len(FEATURES)
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        return Model(np.zeros(k), np.ones(k), np.zeros(k), -float(np.log(share / (1 - share))))
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    better, worse = rng.choice(np.flatnonzero(y == 1), n_pairs), rng.choice(np.flatnonzero(y == 0), n_pairs)
    d = z[better] - z[worse]
    w, m, v = np.zeros(k), np.zeros(k), np.zeros(k)
    for step in range(1, epochs + 1):
        p = 1.0 / (1.0 + np.exp(np.clip(d @ w, -500, 500)))
        g = -(d * p[:, None]).mean(0) + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    s = np.sort(z @ w)
    below = int((y == 0).sum())
    return Model(mean, scale, w, float((s[below - 1] + s[min(below, len(s) - 1)]) / 2))


def featured(df: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the packed features of ``text``."""
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep) + ", x binary"

    def over(batches):
        for batch in batches:
            x = [np.array(features(t)).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(x, pa.binary())], [*keep, "x"])

    return df.mapInArrow(over, schema)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", max_train: int = MAX_TRAIN) -> Model:
    """Fit on at most ``max_train`` labelled rows, those of the smallest hash of the id."""
    marked = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label")).where("_id is not null and label is not null")
    chosen = marked.orderBy(F.xxhash64("_id"), "_id", "label").limit(max_train)
    rows = featured(chosen.join(docs.select(F.col("doc_id").alias("_id"), "text"), "_id").select("label", "text"), ["label"]).collect()
    rows = sorted((r["label"], bytes(r["x"])) for r in rows)
    x = np.array([np.frombuffer(r[1]) for r in rows]).reshape(-1, len(FEATURES))
    return fit(x, np.array([r[0] for r in rows], float))


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """doc_id, score, predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def over(batches):
        for batch in batches:
            if batch.num_rows:
                s = shared.value.scores(np.array([features(t) for t in batch.column("text").to_pylist()]))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(over, f"doc_id {kind}, score double, predicted int")


def learnable(labels: DataFrame) -> DataFrame:
    """The label rows that may be learned from: crc32(doc_id) mod 3 is not 1."""
    return labels.where(crc_remainder("doc_id", 3) != 1)
