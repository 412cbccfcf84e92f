"""Benchmark decontamination by winnowing.

Of each window of 8 words the smallest hash of its 5-word grams is its fingerprint, in the
benchmark and in the documents. Windows of documents whose fingerprint is among the
benchmark's are looked up word for word, and hits that touch extend one another. Each span of
8 shared words holds such a gram, so none is missed. Items of fewer words are one window each,
with a fingerprint of all their words.

Fingerprints of both sides are joined. A benchmark of at most ``BROADCAST_BYTES`` of text (its
size is counted first) goes to all tasks as an index, and documents are not shuffled. A larger
one stays distributed: the documents' fingerprints are joined with the benchmark's by a shuffle,
then the windows that they come from, word for word, and the items of what is found; nothing
but the lengths of short items comes to the driver.

Defined results: a null text has no words; so has an empty one. Items that are null,
wordless or without an id are no items. Repeated documents each get their row; items
that share an id count once. An empty benchmark contaminates nothing. Further columns, of any
name, are ignored; ``screen`` keeps them as they are.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import mixed, text_bytes, written

WINDOW = 8
GRAM = 5
BROADCAST_BYTES = 8 << 20
#: Words of documents that are worked on together.
WORDS_AT_ONCE = 400_000

_TO_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def gram_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` numbers; _NEVER where one of them is 0."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    each = mixed(ids.astype(np.uint64) + np.uint64(0x9E37))
    out, known = np.zeros(n, np.uint64), np.ones(n, bool)
    for k in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + each[k : k + n]
        known &= ids[k : k + n] != 0
    out = mixed(out)
    out[~known] = _NEVER
    return out


def window_prints(ids: np.ndarray) -> np.ndarray:
    """The least gram hash of each full window."""
    g = gram_hashes(ids, GRAM)
    n = len(ids) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = g[:n].copy()
    for k in range(1, WINDOW - GRAM + 1):
        np.minimum(out, g[k : k + n], out=out)
    return out


class Index:
    """Windows of a block of items."""

    def __init__(self, items: list[tuple[str, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        self.windows: dict[bytes, set[str]] = defaultdict(set)
        prints: dict[int, set[int]] = defaultdict(set)
        for item, text in items:
            words = words_of(text)
            if not words:
                continue
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int32)
            size = min(WINDOW, len(ids))
            for i in range(len(ids) - size + 1):
                self.windows[ids[i : i + size].tobytes()].add(item)
            prints[size].update((window_prints(ids) if size == WINDOW else gram_hashes(ids, size)).tolist())
        self.prints = {k: np.sort(np.array(list(v), np.uint64)) for k, v in prints.items()}

    def hits(self, ids: np.ndarray) -> list[tuple[int, int, set[str]]]:
        """(place, words, items) of each occurrence of a window."""
        out = []
        for size, known in self.prints.items():
            own = window_prints(ids) if size == WINDOW else gram_hashes(ids, size)
            at = np.searchsorted(known, own)
            at[at == len(known)] = 0
            for i in np.flatnonzero((known[at] == own) & (own != _NEVER)).tolist():
                if found := self.windows.get(ids[i : i + size].tobytes()):
                    out.append((i, size, found))
        return out


def _by_broadcast(rows: DataFrame, items: DataFrame) -> DataFrame:
    """``rows`` (row, text) -> row, n_words, n_hit, items, with an index in each task."""
    index = Index([(r["item"], r["text"].encode("utf-8")) for r in items.collect()])
    shared = rows.sparkSession.sparkContext.broadcast(index)

    def finished(own, index):
        ids = np.concatenate([x for r in own for x in (r, np.zeros(WINDOW, np.int32))])
        starts = np.cumsum([0] + [len(r) + WINDOW for r in own])
        marks, items = np.zeros(len(ids) + 1, np.int32), [set() for _ in own]
        for place, size, found in index.hits(ids):
            marks[place] += 1
            marks[place + size] -= 1
            items[int(np.searchsorted(starts, place, side="right")) - 1] |= found
        hit = np.concatenate(([0], np.cumsum(np.cumsum(marks[:-1]) > 0)))
        for r, start, found in zip(own, starts.tolist(), items):
            yield len(r), int(hit[start + len(r)] - hit[start]), sorted(found)

    def over(batches):
        index = shared.value
        for batch in batches:
            out, own, n = [], [], 0
            for text in batch.column("text").to_pylist():
                words = words_of((text or "").encode("utf-8"))
                own.append(np.fromiter(map(index.vocabulary.get, words, repeat(0)), np.int32, len(words)))
                n += len(words) + WINDOW
                if n > WORDS_AT_ONCE:
                    out += finished(own, index)
                    own, n = [], 0
            if own:
                out += finished(own, index)
            found = [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *found], ["row", "n_words", "n_hit", "items"])

    return rows.mapInArrow(over, f"row {rows.schema['row'].dataType.simpleString()}, n_words long, n_hit long, items array<string>")


def _windows(words: list[bytes], sizes) -> list[tuple[int, int, int]]:
    """(fingerprint, place, words) of the windows of a text, for each size."""
    ids = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words)) | np.uint64(1)
    out = []
    for size in sizes:
        prints = window_prints(ids) if size == WINDOW else gram_hashes(ids, size)
        out += zip(prints.view(np.int64).tolist(), range(len(prints)), repeat(size))
    return out


def _by_shuffle(rows: DataFrame, items: DataFrame) -> DataFrame:
    """The same by joins of fingerprints, then of windows, then of items."""

    def of_items(batches):
        for batch in batches:
            out = set()
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist()):
                words = words_of(text.encode("utf-8"))
                if words:
                    out |= {(p, b" ".join(words[i : i + n]), n, item) for p, i, n in _windows(words, [min(WINDOW, len(words))])}
            columns = list(zip(*sorted(out))) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.binary(), pa.int32(), pa.string()))], ["print", "window", "size", "item"])

    def counted(batches):
        for batch in batches:
            n = [len(words_of((t or "").encode("utf-8"))) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("text"), pa.array(n, pa.int64())], ["row", "text", "n_words"])

    of_benchmark = written(items.mapInArrow(of_items, "print long, window binary, size int, item string").distinct(), "windows")
    sizes = [r[0] for r in of_benchmark.select("size").distinct().collect()]  # at most eight
    # written, so that the numbers of the rows are the same whenever they are read
    numbered = written(rows.mapInArrow(counted, f"row {rows.schema['row'].dataType.simpleString()}, text string, n_words long").withColumn("uid", F.monotonically_increasing_id()), "numbered")

    def prints(batches):
        for batch in batches:
            for uid, text in zip(batch.column("uid").to_pylist(), batch.column("text").to_pylist()):
                own = {p for p, _, _ in _windows(words_of((text or "").encode("utf-8")), sizes)}
                yield pa.RecordBatch.from_arrays([pa.array([uid] * len(own), pa.int64()), pa.array(list(own), pa.int64())], ["uid", "print"])

    def candidates(batches):
        for batch in batches:
            for uid, text, own in zip(*(batch.column(c).to_pylist() for c in ("uid", "text", "prints"))):
                words, own = words_of((text or "").encode("utf-8")), set(own)
                found = [(i, n, b" ".join(words[i : i + n])) for p, i, n in _windows(words, sizes) if p in own]
                columns = list(zip(*found)) or [[]] * 3
                yield pa.RecordBatch.from_arrays([pa.array([uid] * len(found), pa.int64()), *(pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int32(), pa.binary())))], ["uid", "place", "size", "window"])

    texts = numbered.select("uid", "text")
    met = texts.mapInArrow(prints, "uid long, print long").join(of_benchmark.select("print").distinct(), "print", "left_semi")
    live = texts.join(met.groupBy("uid").agg(F.collect_list("print").alias("prints")), "uid")
    hits = written(live.mapInArrow(candidates, "uid long, place int, size int, window binary").join(of_benchmark.select("window").distinct(), "window", "left_semi"), "hits")
    # spans in order; each adds what lies beyond the end of those before
    spans = F.sort_array(F.collect_list(F.struct("place", "size")))
    none = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    add = lambda acc, x: F.struct(F.greatest(acc["end"], x["place"] + x["size"]).alias("end"), (acc["n"] + F.greatest(F.lit(0), x["place"] + x["size"] - F.greatest(acc["end"], x["place"]))).alias("n"))
    n_hit = hits.groupBy("uid").agg(spans.alias("spans")).select("uid", F.aggregate("spans", none, add)["n"].cast("long").alias("n_hit"))
    of_doc = hits.select("uid", "window").distinct().join(of_benchmark.select("window", "item").distinct(), "window").groupBy("uid").agg(F.collect_set("item").alias("items"))
    found = n_hit.join(of_doc, "uid")
    return numbered.select("uid", "row", "n_words").join(found, "uid", "left").select("row", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def _searched(docs: DataFrame, keep: list[str], benchmark: DataFrame, broadcast_bytes: int) -> DataFrame:
    """row (the columns ``keep``), n_words, n_hit, items of every document."""
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item"), "text")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), "text")
    return (_by_broadcast if text_bytes(items)[1] <= broadcast_bytes else _by_shuffle)(rows, items)


def contamination(docs: DataFrame, benchmark: DataFrame, min_items: int = 2, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row."""
    found = _searched(docs, ["doc_id"], benchmark, broadcast_bytes)
    n = F.size("items").cast("long")
    return found.select("row.doc_id", "n_words", "n_hit", n.alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (n >= min_items).alias("contaminated"))


def screen(docs: DataFrame, benchmark: DataFrame, min_items: int = 2, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, columns as they are."""
    return _searched(docs, docs.columns, benchmark, broadcast_bytes).where(F.size("items") < min_items).select("row.*")
