"""Model stages. A backend is built inside each task and answers items by a bounded pool of
threads; failures become rows with an error. Offline, ``StubBackend`` answers by a hash."""

from __future__ import annotations

import hashlib
import itertools
import json
import time
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import geometry as geo
from ..functions import text as txt
from .sampling import crops

#: Bytes of texts in one part of ``by_length``.
PART = 32_000_000

CAPTION_OUT = "id long, shard int, path string, gt_caption string, gemma_short string, gemma_dense string, error string"


class Backend(Protocol):
    def ask(self, prompt: str, item: dict, max_tokens: int) -> str: ...


class StubBackend:
    """A deterministic stand-in for a model."""

    def ask(self, prompt: str, item: dict, max_tokens: int) -> str:
        h = hashlib.md5(f"{prompt}|{item.get('path')}|{item.get('phrase', '')}".encode()).digest()[0]
        if prompt.startswith("verify"):
            return "Yes." if h % 10 < 7 else "No." if h % 10 < 9 else "perhaps"
        words = f"<think>{h}</think> {item.get('gt_caption') or ''} number {h}".split()
        return " ".join(words[:max_tokens])


def retried(endpoints: list, call: Callable, tries: int = 4, sleep: Callable[[float], None] = time.sleep, first: int = 0):
    """``call(endpoint)``, on the next endpoint after each failure, with waits of 1, 2, 4 ... s."""
    for k in range(tries):
        try:
            return call(endpoints[(first + k) % len(endpoints)])
        except Exception:
            if k + 1 == tries:
                raise
            sleep(2.0**k)


class Endpoints:
    """Several backends as one: each question goes to the next of them in turn, and on to
    the one after it when it fails (``retried``)."""

    def __init__(self, backends: list, tries: int = 4, sleep: Callable[[float], None] = time.sleep):
        self.backends, self.tries, self.sleep, self.turn = backends, tries, sleep, itertools.count()

    def ask(self, prompt: str, item: dict, max_tokens: int) -> str:
        return retried(self.backends, lambda b: b.ask(prompt, item, max_tokens), self.tries, self.sleep, next(self.turn))


def serial(items: Iterator[dict], work: Callable[[dict], dict | list[dict]]) -> Iterator[dict]:
    """``work`` of one item after another, in their order; an item may give several rows. For
    models that take a device for themselves."""
    for item in items:
        try:
            out = work(item)
        except Exception as e:
            out = item | {"error": f"{type(e).__name__}: {e}"}
        yield from out if isinstance(out, list) else [out]


def progress(tag: str, n: int, total: int, seconds: float) -> str:
    """How far a run is and how many minutes are left at this pace."""
    each = seconds / max(1, n)
    pace = f"{each * 1000:.0f} ms" if each < 1 else f"{each:.2f} s"
    return f"[{tag}] {n}/{total}, {pace} each, {(total - n) * each / 60:.1f} min left"


def pooled(items: Iterator[dict], work: Callable[[dict], dict], workers: int) -> Iterator[dict]:
    """``work`` of each item in order of completion; at most max(8 workers, 256) in flight."""
    limit = max(8 * workers, 256)

    def safe(item):
        try:
            return work(item)
        except Exception as e:  # a failed item is a row, not a failed task
            return item | {"error": f"{type(e).__name__}: {e}"}

    with ThreadPoolExecutor(workers) as pool:
        waiting = set()
        for item in items:
            waiting.add(pool.submit(safe, item))
            if len(waiting) >= limit:
                done, waiting = wait(waiting, return_when=FIRST_COMPLETED)
                yield from (f.result() for f in done)
        for f in waiting:
            yield f.result()


def mapped(df: DataFrame, work: Callable[[Backend, dict], dict], backend: Callable[[], Backend | list[Backend]], schema: str, workers: int = 16, batch: int = 256, tries: int = 4, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """``work`` over all rows, in order of completion within a task; with one worker, in their
    order. ``backend`` gives one backend or several that take turns; a call that fails is tried
    again, on the next of them, before its row becomes an error."""
    names = StructType.fromDDL(schema).names

    def over(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own_backends = backend()
        model = Endpoints(own_backends if isinstance(own_backends, list) else [own_backends], tries, sleep)
        items = (row for frame in frames for row in frame.to_dict("records"))
        own: list[dict] = []
        answers = pooled(items, lambda item: work(model, item), workers) if workers > 1 else serial(items, lambda item: work(model, item))
        for r in answers:
            own.append({n: r.get(n) for n in names})
            if len(own) >= batch:
                yield pd.DataFrame(own, columns=names)
                own = []
        if own:
            yield pd.DataFrame(own, columns=names)

    return df.mapInPandas(over, schema)


def caption(work: DataFrame, backend: Callable[[], Backend | list[Backend]] = StubBackend, workers: int = 16, **retry) -> DataFrame:
    """Two captions for each row of a worklist (id, shard, path, gt_caption). ``retry``: tries, sleep."""

    def ask(model, item):
        return item | {"gemma_short": model.ask("short", item, 160), "gemma_dense": model.ask("dense", item, 320)}

    rows = mapped(work.select("id", "shard", "path", "gt_caption"), ask, backend, CAPTION_OUT, workers, **retry)
    return rows.withColumns({c: txt.after_thinking(F.col(c)) for c in ("gemma_short", "gemma_dense")})


def with_words(captions: DataFrame) -> DataFrame:
    return captions.withColumn("_words", txt.word_count(F.coalesce("gemma_dense", F.lit(""))))


def by_length(captions: DataFrame, n: int) -> DataFrame:
    """Rows with captions of like length together, for batches of a model: n parts, or more
    where a part would have over PART bytes of texts. ``_words`` that are there already are taken,
    and stay; such rows need no text, and n parts are enough for them."""
    if "_words" in captions.columns:
        return captions.repartitionByRange(n, "_words", "path").sortWithinPartitions("_words", "path")
    counted = with_words(captions)
    # one row for each length, the upper seven bits of it where it is long: at most some thousands
    step = F.expr("shiftleft(1L, greatest(0, cast(log2(greatest(_words, 1)) as int) - 6))")
    lengths = counted.select((F.floor(F.col("_words") / step) * step).alias("of"), F.octet_length(F.coalesce("gemma_dense", F.lit(""))).alias("bytes"))
    sums = sorted(lengths.groupBy("of").agg(F.sum(F.col("bytes") + 64).alias("bytes")).collect())
    most = max(1, min(PART, -(-sum(r["bytes"] for r in sums) // n)))
    firsts, parts, full = [], 0, most
    for r in sums:  # a part takes lengths until it is full; one that alone is more has parts of its own
        own = -(-r["bytes"] // most)
        if full + r["bytes"] > most:
            firsts.append((r["of"], parts, own))
            parts, full = parts + own, r["bytes"] if own == 1 else most
        else:
            firsts.append((r["of"], parts - 1, 1))
            full += r["bytes"]
    rows = json.dumps([dict(zip(("_of", "_first", "_own"), x)) for x in firsts])  # no Python worker for a few rows
    places = captions.sparkSession.range(1).select(F.inline(F.from_json(F.lit(rows), "array<struct<_of: bigint, _first: int, _own: int>>")))
    placed = counted.withColumn("_of", F.floor(F.col("_words") / step) * step).join(F.broadcast(places), "_of")
    dealt = placed.withColumn("_part", (F.col("_first") + F.pmod(F.xxhash64("path"), F.col("_own"))).cast("int")).repartitionById(max(1, parts), "_part")
    return dealt.sortWithinPartitions("_words", "path").select(*captions.columns)


def ground_texts(captions: DataFrame, generate: Callable[[list[dict]], list[str]], parse: Callable[[str], tuple[list[str], list[list[float]]]], batch: int = 8) -> DataFrame:
    """path, grounding, error: ``generate`` answers a batch of rows with raw texts, which end at
    their end mark, and ``parse`` reads labels and boxes from each; what can't be read has none."""

    def raw(frames):
        for frame in frames:
            rows = frame.to_dict("records")
            for at in range(0, len(rows), batch):
                part = rows[at : at + batch]
                yield pd.DataFrame(_answers(part, generate), columns=["path", "answer", "error"])

    def read(frames):
        for frame in frames:
            out = []
            for path, answer, error in zip(frame["path"], frame["answer"], frame["error"]):
                labels, boxes = None, None
                if isinstance(answer, str):
                    try:
                        labels, boxes = parse(answer)
                    except Exception:
                        labels, boxes = [], []
                out.append((path, labels, boxes, error))
            yield pd.DataFrame(out, columns=["path", "labels", "boxes", "error"])

    rows = captions.mapInPandas(raw, "path string, answer string, error string").withColumn("answer", txt.until_end_mark(F.col("answer")))
    return _grounded(rows.mapInPandas(read, "path string, labels array<string>, boxes array<array<double>>, error string"))


def _answers(rows: list[dict], ask: Callable[[list[dict]], list]) -> list[tuple]:
    """(path, answer, error) of a batch; if it fails, of each row by itself."""
    try:
        return [(r["path"], a, None) for r, a in zip(rows, ask(rows), strict=True)]
    except Exception:
        out = []
        for r in rows:
            try:
                (answer,) = ask([r])
                out.append((r["path"], answer, None))
            except Exception as e:
                out.append((r["path"], None, f"{type(e).__name__}: {e}"))
        return out


def _grounded(rows: DataFrame) -> DataFrame:
    return rows.select("path", F.when(F.col("error").isNull(), txt.boxes_by_label(F.col("labels"), F.col("boxes"))).alias("grounding"), "error")


def ground(captions: DataFrame, detect: Callable[[list[dict]], list[tuple[list[str], list[list[float]]]]], batch: int = 8) -> DataFrame:
    """path, grounding, error: ``detect`` answers a batch of rows with labels and boxes for
    each; a batch that fails is asked again row by row."""

    def over(frames):
        for frame in frames:
            rows = frame.to_dict("records")
            for at in range(0, len(rows), batch):
                out = [(path, *(answer or (None, None)), error) for path, answer, error in _answers(rows[at : at + batch], detect)]
                yield pd.DataFrame(out, columns=["path", "labels", "boxes", "error"])

    return _grounded(captions.mapInPandas(over, "path string, labels array<string>, boxes array<array<double>>, error string"))


def verify(tasks: DataFrame, backend: Callable[[], Backend | list[Backend]] = StubBackend, workers: int = 16, **retry) -> DataFrame:
    """``tasks`` (path, phrase, box, n_box, img_w, img_h) with crop_frac and verdict. Crops
    too small to judge aren't asked about. ``retry``: tries, sleep."""
    rows = crops(tasks).select("path", "phrase", "box", "n_box", "crop_frac", "verdict")

    def ask(model, item):
        if item.get("verdict"):
            return item
        try:
            return item | {"answer": model.ask("verify", item, 6)}
        except Exception as e:
            return item | {"verdict": "ERROR", "error": f"{type(e).__name__}: {e}"}

    schema = "path string, phrase string, box array<double>, n_box int, crop_frac double, verdict string, answer string, error string"
    out = mapped(rows, ask, backend, schema, workers, **retry)
    return out.withColumn("verdict", F.coalesce("verdict", txt.parse_verdict(F.col("answer")))).drop("answer")


def grounding_stub(rows: list[dict]) -> list[tuple[list[str], list[list[float]]]]:
    """Labels: the caption's first three words; boxes by a hash."""
    out = []
    for r in rows:
        words = (r.get("gemma_dense") or "").split()[:3]
        hashes = [hashlib.md5(f"{r['path']}|{w}".encode()).digest() for w in words]
        out.append((words, [[float(h[0]), float(h[1]), float(h[0] + h[2] % 90 + 8), float(h[1] + h[3] % 90 + 8)] for h in hashes]))
    return out


def tasks(work: DataFrame, questions: dict[str, tuple[str, int]], backend: Callable[[], Backend | list[Backend]] = StubBackend, workers: int = 1, **retry) -> DataFrame:
    """id, path, one column for each of ``questions`` (name -> prompt, most tokens), error: several
    questions about each row. If one fails, the row has those before it and the error."""

    def ask(model, item):
        out = {"id": item["id"], "path": item["path"]}
        try:
            for name, (prompt, most) in questions.items():
                out[name] = model.ask(prompt, item, most)
        except Exception as e:
            out["error"] = f"{type(e).__name__}: {e}"
        return out

    schema = "id long, path string, " + "".join(f"`{name}` string, " for name in questions) + "error string"
    rows = mapped(work, ask, backend, schema, workers, **retry)
    return rows.withColumns({name: txt.after_thinking(F.col(f"`{name}`")) for name in questions})


def top_labels(scores: Column, k: int) -> Column:
    """The k most likely of (label, p) as (label, percent with two digits); ties by label."""
    best = F.array_sort(scores, lambda x, y: F.when(x["p"] != y["p"], F.when(x["p"] > y["p"], -1).otherwise(1)).when(x["label"] < y["label"], -1).otherwise(1))
    return F.transform(F.slice(best, 1, k), lambda x: F.struct(x["label"].alias("label"), geo.rounded(x["p"] * 100, 2).alias("percent")))


def crossfed(merged: DataFrame, detect: Callable[[list[dict]], list[tuple[list[str], list[list[float]]]]], count: Callable[[str], int], most: int, batch: int = 8) -> DataFrame:
    """One chain's dense caption (``gemma_dense``) grounded by another's detector: path, words,
    tokens by ``count``, truncated (``most`` or more), grounding, n_phrase, n_box, error."""
    found = ground(merged, detect, batch)

    def counted(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: count(t) if isinstance(t, str) else None).astype("Int64")

    tokens = F.pandas_udf(counted, "long")("gemma_dense")
    n_box = F.aggregate("grounding", F.lit(0), lambda n, g: n + F.size(g["boxes"]))
    rows = merged.select("path", txt.word_count(F.col("gemma_dense")).alias("words"), tokens.alias("tokens")).withColumn("truncated", F.col("tokens") >= most)
    return rows.join(found, "path").select("path", "words", "tokens", "truncated", "grounding", F.size("grounding").alias("n_phrase"), n_box.alias("n_box"), "error")


def side_by_side(work: DataFrame, question: tuple[str, int], backends: dict[str, Callable[[], Backend | list[Backend]]], workers: int = 16, **retry) -> DataFrame:
    """id, path, and each backend's answer to one question, for all rows that are in ``work``."""
    out = work
    for name, backend in backends.items():
        own = tasks(work, {name: question}, backend, workers, **retry)
        out = out.join(own.select("id", name), "id", "left")
    return out.select("id", "path", *backends)
