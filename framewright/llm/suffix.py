"""Removal of repeated strings, by bucket-pointer refinement of sampled suffixes.

A unit (a byte; in ``by="words"`` a word) goes if a string of ``length`` units that covers it
starts anywhere else too. Strings are put into buckets by ever longer prefixes:

1. The first buckets are those of the ``q``-grams, q a quarter of the length. Only some
   suffixes need them: of each string, the least q-gram (its anchor) depends on the string
   alone, so equal strings have equal anchors at equal places. A string whose anchor is
   alone in its bucket is settled.
2. A bucket of longer strings is named by the bucket pointers at a later offset: two of
   q-grams, q apart, name one of 2q units, two of these name one of ``length`` units, and
   so on; what has been worked out for a place is used again by each that points to it.
   ``CELL`` neighbouring starts are refined at once: what all their strings share (the core)
   and what they cover together (the hull) are such pairs. A hull that is not alone has only
   repeated strings, a core that is alone has none.
3. The strings of the cells left between are refined one by one, to their whole length.

A pointer is a 64-bit hash of the pointers that it stands for. What decides a removal is the
equality of two of them, worked out independently (128 bits in all: at 10^14 strings, some two
differing ones agree with a chance of 10^-11).

Each round is one exchange of plain rows, one for each distinct pointer of a chunk of
documents, by the pointer; Spark counts them, and the rows of those that are not alone go
back to their chunks. So an exchange is in proportion to the text, and one pointer has at
most one row for each chunk, however many documents share it. Documents are shuffled once.

Defined results: a null text is empty. Repeated rows are copies of each other. Rows
with null ids take part like others. Texts shorter than the length keep all. An empty table
gives an empty result. Very long texts are searched piece by piece, in bounded memory.
Further columns, of any name, stay as they are in ``stripped``.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import mixed, text_bytes

LENGTH = 400
CELL = 16
#: Bytes of text in one chunk, about.
CHUNK_BYTES = 4 << 20
#: Units searched together. A longer text is searched in pieces that overlap.
TOGETHER = 1 << 19
#: Bits of a gram's hash that choose the anchor; among equal ones the first is it.
ANCHOR_BITS = 32

_BASE = 0x2545F4914F6CDD1D
_INVERSE = pow(_BASE, -1, 1 << 64)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_FAMILIES = (np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))
_ASKS = "chunk int, i int, n int, a long, b long, c long, carry array<binary>"
_SPACE = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Powers:
    """Powers of the base and of its inverse, as many as were ever needed."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_BASE, n + TOGETHER), _powers(_INVERSE, n + TOGETHER)
        return cls.up, cls.down


def _sums(symbols: np.ndarray) -> np.ndarray:
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * Powers.of(len(symbols) + 1)[0][: len(symbols)], out=out[1:])
    return out


class Bytes:
    """A buffer of texts end to end, its units bytes. ``sizes``: the units of each text."""

    #: A symbol is of eight bytes, so n bytes are n - 7 symbols.
    slack = 7

    def __init__(self, buffer: np.ndarray, sizes: np.ndarray):
        self.buffer, self.sizes = buffer, sizes

    def symbols(self, family: int, a: int, b: int) -> np.ndarray:
        padded = np.zeros(b - a + 8, np.uint8)
        own = self.buffer[a : min(len(self.buffer), b + 8)]
        padded[: len(own)] = own
        eights = np.ndarray((b - a,), "<u8", padded, strides=(1,)) * _FAMILIES[family]
        eights ^= eights >> np.uint64(29)
        eights *= np.uint64(0xBF58476D1CE4E5B9)
        eights ^= eights >> np.uint64(32)
        return eights

    def gone_bytes(self, gone: np.ndarray) -> np.ndarray:
        return gone


class Words(Bytes):
    """The same, its units words: runs of bytes other than white space."""

    slack = 0

    def __init__(self, buffer: np.ndarray, sizes: np.ndarray):
        ends = np.cumsum(sizes)
        starts = ends - sizes
        inside = ~_SPACE[buffer]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        some = sizes > 0
        first[starts[some]] = inside[starts[some]]
        last[ends[some] - 1] = inside[ends[some] - 1]
        self.first, self.last = np.flatnonzero(first), np.flatnonzero(last) + 1
        super().__init__(buffer, np.diff(np.append(np.searchsorted(self.first, starts), len(self.first))))
        #: Where each word's bytes, with the white space after it, end.
        of = np.repeat(ends, self.sizes)
        self.until = np.minimum(np.append(self.first[1:], len(buffer)), of)

    def symbols(self, family: int, a: int, b: int) -> np.ndarray:
        if a == b:
            return np.zeros(0, np.uint64)
        table = mixed(np.arange(1, 257, dtype=np.uint64) * _FAMILIES[family])
        start, first, last = self.first[a], self.first[a:b], self.last[a:b]
        sums = _sums(table[self.buffer[start : last[-1]]])
        down = Powers.of(len(sums))[1]
        return mixed((sums[last - start] - sums[first - start]) * down[first - start] + (last - first).astype(np.uint64) * _ODD)

    def gone_bytes(self, gone: np.ndarray) -> np.ndarray:
        """A word goes with the white space after it."""
        marks = np.zeros(len(self.buffer) + 1, np.int32)
        np.add.at(marks, self.first[gone], 1)
        np.add.at(marks, self.until[gone], -1)
        return np.cumsum(marks[:-1]) > 0


class Stretch:
    """Units a to b of a buffer, some texts of the given sizes, and their bucket pointers."""

    def __init__(self, units: Bytes, a: int, b: int, sizes: np.ndarray, length: int):
        if length < 4 * (units.slack + 1):
            raise ValueError(f"strings of {length} units are too short for buckets of a quarter")
        self.units, self.a, self.b, self.sizes, self.length = units, a, b, sizes, length
        self.gram = -(-length // 4)
        self._sum_of: dict[int, np.ndarray] = {}

    def release(self) -> None:
        self._sum_of = {}

    def pointers(self, i: np.ndarray, family: int) -> np.ndarray:
        """Of the grams at i."""
        if family not in self._sum_of:
            self._sum_of[family] = _sums(self.units.symbols(family, self.a, self.b))
        sums, down = self._sum_of[family], Powers.of(self.b - self.a + 1)[1]
        return mixed((sums[i + self.gram - self.units.slack] - sums[i]) * down[i])

    def twice(self, i: np.ndarray, family: int) -> np.ndarray:
        """Of the strings of two grams at i, by the grams' pointers."""
        return mixed(self.pointers(i, family) * _ODD + self.pointers(i + self.gram, family))

    def reach(self, i: np.ndarray, length: int, family: int) -> np.ndarray:
        """Of the strings of 2 to 4 grams' length at i, by pointers to two of two grams each."""
        return mixed(self.twice(i, family) * _ODD + self.twice(i + length - 2 * self.gram, family))

    def runs(self):
        """anchor, first, last, low, high, gram: the runs of strings with one anchor; low and
        high are the first and last string of its text."""
        none = np.zeros(0, np.int64)
        long = np.flatnonzero(self.sizes >= self.length)
        if not len(long):
            return none, none, none, none, none, np.zeros(0, np.uint64)
        starts = np.cumsum(self.sizes) - self.sizes
        m = self.b - self.a - self.gram + 1
        grams = self.pointers(np.arange(m), 0)
        bits = np.uint64(64 - ANCHOR_BITS)
        least = (grams >> bits << bits) | np.arange(m, dtype=np.uint64)
        reach, width = self.length - self.gram + 1, 1
        while 2 * width <= reach:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < reach:
            least = np.minimum(least[: len(least) - (reach - width)], least[reach - width :])
        place = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        counts = self.sizes[long] - self.length + 1
        low = starts[long]
        at = np.arange(counts.sum()) + np.repeat(low - (np.cumsum(counts) - counts), counts)
        own = place[at]
        new = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        doc = np.searchsorted(np.cumsum(counts), new, side="right")
        anchor = own[new]
        return anchor, at[new], at[np.append(new[1:], len(at)) - 1], low[doc], (low + counts - 1)[doc], grams[anchor]

    def cells(self, run: tuple, cell: int) -> list[np.ndarray]:
        """core, hull, check, lowest, highest, anchor of the cells of the given runs."""
        p, first, last, low, high, gram = run
        k0 = (p - last) // cell
        counts = (p - first) // cell - k0 + 1
        of = np.repeat(np.arange(len(p)), counts)
        k = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts) + k0[of]
        p, gram = p[of], gram[of]
        top = p - cell * k
        highest, lowest = np.minimum(top, high[of]), np.maximum(top - cell + 1, low[of])
        core = mixed(self.reach(top, self.length - cell + 1, 0) ^ mixed(gram + k.astype(np.uint64) * _ODD))
        place = core * _ODD + ((p - lowest) * (8 * cell) + (highest - lowest)).astype(np.uint64)
        hull, check = (mixed(mixed(self.reach(lowest, self.length, f) * _ODD + self.reach(highest, self.length, f)) + place) for f in (0, 1))
        return [core, hull, check, lowest, highest, p]


def _distinct(*keys: np.ndarray):
    """first, of, counts: the distinct rows of keys in their order, which row each is."""
    if not len(keys[0]):
        none = np.zeros(0, np.int64)
        return none, none, none
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    of = np.empty(len(order), np.int64)
    of[order] = np.cumsum(new) - 1
    return order[new], of, np.bincount(of)


class Chunk:
    """One chunk of documents and the answers it has so far (``said``, by level). Each level
    is worked out anew from the texts, in the same order, which is that of ids and texts.
    ``asks``: the distinct pointers a, b, c of a level and how often they occur (1, or 2 for more)."""

    def __init__(self, docs: pa.Table, said: dict[int, np.ndarray], length: int, by: str):
        self.rows = docs.column("row").combine_chunks()
        keys, texts = self.rows.field("doc_id").to_pylist(), self.rows.field("text")
        digests = [hashlib.blake2b(t.as_buffer() if t.is_valid else b"", digest_size=8).digest() for t in texts]
        self.order = sorted(range(len(keys)), key=lambda i: (keys[i] is None, "" if keys[i] is None else keys[i], digests[i]))
        self.rows = self.rows.take(pa.array(self.order, pa.int64()))
        texts = self.rows.field("text").cast(pa.large_string()).cast(pa.large_binary()).fill_null(b"")
        edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        self.buffer = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[edges[0] : edges[-1]] if len(texts) else np.zeros(0, np.uint8)
        self.bytes = np.diff(edges)
        self.length, self.said = length, said
        self.cell = min(CELL, max(1, length // 4))
        self.units = (Words if by == "words" else Bytes)(self.buffer, self.bytes)
        self.stretches = list(self._cut())
        self.keep = len(self.buffer) <= 4 * CHUNK_BYTES

    def _cut(self):
        """The texts some at a time; a long one in pieces, so that each string is in one of them."""
        begin = end = 0
        own: list[int] = []
        for n in [*self.units.sizes.tolist(), -1]:
            if own and (n < 0 or end - begin + n > TOGETHER):
                yield Stretch(self.units, begin, end, np.array(own), self.length)
                own, begin = [], end
            if n > 2 * TOGETHER:
                for a in range(end, end + n, TOGETHER):
                    b = min(end + n, a + TOGETHER + self.length - 1)
                    yield Stretch(self.units, a, b, np.array([b - a]), self.length)
                begin = end = end + n
            elif n >= 0:
                own.append(n)
                end += n

    def _done(self, s: Stretch) -> None:
        if not self.keep:
            s.release()

    def level1(self):
        """Grams of the anchors."""
        self.found = []
        for s in self.stretches:
            self.found.append(s.runs())
            self._done(s)
        grams = np.concatenate([r[5] for r in self.found] or [np.zeros(0, np.uint64)])
        first, self.gram_of, counts = _distinct(grams)
        none = np.zeros(len(first), np.uint64)
        return grams[first], none, none, counts

    def level2(self):
        """Hulls and cores of the cells of anchors that are not alone."""
        several = (self.said[1][self.gram_of] & 1).astype(bool)
        parts, begin = [[np.zeros(0, np.uint64)] * 3 + [np.zeros(0, np.int64)] * 4], 0
        for number, (s, run) in enumerate(zip(self.stretches, self.found)):
            n = len(run[5])
            live = several[begin : begin + n]
            begin += n
            if live.any():
                own = s.cells(tuple(x[live] for x in run), self.cell)
                parts.append([*own, np.full(len(own[0]), number)])
                self._done(s)
        self.cells = core, hull, check, _, _, _, _ = [np.concatenate(x) for x in zip(*parts)]
        self.hull_first, self.hull_of, n_hull = _distinct(hull, check)
        own_core = core[self.hull_first]
        core_first, core_of, n_core = _distinct(own_core)
        self.core_of = core_of
        #: Several hulls of one core in this chunk.
        self.mixed_core = n_core > 1
        in_core = np.bincount(core_of, weights=n_hull, minlength=len(core_first))
        none = np.zeros(len(core_first), np.uint64)
        a = np.concatenate([mixed(hull[self.hull_first]), own_core[core_first]])
        # where there are several hulls, something that differs from the hull that another chunk may have alone
        of_core = hull[self.hull_first][core_first]
        b = np.concatenate([np.zeros(len(self.hull_first), np.uint64), np.where(self.mixed_core, ~of_core, of_core)])
        return a, b, np.concatenate([check[self.hull_first], none]), np.concatenate([n_hull, in_core])

    def level3(self):
        """The strings of the cells to be refined one by one."""
        n = len(self.hull_first)
        hull, core = self.said[2][:n], self.said[2][n:][self.core_of]
        mixed_core = self.mixed_core[self.core_of]
        repeats, speaks = (hull & 1) > 0, ((hull & 4) > 0) | ((hull & 1) == 0)
        in_core, hulls = ((core & 1) > 0) | mixed_core, ((core & 2) > 0) | mixed_core
        # of cells with equal hulls one speaks for all
        on = in_core & np.where(repeats, speaks & hulls, True)
        self.repeats = repeats[self.hull_of]
        at = self.hull_first[on]
        core, _, _, lowest, highest, anchor, number = (x[at] for x in self.cells)
        counts = highest - lowest + 1
        of = np.repeat(np.arange(len(at)), counts)
        self.string = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts) + lowest[of]
        self.string_in = number[of]
        keys = np.zeros((2, len(of)), np.uint64)
        for k in np.unique(self.string_in).tolist():
            own = self.string_in == k
            for f in (0, 1):
                keys[f, own] = self.stretches[k].reach(self.string[own], self.length, f)
            self._done(self.stretches[k])
        # the place of the anchor belongs to the bucket
        keys[0] = mixed(keys[0] + core[of] * _ODD + mixed((anchor[of] - self.string).astype(np.uint64)))
        first, self.string_of, counts = _distinct(keys[0], keys[1])
        return keys[0][first], np.zeros(len(first), np.uint64), keys[1][first], counts

    def removed(self) -> np.ndarray:
        """Which units go."""
        repeats = (self.said[3][self.string_of] & 1).astype(bool)
        _, _, _, lowest, highest, _, number = self.cells
        marks = np.zeros(int(self.units.sizes.sum()) + 1, np.int32)
        begin = np.array([s.a for s in self.stretches] or [0])
        own = self.repeats
        np.add.at(marks, begin[number[own]] + lowest[own], 1)
        np.add.at(marks, begin[number[own]] + highest[own] + self.length, -1)
        at = begin[self.string_in[repeats]] + self.string[repeats]
        np.add.at(marks, at, 1)
        np.add.at(marks, at + self.length, -1)
        return np.cumsum(marks[:-1]) > 0

    def kept(self):
        """For each text its kept bytes, or None where all are kept, and the number of removed runs."""
        gone = self.units.gone_bytes(self.removed())
        for a, b in zip((np.cumsum(self.bytes) - self.bytes).tolist(), np.cumsum(self.bytes).tolist()):
            g = gone[a:b]
            if g.any():
                yield self.buffer[a:b][~g].tobytes(), int(g[0]) + int(np.count_nonzero(g[1:] & ~g[:-1]))
            else:
                yield None, 0


def _replay(docs: pa.Table, answers: pa.Table | None, level: int, length: int, by: str):
    """The chunk, and what it asks at ``level``; the answers of all levels before are in ``said``."""
    said: dict[int, np.ndarray] = {}
    fresh = np.zeros(0, np.int64)
    if answers is not None and answers.num_rows:
        for carry in answers.column("carry").to_pylist():
            said |= {k: np.frombuffer(zlib.decompress(x), np.uint8) for k, x in enumerate(carry or [], 1)}
        fresh = answers.column("x").combine_chunks().flatten().to_numpy()
    chunk, asked = Chunk(docs, said, length, by), None
    for n in range(1, min(level, 3) + 1):
        asked = (chunk.level1, chunk.level2, chunk.level3)[n - 1]()
        if n == level - 1:
            said[n] = np.zeros(len(asked[0]), np.uint8)
            said[n][fresh >> 3] = fresh & 7
    return chunk, asked


def _asking(level: int, length: int, by: str):
    def ask(docs: pa.Table, answers: pa.Table | None = None) -> pa.Table:
        kinds = {"chunk": pa.int32(), "i": pa.int32(), "n": pa.int32(), "a": pa.int64(), "b": pa.int64(), "c": pa.int64(), "carry": pa.list_(pa.binary())}
        if not docs.num_rows:
            return pa.table({k: pa.array([], t) for k, t in kinds.items()})
        number = docs.column("chunk")[0].as_py()
        chunk, (a, b, c, counts) = _replay(docs, answers, level, length, by)
        n, more = len(a), int(level > 1)
        # the answers so far go along in a row that has a pointer to itself
        own = mixed(np.array([number], np.uint64) * _ODD)[:more]
        long = lambda x, y: pa.array(np.concatenate([x, y]).view(np.int64))
        ints = lambda x, y: pa.array(np.concatenate([x, y]).astype(np.int32))
        carry = pa.array([None] * n + [[zlib.compress(chunk.said[k].tobytes(), 1) for k in sorted(chunk.said)]] * more, pa.list_(pa.binary()))
        return pa.table({"chunk": pa.array(np.full(n + more, number, np.int32)), "i": ints(np.arange(n), np.full(more, -1)), "n": ints(np.minimum(counts, 2), np.ones(more, np.int64)), "a": long(a, own), "b": long(b, own), "c": long(c, own), "carry": carry})

    return ask


def _answered(asks: DataFrame) -> DataFrame:
    """For each chunk those of its pointers that are not alone, as x = 8 i + 1, + 2 if they
    differ in b, + 4 for the first chunk."""
    of = Window.partitionBy("a", "c")
    rows = asks.select("chunk", "i", "carry", F.sum("n").over(of).alias("n"), (F.min("b").over(of) != F.max("b").over(of)).alias("differ"), (F.min("chunk").over(of) == F.col("chunk")).alias("first"))
    said = F.lit(1) + F.when(F.col("differ"), 2).otherwise(0) + F.when(F.col("first"), 4).otherwise(0)
    said = F.when(F.col("i") >= 0, 8 * F.col("i") + said)
    return rows.where("n > 1 or i < 0").select("chunk", said.alias("x"), "carry").groupBy("chunk").agg(F.collect_list("x").alias("x"), F.max_by("carry", F.col("carry").isNotNull()).alias("carry"))


def _searched(docs: DataFrame, length: int, by: str, finish, schema) -> DataFrame:
    """``finish(chunk)`` after all three rounds."""
    chunks = max(1, -(-text_bytes(docs)[1] // CHUNK_BYTES))
    dealt = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    by_chunk = dealt.groupBy("chunk")
    first = _asking(1, length, by)
    answers = _answered(by_chunk.applyInArrow(lambda t: first(t), _ASKS))
    for level in (2, 3):
        answers = _answered(by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(_asking(level, length, by), _ASKS))

    def last(d: pa.Table, a: pa.Table) -> pa.Table:
        chunk, _ = _replay(d, a, 4, length, by)
        return finish(chunk)

    return by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(last, schema)


def repeats(docs: DataFrame, length: int = LENGTH, by: str = "bytes") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    docs = docs.select("doc_id", "text")

    def finish(chunk: Chunk) -> pa.Table:
        kept, at = [], 0
        for n, (rest, spans) in zip(chunk.bytes.tolist(), chunk.kept()):
            rest = chunk.buffer[at : at + n].tobytes() if rest is None else rest
            kept.append((n, n - len(rest), spans, hashlib.sha256(rest).hexdigest()))
            at += n
        columns = list(zip(*kept))
        return pa.table({"doc_id": chunk.rows.field("doc_id"), **{name: pa.array(c, pa.int64()) for name, c in zip(("n_bytes", "n_removed", "n_spans"), columns)}, "kept_sha256": pa.array(columns[3], pa.string())})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _searched(docs, length, by, finish, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def stripped(docs: DataFrame, length: int = LENGTH, by: str = "bytes") -> DataFrame:
    """All rows and columns of ``docs``, with what is left of ``text``. A character cut in
    two by a removal goes wholly; a null text stays null."""
    names = docs.columns

    def finish(chunk: Chunk) -> pa.Table:
        old = chunk.rows.field("text")
        texts = [t.as_py() if k is None else k.decode("utf-8", "ignore") for t, (k, _) in zip(old, chunk.kept())]
        return pa.table([pa.array(texts, pa.string()) if c == "text" else chunk.rows.field(k) for k, c in enumerate(names)], names)

    return _searched(docs, length, by, finish, docs.schema)
