"""Packing documents into sequences of at most ``SEQUENCE`` tokens.

A document's tokens are those of the tokenizer and one end token. Longer ones are cut
into full pieces, with what is over in the first; all others stay whole. Pieces are
dealt by a hash to groups of about ``GROUP`` pieces (their number is told from those of the
documents and bytes). In each group, best-fit (longest
first) makes a start; then local search takes the bins, emptiest first, and tries to empty
them into other underfull bins: it moves one or two documents, or exchanges them for one,
always towards the fuller bin, so that the sum of squared fills grows with each step. It
passes over the bins until as few are left as the tokens need or no step is left.

Words repeat, so each worker keeps a bounded table of the ids of words, which is
emptied when full. Texts with characters beyond the Latin ones are cut into words by the
tokenizer's own pattern.

Defined results: a null text is empty and has the end token only. Repeated rows and
rows with null ids are packed like others. An empty table gives no pieces. Further
columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_bytes

SEQUENCE = 2048
END = 0
GROUP = 20_000
CACHE = 250_000
#: Bytes of a token, about, to tell how many pieces there will be.
BYTES = 4

_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Texts of these characters only are cut by Python's own regular expressions, whose
#: classes agree with the tokenizer's there.
_LATIN = re.compile(rf"[{_LETTER}0-9\x09-\x0d\x20-\x7e¡-©«¬®-±´¶-¸»¿×÷–—‘’“”…€]*")
_LATIN_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\s{_LETTER}0-9]+|\s+(?!\S)|\s+")


def _same_merges(vocabulary: dict[str, int], specials: set[str]):
    """A tiktoken encoding of the same byte-level vocabulary, whose ids are the ranks of
    its merges; it is faster at single words."""
    import tiktoken

    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(moved)}
    ranks = {bytes(map(byte_of.__getitem__, token)): rank for token, rank in vocabulary.items() if token not in specials}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("same", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """ids of texts, as little-endian unsigned 32-bit bytes, equal to the tokenizer's own."""

    def __init__(self, path: str, cache: int = CACHE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        config = json.loads(self.tokenizer.to_str())
        self.specials = [t["content"] for t in config["added_tokens"]]
        # the table of words holds only for this kind of tokenizer
        pre = config["pre_tokenizer"] or {}
        self.by_word = config["normalizer"] is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and config["model"]["type"] == "BPE"
        if self.by_word:
            self.words = _same_merges(config["model"]["vocab"], set(self.specials))
        self.table: dict[str, bytes] = {}
        self.cache = cache

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.by_word or any(s in text for s in self.specials) or not _LATIN.fullmatch(text):
            return self.whole(text)
        pieces, table = _LATIN_PIECES.findall(text), self.table
        found = list(map(table.get, pieces))
        if None in found:
            if len(table) >= self.cache:
                table.clear()
            new = list({p for p in pieces if p not in table})
            for p in new:
                table[p] = np.array(self.words.encode_ordinary(p), "<u4").tobytes()
            found = map(table.__getitem__, pieces)
        return b"".join(found)


def pieces(docs: DataFrame, path: str, size: int = SEQUENCE, end: int = END) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: the pieces of every row."""
    last = np.array([end], "<u4").tobytes()

    def over(batches):
        encode = Encoder(path)
        for batch in batches:
            at, out = [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                ids = encode(text or "") + last
                n = len(ids) // 4
                first = n % size or size
                edges = [0, *range(first, n + 1, size)]
                for piece, (a, b) in enumerate(zip(edges, edges[1:])):
                    at.append(k)
                    out.append((piece, a, b - a, zlib.crc32(ids[4 * a : 4 * b])))
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(columns[0], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[1:])], ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(over, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class Bins:
    """Bins of one group, and the steps of the search."""

    def __init__(self, lengths: np.ndarray, size: int):
        self.lengths, self.size, self.plain = lengths, size, lengths.tolist()
        self.items: list[list[int]] = []
        self.free: list[int] = []

    def best_fit(self) -> None:
        """Longest first, each into the fullest bin that takes it; a bit mask tells which free sizes there are."""
        by_free: list[list[int]] = [[] for _ in range(self.size + 1)]
        mask = 0
        for i in np.argsort(-self.lengths, kind="stable").tolist():
            n = int(self.lengths[i])
            fits = mask >> n
            if fits:
                f = n + (fits & -fits).bit_length() - 1
                b = by_free[f].pop()
                if not by_free[f]:
                    mask &= ~(1 << f)
                self.items[b].append(i)
            else:
                f, b = self.size, len(self.items)
                self.items.append([i])
                self.free.append(0)
            self.free[b] = f - n
            by_free[f - n].append(b)
            mask |= 1 << (f - n)

    def search(self) -> None:
        """Passes from the emptiest bin to the fullest, in which each gives to bins at least as
        full; the end comes when no bin is left to save or in a whole pass none can give."""
        least = -(-int(self.lengths.sum()) // self.size)
        self.used = sum(map(bool, self.items))
        while self.used > least and self._pass(least):
            pass

    def _pass(self, least: int) -> bool:
        """Whether any bin has given."""
        gave, rooms = False, Rooms(self.size)
        waiting: list[list[int]] = [[] for _ in range(self.size + 1)]
        for b, own in enumerate(self.items):
            if own and self.free[b]:
                waiting[self.free[b]].append(b)
                rooms.add(b, self._lengths(b), self.free[b])
        for f in range(self.size, 0, -1):
            # bins only get fuller while they wait, so what comes to waiting[f] comes before its turn, or now
            for donor in waiting[f]:
                if self.free[donor] != f or not self.items[donor]:
                    continue
                rooms.remove(donor)
                while self.items[donor] and (receiver := self._give(donor, rooms)) is not None:
                    gave = True
                    if self.free[receiver]:
                        waiting[self.free[receiver]].append(receiver)
                if not self.items[donor]:
                    self.used -= 1
                    if self.used <= least:
                        return True
                elif self.free[donor] == f:
                    rooms.add(donor, self._lengths(donor), f)
            for b in waiting[f]:
                if self.free[b] == f and b in rooms.held:
                    rooms.remove(b)
        return gave

    def _lengths(self, b: int) -> dict[int, list[int]]:
        """The documents of a bin by their length."""
        out: dict[int, list[int]] = {}
        for i in self.items[b]:
            out.setdefault(self.plain[i], []).append(i)
        return out

    def _give(self, donor: int, rooms: Rooms) -> int | None:
        """The step that takes most from ``donor``: one or two documents move to another bin or
        are exchanged for a shorter one; the bin that took them, if there is any."""
        own = self._lengths(donor)
        u = list(own)
        sets = [(n,) for n in u] + [(n, n) for n in u if len(own[n]) > 1] + [(n, m) for k, n in enumerate(u) for m in u[:k]]
        totals = np.fromiter(map(sum, sets), np.int64, len(sets))
        back = rooms.shortest(totals)
        k = int((totals - back).argmax())
        total, x = int(totals[k]), int(back[k])
        if x >= total:
            return None
        b = rooms.fullest(x, total - x)
        rooms.remove(b)
        given = [own[n].pop() for n in sets[k]]
        self.items[donor] = [i for i in self.items[donor] if i not in given]
        if x:
            i = next(i for i in self.items[b] if self.plain[i] == x)
            self.items[b].remove(i)
            self.items[donor].append(i)
        self.items[b] += given
        self.free[b] -= total - x
        self.free[donor] += total - x
        if self.free[b]:
            rooms.add(b, self._lengths(b), self.free[b])
        return b


class Rooms:
    """Bins that can take something, by the length of a document that they could give back
    (0: none) and their free size."""

    def __init__(self, size: int):
        self.held: dict[int, tuple[list[int], int]] = {}
        self.bins: dict[tuple[int, int], dict[int, None]] = {}
        #: For each length a bit mask of the free sizes, and the longest total that fits in its place.
        self.masks = [0] * (size + 1)
        self.room = np.full(size + 1, -1, np.int64)

    def add(self, b: int, lengths, free: int) -> None:
        self.held[b] = own = ([0, *lengths], free)
        for x in own[0]:
            self.bins.setdefault((x, free), {})[b] = None
            self.masks[x] |= 1 << free
            self.room[x] = x + self.masks[x].bit_length() - 1

    def remove(self, b: int) -> None:
        lengths, free = self.held.pop(b)
        for x in lengths:
            own = self.bins[x, free]
            del own[b]
            if not own:
                del self.bins[x, free]
                self.masks[x] ^= 1 << free
                self.room[x] = x + self.masks[x].bit_length() - 1 if self.masks[x] else -1

    def shortest(self, totals: np.ndarray) -> np.ndarray:
        """For each total the shortest length in whose place it fits; beyond all lengths if none."""
        return np.searchsorted(np.maximum.accumulate(self.room), totals)

    def fullest(self, x: int, free: int) -> int:
        """The fullest bin with a document of length ``x`` and at least that free size."""
        mask = self.masks[x] >> free
        return next(iter(self.bins[x, free + (mask & -mask).bit_length() - 1]))


def assign(lengths: np.ndarray, size: int = SEQUENCE) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length."""
    bins = Bins(lengths, size)
    bins.best_fit()
    bins.search()
    number, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for b, own in enumerate(x for x in bins.items if x):
        number[own] = b
        offset[own] = np.cumsum(np.concatenate(([0], lengths[own][:-1])))
    return number, offset


def pack(docs: DataFrame, path: str, size: int = SEQUENCE, end: int = END, group: int = GROUP) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    cut = pieces(docs, path, size, end)
    rows, n_bytes = text_bytes(docs)
    n = max(1, round((rows + n_bytes / (BYTES * size)) / group))
    dealt = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "length"), F.lit(n)).cast("int"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def over(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
        number, offset = assign(table.column("length").to_numpy(), size)
        sequence = number + (table.column("part").to_numpy().astype(np.int64) << 32)
        return table.drop_columns("part").append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    return dealt.groupBy("part").applyInArrow(over, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
