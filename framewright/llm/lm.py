"""Scores of a trigram language model as a weighted backoff automaton.

States are the root, the words and the pairs of words seen in training: what has been read
last, as far as it is known. A state's arcs are the words seen after it; its failure arc,
taken without reading, leads to the state without the first word: from a pair to a word, from
a word to the root. With c the counts in training, an arc of a pair weighs
(c(uvw) + nu p(w|v)) / (c(uv) + nu) and its failure arc nu / (c(uv) + nu); an arc of a word
(c(vw) + mu p(w)) / (c(v) + mu), its failure arc mu / (c(v) + mu). The root has an arc for
each known word, (c(w) - d) / N, and one for all unknown words together, d V / N. So each
state's probabilities sum to 1 over the known words and the unknown one.

A text is read once from left to right. In the state that has been carried there, a token
takes its arc or fails until there is one; the logarithms of all arcs on the way are added,
and the state of the longest known end of what has been read is carried on.

d comes from the counts of counts, d = n1 / (n1 + 2 n2); mu and nu are those of ``MUS`` and
``NUS`` that give all training texts the highest probability when each token is left out of
the counts that predict it.

The automaton is never in one place. Documents are tokenized once, into chunks that are
written to the shared folder. Chunks send the words, pairs and triples that they hold, with
their counts in training texts; what adds them up answers each chunk with the totals that
differ from its own counts, so each chunk has the part of the automaton that its texts walk,
which is bounded by the chunk. Up to ``PACKED`` shards, a chunk's keys are sent sorted and packed,
in one row for each shard; beyond, in plain rows that Spark itself sorts, so that
the exchange is always in proportion to the text.

Words, pairs and triples are named by 60-bit hashes. Among 10^9 distinct ones some two collide
with a chance of 35 %, among 10^11 about 4,300 pairs do; those have the sum of their counts.

Defined results: a null text is empty and has its end token only. Rows with null ids are
held out. Repeated rows count and are scored each time. Without training rows all
counts are 0: then V + 1 is 1, base_score 0 for each token and score the same. An empty
table gives an empty result. Very long texts are tokenized piece by piece. Further columns
are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh3_64_intdigest

from .common import mixed, text_bytes, written

HELD_OUT = (10, 0)
#: Weights of the failure arcs that are tried: of words, of pairs.
MUS = (1.0, 16.0, 256.0, 4096.0)
NUS = (0.25, 2.0, 16.0, 256.0)
SMOOTH = 0.1
CHUNK = 6 << 20
SHARD_BYTES = 24 << 20
#: Most shards that a chunk's keys are packed for; its rows then hold some 250 keys at least.
PACKED = 12_000
PIECE = 1 << 20
START = np.uint64(xxh3_64_intdigest(b" start"))
END = xxh3_64_intdigest(b" end")
WORD, PAIR, TRIPLE = range(3)
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
#: Bits of a hash that a key does without.
_SPARE = np.uint64(4)
_GAP = re.compile(rb"[\x20\x09-\x0d]")


def held_out(doc_id) -> bool:
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % HELD_OUT[0] == HELD_OUT[1]


def packed_ints(x: np.ndarray) -> bytes:
    """Whole numbers, their bytes of one place together, as most of the upper ones are alike."""
    planes = np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked_ints(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def packed_keys(x: np.ndarray) -> bytes:
    """Keys that are mostly sorted, by their differences."""
    return packed_ints(np.diff(x, prepend=np.uint64(0)))


def unpacked_keys(b: bytes) -> np.ndarray:
    return np.cumsum(unpacked_ints(b), dtype=np.uint64)


def words_of(text: bytes):
    """The words of a text, a bounded piece of it at a time."""
    at = 0
    while at < len(text):
        cut = _GAP.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        yield text[at:end].lower().split()
        at = end


class Pack:
    """Documents on their way into a chunk, as numbers of its distinct words."""

    def __init__(self, kind: pa.DataType):
        self.kind, self.ids, self.sizes, self.tokens, self.bytes = kind, [], [], [], 0
        self.numbers: dict[bytes, int] = {b" end": 0}

    def add(self, doc_id, text: bytes) -> None:
        n, numbers = 0, self.numbers
        for own in words_of(text):
            for w in set(own):
                if w not in numbers:
                    numbers[w] = len(numbers)
            self.tokens.append(np.fromiter(map(numbers.__getitem__, own), np.int32, len(own)))
            n += len(own)
        self.tokens.append(np.zeros(1, np.int32))
        self.ids.append(doc_id)
        self.sizes.append(n + 1)
        self.bytes += len(text)

    def row(self, number: int) -> pa.RecordBatch:
        hashes = np.fromiter((END if w == b" end" else xxh3_64_intdigest(w) for w in self.numbers), np.uint64, len(self.numbers))
        tokens = np.concatenate(self.tokens)
        # frequent words first: most numbers are small then; equally frequent ones by their hashes
        order = np.lexsort((hashes, -np.bincount(tokens, minlength=len(hashes))))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        train = np.array([not held_out(k) for k in self.ids])
        columns = {
            "chunk": pa.array([number], pa.int64()),
            "ids": pa.array([self.ids], pa.list_(self.kind)),
            "sizes": pa.array([packed_ints(np.array(self.sizes))], pa.binary()),
            "train": pa.array([train.tobytes()], pa.binary()),
            "n_train": pa.array([int(train.sum())], pa.int64()),
            "hashes": pa.array([packed_keys(hashes[order])], pa.binary()),
            "tokens": pa.array([packed_ints(rank[tokens])], pa.binary()),
        }
        return pa.RecordBatch.from_pydict(columns)


def tokenized(docs: DataFrame) -> DataFrame:
    """The chunks, each a row, numbered by the task that made them."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def over(batches):
        number, pack = TaskContext.get().partitionId() << 24, None
        for batch in batches:
            for k, t in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                pack = pack or Pack(batch.schema.field("doc_id").type)
                pack.add(k, t.as_buffer().to_pybytes() if t.is_valid else b"")
                if pack.bytes >= CHUNK:
                    yield pack.row(number)
                    number, pack = number + 1, None
        if pack:
            yield pack.row(number)

    schema = f"chunk long, ids array<{kind}>, sizes binary, train binary, n_train long, hashes binary, tokens binary"
    return written(docs.select("doc_id", "text").mapInArrow(over, schema), "tokenized")


class Chunk:
    """The tokens of one chunk, and its distinct words, pairs and triples: ``keys`` sorted, and
    ``of``, which of them each token ends. A text's first token ends no triple (-1)."""

    def __init__(self, row: dict):
        self.number, self.ids = row["chunk"], row["ids"]
        self.sizes = unpacked_ints(row["sizes"]).astype(np.int64)
        self.train = np.frombuffer(row["train"], bool)
        tokens, hashes = unpacked_ints(row["tokens"]).astype(np.int64), unpacked_keys(row["hashes"])
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.train_token = np.repeat(self.train, self.sizes)
        by_hash = np.argsort(hashes)
        place = np.empty(len(hashes), np.int32)
        place[by_hash] = np.arange(len(hashes), dtype=np.int32)
        h = hashes[tokens]
        before = np.empty_like(h)
        before[1:] = h[:-1]
        before[self.begins] = START
        pair = mixed(before * _ODD[0] + h)
        first = np.zeros(len(h), bool)
        first[self.begins] = True
        triple = mixed(np.concatenate((pair[:1], pair[:-1])) * _ODD[1] + h)
        pairs, of_pair = np.unique(pair >> _SPARE, return_inverse=True)
        triples, of_triple = np.unique(triple[~first] >> _SPARE, return_inverse=True)
        with_none = np.full(len(h), -1, np.int32)
        with_none[~first] = of_triple
        self.keys, self.of = (hashes[by_hash] >> _SPARE, pairs, triples), (place[tokens], of_pair.astype(np.int32), with_none)

    def counts(self, kind: int) -> np.ndarray:
        own = self.of[kind][self.train_token]
        return np.bincount(own[own >= 0], minlength=len(self.keys[kind]))

    def cuts(self, kind: int, shards: int) -> list[int]:
        """Where each shard's part of the keys begins, and their number: shards are ranges of keys."""
        edges = np.array([(k << 60) // shards for k in range(1, shards)], np.uint64)
        return [0, *np.searchsorted(self.keys[kind], edges).tolist(), len(self.keys[kind])]


_ASKS = "chunk long, kind int, shard int, keys binary, counts binary"
_TOTALS = "chunk long, kind int, shard int, differ binary, totals binary, n long, v long, n1 long, n2 long"


def _chunks_of(table: pa.Table):
    for k in range(table.num_rows):
        yield Chunk(table.slice(k, 1).to_pylist()[0])


def _ask(shards: int):
    def ask(batches):
        for batch in batches:
            for chunk in _chunks_of(pa.table(batch)):
                for kind in (WORD, PAIR, TRIPLE):
                    keys, counts = chunk.keys[kind], chunk.counts(kind)
                    cuts = chunk.cuts(kind, shards)
                    rows = [(s, packed_keys(keys[a:b]), packed_ints(counts[a:b])) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
                    n = len(rows)
                    columns = [pa.array([chunk.number] * n, pa.int64()), pa.array([kind] * n, pa.int32()), pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[k] for r in rows], pa.binary()) for k in (1, 2))]
                    yield pa.RecordBatch.from_arrays(columns, ["chunk", "kind", "shard", "keys", "counts"])

    return ask


def _added(table: pa.Table) -> pa.Table:
    """For each ask which totals differ from its own counts, and those; and a row for the
    chunk -1: training tokens, distinct ones, those met once and twice."""
    keys = [unpacked_keys(b) for b in table.column("keys").to_pylist()]
    counts = [unpacked_ints(b) for b in table.column("counts").to_pylist()]
    own = np.concatenate(counts)
    _, of = np.unique(np.concatenate(keys), return_inverse=True)
    distinct = np.bincount(of, weights=own)  # exact below 2^53
    totals = distinct[of].astype(np.uint64)
    differ, values = [], []
    for t, c in zip(np.split(totals, np.cumsum([len(c) for c in counts])[:-1]), counts):
        d = t != c
        differ.append(np.packbits(d).tobytes())
        values.append(packed_ints(t[d]))
    n = len(differ)
    stats = [int(x) for x in (distinct.sum(), (distinct > 0).sum(), (distinct == 1).sum(), (distinct == 2).sum())]
    out = {"chunk": pa.array([*table.column("chunk").to_pylist(), -1], pa.int64()), "kind": pa.array(table.column("kind").to_pylist() + table.column("kind").to_pylist()[:1], pa.int32()), "shard": pa.array(table.column("shard").to_pylist() + [-1], pa.int32()), "differ": pa.array([*differ, None], pa.binary()), "totals": pa.array([*values, None], pa.binary())}
    return pa.table(out | {k: pa.array([None] * n + [x], pa.int64()) for k, x in zip(("n", "v", "n1", "n2"), stats)})


def _plain(batches):
    """Each key of a chunk as a row of its own."""
    for batch in batches:
        for chunk in _chunks_of(pa.table(batch)):
            for kind in (WORD, PAIR, TRIPLE):
                keys, counts = chunk.keys[kind], chunk.counts(kind)
                for a in range(0, len(keys), 1 << 16):
                    b = min(len(keys), a + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(b - a, chunk.number)), pa.array(np.full(b - a, kind, np.int32)), pa.array(np.arange(a, b)), pa.array(keys[a:b].view(np.int64)), pa.array(counts[a:b])], ["chunk", "kind", "i", "key", "n"])


def totals(chunks: DataFrame, shards: int, packed: bool) -> tuple[DataFrame, list[int]]:
    """The answers to each chunk (packed: differ and totals by shard; plain: at and total of those
    that differ), and N, V, n1 and n2 of the words."""
    if packed:
        asks = chunks.mapInArrow(_ask(shards), _ASKS)
        found = written(asks.groupBy("kind", "shard").applyInArrow(_added, _TOTALS), "lm")
        words = found.where(f"chunk = -1 and kind = {WORD}")
        answers = found.where("chunk >= 0").select("chunk", "kind", "shard", "differ", "totals")
    else:
        rows = chunks.mapInArrow(_plain, "chunk long, kind int, i long, key long, n long")
        of = Window.partitionBy("kind", "key")
        found = written(rows.select("chunk", "kind", "i", "n", F.sum("n").over(of).alias("total"), (F.row_number().over(of.orderBy("chunk")) == 1).alias("once")).where("total <> n or kind = 0"), "lm")
        of_word = found.where(f"kind = {WORD} and once")
        words = of_word.agg(F.sum("total").alias("n"), *(F.count_if(F.expr(test)).alias(k) for k, test in (("v", "total > 0"), ("n1", "total = 1"), ("n2", "total = 2"))))
        answers = found.where("total <> n").groupBy("chunk", "kind").agg(F.collect_list("i").alias("at"), F.collect_list("total").alias("total"))
    row = words.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long") for c in ("n", "v", "n1", "n2"))).first()
    return answers, list(row)


def _answered(chunk: Chunk, answers: pa.Table, shards: int) -> list[np.ndarray]:
    """The totals of the chunk's words, pairs and triples."""
    out = [chunk.counts(kind) for kind in (WORD, PAIR, TRIPLE)]
    if "at" in answers.column_names:
        for r in answers.to_pylist():
            out[r["kind"]][r["at"]] = r["total"]
        return out
    cuts = [chunk.cuts(kind, shards) for kind in (WORD, PAIR, TRIPLE)]
    for r in answers.to_pylist():
        a, b = cuts[r["kind"]][r["shard"] : r["shard"] + 2]
        differ = np.unpackbits(np.frombuffer(r["differ"], np.uint8), count=b - a).astype(bool)
        out[r["kind"]][a:b][differ] = unpacked_ints(r["totals"])
    return out


class Automaton:
    """The states and arcs that the texts of a chunk can meet. A state is a number: 0 the root,
    then the words, then the pairs; ``seen`` is how often each was left in training. ``arcs``
    are by token: the counts of the arcs that a pair, a word and the root have for it."""

    def __init__(self, chunk: Chunk, totals: list[np.ndarray], stats: list[int], starts: int, left_out: bool = False):
        """``left_out``: as if each token of a training text had not been counted when it is read."""
        self.chunk = chunk
        self.n, self.v, n1, n2 = stats
        self.d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        less = chunk.train_token.astype(np.int64) if left_out else 0
        words, pairs, triples = totals
        with_none = np.append(triples, 0)  # for -1
        of_word, of_pair, of_triple = chunk.of
        self.arcs = with_none[of_triple] - less * (of_triple >= 0), pairs[of_pair] - less, words[of_word] - less
        # what each token leads to: the longest end that is known
        n_words = len(words) + 1
        self.to = np.where(pairs[of_pair] > 0, 1 + n_words + of_pair, np.where(words[of_word] > 0, 1 + of_word, 0))
        self.fails = np.zeros(1 + n_words + len(pairs), np.int64)
        self.fails[1 + n_words + of_pair] = 1 + of_word
        self.start = len(words) + 1  # the state of nothing read, a word as it were
        self.seen = np.concatenate(([0], words, [starts], pairs))
        self.less = less
        self.first_pair = 1 + n_words

    def walk(self) -> np.ndarray:
        """Reads all texts from left to right, side by side; the state carried to each token."""
        c = self.chunk
        order = np.argsort(-c.sizes, kind="stable")
        begins, sizes = c.begins[order], c.sizes[order]
        carried = np.empty(int(c.sizes.sum()), np.int64)
        state = np.full(len(order), self.start, np.int64)
        alive = np.searchsorted(-sizes, -np.arange(int(sizes[0]) if len(sizes) else 0), side="left")
        for t, n in enumerate(alive.tolist()):
            at = begins[:n] + t
            carried[at] = state[:n]
            state[:n] = self.to[at]
        return carried

    def root(self) -> np.ndarray:
        """Weights of the root's arcs."""
        if not self.n:
            return np.ones(len(self.arcs[2]))
        c = self.arcs[2]
        return np.where(c > 0, np.maximum(c - self.d, 1e-12), self.d * self.v) / np.maximum(1, self.n - self.less)

    def path(self):
        """For each token: from a pair, from a word: how often the state was seen."""
        carried = self.walk()
        pair = carried >= self.first_pair
        word = np.where(pair, self.fails[carried], carried)
        return np.where(pair, self.seen[carried] - self.less, 0), np.where(word > 0, self.seen[word] - self.less, 0)

    def logs(self, mu: float, nu: float, root: np.ndarray, path) -> np.ndarray:
        """log10 of the product of the arcs that each token takes: its state's own, or failure arcs down to one that has it."""
        of_pair, of_word = (np.maximum(x, 0) for x in path)
        arc3, arc2 = np.maximum(self.arcs[0], 0), np.maximum(self.arcs[1], 0)
        lower = (arc2 + mu * root) / (of_word + mu)
        return np.log10((np.where(of_pair > 0, arc3, 0) + nu * lower) / (of_pair + nu))


def _score(shards: int, stats: list[int], starts: int):
    n, v = stats[:2]

    def score(docs: pa.Table, answers: pa.Table) -> pa.Table:
        parts = []
        for chunk in _chunks_of(docs):
            found = _answered(chunk, answers, shards)
            word = found[WORD][chunk.of[WORD]]
            sums = lambda x: np.add.reduceat(x, chunk.begins)  # noqa: E731,B023
            base = sums(np.log10((word + SMOOTH) / (n + SMOOTH * (v + 1))))
            whole, less = (Automaton(chunk, found, stats, starts, left_out) for left_out in (False, True))
            (root, path), (root_less, path_less) = ((a.root(), a.path()) for a in (whole, less))
            columns = {"doc_id": pa.array(chunk.ids, docs.schema.field("ids").type.value_type), "held_out": pa.array(~chunk.train), "n_tokens": pa.array(chunk.sizes), "n_known": pa.array(sums((word > 0).astype(np.int64))), "base_score": pa.array(base)}
            scores, left = [], []
            for mu in MUS:
                for nu in NUS:
                    scores.append(sums(whole.logs(mu, nu, root, path)))
                    left.append(float(less.logs(mu, nu, root_less, path_less)[chunk.train_token].sum()))
            columns["scores"] = pa.FixedSizeListArray.from_arrays(pa.array(np.array(scores).T.ravel()), len(scores)).cast(pa.list_(pa.float64()))
            columns["left"] = pa.array([left] + [None] * (len(chunk.ids) - 1), pa.list_(pa.float64()))
            parts.append(pa.table(columns))
        return pa.concat_tables(parts)

    return score


def scores(docs: DataFrame, packed: bool | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.
    ``packed``: how chunks send their keys; by the size of the texts if it is not given."""
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    shards = max(1, -(-text_bytes(docs)[1] // SHARD_BYTES))
    chunks = tokenized(docs)
    starts = chunks.agg(F.coalesce(F.sum("n_train"), F.lit(0)).cast("long")).first()[0]
    answers, stats = totals(chunks, shards, shards <= PACKED if packed is None else packed)
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, scores array<double>, left array<double>"
    found = chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_score(shards, stats, starts), schema)
    found = written(found, "lm-scores")
    left = found.where("left is not null").agg(*(F.sum(F.col("left")[k]) for k in range(len(MUS) * len(NUS)))).first()
    best = max(range(len(left)), key=lambda k: left[k] if left[k] is not None else 0.0)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(stats[0]).cast("long").alias("train_tokens"), "base_score", F.col("scores")[best].alias("score"))
