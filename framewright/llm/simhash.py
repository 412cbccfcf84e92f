"""SimHash near-duplicates over deletion-variant signatures.

Fingerprint: the majority of the bits of the XXH64 (seed 42) of all 4-word shingles.
Two fingerprints that differ in at most 4 bits, cut into 3 segments, agree in one
segment up to a single bit. So each distinct fingerprint is indexed under every
segment with each bit in turn made a wildcard (64 variants); equal variants meet and
are verified. Rows with equal fingerprints count as one all the way.

A bucket is read as a sorted stream. Small ones compare all their members; larger
ones walk outward from one member at a time and return a star for each component
found, never all pairs. A bucket over ``BLOCK`` members is cut into blocks, and pairs
of blocks are compared in tasks of their own, so that no bucket must fit in one task.

Defined results: a null or wordless text has fingerprint zero, linked like any other.
A repeated row keeps its row. Rows with null ids are kept; they never name a
component unless all of it is null, and then its id is null. An empty table gives an
empty result. Further columns of the input are ignored.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import doc_rows, written
from .components import connected_components, with_least

SHINGLE = 4
SEED = 42
MAX_BITS = 4
#: (lowest bit, width) of the segments; 4 differing bits leave one of 3 with at most one.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
SMALL = 24
BLOCK = 4096

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_OFFSETS = np.arange(8) * 256


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    whole = b" ".join(words)
    if n <= size:
        return xxh64_intdigest(whole, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    shingles = [whole[a:b] for a, b in zip(starts[: n - size + 1].tolist(), ends[size - 1 :].tolist())]
    h = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles))
    by_byte = h.astype("<u8").view(np.uint8).reshape(-1, 8)
    if len(h) < 256:
        ones = np.unpackbits(by_byte, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        counts = np.bincount((by_byte + _OFFSETS).ravel(), minlength=2048).reshape(8, 256)
        ones = (counts @ _BITS).ravel()
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) of every row."""

    def over(batches):
        for batch in batches:
            fp = np.array([fingerprint(t) for _, t in doc_rows(batch, "doc_id", "text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(over, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def variants(fp: np.ndarray) -> np.ndarray:
    """The 64 variant keys of each fingerprint, as rows: (number of the variant, segment without that bit)."""
    out, number = [], 0
    for low, width in SEGMENTS:
        segment = (fp >> np.uint64(low)) & np.uint64((1 << width) - 1)
        for bit in range(width):
            out.append((np.uint64(number) << np.uint64(22)) | (segment & np.uint64(~(1 << bit) & ((1 << width) - 1))))
            number += 1
    return np.stack(out, axis=1).view(np.int64)


def first_meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The number of the first variant in which fingerprints meet that are linked."""
    x, out, number = a ^ b, np.full(len(a), -1, np.int64), 0
    for low, width in SEGMENTS:
        segment = (x >> np.uint64(low)) & np.uint64((1 << width) - 1)
        fits = (out < 0) & (np.bitwise_count(segment) <= 1)
        bit = np.log2(np.maximum(segment, np.uint64(1)).astype(np.float64)).astype(np.int64)
        out[fits] = number + bit[fits]
        number += width
    return out


def stars(fp: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect what is linked among distinct fingerprints: each walk goes
    out from one member, comparing members newly reached with those not reached."""
    out, left = [], fp
    while len(left) > 1:
        seed, frontier, left, found = left[0], left[:1], left[1:], []
        while len(frontier) and len(left):
            near = np.zeros(len(left), bool)
            for f in frontier:
                near |= np.bitwise_count(left ^ f) <= MAX_BITS
            frontier, left = left[near], left[~near]
            found.append(frontier)
        reached = np.concatenate(found) if found else left[:0]
        if len(reached):
            out.append((np.full(len(reached), seed), reached))
    return out


def _near_in_buckets(batches):
    """A stream of (key, fp), sorted. Yields edges (u, v, null, null) and, of buckets
    over BLOCK, members (fp, null, key, number of the block)."""

    def packed(u, v=None, key=None, block=None):
        n = len(u)
        none = lambda kind: pa.nulls(n, kind)
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), none(pa.int64()) if v is None else pa.array(v.view(np.int64)), none(pa.int64()) if key is None else pa.array(np.full(n, key, np.int64)), none(pa.int32()) if block is None else pa.array(np.full(n, block, np.int32))], ["u", "v", "key", "block"])

    def closed(key, fp):
        """Of whole buckets."""
        starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        sizes = np.diff(np.append(starts, len(key)))
        small = np.repeat(sizes <= SMALL, sizes)
        k, f = key[small], fp[small]
        for d in range(1, SMALL):
            at = np.flatnonzero(k[d:] == k[:-d])
            if not len(at):
                break
            at = at[np.bitwise_count(f[at] ^ f[at + d]) <= MAX_BITS]
            at = at[first_meeting(f[at], f[at + d]) == k[at] >> 22]
            if len(at):
                yield packed(f[at], f[at + d])
        for i in np.flatnonzero(sizes > SMALL):
            for u, v in stars(fp[starts[i] : starts[i] + sizes[i]]):
                yield packed(u, v)

    key, fp, blocks = np.zeros(0, np.int64), np.zeros(0, np.uint64), 0
    for batch in batches:
        key = np.concatenate([key, batch.column("key").to_numpy()])
        fp = np.concatenate([fp, batch.column("fp").to_numpy().view(np.uint64)])
        if not len(key):
            continue
        end = int(np.searchsorted(key, key[-1]))  # the last bucket may go on
        if end and blocks:  # the first bucket is the rest of one already cut
            first = int(np.searchsorted(key, key[0], side="right"))
            for i in range(0, first, BLOCK):
                yield packed(fp[i : min(first, i + BLOCK)], key=key[0], block=blocks + i // BLOCK)
            key, fp, end, blocks = key[first:], fp[first:], end - first, 0
        if end:
            yield from closed(key[:end], fp[:end])
            key, fp = key[end:], fp[end:]
        while len(key) > BLOCK:
            yield packed(fp[:BLOCK], key=key[0], block=blocks)
            key, fp, blocks = key[BLOCK:], fp[BLOCK:], blocks + 1
    if blocks and len(key):
        yield packed(fp, key=key[0], block=blocks)
    elif len(key):
        yield from closed(key, fp)


def _near_in_blocks(table: pa.Table) -> pa.Table:
    found = stars(np.unique(table.column("u").to_numpy().view(np.uint64)))
    u = np.concatenate([x for x, _ in found]) if found else np.zeros(0, np.uint64)
    v = np.concatenate([y for _, y in found]) if found else np.zeros(0, np.uint64)
    return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})


def near_edges(distinct_fp: DataFrame) -> DataFrame:
    """(u, v): edges that connect all distinct fingerprints within MAX_BITS."""

    def spread(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy()
            keys = variants(fp.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(fp, keys.shape[1]))], ["key", "fp"])

    buckets = distinct_fp.select("fp").mapInArrow(spread, "key long, fp long").repartition("key").sortWithinPartitions("key", "fp")
    out = written(buckets.mapInArrow(_near_in_buckets, "u long, v long, key long, block int"), "near")
    members = out.where("key is not null")
    blocks = members.groupBy("key").agg((F.max("block") + 1).alias("n"))
    pairs = members.join(blocks, "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    pairs = pairs.select("u", "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    return out.where("key is null").select("u", "v").unionByName(pairs.groupBy("key", "i", "j").applyInArrow(_near_in_blocks, "u long, v long"))


def components(docs: DataFrame) -> DataFrame:
    """doc_id, fp, component_id of every row of ``docs`` (doc_id, text)."""
    fps = written(fingerprints(docs), "fingerprints")
    classes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    found = connected_components(near_edges(classes)).withColumnRenamed("node", "fp")
    # a fingerprint without links is its own component; only the others are grouped
    linked = classes.join(found, "fp")
    named = with_least(linked, "component", "least").select("fp", F.col("name").alias("component_id"))
    single = classes.join(found.select("fp"), "fp", "left_anti").select("fp", F.col("least").alias("component_id"))
    return fps.join(named.unionByName(single), "fp", "left").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their component, columns as they
    are; repeated rows of one id stay, and so do rows with null ids."""
    kept = components(docs).where("doc_id = component_id").select("doc_id").distinct()
    # the names of the other columns don't matter inside a struct
    rows = docs.select(F.col("doc_id"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return rows.join(kept, "doc_id", "left_semi").unionByName(rows.where("doc_id is null")).select("row.*")
