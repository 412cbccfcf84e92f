"""Embedding near-duplicates by product quantisation.

Vectors are put into inverted lists by the centroid of the largest dot product, and, where
lists would grow beyond ``LIST`` members, by the nearest sub-centroid of what is left; so the
number of lists grows with that of the vectors. In its list a vector is known by the codes of
its residual, the nearest of 256 codewords in each subspace of 8 components. A query reads the
lists that could hold a linked vector: those whose centroids' products fall short of the best
by no more than a link of the least cosine may shift them. There, its products with the
decoded vectors (the sums of what the query's tables say for the codes) are compared with the
least product that a linked query may have with each; what passes is computed exactly, in
double precision. Links below the least cosine are never returned.

What a link may shift is ``SIGMAS`` (for members ``CODE_SIGMAS``) standard deviations of the
product with a direction as they lie in the data (any two vectors, nearest vectors of the sample, or evenly), whichever is
most, and never more than a link can shift at all.

Vectors with equal directions count as one all the way, with their number. Near lists are
put together in groups; groups are read by blocks of vectors against blocks of queries,
each in a task of its own, so no list must fit in one; a block returns sums for each query and edges that connect what is
linked, never all pairs.

Each length of vectors has an index (centroids, codewords) of its own, fitted on a bounded
sample, about ``SAMPLE`` distinct vectors of the smallest hash, at most SAMPLE_BYTES in all;
every vector is indexed and is a query.

In vectors of a few dimensions all links are found; in others a link may be missed that goes
in a direction in which the data hardly differ otherwise. Tests measure the recall against
brute force, by lengths and spectra.

Defined results: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing, and so do vectors of different lengths. Rows with null ids
are counted as links of others and named by the smallest id of their component. Repeated
rows link with each other. An empty table gives an empty result. Further columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import connected_components, with_least

LEAST = 0.9
SAMPLE = 16_384
SAMPLE_BYTES = 32 << 20
MAX_LISTS = 4096
#: Sub-lists of a list, at most, and members of one, about; numbers of lists of one length of vectors.
SUBLISTS, LIST = 256, 1024
SPAN = MAX_LISTS * SUBLISTS
#: Standard deviations that a link may shift a product by: in the choice of lists, of members.
SIGMAS, CODE_SIGMAS = 2.5, 4.0
#: Components of one subspace.
DIMS = 8
CODEWORDS = 256
#: Vectors of a block, if they have 128 components at most; fewer if they are longer.
MEMBERS, QUERIES = 2048, 32768


def units(df: DataFrame) -> DataFrame:
    """vec_id, unit (doubles of length 1, packed; null if there is no direction), dim."""
    kind = df.schema["vec_id"].dataType.simpleString()

    def unit(values) -> bytes | None:
        if not values or None in values:
            return None
        x = np.array(values, float)
        top = np.abs(x).max()
        if not np.isfinite(top) or top == 0:
            return None
        x = x / top
        return (x / np.sqrt(x @ x) + 0.0).tobytes()

    def over(batches):
        for batch in batches:
            found = [unit(v) for v in batch.column("embedding").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(found, pa.binary()), pa.array([len(u) // 8 if u else 0 for u in found], pa.int32())], ["vec_id", "unit", "dim"])

    return df.select("vec_id", "embedding").mapInArrow(over, f"vec_id {kind}, unit binary, dim int").withColumn("cls", F.when(F.col("unit").isNotNull(), F.xxhash64("unit")))


def _means(x: np.ndarray, k: int, rounds: int, rng, normed: bool) -> np.ndarray:
    """k means; by dot product if ``normed``, by distance otherwise."""
    centres = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        score = x @ centres.T if normed else x @ centres.T - 0.5 * (centres**2).sum(1)
        of = score.argmax(1)
        order = np.argsort(of, kind="stable")
        present, first = np.unique(of[order], return_index=True)
        sums = np.add.reduceat(x[order], first, axis=0)
        centres[present] = sums / np.diff(np.append(first, len(x)))[:, None]
        if normed:
            centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    return centres


def matrix(packed: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(packed), width))
    for row, u in zip(out, packed):
        v = np.frombuffer(u)
        row[: len(v)] = v
    return out


class Index:
    """Centroids of the lists and codewords of the subspaces, for vectors of one length; ``width``
    is the padded length. A list is numbered by its centroid and its sub-centroid."""

    def __init__(self, sample: np.ndarray, n: int, least: float, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.width, self.least = sample.shape[1], least
        x = sample.astype(np.float32)
        lists = max(1, min(MAX_LISTS, int(math.sqrt(n)), len(sample) // 8))
        self.parts = max(1, min(SUBLISTS, -(-n // (lists * LIST)), len(sample) // 8))
        self.centroids = _means(x, lists, 8, rng, True)
        residual = x - self.centroids[(x @ self.centroids.T).argmax(1)]
        self.sub = self._in_a_row(_means(residual, self.parts, 8, rng, False)) if self.parts > 1 else np.zeros((1, self.width), np.float32)
        residual -= self.sub[(residual @ self.sub.T - 0.5 * (self.sub**2).sum(1)).argmax(1)]
        words = min(CODEWORDS, len(sample))
        self.codewords = np.stack([_means(np.ascontiguousarray(residual[:, a : a + DIMS]), words, 6, rng, False) for a in range(0, self.width, DIMS)])
        self.spread = math.sqrt(2 - 2 * least)
        # how directions lie in which vectors differ: any two of the sample, and nearest ones
        pairs = x - x[rng.permutation(len(x))]
        some = x[: min(len(x), 2048)]
        near = some @ x.T
        near[near > 1 - 1e-6] = -2
        self.shapes = [np.eye(self.width, dtype=np.float32) / self.width]
        for d in (pairs, some - x[near.argmax(1)]):
            length = np.linalg.norm(d, axis=1)
            if (length > 0).any():
                d = d[length > 0] / length[length > 0, None]
                self.shapes.append((d.T @ d / len(d)).astype(np.float32))
        self.apart = self._apart(self.centroids)
        self.sub_apart = self._apart(self.sub)

    @staticmethod
    def _in_a_row(centres: np.ndarray) -> np.ndarray:
        """Each followed by the nearest that is left, so that neighbours share groups."""
        left, out = list(range(1, len(centres))), [0]
        while left:
            k = int(((centres[left] - centres[out[-1]]) ** 2).sum(1).argmin())
            out.append(left.pop(k))
        return centres[out]

    def _allowed(self, d: np.ndarray, sigmas: float) -> np.ndarray:
        """How far a linked query's product with each of ``d`` may be from its vector's: so many
        standard deviations, in the worst of ``shapes``, and no more than the length allows."""
        length = np.sqrt((d * d).sum(1))
        most = np.sqrt(np.maximum(0, np.max([((d @ m) * d).sum(1) for m in self.shapes], axis=0)))
        return np.minimum(length, sigmas * most)

    def _apart(self, centres: np.ndarray) -> np.ndarray:
        """For each pair of centres, the shift of a linked query between them that is allowed."""
        return np.stack([self._allowed(centres - c, SIGMAS) for c in centres]) * self.spread + 1e-5

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """List and residual of each vector."""
        of = (x @ self.centroids.T).argmax(1)
        residual = x - self.centroids[of]
        sub = (residual @ self.sub.T - 0.5 * (self.sub**2).sum(1)).argmax(1)
        return of * self.parts + sub, residual - self.sub[sub]

    def encode(self, x: np.ndarray):
        """list, codes, least product that a query linked with x has with what the codes stand for."""
        x = x.astype(np.float32)
        of, residual = self.assign(x)
        codes = np.empty((len(x), len(self.codewords)), np.uint8)
        for m, words in enumerate(self.codewords):
            part = residual[:, m * DIMS : m * DIMS + DIMS]
            codes[:, m] = (part @ words.T - 0.5 * (words**2).sum(1)).argmax(1)
        error = x - self.decode(of, codes)
        # a query of the least cosine is that share of x and, for the rest, a direction across x
        along = (x * error).sum(1)
        across = self._allowed(error - along[:, None] * x, CODE_SIGMAS) * math.sqrt(1 - self.least**2)
        return of, codes, (self.least * (1 - along) - across - 1e-3).astype(np.float32)

    def decode(self, of, codes: np.ndarray) -> np.ndarray:
        """The vectors that the codes stand for."""
        coarse = self.centroids[of // self.parts] + self.sub[of % self.parts]
        return coarse + np.hstack([words[codes[:, m]] for m, words in enumerate(self.codewords)])

    def probes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, list) pairs: which lists each query must read."""
        x = x.astype(np.float32)
        score = x @ self.centroids.T
        best = score.argmax(1)
        hit = score[np.arange(len(x)), best][:, None] - score <= self.apart[best]
        if self.parts == 1:
            return np.nonzero(hit)
        rows, lists = [], []
        for i in np.flatnonzero(hit.any(0)).tolist():
            own = np.flatnonzero(hit[:, i])
            fit = (x[own] - self.centroids[i]) @ self.sub.T - 0.5 * (self.sub**2).sum(1)
            top = fit.argmax(1)
            r, j = np.nonzero(fit[np.arange(len(own)), top][:, None] - fit <= self.sub_apart[top])
            rows.append(own[r])
            lists.append(i * self.parts + j)
        return np.concatenate(rows), np.concatenate(lists)

    def groups(self, sizes: dict[int, int], most: int) -> list[list[int]]:
        """The lists in groups of at most ``most`` members (or of one list): those of a centroid,
        then those of the nearest centroid that is left."""
        of: dict[int, list[int]] = {}
        for k in sorted(sizes):
            of.setdefault(k // self.parts, []).append(k)
        out, left, at, total = [], np.array(sorted(of)), None, 0
        while len(left):
            k = 0 if at is None else int((self.centroids[left] @ self.centroids[at]).argmax())
            at = int(left[k])
            left = np.delete(left, k)
            for own in of[at]:
                if not out or total + sizes[own] > most:
                    out.append([])
                    total = 0
                out[-1].append(own)
                total += sizes[own]
        return out

    def links(self, x: np.ndarray, y: np.ndarray, seen: np.ndarray, reach: np.ndarray) -> np.ndarray:
        """Which of the members y (columns), seen by their codes, each query x (row) is linked with."""
        i, j = np.nonzero(x.astype(np.float32) @ seen.T >= reach[None, :])
        out = np.zeros((len(x), len(y)), bool)
        for a in range(0, len(i), 65536):
            p, q = i[a : a + 65536], j[a : a + 65536]
            out[p, q] = np.einsum("ij,ij->i", x[p], y[q]) >= self.least
        return out


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """(row, column) pairs that connect what a link matrix connects; at most rows + columns."""
    if np.count_nonzero(linked) <= sum(linked.shape):
        return list(zip(*(x.tolist() for x in np.nonzero(linked))))
    out, rows, columns = [], linked.any(1), np.ones(linked.shape[1], bool)
    while rows.any():
        frontier = [int(np.argmax(rows))]
        rows[frontier[0]] = False
        while frontier:
            i = frontier.pop()
            new = np.flatnonzero(linked[i] & columns)
            columns[new] = False
            for j in new.tolist():
                out.append((i, j))
                reached = np.flatnonzero(linked[:, j] & rows)
                rows[reached] = False
                out += [(k, j) for k in reached.tolist()]
                frontier += reached.tolist()
    return out


def fit(classes: DataFrame, counts: dict[int, int], least: float) -> dict[int, Index]:
    """An index for each length of vectors, from about as many vectors of the smallest hashes as share SAMPLE_BYTES."""
    tops, widths = [], {dim: -(-dim // DIMS) * DIMS for dim in counts}
    for dim, n in counts.items():
        most = max(16, min(SAMPLE, SAMPLE_BYTES // (8 * widths[dim] * len(counts))))
        tops.append((dim, 2**63 - 1 if most >= n else int(2**64 * (most / n)) - 2**63))
    top = classes.sparkSession.createDataFrame(tops, "dim int, top long")
    samples = {dim: [] for dim in counts}
    for r in classes.join(F.broadcast(top), "dim").where("cls <= top").orderBy("cls").select("dim", "unit").collect():
        samples[r["dim"]].append(r["unit"])
    return {dim: Index(matrix(own, widths[dim]) if own else np.eye(1, widths[dim]), counts[dim], least) for dim, own in samples.items()}


def by_dim(batch: pa.RecordBatch):
    """(dim, places, packed vectors) for each length of vectors of a batch."""
    dims, packed = batch.column("dim").to_numpy(), batch.column("unit").to_pylist()
    for dim in np.unique(dims).tolist():
        at = np.flatnonzero(dims == dim)
        yield dim, at, [packed[k] for k in at.tolist()]


def linked(classes: DataFrame, least: float = LEAST) -> tuple[DataFrame, DataFrame]:
    """Of distinct directions (cls, unit, dim, m): (cls, links), the sum of the ``m`` of the
    others linked; and (u, v), edges that connect them."""
    spark = classes.sparkSession
    counts = {r["dim"]: r["count"] for r in classes.groupBy("dim").count().collect()}
    if not counts:
        return spark.createDataFrame([], "cls long, links long"), spark.createDataFrame([], "u long, v long")
    indexes = fit(classes, counts, least)
    shared = spark.sparkContext.broadcast(indexes)

    def encode(batches):
        for batch in batches:
            lists, codes, reach = np.zeros(batch.num_rows, np.int64), [b""] * batch.num_rows, np.zeros(batch.num_rows, np.float32)
            for dim, at, packed in by_dim(batch):
                index = shared.value[dim]
                of, own, reach[at] = index.encode(matrix(packed, index.width))
                lists[at] = dim * SPAN + of
                for k, c in zip(at.tolist(), own):
                    codes[k] = c.tobytes()
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("cls", "unit", "dim", "m")), pa.array(lists), pa.array(codes, pa.binary()), pa.array(reach)], ["cls", "unit", "dim", "m", "list", "codes", "reach"])

    members = written(classes.select("cls", "unit", "dim", "m").mapInArrow(encode, "cls long, unit binary, dim int, m long, list long, codes binary, reach float"), "codes")

    # a row for each list: at most SPAN for each length of vectors
    sizes: dict[int, dict[int, int]] = {}
    for r in members.groupBy("list").count().collect():
        sizes.setdefault(r["list"] // SPAN, {})[r["list"] % SPAN] = r["count"]
    block = lambda rows, dim: max(1, min(rows, rows * 128 // dim))
    # groups of lists of one length, each named by its first list
    groups = {dim: indexes[dim].groups(own, block(MEMBERS, dim)) for dim, own in sizes.items()}
    group_of = {dim * SPAN + a: dim * SPAN + own[0] for dim, all_own in groups.items() for own in all_own for a in own}
    group_number = {name: k for k, name in enumerate(sorted({*group_of.values()}))}
    names_of = np.array(sorted({*group_of.values()}), np.int64)
    known = np.array(sorted(group_of), np.int64)
    grouped = spark.sparkContext.broadcast((known, np.array([group_number[group_of[k]] for k in known.tolist()], np.int64), names_of))

    def probes(batch):
        """For each query of a batch the groups to read, each once."""
        known, group, names = grouped.value
        rows, found = [], []
        for dim, at, packed in by_dim(batch):
            index = shared.value[dim]
            for a in range(0, len(at), 1024):
                row, k = index.probes(matrix(packed[a : a + 1024], index.width))
                name = dim * SPAN + k.astype(np.int64)
                where = np.minimum(np.searchsorted(known, name), len(known) - 1)
                there = known[where] == name  # lists without members aren't read
                both = np.unique(row[there] * len(names) + group[where[there]])
                rows.append(at[a : a + 1024][both // len(names)])
                found.append(names[both % len(names)])
        return (np.concatenate(rows), np.concatenate(found)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))

    def counted(batches):
        for batch in batches:
            names, n = np.unique(probes(batch)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(n.astype(np.int64))], ["list", "n"])

    asked = members.select("unit", "dim").mapInArrow(counted, "list long, n long").groupBy("list").agg(F.sum("n").alias("asked"))
    plan, size_of = {}, {(dim, g[0]): sum(sizes[dim][a] for a in g) for dim, all_own in groups.items() for g in all_own}
    for r in asked.collect():
        dim, first = divmod(r["list"], SPAN)
        size = size_of[dim, first]
        plan[r["list"]] = (-(-size // block(MEMBERS, dim)), -(-r["asked"] // block(QUERIES, dim)))
    blocks = spark.sparkContext.broadcast(plan)

    def placed(batches):
        """Members go to all blocks of queries of their group, each in one block of members."""
        for batch in batches:
            lists, cls = batch.column("list").to_numpy(), batch.column("cls").to_numpy()
            known, group, names = grouped.value
            row, name, block, part = [], [], [], []
            for k, (g, c) in enumerate(zip(names[group[np.searchsorted(known, lists)]].tolist(), cls.tolist())):
                nm, nq = blocks.value[g]
                row += [k] * nq
                name += [g] * nq
                block += [c % nm] * nq
                part += range(nq)
            taken = batch.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(name, pa.int64()), pa.array(block, pa.int32()), pa.array(part, pa.int32()), *(taken.column(c) for c in ("cls", "unit", "m", "list", "codes", "reach"))], ["name", "block", "part", "cls", "unit", "m", "list", "codes", "reach"])

    def asking(batches):
        """Queries go to all blocks of members of the groups they read, each in one block of queries."""
        for batch in batches:
            row, names = probes(batch)
            cls = batch.column("cls").to_numpy()
            r, a, b, p = [], [], [], []
            for k, name in zip(row.tolist(), names.tolist()):
                nm, nq = blocks.value[name]
                r += [k] * nm
                a += [name] * nm
                b += range(nm)
                p += [(int(cls[k]) >> 20) % nq] * nm
            taken = batch.take(pa.array(r, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int32()), pa.array(p, pa.int32()), taken.column("cls"), taken.column("unit")], ["name", "block", "part", "cls", "unit"])

    def compared(key, y: pa.Table, x: pa.Table) -> pa.Table:
        index = shared.value[key[0].as_py() // SPAN]
        rows = {"cls": [], "links": [], "u": [], "v": []}
        if y.num_rows and x.num_rows:
            mine, weights = y.column("cls").to_numpy(), y.column("m").to_numpy()
            ym = matrix(y.column("unit").to_pylist(), index.width)
            codes = np.frombuffer(b"".join(y.column("codes").to_pylist()), np.uint8).reshape(y.num_rows, -1)
            seen, reach = index.decode(y.column("list").to_numpy() % SPAN, codes), y.column("reach").to_numpy()
            for a in range(0, x.num_rows, 256):
                part = x.slice(a, 256)
                theirs = part.column("cls").to_numpy()
                hit = index.links(matrix(part.column("unit").to_pylist(), index.width), ym, seen, reach)
                hit &= theirs[:, None] != mine[None, :]
                i, j = np.nonzero(hit)
                total = np.zeros(len(theirs), np.int64)
                np.add.at(total, i, weights[j])
                own = np.flatnonzero(total)
                rows["cls"] += theirs[own].tolist()
                rows["links"] += total[own].tolist()
                for i, j in spanning(hit):
                    rows["u"].append(int(theirs[i]))
                    rows["v"].append(int(mine[j]))
        k, e = len(rows["cls"]), len(rows["u"])
        return pa.table({"cls": pa.array(rows["cls"] + [None] * e, pa.int64()), "links": pa.array(rows["links"] + [None] * e, pa.int64()), "u": pa.array([None] * k + rows["u"], pa.int64()), "v": pa.array([None] * k + rows["v"], pa.int64())})

    left = members.mapInArrow(placed, "name long, block int, part int, cls long, unit binary, m long, list long, codes binary, reach float").groupBy("name", "block", "part")
    right = members.select("cls", "unit", "dim").mapInArrow(asking, "name long, block int, part int, cls long, unit binary").groupBy("name", "block", "part")
    found = written(left.cogroup(right).applyInArrow(compared, "cls long, links long, u long, v long"), "links")
    return found.where("cls is not null").groupBy("cls").agg(F.sum("links").alias("links")), found.where("u is not null").select("u", "v")


def near_duplicates(vectors: DataFrame, least: float = LEAST) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of ``vectors`` (vec_id, embedding)."""
    rows = written(units(vectors), "units")
    # what has one hash must be one vector, and another hash tells if it is
    again = F.xxhash64(F.lit(1), "unit")
    same = rows.where("cls is not null").groupBy("cls").agg(F.first("unit").alias("unit"), F.first("dim").alias("dim"), F.count(F.lit(1)).alias("m"), F.min("vec_id").alias("least"), F.min(again).alias("low"), F.max(again).alias("high"))
    unit = F.when(F.col("low") == F.col("high"), F.col("unit")).otherwise(F.raise_error(F.lit("two directions share a 64-bit hash")).cast("binary"))
    classes = written(same.withColumn("unit", unit).drop("low", "high"), "classes")
    links, edges = linked(classes, least)
    components = connected_components(edges).withColumnRenamed("node", "cls")
    named = with_least(classes.select("cls", "least").join(components, "cls"), "component", "least").select("cls", F.col("name").alias("component_id"))
    named = classes.select("cls", "m", "least").join(named, "cls", "left").join(links, "cls", "left").select("cls", (F.col("m") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least").alias("component_id"))
    out = rows.join(named, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
