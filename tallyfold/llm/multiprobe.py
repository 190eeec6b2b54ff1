"""Approximate nearest neighbours by multiprobe p-stable hashing.

Nearness is the inner product. Vectors are scaled by the largest norm M and get
one more coordinate, sqrt(1 - |x|^2 / M^2); the queries, scaled to length one, get
a zero there. The distance between the two then falls as the product grows.

A table has m functions floor((a . x + b) / W) with normal a. A query visits its
own bucket of each table, then buckets next to it in the order in which the
distances of its projections to the bucket's edges make a hit likely: sets of
steps to a neighbour, from a fixed list in order of their expected squared
distance. What all tables give is merged, and ranked by the exact product.

Width, functions, tables and probes are fitted on a sample of ``sample_rows``
vectors at most, so that the sample's own nearest neighbours are found with the
target recall; every vector is indexed. Where no number of tables and probes
reaches the target, functions are taken away, down to none, which is one bucket
and exact. This is so for tables of any size; only one or two vectors have no
functions to begin with. A query that meets fewer than the wanted neighbours is
compared with all vectors, in blocks.

Equal vectors form one entry with their smallest k + 1 ids, which are all that any
answer needs. Buckets of more than ``PART`` entries are cut into parts by a hash,
and queries visit every part.

Defined cases: vectors that are null, zero, of another length than most, or hold
null or non-finite components take no part, as do rows with a null id; rows with
the query's id are no candidates; an id on several rows counts once, with its
best score; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyfold.llm.common import groups_in_order, stored

K = 20
PART = 4096
SAMPLE_ROWS = 20_000


def probing_order(m: int, most: int) -> list[tuple[int, ...]]:
    """Step sets in order of expected success; a step is a place among the 2m edges, nearest first.

    The j-th nearest edge has the expected squared distance j(j + 1) / (4(m + 1)(m + 2)),
    in widths, in the nearer half, and mirrored in the other. Places j and
    2m + 1 - j are the two edges of one function and exclude each other.
    """
    near = [j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)]
    cost = near + [1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(m + 1, 2 * m + 1)]
    out: list[tuple[int, ...]] = [()]
    heap = [(cost[0], (0,))] if m else []
    while heap and len(out) < most:
        total, steps = heapq.heappop(heap)
        if len({min(j, 2 * m - 1 - j) for j in steps}) == len(steps):
            out.append(steps)
        last = steps[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], (*steps[:-1], last + 1)))
            heapq.heappush(heap, (total + cost[last + 1], (*steps, last + 1)))
    return out


@dataclass
class Hashing:
    """All tables' functions: directions (dim + 1, tables * m), offsets, width, and the probing order."""

    largest: float
    directions: np.ndarray
    offsets: np.ndarray
    width: float
    m: int
    tables: int
    order: list[tuple[int, ...]]

    def _projected(self, lifted: np.ndarray) -> np.ndarray:
        return ((lifted @ self.directions + self.offsets) / self.width).reshape(len(lifted), self.tables, self.m)

    def keys(self, floors: np.ndarray) -> np.ndarray:
        """Bucket of each (row, table) from the functions' values, as int64."""
        h = np.broadcast_to(np.arange(1, self.tables + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), floors.shape[:2]).copy()
        for j in range(self.m):
            h = (h ^ floors[:, :, j].astype(np.int64).view(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
            h ^= h >> np.uint64(31)
        return h.view(np.int64)

    def buckets(self, vectors: np.ndarray) -> np.ndarray:
        return self.keys(np.floor(self._projected(lifted(vectors, self.largest))))

    def probes(self, vectors: np.ndarray) -> np.ndarray:
        """(row, table, probe) buckets of queries, most promising first."""
        p = self._projected(lifted(vectors, None))
        floors = np.floor(p)
        below = p - floors
        edges = np.concatenate([below, 1 - below], axis=2)
        rank = np.argsort(edges, axis=2)
        out = np.zeros((len(p), self.tables, len(self.order)), np.int64)
        for k, steps in enumerate(self.order):
            moved = floors.copy()
            for j in steps:
                edge = rank[:, :, j : j + 1]
                at = edge % max(self.m, 1)
                np.put_along_axis(moved, at, np.take_along_axis(moved, at, 2) + np.where(edge < self.m, -1, 1), 2)
            out[:, :, k] = self.keys(moved)
        return out


def lifted(vectors: np.ndarray, largest: float | None) -> np.ndarray:
    """Vectors with the coordinate that makes products distances; queries have no ``largest``."""
    v = vectors.astype(np.float64)
    norm = np.sqrt((v * v).sum(axis=1, keepdims=True))
    if largest is None:
        return np.concatenate([v / norm, np.zeros_like(norm)], axis=1)
    return np.concatenate([v / largest, np.sqrt(np.maximum(0, 1 - (norm / largest) ** 2))], axis=1)


def one_bucket(dim: int, largest: float) -> Hashing:
    """No functions: all vectors are in one bucket, and every query is compared with all of them."""
    return Hashing(largest, np.zeros((dim + 1, 0)), np.zeros(0), 1.0, 0, 1, [()])


def fit(sample: np.ndarray, n: int, largest: float, k: int = K, recall: float = 0.95, seed: int = 5, queries: int = 300, copies: np.ndarray | None = None) -> Hashing:
    """Hashing for n vectors, fitted on a sample of them; ``copies`` says how many rows each stands for, which count as neighbours one by one."""
    rng = np.random.default_rng(seed)
    if len(sample) < 3:
        return one_bucket(sample.shape[1], largest)
    k, wanted = min(k, len(sample) - 2), k
    asked = rng.choice(len(sample), min(queries, len(sample)), replace=False)
    base, ask = lifted(sample, largest), lifted(sample[asked], None)
    gain = ask @ base.T
    gain[np.arange(len(asked)), asked] = -np.inf
    best = np.argpartition(-gain, k, axis=1)[:, :k]
    best = np.take_along_axis(best, np.argsort(-np.take_along_axis(gain, best, 1), axis=1), 1)
    rows = np.cumsum((np.ones(len(sample)) if copies is None else copies)[best], axis=1)
    share = np.diff(np.minimum(rows, wanted), axis=1, prepend=0)  # of the answer's rows, those that are copies of each neighbour
    far = np.sqrt(np.maximum(0, 2 - 2 * np.take_along_axis(gain, best, 1)))
    width = max(1.1 * float(np.median(far)), 1e-9)
    line = np.floor((base @ rng.normal(size=(base.shape[1], 8)) + rng.uniform(0, width, 8)) / width)
    shares = [np.unique(c, return_counts=True)[1] / len(c) for c in line.T]
    spread = float(np.mean([np.exp(-(s * np.log(s)).sum()) for s in shares]))  # buckets of one function, as good as equal ones
    m = int(np.clip(round(math.log(max(n, 1) / 512) / math.log(max(spread, 1.5))), 1, 12))
    for m in range(m, 0, -1):  # fewer functions, so larger buckets, until the target is met
        order = probing_order(m, 40)
        for tables in (4, 6, 8, 12, 16, 24):
            found = Hashing(largest, rng.normal(size=(base.shape[1], tables * m)), rng.uniform(0, width, tables * m), width, m, tables, order)
            held = found.buckets(sample)[best]  # query, neighbour, table
            first = np.full(best.shape, len(order))
            probes = found.probes(sample[asked])
            for t in range(tables):
                same = probes[:, t, None, :] == held[:, :, t, None]
                first = np.minimum(first, np.where(same.any(axis=2), same.argmax(axis=2), len(order)))
            reached = [(share * (first < p)).sum() / share.sum() for p in range(1, len(order) + 1)]
            enough = np.flatnonzero(np.array(reached) >= recall)
            if len(enough):
                found.order = order[: int(enough[0]) + 1]
                return found
    return one_bucket(sample.shape[1], largest)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _best(asked: np.ndarray, vectors: np.ndarray, ids: list[np.ndarray], k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query the k ids of the largest products, ties to smaller ids, and the products.

    Fast products choose; the products returned, and their ties, come from one
    sum per pair that does not depend on where the pair stands.
    """
    a, b = asked.astype(np.float64), vectors.astype(np.float64)
    rough = a @ b.T
    n = min(k, len(b))
    bound = np.partition(rough, len(b) - n, axis=1)[:, len(b) - n]
    slack = 1e-9 * np.sqrt((a * a).sum(axis=1)) * math.sqrt(float((b * b).sum(axis=1).max()))
    for q in range(len(a)):
        near = np.flatnonzero(rough[q] >= bound[q] - slack[q])
        score = (b[near] * a[q]).sum(axis=1)
        sizes = [len(ids[j]) for j in near]
        names, score = np.concatenate([ids[j] for j in near]), np.repeat(score, sizes)
        place = np.lexsort((names, -score))[:k]
        yield names[place], score[place]


_FOUND = "query long, ids array<long>, scores array<double>"


def _compare(k: int):
    """Products of the queries and entries of each (bucket, part); columns bucket, part, is_query, entry, ids, vector."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in groups_in_order(batches, 2):
            asks = table.column(2).to_numpy(zero_copy_only=False)
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                n = int(hi - lo)
                ask = int(asks[lo:hi].sum())  # entries come first
                if not ask or ask == n:
                    continue
                held = table.slice(lo, n - ask)
                vectors, ids = _matrix(held.column(5).combine_chunks()), [x.values.to_numpy() for x in held.column(4).combine_chunks()]
                for start in range(lo + n - ask, hi, 256):
                    some = table.slice(start, min(256, hi - start))
                    rows = list(_best(_matrix(some.column(5).combine_chunks()), vectors, ids, k))
                    yield pa.RecordBatch.from_arrays(
                        [some.column(3).combine_chunks(), pa.array([r[0] for r in rows], pa.list_(pa.int64())), pa.array([r[1] for r in rows], pa.list_(pa.float64()))],
                        names=["query", "ids", "scores"],
                    )

    return compare


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of everything that the parts found for a query."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in groups_in_order(batches, 1):
            queries, ids, scores = [], [], []
            for lo, hi in zip(bounds[:-1], bounds[1:]):
                rows = table.slice(lo, hi - lo)
                names = rows.column(1).combine_chunks().flatten().to_numpy()
                score = rows.column(2).combine_chunks().flatten().to_numpy()
                place = np.lexsort((names, -score))
                names, score = names[place], score[place]
                _, first = np.unique(names, return_index=True)  # the best row of an id
                first = np.sort(first)[:k]
                queries.append(rows.column(0)[0].as_py())
                ids.append(names[first])
                scores.append(score[first])
            yield pa.RecordBatch.from_arrays([pa.array(queries, pa.int64()), pa.array(ids, pa.list_(pa.int64())), pa.array(scores, pa.list_(pa.float64()))], names=["query", "ids", "scores"])

    n_tasks = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return found.repartition(n_tasks, "query").sortWithinPartitions("query").mapInArrow(merge, _FOUND)


class NeighbourSearch:
    """An index over all vectors of a table and the search of query vectors in it."""

    def __init__(self, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, recall: float = 0.95, sample_rows: int = SAMPLE_ROWS):
        self.k = k
        v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).where("id is not null and vector is not null")
        finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
        norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
        v = v.where(finite).withColumn("norm", norm).where("norm > 0")
        sizes = v.groupBy(F.size("vector").alias("dim")).agg(F.count("*").alias("n"), F.max("norm").alias("largest")).orderBy(F.desc("n"), "dim").limit(1).collect()
        self.dim, n, largest = (sizes[0][0], sizes[0][1], math.sqrt(sizes[0][2])) if sizes else (0, 0, 1.0)
        self.usable = v.where(F.size("vector") == self.dim).select("id", "vector")
        self.entries = stored(self._entries(), "entries")
        share = min(1.0, sample_rows / max(n, 1))
        some = self.entries.where(F.pmod(F.xxhash64("entry"), F.lit(1 << 20)) < share * (1 << 20)).select("vector", F.size("ids")).toArrow()
        sample = _matrix(some.column(0).combine_chunks()) if len(some) else np.zeros((0, self.dim))
        self.hashing = fit(sample, n, largest, k, recall, copies=some.column(1).to_numpy())

    def _entries(self) -> DataFrame:
        """entry (least id), ids (the k + 1 least) and vector of each distinct vector; a frequent one is thinned by salt first."""
        salted = Window.partitionBy("vector", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id")
        thin = self.usable.withColumn("r", F.row_number().over(salted)).where(F.col("r") <= self.k + 1)
        every = thin.groupBy("vector").agg(F.slice(F.array_sort(F.collect_set("id")), 1, self.k + 1).alias("ids"))
        return every.select(F.col("ids")[0].alias("entry"), "ids", "vector")

    def neighbours(self, queries: DataFrame, id_col: str = "vec_id") -> DataFrame:
        """query_id, rank, vec_id, score: the k nearest of each query id that has a usable vector."""
        k, hashing = self.k, self.hashing
        asked = self.usable.join(queries.select(F.col(id_col).cast("long").alias("id")).distinct(), "id", "left_semi")
        of_entry = stored(asked.join(self.entries.select("entry", "vector"), "vector").select(F.col("id").alias("query_id"), "entry"), "asked")
        asked = self.entries.join(of_entry.select("entry").distinct(), "entry", "left_semi")

        def hashed(probes: bool):
            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    for start in range(0, len(batch), 1000):
                        some = batch.slice(start, 1000)
                        vectors = _matrix(some.column(1))
                        keys = hashing.probes(vectors) if probes else hashing.buckets(vectors)
                        keys = keys.reshape(len(some), -1)
                        rows = pa.array(np.repeat(np.arange(len(some)), keys.shape[1]))
                        yield pa.RecordBatch.from_arrays([some.column(0).take(rows), pa.array(keys.reshape(-1))], names=["entry", "bucket"])

            return run

        held = stored(self.entries.select("entry", "vector").mapInArrow(hashed(False), "entry long, bucket long"), "buckets")
        probes = asked.select("entry", "vector").mapInArrow(hashed(True), "entry long, bucket long")
        parts = held.groupBy("bucket").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
        found = stored(_merged(self._searched(held.join(parts, "bucket"), probes.join(parts, "bucket")), k + 1), "found")
        short = found.where(F.size("ids") <= k)  # all of them, where there are no more vectors
        missing = asked.select("entry").join(found.where(F.size("ids") > k).select(F.col("query").alias("entry")), "entry", "left_anti")
        if not short.isEmpty() or not missing.isEmpty():
            found = found.where(F.size("ids") > k).unionAll(self._exhaustive(missing))
        ranked = of_entry.join(found, of_entry.entry == found["query"]).select("query_id", F.posexplode(F.arrays_zip("ids", "scores")).alias("pos", "hit"))
        own = Window.partitionBy("query_id").orderBy("pos")
        ranked = ranked.where(F.col("hit.ids") != F.col("query_id")).withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
        return ranked.select("query_id", "rank", F.col("hit.ids").alias("vec_id"), F.col("hit.scores").alias("score"))

    def _searched(self, held: DataFrame, asked: DataFrame) -> DataFrame:
        """Rows (entry, bucket, parts) of both sides, compared bucket part by bucket part."""
        held = held.withColumn("part", F.pmod(F.xxhash64("entry"), F.col("parts").cast("long")).cast("int"))
        asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        both = held.withColumn("is_query", F.lit(False)).unionByName(asked.withColumn("is_query", F.lit(True)))
        both = both.join(self.entries, "entry").select("bucket", "part", "is_query", "entry", "ids", "vector")
        n_tasks = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return both.repartition(n_tasks, "bucket", "part").sortWithinPartitions("bucket", "part", "is_query").mapInArrow(_compare(self.k + 1), _FOUND)

    def _exhaustive(self, asked: DataFrame) -> DataFrame:
        """The queries against all vectors, in blocks of ``PART`` entries."""
        n = max(1, -(-self.entries.count() // PART))
        every = self.entries.select("entry", F.lit(0).cast("long").alias("bucket"), F.lit(n).alias("parts"))
        return _merged(self._searched(every, asked.select("entry", F.lit(0).cast("long").alias("bucket"), F.lit(n).alias("parts"))), self.k + 1)
