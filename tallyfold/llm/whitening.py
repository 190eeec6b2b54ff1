"""Whitening of embeddings by a randomised range finder with Rayleigh-Ritz.

Entries are fixed-point numbers x = floor(``SCALE`` * c). The covariance V is that
of the fit list, which holds every distinct vector once; no d x d matrix is formed
unless the last step needs it.

1. One aggregation gives the fit list, one more its number n and sums S, exactly.
2. A random block of k + ``oversample`` directions, kept orthonormal, is multiplied
   by V: a pass over all rows of the fit list, each centred before it is multiplied.
   Every pass also gives the Rayleigh-Ritz values and vectors of the block before
   it, and their residuals.
3. Passes are repeated until the residuals show the first k vectors to be
   eigenvectors to double precision. Where they do not fall fast enough for
   ``passes`` passes to be enough, the block is expanded to all d directions: one
   more pass then gives V in that basis, and Rayleigh-Ritz is exact.
4. One pass over the fit list measures how far the covariance of the whitened
   vectors is from the identity; one narrow pass over all rows whitens them.

In a pass every task adds up its own rows and gives one matrix of d x l; these are
summed by place in Spark. What reaches the driver is d x l numbers, and d x d at
most, whatever the number of rows.

Defined cases: rows whose vector is null, is empty, holds a null, NaN or infinite
entry, or an entry of more than 2^40 in size, take no part and have no result, nor
do rows of another length than most (of lengths equally frequent the greatest
counts). A null id is an id like any other; repeated rows have repeated results.
Components whose variance is below ``RANK`` of the whole have none to be scaled to,
and are left out: a table of one distinct vector, or of none, gives no rows. A
deviation that does not fit a long is null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyfold.llm.common import release_memory, stored

SCALE = 256
OVERSAMPLE, PASSES = 10, 6
#: Least share of the whole variance for a component.
RANK = 1e-13
#: Largest angle between a Ritz vector and the eigenvector, by residual and gap.
ANGLE = 1e-11
LARGEST = 2.0**40


def fixed_point(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows that take part, x as an array of longs of the most frequent length."""
    c = F.col(vector_col).cast("array<double>")
    usable = F.size(c) > 0
    usable &= F.forall(c, lambda v: v.isNotNull() & (F.abs(v) <= LARGEST))  # false for NaN, which is above all numbers
    rows = vectors.select(F.col(id_col).alias("vec_id"), c.alias("c")).where(c.isNotNull() & usable)
    rows = rows.select("vec_id", F.transform("c", lambda v: F.floor(v * SCALE)).cast("array<bigint>").alias("x"))
    most = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("x") == (most.d if most else 0))


def _matrix(batch: pa.RecordBatch, column: int) -> np.ndarray:
    values = batch.column(column)
    return values.flatten().to_numpy().reshape(len(values), -1)


def _summed(rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum of ``part`` (a matrix of the shape) over all blocks of rows (x)."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                found = part(_matrix(batch, 0))
                total = found if total is None else total + found
        if total is not None:
            at = np.arange(total.size)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.astype(np.float64).ravel())], names=["at", "value"])
        release_memory()

    sums = rows.select("x").mapInArrow(parts, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(shape[0] * shape[1])
    for r in sums:
        out[r["at"]] = r["value"]
    return out.reshape(shape)


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: exact n and S, components as columns, their variances, and figures of the fit."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float
    passes: int
    expanded: bool

    def whiten(self, rows: DataFrame) -> DataFrame:
        """vec_id, component, n, deviation, whitened, explained, identity_error of each row (vec_id, x) and component."""
        n, k = self.n, len(self.variances)
        sums, scaled = np.array(self.sums, np.int64), self.components / np.sqrt(self.variances)
        mean, explained, error = np.array([s / n for s in self.sums]), self.variances / self.trace, self.identity_error

        def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not len(batch):
                    continue
                x = _matrix(batch, 1)
                columns = [
                    batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(x) * k, n)),
                    pa.array([v for d in _deviations(x, n, sums) for v in [d] * k], pa.int64()),
                    pa.array(((x - mean) @ scaled).ravel()),
                    pa.array(np.tile(explained, len(x))),
                    pa.array(np.full(len(x) * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
            release_memory()

        kind = dict(rows.dtypes)["vec_id"]
        schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
        return (rows if k else rows.limit(0)).mapInArrow(whitened, schema)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """The sum over dimensions of (n * x - S)^2, exactly; None where it is beyond a long."""
    most = float(n) * float(np.abs(x).max(initial=0)) + float(np.abs(sums).max(initial=0))
    if most * most * x.shape[1] < 2.0**62:
        return ((n * x - sums) ** 2).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums.tolist())) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def fit(rows: DataFrame, k: int = 4, oversample: int = OVERSAMPLE, passes: int = PASSES, seed: int = 1) -> Whitening:
    """The whitening of the rows (x) to k components at most, fitted to all distinct vectors."""
    distinct = stored(rows.select("x").distinct(), "fit")
    sums = distinct.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).collect()
    d = len(sums)
    n = sums[0]["n"] if d else 0
    total = [int(r["s"]) for r in sorted(sums, key=lambda r: r["at"])]
    mean = np.array([s / n for s in total])
    nothing = Whitening(n, tuple(total), np.zeros((d, 0)), np.zeros(0), 0.0, 0.0, 0, False)
    if n < 2:
        return nothing
    k = min(k, d)

    def times(block: np.ndarray) -> tuple[np.ndarray, float]:
        """V times the block, and V's trace, from one pass over the centred rows."""

        def part(x: np.ndarray) -> np.ndarray:
            c = x - mean
            return np.vstack([c.T @ (c @ block), np.full(block.shape[1], (c * c).sum())])

        found = _summed(distinct, part, (d + 1, block.shape[1])) / n
        return found[:-1], float(found[-1, 0])

    width = min(d, k + oversample)
    start = np.random.default_rng(seed).standard_normal((d, width))
    block, done, expanded, before = np.linalg.qr(start)[0], 0, width == d, np.inf
    while True:
        image, trace = times(block)
        done += 1
        values, turn = np.linalg.eigh(_symmetric(block.T @ image))
        values, turn = values[::-1], turn[:, ::-1]
        vectors, residual = block @ turn, image @ turn - (block @ turn) * values
        worst = _angle(values, np.linalg.norm(residual, axis=0), k)
        if expanded or worst <= ANGLE:
            break
        left = passes - done
        fall = worst / before if np.isfinite(before) and before else 0.0
        if left <= 0 or fall and worst * fall**left > ANGLE:
            block, expanded = np.eye(d), True
        else:
            block, before = np.linalg.qr(image)[0], worst
    keep = min(k, int((values > RANK * trace).sum()))
    if not keep:
        return nothing
    vectors, values = vectors[:, :keep], values[:keep]
    scaled = vectors / np.sqrt(values)

    def whitened(x: np.ndarray) -> np.ndarray:
        w = (x - mean) @ scaled
        return np.vstack([w.T @ w, w.sum(axis=0)])

    found = _summed(distinct, whitened, (keep + 1, keep)) / n
    error = float(np.abs(found[:-1] - np.outer(found[-1], found[-1]) - np.eye(keep)).max())
    return Whitening(n, tuple(total), vectors, values, trace, error, done, expanded)


def _symmetric(a: np.ndarray) -> np.ndarray:
    return (a + a.T) / 2


def _angle(values: np.ndarray, residual: np.ndarray, k: int) -> float:
    """Bound of the angle between the first k Ritz vectors and eigenvectors: residual by gap to the nearest other value."""
    if values[0] <= 0:
        return 0.0
    gaps = np.abs(values[:k, None] - values[None, :])
    gaps[np.arange(k), np.arange(k)] = np.inf
    return float((residual[:k] / np.maximum(gaps.min(axis=1), 1e-300)).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", **how) -> DataFrame:
    """One row per usable vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = fixed_point(vectors, id_col, vector_col)
    return fit(rows, **how).whiten(rows)
