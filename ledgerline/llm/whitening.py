"""Embedding whitening from an exact covariance by polarisation.

An entry c becomes the whole number x = floor(256 c). The *fit list* has each distinct x-vector
once: n vectors with the sums S. With y = x - round(S / n), which is centred but for less than
one half, tasks add up y_i^2 of every dimension and (y_i + y_j)^2 of every pair of dimensions as
whole numbers. What the rest of the centring takes away is known exactly, so that

    n var(u) = sum of u^2 - (sum of u)^2 / n,    cov(i, j) = (var(i + j) - var(i) - var(j)) / 2

are exact fractions up to the one division that makes them doubles for ``eigh``. The driver gets
d(d + 1) / 2 sums of each fit, whatever the number of rows.

Defined cases: vectors that are null or hold a null, non-finite or too large (256 c beyond a
long) entry take no part; of the others those take part whose length most vectors of the fit
list have (of equally many, the longer), empty ones never. Repeated rows and rows with null or
equal vec_ids give results of their own. A component without variance (one vector, or fewer
dimensions than rows vary in) has a null ``whitened`` and is left out of ``identity_error``;
``explained`` is 0 where nothing varies. Signs are set so that the largest entry of a component
(the first of equals) is positive. Without usable vectors the result is empty. Columns other
than vec_id and embedding are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.worktables import WorkTables

SCALE = 256
LONG = 9.2e18  # entries beyond do not become longs
SAFE = 1 << 62  # sums of whole numbers up to here are added as 64-bit numbers
ROWS = 4096  # vectors taken at once


def scaled(rows: DataFrame) -> DataFrame:
    """vec_id and x of the vectors that take part, whatever their length."""
    fits = F.forall("embedding", lambda c: F.coalesce(F.abs(c.cast("double")) * SCALE < LONG, F.lit(False)))
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE).cast("long"))
    usable = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("embedding").isNotNull() & (F.size("embedding") > 0) & fits
    )
    return usable.select("vec_id", x.alias("x"))


def _matrices(batches: Iterator[pa.RecordBatch], column: str = "x"):
    """Whole-number matrices of the vectors, and their batches."""
    for batch in batches:
        for begin in range(0, batch.num_rows, ROWS):
            part = batch.slice(begin, ROWS)
            vectors = part.column(column)
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            yield part, flat.reshape(part.num_rows, -1)


def _exact_sums(values: np.ndarray) -> list[int]:
    """Column sums of whole numbers, none of them wrapped around."""
    top = max(int(values.max()), -int(values.min())) if values.size else 0
    if top * len(values) < SAFE:
        return values.sum(axis=0).tolist()
    return values.astype(object).sum(axis=0).tolist()


def _emit(index: list[int], sums: list[int]) -> pa.RecordBatch:
    # beyond 38 digits a sum goes in two halves
    half = 10**30
    return pa.RecordBatch.from_arrays(
        [
            pa.array(index, pa.int32()),
            pa.array([Decimal(s // half) for s in sums], pa.decimal128(38, 0)),
            pa.array([Decimal(s % half) for s in sums], pa.decimal128(38, 0)),
        ],
        ["i", "high", "low"],
    )


def _added(rows: DataFrame, task) -> dict[int, int]:
    """Sums by number over all tasks; each task hands over one row for each number."""
    parts = rows.mapInArrow(task, "i int, high decimal(38,0), low decimal(38,0)")
    total = parts.groupBy("i").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    return {r["i"]: int(r["high"]) * 10**30 + int(r["low"]) for r in total.collect()}


def _sum_dimensions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: list[int] = []
    count = 0
    for _, x in _matrices(batches):
        sums = _exact_sums(x)
        total = [a + b for a, b in zip(total, sums)] if total else sums
        count += len(x)
    if total:
        yield _emit([-1, *range(len(total))], [count, *total])


def _pairs(d: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs i < j, in the order in which they are numbered."""
    return np.triu_indices(d, 1)


def _sum_squares(centre: list[int]):
    """Sums of squares of all dimensions, then of all sums of two dimensions."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(centre)
        total: list[int] = []
        middle = np.array(centre, np.int64)
        for _, x in _matrices(batches):
            low = int(x.min()) - max(centre) if x.size else 0
            high = int(x.max()) - min(centre) if x.size else 0
            top = 2 * max(abs(low), abs(high))
            y = x - middle if top * top * len(x) < SAFE else x.astype(object) - np.array(centre, object)
            y = np.ascontiguousarray(y.T)
            sums = (y * y).sum(axis=1).tolist()
            for i in range(d - 1):
                both = y[i + 1 :] + y[i]
                sums += (both * both).sum(axis=1).tolist()
            total = [a + b for a, b in zip(total, sums)] if total else sums
        if total:
            yield _emit(list(range(len(total))), total)

    return task


@dataclass
class Whitening:
    """Means and components of a fit list; ``sums`` are exact."""

    n: int
    sums: list[int]
    centre: list[int]
    components: np.ndarray  # one in each column
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    @property
    def dimensions(self) -> int:
        return len(self.sums)


def covariance(n: int, rest: list[int], squares: dict[int, int]) -> tuple[np.ndarray, float]:
    """The covariance matrix and its trace from sums of squares; ``rest`` are the sums of y."""
    d = len(rest)
    spread = [n * squares[i] - rest[i] ** 2 for i in range(d)]  # n^2 times the variance
    found = np.zeros((d, d))
    for i in range(d):
        found[i, i] = spread[i] / n**2
    for k, (i, j) in enumerate(zip(*(p.tolist() for p in _pairs(d)))):
        both = n * squares[d + k] - (rest[i] + rest[j]) ** 2
        found[i, j] = found[j, i] = (both - spread[i] - spread[j]) / (2 * n**2)
    return found, sum(spread) / n**2


def fit_whitening(x: DataFrame, keep: int, work: WorkTables) -> Whitening | None:
    """Fits on the distinct vectors of ``x``; None where there are none."""
    distinct = work.store(x.groupBy("x").agg(F.lit(1).alias("one")).select("x"), "distinct")
    lengths = distinct.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d"))
    commonest = lengths.first()
    if commonest is None:
        return None
    fit = distinct.where(F.size("x") == commonest["d"])
    d = commonest["d"]
    sums = _added(fit, _sum_dimensions)
    n = sums.pop(-1)
    sums = [sums[i] for i in range(d)]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre)]
    matrix, trace = covariance(n, rest, _added(fit, _sum_squares(centre)))
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")[:keep]
    vectors = vectors[:, order]
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.where(vectors[largest, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    values = np.where(values[order] > trace * d * np.finfo(float).eps, values[order], 0.0)
    model = Whitening(n, sums, centre, vectors, values, trace)
    model.identity_error = _identity_error(fit, model)
    return model


def _project(x: np.ndarray, model: Whitening) -> np.ndarray:
    """Whitened values by row and component; NaN where a component has no variance."""
    rest = np.array([(s - model.n * c) / model.n for s, c in zip(model.sums, model.centre)])
    centred = (x - np.array(model.centre, np.int64)).astype(float) - rest
    with np.errstate(divide="ignore", invalid="ignore"):
        found = centred @ model.components / np.sqrt(model.eigenvalues)
    found[:, model.eigenvalues == 0] = np.nan
    return found


def _identity_error(fit: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened fit list's covariance less the identity, as measured."""
    live = np.flatnonzero(model.eigenvalues > 0)
    if not len(live):
        return 0.0

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, means = np.zeros((len(live), len(live))), np.zeros(len(live))
        for _, x in _matrices(batches):
            w = _project(x, model)[:, live]
            total += w.T @ w
            means += w.sum(axis=0)
        flat = np.concatenate([means, total.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(flat)], ["i", "s"])

    parts = fit.mapInArrow(task, "i int, s double").groupBy("i").agg(F.sum("s").alias("s"))
    sums = np.array([r["s"] for r in sorted(parts.collect(), key=lambda r: r["i"])])
    means = sums[: len(live)] / model.n
    found = sums[len(live) :].reshape(len(live), len(live)) / model.n - np.outer(means, means)
    return float(np.abs(found - np.eye(len(live))).max())


WHITENED = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("deviation", T.DecimalType(38, 0)),
        T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()),
        T.StructField("identity_error", T.DoubleType()),
    ]
)


def _deviations(x: np.ndarray, model: Whitening) -> list[int]:
    """Exact sums of (n x - S)^2 by row."""
    top = max(abs(int(x.min())), abs(int(x.max())))
    far = model.n * top + max(abs(s) for s in model.sums)
    if far * far * model.dimensions < SAFE:
        z = x * model.n - np.array(model.sums, np.int64)
    else:
        z = x.astype(object) * model.n - np.array(model.sums, object)
    return (z * z).sum(axis=1).tolist()


def _whitener(model):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        count = len(m.eigenvalues)
        share = m.eigenvalues / m.trace if m.trace > 0 else np.zeros(count)
        for part, x in _matrices(batches):
            if not len(x):
                continue
            rows = len(x)
            found = _project(x, m).ravel()
            limit = 10**38
            far = [Decimal(v) if v < limit else None for v in _deviations(x, m)]
            ids = part.column("vec_id").take(pa.array(np.repeat(np.arange(rows), count)))
            yield pa.RecordBatch.from_arrays(
                [
                    ids, pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * count, m.n, np.int64)),
                    pa.array([v for v in far for _ in range(count)], pa.decimal128(38, 0)),
                    pa.array(found, mask=np.isnan(found)), pa.array(np.tile(share, rows)),
                    pa.array(np.full(rows * count, m.identity_error)),
                ],
                WHITENED.names,
            )

    return task


def whiten(rows: DataFrame, keep: int = 4) -> DataFrame:
    """Whitened values of every usable row for the ``keep`` components of largest variance.

    ``deviation`` is an exact whole number; where it has more than 38 digits it is null.
    """
    spark = rows.sparkSession
    x = scaled(rows)
    model = fit_whitening(x, keep, WorkTables(spark, "whitening"))
    if model is None:
        return spark.createDataFrame([], WHITENED)
    fits = x.where(F.size("x") == model.dimensions)
    return fits.mapInArrow(_whitener(spark.sparkContext.broadcast(model)), WHITENED)
