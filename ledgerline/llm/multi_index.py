"""Approximate nearest neighbours by inner product with an inverted multi-index.

The two halves of a vector are quantised separately, by k-means on a bounded sample, and a
vector is filed under the pair of its centroids. A query walks the pairs by summed distance
(less is nearer: the negative inner product of each half with its centroid) with a heap, until
the cells walked hold ``share`` of all vectors, and as many candidates as are asked for; what
lies in them is reranked by the exact inner product in double precision. Where many vectors are
alike, their cell alone is much of all vectors, so the walk goes on until ``share`` is also
reached with no cell counting for more than ``LIMIT`` times the median one.

Cells are packed into buckets of about ``BUCKET`` vectors, a larger cell is cut into several. A
query goes to the buckets that have a cell it walks, with the list of those cells, and no others;
there the queries that walk a cell are multiplied with the vectors of that cell alone, so the work
of a query is the number of vectors it walks. The vectors of a bucket that very many queries walk
are copied once for every ``QUERIES`` of them. Each bucket gives a query its nearest there, and
those are merged. So no cell, however many vectors are alike, is in one task.

Defined cases: null vectors, zero vectors, those with a null or non-finite component and those
of another length than the first of the sample take no part, nor do rows without an id. Rows
with the same id are all candidates, but none for a query of that id. Fewer candidates than
asked for are all returned. Ties go to the smaller id. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.worktables import WorkTables, wide

BUCKET = 16384
QUERIES = 2048
LIMIT = 4


def usable(column: pa.Array, dimension: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part, and their vectors in double precision."""
    sizes = np.array([-1 if v is None else v for v in pc.list_value_length(column).to_pylist()])
    if dimension is None:
        dimension = int(sizes.max(initial=0))
    rows = np.flatnonzero(sizes == dimension) if dimension > 0 else np.zeros(0, np.int64)
    if not len(rows):
        return rows, np.zeros((0, max(0, dimension)))
    flat = column.take(pa.array(rows)).flatten()
    flat = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(rows), dimension)
    good = np.isfinite(flat).all(1) & (flat != 0).any(1)
    return rows[good], flat[good]


def k_means(points: np.ndarray, k: int, rounds: int = 15) -> np.ndarray:
    distinct = np.unique(points, axis=0)
    chosen = np.random.default_rng(11).permutation(len(distinct))[: min(k, len(distinct))]
    centres = distinct[chosen].copy()
    for _ in range(rounds):
        near = nearest_centre(points, centres)
        for c in range(len(centres)):
            if (near == c).any():
                centres[c] = points[near == c].mean(0)
    return centres


def nearest_centre(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1) - 2 * points @ centres.T, axis=1)


class MultiIndex:
    """Centroids of both halves."""

    def __init__(self, sample: np.ndarray, centroids: int):
        self.dimension = sample.shape[1]
        self.half = self.dimension // 2
        self.first = k_means(sample[:, : self.half], centroids)
        self.second = k_means(sample[:, self.half :], centroids)
        self.cells = len(self.first) * len(self.second)

    def cell_of(self, vectors: np.ndarray) -> np.ndarray:
        a = nearest_centre(vectors[:, : self.half], self.first)
        return a * len(self.second) + nearest_centre(vectors[:, self.half :], self.second)

    def walk(self, query: np.ndarray, counts: np.ndarray, wanted: float, share: float = 0.0) -> list[int]:
        """Cells by summed distance until they hold ``wanted`` vectors and ``share`` of the
        limited counts."""
        limited = _limited(counts)
        mass, limited = share * limited.sum(), limited.tolist()
        a, b = -(self.first @ query[: self.half]), -(self.second @ query[self.half :])
        by_a, by_b = np.argsort(a, kind="stable").tolist(), np.argsort(b, kind="stable").tolist()
        a, b, width = a.tolist(), b.tolist(), len(self.second)
        heap, held, reached, cells = [(a[by_a[0]] + b[by_b[0]], 0, 0)], 0, 0, []
        while heap and (held < wanted or reached < mass):
            _, i, j = heapq.heappop(heap)
            cell = by_a[i] * width + by_b[j]
            cells.append(cell)
            held += counts[cell]
            reached += limited[cell]
            # each pair is pushed once: along the row, and down only from its first column
            if j + 1 < len(by_b):
                heapq.heappush(heap, (a[by_a[i]] + b[by_b[j + 1]], i, j + 1))
            if j == 0 and i + 1 < len(by_a):
                heapq.heappush(heap, (a[by_a[i + 1]] + b[by_b[0]], i + 1, 0))
        return cells


def _limited(counts: np.ndarray) -> np.ndarray:
    filled = counts[counts > 0]
    return np.minimum(counts, LIMIT * max(1, int(np.median(filled)))) if len(filled) else counts


def fit_index(vectors: DataFrame, centroids: int = 32, sample: int = 8000) -> MultiIndex | None:
    """Centroids from at most ``sample`` vectors, those with the least hash of their id."""
    rows = (
        vectors.where("embedding IS NOT NULL AND vec_id IS NOT NULL")
        .orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("embedding").toArrow()
    )
    column = rows["embedding"].combine_chunks() if rows.num_rows else None
    if column is None or not len(column):
        return None
    sizes = [n for n in pc.list_value_length(column).to_pylist() if n]
    if not sizes:
        return None
    points = usable(column, sizes[0])[1]
    return MultiIndex(points, centroids) if len(points) else None


FOUND = "query_id long, vec_id long, score double"


def _buckets(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bucket and number of buckets of each cell."""
    first, pieces, at, room = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64), -1, 0
    for cell, count in enumerate(counts.tolist()):
        if count > room:
            pieces[cell] = max(1, -(-count // BUCKET))
            first[cell] = at + 1
            at += int(pieces[cell])
            room = BUCKET * int(pieces[cell]) - count if pieces[cell] == 1 else 0
        else:
            first[cell] = max(at, 0)
            room -= count
    return first, pieces


def _filer(index):
    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value
        for batch in batches:
            rows, vectors = usable(batch.column("embedding"), known.dimension)
            packed = pa.array([v.tobytes() for v in vectors], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(rows)), pa.array(known.cell_of(vectors), pa.int64()) if len(rows) else pa.array([], pa.int64()), packed],
                ["vec_id", "cell", "vector"],
            )

    return file


WALKED = "query_id long, query binary, bucket long, cells binary"


def _walker(plan, share: float, nearest: int, own: int):
    """The buckets each query goes to, with the cells it walks there. At most ``own`` rows have
    the id of a query; they are no candidates, so that many more are held."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, counts, first, pieces = plan.value
        wanted = max(share * counts.sum(), nearest) + own
        for batch in batches:
            vectors = _matrix(batch.column("vector"))
            rows, buckets, lists = [], [], []
            for row, query in enumerate(vectors):
                cells = np.array(index.walk(query, counts, wanted, share))
                cells = cells[counts[cells] > 0]
                # a cell in several pieces is in as many buckets
                where = np.repeat(first[cells], pieces[cells])
                where += np.arange(len(where)) - np.repeat(np.cumsum(pieces[cells]) - pieces[cells], pieces[cells])
                cells = np.repeat(cells, pieces[cells]).astype(np.int32)
                order = np.argsort(where, kind="stable")
                where, cells = where[order], cells[order]
                cuts = np.flatnonzero(np.append(True, where[1:] != where[:-1])) if len(where) else []
                for a, b in zip(cuts, [*cuts[1:], len(where)]):
                    rows.append(row)
                    buckets.append(int(where[a]))
                    lists.append(cells[a:b].tobytes())
            taken = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(taken), batch.column("vector").take(taken),
                    pa.array(buckets, pa.int64()), pa.array(lists, pa.binary()),
                ],
                ["query_id", "query", "bucket", "cells"],
            )

    return walk


def _matrix(column) -> np.ndarray:
    packed = column.to_pylist()
    return np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1) if packed else np.zeros((0, 0))


def products(
    asked: np.ndarray, walked: list[np.ndarray], vectors: np.ndarray, cells: np.ndarray
) -> tuple[np.ndarray, int]:
    """Inner products of queries with the vectors of the cells they walk, and how many these are.

    ``cells`` are those of the vectors, ascending. What is not walked is not multiplied and has
    minus infinity.
    """
    found = np.full((len(asked), len(vectors)), -np.inf)
    who = np.repeat(np.arange(len(asked)), [len(w) for w in walked])
    which = np.concatenate(walked) if walked else np.zeros(0, np.int64)
    order = np.argsort(which, kind="stable")
    who, which = who[order], which[order]
    present, starts = np.unique(which, return_index=True)
    stops = np.append(starts[1:], len(which))
    low, high = np.searchsorted(cells, present, "left"), np.searchsorted(cells, present, "right")
    pairs = 0
    for a, b, s, e in zip(low.tolist(), high.tolist(), starts.tolist(), stops.tolist()):
        if a < b:
            found[who[s:e], a:b] = asked[who[s:e]] @ vectors[a:b].T
            pairs += (e - s) * (b - a)
    return found, pairs


def _reranker(nearest: int):
    def rerank(queries: pa.Table, entries: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if queries.num_rows and entries.num_rows:
            cells = entries["cell"].to_numpy()
            order = np.argsort(cells, kind="stable")
            cells, ids = cells[order], entries["vec_id"].to_numpy()[order]
            vectors = _matrix(entries["vector"])[order]
            asked, query_ids = _matrix(queries["query"]), queries["query_id"].to_numpy()
            walked = [np.frombuffer(c, np.int32) for c in queries["cells"].to_pylist()]
            for k in range(0, len(asked), 256):
                rough, _ = products(asked[k : k + 256], walked[k : k + 256], vectors, cells)
                rough[query_ids[k : k + 256][:, None] == ids[None, :]] = -np.inf
                for row, q in zip(rough, range(k, len(asked))):
                    found.append(_nearest(row, asked[q], vectors, ids, query_ids[q], nearest))
        if not found:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        q, v, s = (np.concatenate(x) for x in zip(*found))
        return pa.table({"query_id": q, "vec_id": v, "score": s})

    return rerank


def _nearest(rough, query, vectors, ids, query_id, nearest):
    """The nearest entries. Equal vectors must score equally, so what a matrix product found is
    summed once more in one fixed order, with all that come within rounding of the last."""
    some = np.flatnonzero(rough > -np.inf)
    if len(some) > nearest:
        least = -np.partition(-rough[some], nearest - 1)[nearest - 1]
        some = some[rough[some] >= least - 1e-9 * max(1.0, abs(least))]
    score = (vectors[some] * query).sum(1)
    best = np.lexsort((ids[some], -score))[:nearest]
    return np.full(len(best), query_id), ids[some][best], score[best]


def nearest_vectors(
    vectors: DataFrame,
    is_query: Column | None = None,
    nearest: int = 20,
    share: float = 0.65,
    centroids: int = 32,
) -> DataFrame:
    """query_id, rank, vec_id and score of the nearest vectors found for every query.

    ``vectors`` has vec_id and embedding; ``is_query`` says which rows ask (all divisible by
    20 unless given). What is broadcast, centroids and the sizes of at most ``centroids``
    squared cells, does not grow with the rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where("vec_id IS NOT NULL")
    index = fit_index(rows, centroids)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    work = WorkTables(spark, "multi-index")
    shared = spark.sparkContext.broadcast(index)
    filed = work.store(rows.mapInArrow(_filer(shared), "vec_id long, cell long, vector binary"), "filed")
    counts = np.zeros(index.cells, np.int64)
    for cell, n in filed.groupBy("cell").count().collect():
        counts[cell] = n
    first, pieces = _buckets(counts)
    asks = F.pmod("vec_id", F.lit(20)) == 0 if is_query is None else is_query
    plan = spark.sparkContext.broadcast((index, counts, first, pieces))
    # rows of one id ask alike or not, as ``is_query`` says; all of them are no candidates
    own = filed.groupBy("vec_id").count().agg(F.max("count")).first()[0] or 0
    walked = work.store(
        filed.where(asks).mapInArrow(_walker(plan, share, nearest, own), WALKED), "walked"
    )
    # a row for each bucket that is walked
    blocks = work.store(
        walked.groupBy("bucket").agg(F.ceil(F.count("*") / QUERIES).cast("long").alias("blocks")), "blocks"
    )
    start = F.element_at(F.array(*[F.lit(int(x)) for x in first]), (F.col("cell") + 1).cast("int"))
    number = F.element_at(F.array(*[F.lit(int(x)) for x in pieces]), (F.col("cell") + 1).cast("int"))
    bucket = start + F.pmod(F.xxhash64("vec_id", F.lit(5)), number)
    left = walked.join(blocks, "bucket").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")))
    left = left.drop("blocks")
    again = spark.read.parquet(f"{work.folder}/blocks")
    right = filed.withColumn("bucket", bucket.cast("long")).join(again, "bucket").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    ).drop("blocks")
    found = (
        left.repartition(wide(spark), "block", "bucket").groupBy("block", "bucket")
        .cogroup(right.repartition(wide(spark), "block", "bucket").groupBy("block", "bucket"))
        .applyInArrow(_reranker(nearest), FOUND)
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)
    return ranked.select("query_id", "rank", "vec_id", "score")
