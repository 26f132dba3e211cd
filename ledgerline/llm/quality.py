"""Quality of texts by voting of the nearest labelled texts in a latent-semantic space.

The terms of a text are its pairs of neighbouring byte classes (letters, digits, spaces and
signs), by the square root of their share, and a few soft bins of its shape: the shares of
distinct words and of distinct three-word runs, of capitals, and the length of words. A
bounded sample of labelled texts spans a latent-semantic space of few dimensions (truncated
singular value decomposition, by subspace iteration). The vectors of the sample are broadcast;
every text is projected and its cosine with every one of them computed exactly, in blocks of
texts. The nearest ones vote with a power of their cosine, each class by its share among all
labels, which gives a score in 0 to 1.

Defined cases: a null text is an empty one; an empty text has only shape terms and is scored
like any other. Very long texts are read whole. Without any labels every score is 0.5; with one
class only, that class's value. Ties among nearest texts all vote. Repeated rows are scored
alike. Neither doc_id, lang, source nor labels are part of what is scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.labelled import held_out, labelled_sample
from ledgerline.llm.textwords import (
    distinct_runs,
    sequence_hashes,
    slices,
    span_hashes,
    text_bytes,
    word_bounds,
)
from ledgerline.llm.worktables import WorkTables

KINDS = 64
SIGNS = "!#$%&*.,|<>/:;'\"-_=@()[]{}+?"
BINS = 8


def _byte_kinds() -> np.ndarray:
    kinds = np.zeros(256, np.int64)
    kinds[ord("a") : ord("z") + 1] = np.arange(1, 27)
    kinds[ord("A") : ord("Z") + 1] = 27
    kinds[ord("0") : ord("9") + 1] = 28
    kinds[ord(" ")], kinds[ord("\n")] = 29, 30
    for k, sign in enumerate(SIGNS):
        kinds[ord(sign)] = 31 + k
    kinds[0x80:0xC0], kinds[0xC0:] = 62, 63
    return kinds


BYTE_KINDS = _byte_kinds()


def _soft_bins(values: np.ndarray, low: float, high: float, weight: float) -> np.ndarray:
    at = np.clip((values - low) / (high - low), 0, 1) * (BINS - 1)
    base = np.minimum(at.astype(np.int64), BINS - 2)
    part = at - base
    out = np.zeros((len(values), BINS), np.float32)
    rows = np.arange(len(values))
    out[rows, base] = weight * np.sqrt(1 - part)
    out[rows, base + 1] = weight * np.sqrt(part)
    return out


def term_vectors(column: pa.Array) -> np.ndarray:
    """One row of terms for each text."""
    raw, offsets = text_bytes(column)
    n = len(column)
    size = np.diff(offsets)
    kind = BYTE_KINDS[raw]
    owner = np.repeat(np.arange(n), size)
    within = owner[1:] == owner[:-1]
    code = (owner[:-1] * KINDS + kind[:-1]) * KINDS + kind[1:]
    pairs = np.bincount(code[within], minlength=n * KINDS * KINDS).reshape(n, -1).astype(np.float32)
    pairs = np.sqrt(pairs / np.maximum(1, pairs.sum(1, keepdims=True)))
    starts, ends, of = word_bounds(raw, offsets)
    words = span_hashes(raw, starts, ends)
    count = np.bincount(of, minlength=n)
    distinct = np.diff(distinct_runs(words, of, n)[1]) / np.maximum(1, count)
    runs, run_of = sequence_hashes(words, of, n, 3)
    run_count = np.bincount(run_of, minlength=n)
    distinct_three = np.diff(distinct_runs(runs, run_of, n)[1]) / np.maximum(1, run_count)
    capitals = np.bincount(owner, kind == 27, minlength=n) / np.maximum(1, size)
    length = size / np.maximum(1, count)
    return np.concatenate(
        [
            pairs,
            _soft_bins(distinct, 0, 1, 0.5),
            _soft_bins(distinct_three, 0, 1, 0.5),
            _soft_bins(capitals, 0, 1, 0.35),
            _soft_bins(length, 3, 12, 0.35),
        ],
        axis=1,
    )


class NearestVote:
    """The latent-semantic space, the labelled vectors in it, and the vote."""

    def __init__(self, terms: np.ndarray, y: np.ndarray, sizes: dict[int, int], rank: int, nearest: int, power: int):
        self.nearest, self.power = nearest, power
        self.y = y.astype(np.float32)
        classes = [int(v) for v in np.unique(y)]
        share = {v: sizes[v] / max(1, int((y == v).sum())) for v in classes}
        total = sum(share.values()) or 1.0
        self.weight = np.array([share[int(v)] / total for v in y], np.float32)
        self.middle = terms.mean(0) if len(y) else np.zeros(terms.shape[1], np.float32)
        centred = terms - self.middle
        rank = min(rank, *centred.shape) if len(y) else 0
        basis = np.random.default_rng(7).standard_normal((centred.shape[1], rank + 8 if rank else 0)).astype(np.float32)
        for _ in range(6):
            basis = np.linalg.qr(centred.T @ (centred @ basis))[0] if rank else basis
        if rank:
            small = centred @ basis
            _, _, turn = np.linalg.svd(small, full_matrices=False)
            basis = basis @ turn[:rank].T
        self.basis = basis.astype(np.float32)
        self.vectors = self._unit(centred @ self.basis) if rank else np.zeros((0, 0), np.float32)

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        return (x / np.where(norm > 0, norm, 1)).astype(np.float32)

    def scores(self, terms: np.ndarray) -> np.ndarray:
        if len(self.y) == 0:
            return np.full(len(terms), 0.5)
        latent = self._unit((terms - self.middle) @ self.basis)
        cosine = latent @ self.vectors.T
        k = min(self.nearest, cosine.shape[1])
        least = -np.partition(-cosine, k - 1, axis=1)[:, k - 1 : k]
        vote = np.where(cosine >= least, np.maximum(cosine, 1e-3) ** self.power, 0) * self.weight
        return np.clip((vote @ self.y) / vote.sum(1), 0, 1).astype(np.float64)


def fit_quality(
    documents: DataFrame,
    labels: DataFrame,
    per_class: int = 1200,
    rank: int = 32,
    nearest: int = 15,
    power: int = 4,
) -> NearestVote:
    """Learns from at most ``per_class`` labelled documents of each class.

    Their term vectors, ``2 * per_class`` rows of 4,128 numbers, are what comes to the driver.
    """
    work = WorkTables(documents.sparkSession, "quality")
    sample, sizes = labelled_sample(documents, labels, "quality", {0: per_class, 1: per_class}, work)

    def terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = term_vectors(batch.column("text")).astype(np.float16)
            packed = pa.array([r.tobytes() for r in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([packed, batch.column("y")], ["terms", "y"])

    rows = sample.mapInArrow(terms_of, "terms binary, y int").toArrow()
    # an order of their own, so that every run adds up in the same one
    packed, y = zip(*sorted(zip(rows["terms"].to_pylist(), rows["y"].to_pylist()))) if rows.num_rows else ((), ())
    width = KINDS * KINDS + 4 * BINS
    terms = np.frombuffer(b"".join(packed), np.float16).astype(np.float32).reshape(-1, width)
    return NearestVote(terms, np.array(y, np.int64), sizes, rank, nearest, power)


def score_quality(documents: DataFrame, model: NearestVote, least: float = 0.7) -> DataFrame:
    """``documents`` with score and predicted (1 from ``least`` on), in place of any such."""
    # bounded by the parameters of the fit: the basis and the vectors of the sample
    shared = documents.sparkSession.sparkContext.broadcast(model)
    added = ("score", "predicted")
    documents = documents.select(*[c for c in documents.columns if c not in added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            scores = np.concatenate([
                shared.value.scores(term_vectors(batch.column("text").slice(k, 512)))
                for k in range(0, batch.num_rows, 512)
            ])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores), pa.array((scores >= least).astype(np.int32))],
                [*batch.schema.names, "score", "predicted"],
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return documents.mapInArrow(run, f"{kept}, score double, predicted int")


def classify_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score_quality(rows, fit_quality(documents, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")

