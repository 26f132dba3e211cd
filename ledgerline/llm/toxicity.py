"""Toxic passages by maximum-scoring segments, and a calibrated score of each text.

Tokens are runs of letters and digits with A-Z folded; a token's features are the token and its
first four, five and six bytes, which stand for its inflected forms. From a bounded sample of
labelled texts every feature gets the log odds of its frequency in toxic against other texts,
with an informative Dirichlet prior (both classes together); what does not stand out by its z
value is left out. A token scores its best feature's log odds. All other tokens together have
log odds a little below zero, which is what each of them costs.

One linear scan over a text gives all maximal scoring segments (no segment can be extended or
cut without losing score). By extreme-value statistics a text of n tokens has about
``K n exp(-lambda s)`` segments of score s or more by chance; a segment is significant below
0.5 of these. The text's evidence is the sum of ``lambda s - ln(K n)`` over its significant
segments, and a logistic curve fitted on the sample turns it into a score in 0 to 1.

Defined cases: a null or empty text has no tokens, no segment and the score of no evidence.
Very long texts are scanned whole. Without labels, or with one class only, nothing stands out
and every score is that class's value, or 0.5. Repeated rows are scored alike. Neither doc_id,
lang, source nor labels are part of what is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.labelled import held_out, labelled_sample
from ledgerline.llm.textwords import distinct_runs, mixed, slices, span_hashes, text_bytes
from ledgerline.llm.worktables import WorkTables

STEMS = (4, 5, 6)
IS_TOKEN = np.zeros(256, bool)
IS_TOKEN[0x80:] = True
IS_TOKEN[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("0"), ord("9") + 1)]] = True


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts, ends and text numbers of all tokens."""
    raw, offsets = text_bytes(column)
    if not len(raw):
        none = np.zeros(0, np.int64)
        return raw, none, none, none
    inside = IS_TOKEN[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before = np.concatenate([[False], inside[:-1]])
    after = np.concatenate([inside[1:], [False]])
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return raw, starts, ends, np.searchsorted(offsets, starts, "right") - 1


def feature_hashes(raw, starts, ends) -> list[tuple[np.ndarray, np.ndarray]]:
    """(token numbers, hashes) of whole tokens and of each stem length."""
    found = [(np.arange(len(starts)), span_hashes(raw, starts, ends, fold=True))]
    for size in STEMS:
        long = np.flatnonzero(ends - starts > size)
        stem = span_hashes(raw, starts[long], starts[long] + size, fold=True)
        found.append((long, mixed(stem ^ np.uint64(size))))
    return found


def maximal_segments(places: np.ndarray, scores: np.ndarray, cost: float) -> list[tuple[float, int, int]]:
    """(score, first token, last token) of all maximal scoring segments.

    ``places`` are the tokens with a positive score; each other token costs ``cost``. The scan
    keeps, for every open segment, the running sums before and behind it and the latest segment
    that begins lower; a new one is joined to the latest that begins lower and ends lower. Where
    none begins lower, no open segment can grow any more, and all are done. Each link is followed
    once, so the time is linear.
    """
    done: list[tuple[float, float, int, int, int]] = []
    # sum before, sum behind, first, last, the latest kept one with a lower sum before
    kept: list[tuple[float, float, int, int, int]] = []
    total, last = 0.0, -1
    for place, score in zip(places.tolist(), scores.tolist()):
        total -= cost * (place - last - 1)
        before, behind, first, last = total, total + score, place, place
        total = behind
        at = len(kept) - 1
        while at >= 0 and kept[at][0] >= before:
            at = kept[at][4]
        while at >= 0 and kept[at][1] < behind:
            before, _, first, _, link = kept[at]
            del kept[at:]
            at = link
        if at < 0:
            done += kept
            kept = []
        kept.append((before, behind, first, last, at))
    return [(b - a, i, j) for a, b, i, j, _ in done + kept]


@dataclass
class ToxicityModel:
    """Features with their log odds (ascending hashes), segment statistics and the curve."""

    features: np.ndarray
    odds: np.ndarray
    cost: float
    decay: float  # lambda
    level: float  # ln K
    slope: float
    shift: float

    def token_scores(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log odds of all tokens (0 where nothing is known), text numbers, token counts."""
        raw, starts, ends, owner = tokens(column)
        best = np.zeros(len(starts))
        if len(self.features):
            for at, hashes in feature_hashes(raw, starts, ends):
                place = np.searchsorted(self.features, hashes)
                place[place == len(self.features)] = 0
                hit = self.features[place] == hashes
                best[at[hit]] = np.maximum(best[at[hit]], self.odds[place[hit]])
        return best, owner, np.bincount(owner, minlength=len(column))

    def passages(self, column: pa.Array) -> tuple[list[list[tuple[float, int, int]]], np.ndarray]:
        """Maximal segments of each text, and its number of tokens."""
        best, owner, count = self.token_scores(column)
        first = np.cumsum(count) - count
        found: list[list[tuple[float, int, int]]] = [[] for _ in range(len(column))]
        toxic = np.flatnonzero(best > 0)
        texts, cut = np.unique(owner[toxic], return_index=True)
        for text, a, b in zip(texts.tolist(), cut, [*cut[1:], len(toxic)]):
            places = toxic[a:b]
            found[text] = maximal_segments(places - first[text], best[places], self.cost)
        return found, count

    def evidence(self, segments: list[tuple[float, int, int]], n: int) -> tuple[float, int]:
        """Summed normalised score of the significant segments, and their number."""
        chance = self.level + np.log(max(1, n))
        strong = [v for s, _, _ in segments if (v := self.decay * s - chance) > np.log(2)]
        return float(sum(strong)), len(strong)

    def score(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * np.log1p(evidence) + self.shift)))


def _feature_counts(sample: DataFrame) -> DataFrame:
    """How many texts of each class have a feature."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            raw, starts, ends, owner = tokens(batch.column("text"))
            parts = feature_hashes(raw, starts, ends)
            hashes = np.concatenate([h for _, h in parts])
            owners = np.concatenate([owner[at] for at, _ in parts])
            hashes, bounds = distinct_runs(hashes, owners, batch.num_rows)
            y = np.repeat(batch.column("y").to_numpy(), np.diff(bounds))
            for value in np.unique(y).tolist():
                feature, n = np.unique(hashes[y == value], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(feature.view(np.int64)),
                        pa.array(np.where(value == 1, n, 0)),
                        pa.array(np.where(value == 1, 0, n)),
                    ],
                    ["feature", "toxic", "other"],
                )

    counts = sample.mapInArrow(count, "feature long, toxic long, other long")
    return counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def fit_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    toxic_documents: int = 4000,
    other_documents: int = 8000,
    least_texts: int = 3,
    least_z: float = 5.0,
    prior: float = 0.5,
) -> ToxicityModel:
    """Learns from at most that many labelled documents of each class.

    What comes to the driver is bounded by the sample: the features that stand out in it, and a
    row of numbers for each of its texts.
    """
    work = WorkTables(documents.sparkSession, "toxicity")
    per_class = {1: toxic_documents, 0: other_documents}
    sample, sizes = labelled_sample(documents, labels, "toxic", per_class, work)
    classes = {r[0]: r[1] for r in sample.groupBy("y").count().collect()}
    texts = [classes.get(k, 0) for k in (0, 1)]
    if not all(texts):
        flat = 0.0 if not any(texts) else (20.0 if texts[1] else -20.0)
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), 0.01, 1.0, 0.0, 0.0, flat)
    # the prior has the mean frequency of both classes, worth ``prior`` texts of each
    both = (F.col("toxic") + F.col("other")) / F.lit(float(sum(texts)))
    a1, a0 = F.lit(prior) * both, F.lit(prior) * both
    odds = F.log((F.col("toxic") + a1) / (texts[1] + prior - F.col("toxic") - a1 + 1)) - F.log(
        (F.col("other") + a0) / (texts[0] + prior - F.col("other") - a0 + 1)
    )
    spread = F.sqrt(1 / (F.col("toxic") + a1) + 1 / (F.col("other") + F.lit(0.3)))
    judged = (
        _feature_counts(sample).where(F.col("toxic") >= least_texts)
        .select("feature", odds.alias("odds"), (odds / spread).alias("z"), "toxic", "other")
    )
    # by chance a feature of few toxic texts is in no other one, so its z must also beat that
    expected = (F.col("toxic") + F.col("other")) * F.lit(texts[1] / sum(texts))
    excess = (F.col("toxic") - expected) / F.sqrt(expected * F.lit(texts[0] / sum(texts)))
    strong = judged.where((excess >= least_z) & (F.col("odds") > 3.0)).toPandas()
    strong["hash"] = strong["feature"].to_numpy(np.int64).view(np.uint64)
    strong = strong.sort_values("hash")
    model = ToxicityModel(
        strong["hash"].to_numpy(np.uint64), strong["odds"].to_numpy(float), 0.01, 1.0, 0.0, 1.0, 0.0
    )
    return _calibrated(model, sample, sizes)


def _calibrated(model: ToxicityModel, sample: DataFrame, sizes: dict[int, int]) -> ToxicityModel:
    """Costs, extreme-value constants and the logistic curve, from the sample's segments."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            best, owner, count = model.token_scores(batch.column("text"))
            hit = np.flatnonzero(best > 0)
            bounds = pa.array(np.searchsorted(owner[hit], np.arange(batch.num_rows + 1)).astype(np.int32))
            places = hit - (np.cumsum(count) - count)[owner[hit]]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("y"),
                    pa.array(count.astype(np.int64)),
                    pa.ListArray.from_arrays(bounds, pa.array(places.astype(np.int64))),
                    pa.ListArray.from_arrays(bounds, pa.array(best[hit])),
                ],
                ["y", "n", "places", "scores"],
            )

    rows = sample.mapInArrow(measure, "y int, n long, places array<long>, scores array<double>").toPandas()
    rows = rows.sort_values(["y", "n"], kind="stable")
    hits = np.array([len(p) for p in rows["places"]])
    y, n = rows["y"].to_numpy(), rows["n"].to_numpy()
    share = [(hits[y == k].sum() + 0.5) / (n[y == k].sum() + 1.0) for k in (0, 1)]
    model.cost = float(max(0.01, np.log1p(-share[0]) - np.log1p(-min(share[1], 0.5))))
    # lambda: clean tokens' mean of exp(lambda * score) is one; half a hit is added to what
    # clean texts had, so that it is finite
    clean = np.concatenate([np.zeros(0), *rows["scores"][y == 0]])
    points = np.concatenate([clean, model.odds]) if len(model.odds) else np.array([1.0])
    mass = np.concatenate([np.ones(len(clean)), np.full(len(model.odds), 0.5 / max(1, len(model.odds)))])
    mass = (mass if len(model.odds) else np.array([0.5])) / (n[y == 0].sum() + 1.0)
    rest = 1 - mass.sum()
    low, high = 0.0, 20.0
    for _ in range(60):
        middle = (low + high) / 2
        mean = rest * np.exp(-middle * model.cost) + (mass * np.exp(middle * points)).sum()
        low, high = (middle, high) if mean < 1 else (low, middle)
    model.decay = max(low, 1e-3)
    segments = [
        maximal_segments(np.asarray(p, np.int64), np.asarray(s, float), model.cost)
        for p, s in zip(rows["places"], rows["scores"])
    ]
    tops = [s for k, found in zip(y, segments) if k == 0 for s, _, _ in found]
    at = float(np.median(tops)) if tops else 0.0
    count = sum(s >= at for s in tops) + 0.5
    model.level = float(np.log(count / (n[y == 0].sum() + 1.0)) + model.decay * at)
    evidence = np.array([model.evidence(found, int(k))[0] for found, k in zip(segments, n)])
    weight = np.where(y == 1, sizes.get(1, 1) / max(1, (y == 1).sum()), sizes.get(0, 1) / max(1, (y == 0).sum()))
    model.slope, model.shift = _logistic(np.log1p(evidence), y, weight / weight.mean())
    return model


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression on one number, with a small ridge, by Newton's method."""
    a = b = 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        g = weight * (y - p)
        h = weight * p * (1 - p) + 1e-6
        grad = np.array([(g * x).sum() - 0.1 * a, g.sum() - 0.01 * b])
        hess = np.array([[(h * x * x).sum() + 0.1, (h * x).sum()], [(h * x).sum(), h.sum() + 0.01]])
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        a, b = a + step[0], b + step[1]
    return float(a), float(b)


def score_toxicity(documents: DataFrame, model: ToxicityModel, least: float = 0.3) -> DataFrame:
    """``documents`` with score, predicted (1 from ``least`` on), n_passages and passages.

    ``passages`` has the significant segments by first and last token and score. Columns of
    these names that are there already are replaced.
    """
    # bounded by the parameters of the fit
    shared = documents.sparkSession.sparkContext.broadcast(model)
    added = ("score", "predicted", "n_passages", "passages")
    documents = documents.select(*[c for c in documents.columns if c not in added])
    passage = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in slices(batches, "text"):
            found, count = known.passages(batch.column("text"))
            evidence, strong = [], []
            for segments, n in zip(found, count.tolist()):
                total, _ = known.evidence(segments, n)
                chance = known.level + np.log(max(1, n)) + np.log(2)
                evidence.append(total)
                strong.append([
                    {"first": a, "last": b, "score": s} for s, a, b in segments if known.decay * s > chance
                ])
            score = known.score(np.array(evidence))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(score),
                    pa.array((score >= least).astype(np.int32)),
                    pa.array([len(s) for s in strong], pa.int32()),
                    pa.array(strong, pa.list_(passage)),
                ],
                [*batch.schema.names, "score", "predicted", "n_passages", "passages"],
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    extra = "score double, predicted int, n_passages int, passages array<struct<first:int,last:int,score:double>>"
    return documents.mapInArrow(run, f"{kept}, {extra}")


def classify_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages and passages of every document."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = score_toxicity(rows, fit_toxicity(documents, labels)).drop("text")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "n_passages", "passages"
    )
