"""Removal of long repeated byte strings through a suffix array in range-partitioned buckets.

A suffix counts with its first ``length`` bytes only, and only suffixes that could have an equal
are sorted. Every suffix has an *anchor*, the place of the least hash of ``TOKEN`` bytes within
its first ``length`` bytes (the leftmost of equals); equal suffixes have equal anchors at equal
distances. Suffixes of one text with one anchor are consecutive and travel as one *block* of
bytes.

1. Anchor hashes are counted. A block whose anchor is alone has no equal suffix. The others are
   known by a bitmap of bounded size, which only prunes: where it is too small for the data,
   more blocks are sorted, and none is missed.
2. Suffixes are ordered by the leading token at the anchor, its distance, their bytes, and a
   number of their own. Splitters are taken from a bounded sample in that order and shortened
   to what tells them from their neighbours. A block goes whole to its bucket; only where
   splitters fall among its suffixes, as for a token that very many blocks share, is it cut,
   so that even equal suffixes spread over buckets.
3. Each bucket is sorted by multikey quicksort. Suffixes that are equal to a neighbour repeat;
   the first and last suffix of a bucket are compared with those of the buckets beside it.

Blocks of equal content are sorted once for each slice of the input; all their places are
joined to the verdict by a 128-bit hash of the content, in a join that adaptive execution can
split. Rows of one doc_id and text are told apart by nothing and get the same result.

Defined cases: a null text is an empty one; texts of fewer than ``length`` bytes keep all; rows
with null or equal doc_ids stay rows of their own and repeat each other; texts of any size are
read in pieces that overlap; an empty table gives an empty result. Columns other than doc_id and
text are not looked at.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.multikey import equal_classes
from ledgerline.llm.textwords import slices, span_hashes, text_bytes
from ledgerline.llm.worktables import WorkTables, wide

TOKEN = 32  # bytes of the leading token
PIECE = 1 << 20  # bytes of text looked at at once
HELD = 8 << 20  # bytes of blocks held to find equal ones
MOST_BITS = 1 << 28  # of the bitmap, 32 MB
BUCKET = 16 << 20  # bytes of blocks in a partition of buckets, unless that makes too many
MOST_BUCKETS = 1 << 17
SAMPLES = 64  # sampled suffixes for each bucket
MOST_SAMPLES = 1 << 19
CHUNK = 1 << 20  # suffixes sorted at once

_PLACE_BITS = np.uint64(24)


def _anchors(raw: np.ndarray, length: int) -> np.ndarray:
    """The anchor of every suffix with ``length`` bytes, ascending."""
    count = len(raw) - TOKEN + 1
    width = length - TOKEN + 1
    at = np.arange(count)
    key = span_hashes(raw, at, at + TOKEN)
    key &= ~np.uint64((1 << 24) - 1)
    key |= at.astype(np.uint64)
    padded = np.full(-(-count // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:count] = key
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    starts = count - width + 1
    least = np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts])
    return (least & np.uint64((1 << 24) - 1)).astype(np.int64)


def _blocks(raw: np.ndarray, offsets: np.ndarray, length: int):
    """Blocks of the texts, piece by piece: bytes, first suffix, number of them, anchor, text."""
    begin = 0
    while begin + length <= len(raw):
        end = min(len(raw), begin + PIECE + length - 1)
        part = raw[begin:end]
        anchor = _anchors(part, length)
        at = np.arange(len(anchor))
        text = np.searchsorted(offsets, at + begin, "right") - 1
        inside = at + begin + length <= offsets[text + 1]
        edge = np.ones(len(anchor), bool)
        edge[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
        edge &= inside
        first = np.flatnonzero(edge)
        block = np.cumsum(edge) - 1
        size = np.bincount(block[inside], minlength=len(first)) if len(first) else first
        yield part, begin, first, size, anchor[first], text[first]
        begin += PIECE


def _token_hashes(part: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    return span_hashes(part, anchor, anchor + TOKEN)


def _count_anchors(length: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 * PIECE):
            raw, offsets = text_bytes(batch.column("text"))
            found = [
                _token_hashes(part, anchor)
                for part, _, first, _, anchor, _ in _blocks(raw, offsets, length)
            ]
            if found:
                hashes, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), pa.array(n.astype(np.int64))], ["hash", "n"]
                )

    return count


def _bits(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of each hash in a bitmap of ``size`` (a power of two) bits."""
    mask = np.uint64(size - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def _bitmap(repeated: DataFrame) -> np.ndarray:
    """A bitmap of the hashes, 8 to 16 bits for each but ``MOST_BITS`` at most; as bytes."""
    known = repeated.count()
    size = 1 << 15
    while size < MOST_BITS and size < 8 * known:
        size *= 2
    place = F.explode(
        F.array(
            F.col("hash").bitwiseAND(F.lit(size - 1)),
            F.shiftrightunsigned("hash", 32).bitwiseAND(F.lit(size - 1)),
        )
    ).alias("bit")
    cells = (
        repeated.select(place)
        .groupBy(F.shiftright("bit", 15).alias("cell"))
        .agg(F.bitmap_construct_agg(F.col("bit").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
    )
    whole = np.zeros((size >> 15, 4096), np.uint8)
    # at most MOST_BITS / 2^15 rows of 4 KB
    for row in cells.toLocalIterator():
        whole[row["cell"]] = np.frombuffer(row["bits"], np.uint8)
    return whole.ravel()


def _known(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    yes = np.ones(len(hashes), bool)
    for place in _bits(hashes, 8 * len(bitmap)):
        yes &= (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
    return yes


BLOCKS = "c1 long, c2 long, distance int, copies int, body binary, members array<struct<k1:long,k2:long,at:long>>"
_MEMBER = pa.struct([("k1", pa.int64()), ("k2", pa.int64()), ("at", pa.int64())])


class _Held:
    """Blocks of a part of the input, those of equal content together."""

    def __init__(self):
        self.rows: dict[bytes, list] = {}
        self.size = 0

    def add(self, body: bytes, distance: int, k1: int, k2: int, at: int) -> None:
        code = hashlib.blake2b(body, digest_size=16, salt=distance.to_bytes(2, "little")).digest()
        row = self.rows.get(code)
        if row is None:
            row = self.rows[code] = [body, distance, [], [], []]
            self.size += len(body)
        for column, value in zip(row[2:], (k1, k2, at)):
            column.append(value)
        self.size += 24

    def batch(self) -> pa.RecordBatch:
        codes = np.frombuffer(b"".join(self.rows), np.int64).reshape(-1, 2)
        bodies, distance, *members = zip(*self.rows.values())
        sizes = [len(m) for m in members[0]]
        flat = pa.StructArray.from_arrays(
            [pa.array(np.concatenate(m).astype(np.int64)) for m in members], fields=list(_MEMBER)
        )
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        columns = [
            pa.array(codes[:, 0].copy()), pa.array(codes[:, 1].copy()), pa.array(distance, pa.int32()),
            pa.array(sizes, pa.int32()), pa.array(bodies, pa.binary()),
            pa.ListArray.from_arrays(ends, flat),
        ]
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in BLOCKS.split(", ")])


def _candidate_blocks(length: int, bitmap):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Held()
        for batch in slices(batches, "text", 4 * PIECE):
            raw, offsets = text_bytes(batch.column("text"))
            k1 = batch.column("k1").to_numpy()
            k2 = batch.column("k2").to_numpy()
            for part, begin, first, size, anchor, text in _blocks(raw, offsets, length):
                if not len(first):
                    continue
                keep = _known(bitmap.value, _token_hashes(part, anchor))
                first, size, anchor, text = first[keep], size[keep], anchor[keep], text[keep]
                # the distance of the last suffix, the least
                distance = anchor - (first + size - 1)
                ends = first + size - 1 + length
                at = first + begin - offsets[text]
                data = part.tobytes()
                for row in zip(*(
                    c.tolist() for c in (first, ends, distance, k1[text], k2[text], at)
                )):
                    held.add(data[row[0] : row[1]], *row[2:])
                if held.size > HELD:
                    yield held.batch()
                    held = _Held()
        if held.rows:
            yield held.batch()

    return write


def _key(body: bytes, suffix: int, distance: int, length: int, own: bytes) -> bytes:
    """Place of a suffix of a block in the order of all: token, distance, bytes, own number."""
    anchor = suffix + distance
    return b"".join(
        (body[anchor : anchor + TOKEN], distance.to_bytes(2, "big"), body[suffix : suffix + length], own)
    )


def _own(c1: int, c2: int, row: int) -> bytes:
    return hashlib.blake2b(b"%d %d %d" % (c1, c2, row), digest_size=8).digest()


def _splitters(blocks: DataFrame, length: int, buckets: int, rows: int) -> list[bytes]:
    """Ascending bounds of the buckets, from at most about ``SAMPLES`` suffixes for each."""
    if buckets < 2:
        return []
    share = min(1.0, min(MOST_SAMPLES, buckets * SAMPLES) / max(1, rows))
    # which rows are taken follows from their content, so a task that runs again takes the same
    taken = blocks.where(
        F.xxhash64("c1", "c2", F.lit(11)).bitwiseAND(F.lit((1 << 30) - 1)) < F.lit(int(share * (1 << 30)))
    )

    def keys(batches):
        for batch in batches:
            found = []
            columns = (batch.column(c).to_pylist() for c in ("c1", "c2", "distance", "body"))
            for number, (c1, c2, distance, body) in enumerate(zip(*columns)):
                count = len(body) - length + 1
                own = _own(c1, c2, number)
                suffix = int.from_bytes(own[:4], "big") % count
                found.append(_key(body, suffix, distance + count - 1 - suffix, length, own))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["key"])

    sample = taken.select("c1", "c2", "distance", "body").mapInArrow(keys, "key binary")
    # at most about MOST_SAMPLES keys of some 240 bytes come to the driver
    ordered = sorted(bytes(r["key"]) for r in sample.collect())
    cuts, before = [], b""
    for i in range(1, buckets):
        # of equal keys, as of one content in several slices, the first
        j = bisect_left(ordered, ordered[i * len(ordered) // buckets]) if ordered else 0
        if j == 0:
            continue
        low, high = ordered[j - 1], ordered[j]
        same = next(x for x, (a, b) in enumerate(zip(low, high)) if a != b)
        cut = high[: same + 1]
        if cut > before:
            cuts.append(cut)
            before = cut
    return cuts


ROUTED = "bucket int, c1 long, c2 long, skipped int, distance int, copies int, body binary"


def _router(length: int, splitters):
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts = splitters.value
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("c1", "c2", "distance", "copies", "body")]
            for number, (c1, c2, distance, copies, body) in enumerate(zip(*columns)):
                count = len(body) - length + 1
                anchor = distance + count - 1
                token = body[anchor : anchor + TOKEN]
                low = bisect_right(cuts, token + distance.to_bytes(2, "big"))
                high = bisect_right(cuts, token + (distance + count).to_bytes(2, "big"))
                if low == high:
                    out.append((low, c1, c2, 0, distance, copies, body))
                    continue
                own = _own(c1, c2, number)
                where = [
                    bisect_right(cuts, _key(body, s, anchor - s, length, own)) for s in range(count)
                ]
                begin = 0
                for s in range(1, count + 1):
                    if s == count or where[s] != where[begin]:
                        piece = body[begin : s - 1 + length]
                        out.append((where[begin], c1, c2, begin, anchor - (s - 1), copies, piece))
                        begin = s
            if out:
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                    [f.split()[0] for f in ROUTED.split(", ")],
                )

    return route


VERDICTS = "c1 long, c2 long, begin int, end int, bucket int, side int, edge binary"
_VERDICT_KINDS = (
    pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary(),
)


def _sort_bucket(length: int):
    """Suffixes of a bucket that repeat, as runs by block; first and last suffix as edges."""

    def sort(table: pa.Table) -> pa.Table:
        c = [table.column(f).to_numpy() for f in ("c1", "c2", "skipped", "distance", "copies")]
        # equal pieces, of several slices, stand for each other
        order = np.lexsort((c[2], c[1], c[0]))
        c1, c2, skipped, distance, copies = (x[order] for x in c)
        bodies = pc.take(table.column("body").combine_chunks().cast(pa.large_binary()), pa.array(order))
        _, ends, data = bodies.buffers()
        ends = np.frombuffer(ends, np.int64)[bodies.offset : bodies.offset + len(bodies) + 1]
        raw = np.frombuffer(data, np.uint8)
        size = np.diff(ends) - length + 1
        first = np.ones(len(c1), bool)
        first[1:] = (c1[1:] != c1[:-1]) | (c2[1:] != c2[:-1]) | (skipped[1:] != skipped[:-1]) | (size[1:] != size[:-1])
        group = np.cumsum(first) - 1
        copies = np.bincount(group, copies).astype(np.int64)
        keep = np.flatnonzero(first)
        c1, c2, skipped, distance, size, at = (
            x[keep] for x in (c1, c2, skipped, distance, size, ends[:-1])
        )
        anchor = at + size - 1 + distance
        n = len(at)
        alike = np.arange(n) + n
        who, classes = equal_classes(raw, anchor, TOKEN, np.zeros(n, np.int64))
        alike[who] = classes
        repeats = [np.zeros(int(size.sum()), bool)]
        base = np.cumsum(size) - size  # number of the first suffix of each block
        repeated = repeats[0]
        whole = np.flatnonzero(copies > 1)
        repeated[_ranges(base[whole], size[whole])] = True

        order = np.argsort(alike[who], kind="stable")
        blocks = who[order]
        edges = np.flatnonzero(np.append(True, alike[blocks][1:] != alike[blocks][:-1])) if len(blocks) else []
        heavy = size[blocks]
        done, stops = 0, [*list(edges[1:]), len(blocks)] if len(blocks) else []
        last = 0
        for stop in stops:
            # classes of one token are sorted together, many small ones at once
            if stop != len(blocks) and heavy[last:stop].sum() < CHUNK:
                continue
            some = blocks[last:stop]
            last = stop
            suffix = _ranges(at[some], size[some])
            number = _ranges(base[some], size[some])
            gap = np.repeat(anchor[some], size[some]) - suffix
            part = np.repeat(alike[some], size[some]) * (length + 1) + gap
            same, _ = equal_classes(raw, suffix, length, part)
            repeated[number[same]] = True

        owner = np.repeat(np.arange(n, dtype=np.int32), size)
        start = repeated.copy()
        start[1:] &= ~(repeated[:-1] & (owner[1:] == owner[:-1]))
        stop = repeated.copy()
        stop[:-1] &= ~(repeated[1:] & (owner[1:] == owner[:-1]))
        s, e = np.flatnonzero(start), np.flatnonzero(stop) + 1
        block = owner[s]
        shift = skipped[block] - base[block]
        bucket = table.column("bucket")[0].as_py()
        none = pa.nulls(len(s), pa.int32())
        runs = [
            pa.array(c1[block]), pa.array(c2[block]), pa.array((s + shift).astype(np.int32)),
            pa.array((e + shift).astype(np.int32)), none, none, pa.nulls(len(s), pa.binary()),
        ]
        text = raw.tobytes()
        rows = []
        for side, better in ((0, min), (1, max)):
            token = better(text[a : a + TOKEN] for a in anchor.tolist())
            some = [b for b, a in enumerate(anchor.tolist()) if text[a : a + TOKEN] == token]
            span = [(int(distance[b]), int(distance[b] + size[b] - 1)) for b in some]
            gap = better(x[side] for x in span)
            some = [b for b, x in zip(some, span) if x[side] == gap]
            place = {b: int(anchor[b]) - gap for b in some}
            b = better(some, key=lambda b: text[place[b] : place[b] + length])
            index = int(place[b] - at[b] + skipped[b])
            edge = token + gap.to_bytes(2, "big") + text[place[b] : place[b] + length]
            rows.append((int(c1[b]), int(c2[b]), index, index + 1, bucket, side, edge))
        edges = [pa.array(column, kind) for column, kind in zip(zip(*rows), _VERDICT_KINDS)]
        names = [f.split()[0] for f in VERDICTS.split(", ")]
        return pa.concat_tables(
            [pa.table(runs, names), pa.table(edges, names)]
        )

    return sort


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of [start, start + size), one range after another."""
    total = int(sizes.sum())
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(total)


def _across(edges: DataFrame) -> list[tuple]:
    """First and last suffixes of buckets that are equal to those beside them.

    Two rows for each bucket come to the driver, at most 2 * ``MOST_BUCKETS``.
    """
    rows = sorted((r["bucket"], r["side"], bytes(r["edge"]), r) for r in edges.toLocalIterator())
    found = []
    for (_, side, edge, row), (_, next_side, next_edge, next_row) in zip(rows, rows[1:]):
        if side == 1 and next_side == 0 and edge == next_edge:
            found += [(r["c1"], r["c2"], r["begin"], r["end"]) for r in (row, next_row)]
    return found


def _row_keys() -> list:
    text = F.coalesce("text", F.lit(""))
    return [
        F.xxhash64("doc_id", text).alias("k1"), F.xxhash64(F.lit(2), text, "doc_id").alias("k2"),
        text.alias("text"),
    ]


def repeated_spans(documents: DataFrame, length: int, work: WorkTables) -> DataFrame:
    """k1, k2 and the overlapping spans [begin, end) of bytes that repeat, for each text with any."""
    if length < TOKEN:
        raise ValueError(f"strings of at least {TOKEN} bytes are compared")
    spark = documents.sparkSession
    texts = documents.select(*_row_keys())
    counted = texts.select("text").mapInArrow(_count_anchors(length), "hash long, n long")
    several = counted.groupBy("hash").agg(F.sum("n").alias("n")).where("n > 1").select("hash")
    bitmap = spark.sparkContext.broadcast(_bitmap(work.store(several, "anchors")))
    blocks = work.store(
        texts.mapInArrow(_candidate_blocks(length, bitmap), BLOCKS), "blocks"
    )
    rows, size = blocks.agg(F.count("*"), F.sum(F.length("body"))).first()
    # several buckets for each partition, so that partitions come out even
    partitions = min(MOST_BUCKETS // 4, max(wide(spark), -(-(size or 0) // BUCKET)))
    buckets = 4 * partitions
    cuts = spark.sparkContext.broadcast(_splitters(blocks, length, buckets, rows))
    routed = blocks.select("c1", "c2", "distance", "copies", "body").mapInArrow(
        _router(length, cuts), ROUTED
    )
    verdicts = work.store(
        routed.repartition(partitions, "bucket").groupBy("bucket").applyInArrow(_sort_bucket(length), VERDICTS),
        "verdicts",
    )
    runs = verdicts.where("side IS NULL").select("c1", "c2", "begin", "end").distinct()
    across = _across(verdicts.where("side IS NOT NULL"))
    if across:
        runs = runs.union(
            spark.createDataFrame(across, "c1 long, c2 long, begin int, end int")
        ).distinct()
    runs = work.store(runs, "runs")
    members = blocks.select("c1", "c2", F.explode("members").alias("m"))
    placed = members.join(runs, ["c1", "c2"]).select(
        "m.k1", "m.k2",
        F.struct(
            (F.col("m.at") + F.col("begin")).alias("begin"),
            (F.col("m.at") + F.col("end") + F.lit(length - 1)).alias("end"),
        ).alias("span"),
    )
    return work.store(placed.groupBy("k1", "k2").agg(F.collect_set("span").alias("spans")), "spans")


CUT = "doc_id long, n_bytes long, removed array<struct<begin:long,end:long>>, kept binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
    for batch in slices(batches, "text", 8 * PIECE):
        raw, offsets = text_bytes(batch.column("text"))
        data = raw.tobytes()
        removed, kept = [], []
        for row, spans in enumerate(batch.column("spans").to_pylist()):
            begin, end = int(offsets[row]), int(offsets[row + 1])
            runs: list[list[int]] = []
            for s, e in sorted((x["begin"], x["end"]) for x in spans or ()):
                if runs and s <= runs[-1][1]:
                    runs[-1][1] = max(e, runs[-1][1])
                else:
                    runs.append([s, e])
            stays, at = [], begin
            for s, e in runs:
                stays.append(data[at : begin + s])
                at = begin + e
            stays.append(data[at:end])
            kept.append(b"".join(stays))
            removed.append([{"begin": s, "end": e} for s, e in runs])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), pa.array(np.diff(offsets)), pa.array(removed, span),
                pa.array(kept, pa.binary()),
            ],
            ["doc_id", "n_bytes", "removed", "kept"],
        )


def remove_repeats(documents: DataFrame, length: int = 200) -> DataFrame:
    """doc_id, n_bytes, the maximal ``removed`` runs of bytes and the ``kept`` bytes of each text.

    A byte is removed where a string of ``length`` bytes covers it that also starts elsewhere,
    in the same text or another; strings are judged on the input.
    """
    spark: SparkSession = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spans = repeated_spans(rows, length, WorkTables(spark, "suffixes"))
    joined = rows.select("doc_id", *_row_keys()).join(spans, ["k1", "k2"], "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(_cut, CUT)
