"""SimHash fingerprints of texts, and all fingerprints within a Hamming radius.

The terms of a text are its runs of five words, with four marks before the first and after the
last word, so that every text with a word has terms and short texts share those of a common
beginning or end. A term weighs as often as it occurs. The bits of its hash vote, weighted, for
one or zero on the bits of the fingerprint; a tie is zero. The part of equal bits estimates the
angle between the term vectors, and ``likeness`` is the cosine of that angle, or 0 below it.

Fingerprints close to each other are found with block tables: cut into ``radius + 1`` blocks,
two fingerprints within the radius have a block in common, so each table has the fingerprints
with one block moved to the front as its key. Within a key only fingerprints not yet
connected are compared, and a key that very many have is dealt out as pairs of blocks of rows.

Defined cases: a text without words (also null) has the fingerprint of all zeros. Equal texts
have equal fingerprints. Rows with one doc_id follow each other in the order of a hash of their
text. A null doc_id comes before all others. Further columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.components import components
from ledgerline.llm.textwords import BASE, mixed, slices, span_hashes, text_bytes, word_bounds
from ledgerline.llm.worktables import WorkTables, order_bounds, part_of, wide

BITS = 256
RUN = 5
ROWS_TOGETHER = 1000


def term_hashes(words: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of five words with marks at both ends, and how many each text has."""
    counts = np.bincount(owner, minlength=texts)
    pad = RUN - 1
    padded = np.zeros(len(words) + 2 * pad * texts, np.uint64)
    lead = np.repeat(pad * (2 * np.arange(texts) + 1), counts)
    padded[np.arange(len(words)) + lead] = words
    total = np.zeros(max(0, len(padded) - pad), np.uint64)
    for k in range(RUN):
        total = total * np.uint64(BASE) + padded[k : len(padded) - pad + k]
    # runs that begin in one text's end marks and go over into the next are no terms
    sizes = counts + 2 * pad
    ends = np.cumsum(sizes)
    real = np.ones(len(total), bool)
    for k in range(pad):
        over = ends - 1 - k
        real[over[over < len(real)]] = False
    terms = np.where(counts > 0, counts + pad, 0)
    empty = np.repeat(counts == 0, sizes)[: len(total)]
    return mixed(total[real & ~empty]), terms


def fingerprints(column: pa.Array) -> np.ndarray:
    """One row of ``BITS // 8`` bytes for each text."""
    raw, offsets = text_bytes(column)
    starts, ends, owner = word_bounds(raw, offsets)
    words = span_hashes(raw, starts, ends)
    hashes, terms = term_hashes(words, owner, len(column))
    out = np.zeros((len(column), BITS // 8), np.uint8)
    bounds = np.concatenate([[0], np.cumsum(terms)])
    step, first = 1 << 15, 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + step, "right")) - 1)
        out[first:last] = _votes(hashes[bounds[first] : bounds[last]], terms[first:last])
        first = last
    return out


def _votes(hashes: np.ndarray, terms: np.ndarray) -> np.ndarray:
    some = np.flatnonzero(terms)
    out = np.zeros((len(terms), BITS // 8), np.uint8)
    if not len(some):
        return out
    cut = np.concatenate([[0], np.cumsum(terms[some])])[:-1]
    for k in range(BITS // 64):
        lane = mixed(hashes + np.uint64((k + 1) * BASE & ((1 << 64) - 1)))
        bits = np.unpackbits(lane.view(np.uint8).reshape(-1, 8), axis=1)
        ones = np.add.reduceat(bits, cut, axis=0, dtype=np.int32)
        packed = np.packbits(2 * ones > terms[some][:, None], axis=1)
        out[some, 8 * k : 8 * k + 8] = packed
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    apart = np.bitwise_count(a ^ b).sum(1) / BITS
    return np.where((a == b).all(1), 1.0, np.maximum(0.0, np.cos(np.pi * apart)))


def _edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half] if half else text


DIGEST = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _digest(docs: list, texts: list[str]) -> pa.RecordBatch:
    """Rows of all texts but the last, each with the one behind it."""
    own, following = texts[:-1], texts[1:]
    edited = [_edited(a, b) for a, b in zip(own, following)]
    prints = fingerprints(pa.array(texts, pa.large_string()))
    changed = fingerprints(pa.array(edited, pa.large_string()))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(docs[:-1], pa.int64()),
            pa.array([len(t) for t in own], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
            pa.array([p.tobytes().hex() for p in prints[:-1]]),
            pa.array([p.tobytes().hex() for p in changed]),
            pa.array(likeness(prints[:-1], changed)),
            pa.array(likeness(prints[:-1], prints[1:])),
        ],
        [c.split()[0] for c in DIGEST.split(", ")],
    )


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of runs of rows of one part; the row marked ``tail`` only closes a part."""
    part, docs, texts = None, [], []
    for batch in slices(batches, "text"):
        columns = [batch.column(c).to_pylist() for c in ("part", "doc_id", "text")]
        for p, doc, text in zip(*columns):
            if p != part:
                if len(texts) > 1:
                    yield _digest(docs, texts)
                part, docs, texts = p, [], []
            docs.append(doc)
            texts.append(text or "")
        if len(texts) > 1:
            yield _digest(docs, texts)
            docs, texts = docs[-1:], texts[-1:]
    if len(texts) > 1:
        yield _digest(docs, texts)


def fingerprint_chain(documents: DataFrame) -> DataFrame:
    """The fingerprint of every text, of its edited text, and their likenesses.

    The edited text has the last half replaced by the beginning of the next document's, in
    ascending order of doc_id; the last document is followed by the first. Texts are moved
    once, into ranges of doc_id; the first document of each range is sent to the range before
    it as well.
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    bounds = order_bounds(rows, "doc_id", wide(spark, 4))
    placed = rows.withColumn("part", part_of(F.col("doc_id"), bounds, F.xxhash64("text")).cast("int"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    # one row for each range: the id and text hash its first document has, and the range before
    first = placed.groupBy("part").agg(
        F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id", F.xxhash64("text").alias("h"))).alias("f")
    )
    heads = first.select(
        "part",
        F.col("f.doc_id").alias("head_id"),
        F.col("f.h").alias("head_hash"),
        F.coalesce(
            F.lag("part").over(Window.orderBy("part")), F.max("part").over(Window.partitionBy())
        ).alias("before"),
    )
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.xxhash64("text") == F.col("head_hash"))
    marked = placed.join(F.broadcast(heads), "part").withColumn("head", is_head)
    # among rows that are equal in id and text any may be the head, so all go; the reader
    # takes the first
    sent = marked.select(
        "doc_id",
        "text",
        F.explode(
            F.when(F.col("head"), F.array(F.struct("part", F.lit(0).alias("tail")), F.struct(F.col("before").alias("part"), F.lit(1).alias("tail"))))
            .otherwise(F.array(F.struct("part", F.lit(0).alias("tail"))))
        ).alias("to"),
    ).select("doc_id", "text", F.col("to.part").alias("part"), F.col("to.tail").alias("tail"))
    ordered = sent.repartition(wide(spark), "part").sortWithinPartitions("part", "tail", *order)
    return ordered.mapInArrow(_one_tail, "part int, doc_id long, text string").mapInArrow(_chained, DIGEST)


def _one_tail(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves one closing row in each part."""
    closed = None
    for batch in batches:
        keep = []
        for part, tail in zip(batch.column("part").to_pylist(), batch.column("tail").to_pylist()):
            keep.append(not tail or closed != part)
            closed = part if tail else closed
        yield batch.filter(pa.array(keep, pa.bool_())).select(["part", "doc_id", "text"])


def fingerprint_classes(prints: DataFrame, radius: int = 7) -> DataFrame:
    """(fingerprint, class_of): fingerprints chained by steps within ``radius``.

    ``class_of`` is a number, the same for all of a class; a fingerprint near no other one has
    no row. ``prints`` has a column fingerprint of hexadecimal text; nulls take no part.
    """
    spark = prints.sparkSession
    work = WorkTables(spark, "fingerprints")
    vertex = F.xxhash64("fingerprint")
    rows = work.store(
        prints.select("fingerprint").where("fingerprint IS NOT NULL").distinct()
        .select("fingerprint", vertex.alias("vertex")),
        "distinct",
    )
    digits = BITS // 4
    blocks = radius + 1
    cuts = [digits * k // blocks for k in range(blocks + 1)]
    tables = F.array(
        *[
            F.xxhash64(F.lit(k), F.substring("fingerprint", cuts[k] + 1, cuts[k + 1] - cuts[k]))
            for k in range(blocks)
        ]
    )
    keyed = rows.select(F.explode(tables).alias("key"), "vertex", "fingerprint")
    several = keyed.groupBy("key").count().where("count > 1").select(
        "key", F.ceil(F.col("count") / ROWS_TOGETHER).cast("long").alias("parts")
    )
    mine = F.pmod(F.xxhash64("vertex", F.lit(3)), F.col("parts"))
    pairs = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("parts") - 1),
        lambda other: F.xxhash64("key", F.least(mine, other), F.greatest(mine, other)),
    )
    dealt = keyed.join(several, "key").select(F.explode(pairs).alias("key"), "vertex", "fingerprint")
    found = (
        dealt.repartition(wide(spark), "key").sortWithinPartitions("key")
        .mapInArrow(_near_links(radius), "u long, v long")
    )
    roots = components(spark, found, work, "classes")
    return rows.join(roots, "vertex").select("fingerprint", F.col("root").alias("class_of"))


def _near_links(radius: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, prints = None, [], []
        for batch in batches:
            for k, v, f in zip(*(batch.column(c).to_pylist() for c in ("key", "vertex", "fingerprint"))):
                if k != key:
                    yield from _links_of(held, prints, radius)
                    key, held, prints = k, [], []
                held.append(v)
                prints.append(f)
        yield from _links_of(held, prints, radius)

    return search


def _links_of(held: list[int], prints: list[str], radius: int) -> Iterator[pa.RecordBatch]:
    """A spanning forest of the fingerprints of one key; each is compared until connected."""
    if len(held) < 2:
        return
    bits = np.frombuffer(bytes.fromhex("".join(prints)), np.uint64).reshape(len(held), -1)
    open_rows, found = np.arange(len(held)), []
    while len(open_rows) > 1:
        queue, open_rows = [int(open_rows[0])], open_rows[1:]
        while queue and len(open_rows):
            here = queue.pop()
            near = np.bitwise_count(bits[open_rows] ^ bits[here]).sum(1) <= radius
            reached = open_rows[near].tolist()
            open_rows = open_rows[~near]
            found.extend((held[here], held[r]) for r in reached)
            queue.extend(reached)
    if found:
        u, v = (pa.array(x, pa.int64()) for x in zip(*found))
        yield pa.RecordBatch.from_arrays([u, v], ["u", "v"])


def fingerprint_documents(documents: DataFrame, radius: int = 7) -> DataFrame:
    """``fingerprint_chain`` with class_id: the least doc_id of the fingerprint's class."""
    work = WorkTables(documents.sparkSession, "digest")
    digest = work.store(fingerprint_chain(documents), "digest")
    classes = fingerprint_classes(digest, radius)
    named: Column = F.coalesce("class_of", F.xxhash64("fingerprint"))
    joined = digest.join(classes, "fingerprint", "left").withColumn("class_of", named)
    least = joined.groupBy("class_of").agg(F.min("doc_id").alias("class_id"))
    found = joined.join(least, "class_of").drop("class_of")
    first = [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    ]
    return found.select(*first, *[c for c in found.columns if c not in first])
