"""Phrase collocations by vertical partitioning of the suffixes, one subtree set for each group.

Texts are lower-cased (A-Z), split into pieces and words; every word position begins a suffix,
which is cut at ``DEPTH`` words and at the end of its piece.

1. *Vertical partitioning.* The frequencies of one-word and then two-word prefixes are counted,
   a prefix below the least frequency being given up: no phrase that counts begins with it or
   holds it. Bitmaps of bounded size stand for the prefixes that go on; they only prune.
   Two-word prefixes, in hash order, are packed into groups up to a budget of suffixes. A prefix
   that is over the budget by itself is extended to all its words, so its suffixes spread.
2. *Subtrees.* Equal suffixes of a part of the input travel as one row with a count. Each group
   sorts its suffixes by itself; runs with a common prefix are the nodes of its subtrees, and
   the total of the leaves below a node is the frequency of its phrase. Totals of extended
   prefixes are added up over their groups.
3. Scores, containment and the final order are joins and windows over the frequent phrases.

Words are known by 64-bit hashes of language and word until the phrases are written out.

Defined cases: a null text has no words; a null lang is ``und``; rows with null or equal doc_ids
all count; very long texts are read in parts, cut where pieces end; an empty table gives an
empty result. Columns other than text and lang are not looked
at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.textwords import mixed, slices, span_hashes, text_bytes
from ledgerline.llm.worktables import WorkTables, wide

DEPTH = 4
BUDGET = 1 << 20  # suffixes of a group
MOST_GROUPS = 1 << 16
CELLS = 1 << 16  # of the hash order, the grain of packing
MOST_BITS = 1 << 28  # of a bitmap, 32 MB
SLICE = 4 << 20
NO_LANG = "und"

_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
_GAPS = _ENDS.copy()
_GAPS[[0x20, 0x09]] = True


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same texts in slices; a very long one is cut at ends of pieces, which no phrase crosses."""
    for batch in slices(batches, "text", SLICE):
        raw, _ = text_bytes(batch.column("text"))
        if batch.num_rows > 1 or len(raw) <= 2 * SLICE:
            yield batch
            continue
        ends = np.flatnonzero(_ENDS[raw]) + 1
        begin = 0
        while begin < len(raw):
            k = np.searchsorted(ends, begin + SLICE)
            end = int(ends[k]) if k < len(ends) else len(raw)
            part = pa.array([raw[begin:end].tobytes().decode()])
            yield pa.RecordBatch.from_arrays([part, batch.column("lang")], ["text", "lang"])
            begin = end


def _words(batch: pa.RecordBatch):
    """Raw bytes, word starts and ends, ids by language and word, piece and row of each word."""
    raw, offsets = text_bytes(batch.column("text"))
    rows = batch.column("lang").to_pylist()
    codes = {
        name: int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")
        for name in set(rows)
    }
    lang = np.array([codes[r] for r in rows], np.uint64)
    if not len(raw):
        none = np.zeros(0, np.int64)
        return raw, none, none, none.astype(np.uint64), none, none
    inside = ~_GAPS[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before = np.append(False, inside[:-1])
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.append(inside[1:], False)
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    row = np.searchsorted(offsets, starts, "right") - 1
    ids = mixed(span_hashes(raw, starts, ends, fold=True) ^ lang[row])
    piece = np.cumsum(_ENDS[raw] | edge[:-1])[starts]
    return raw, starts, ends, ids, piece, row


def _follow(ids: np.ndarray, piece: np.ndarray, going: np.ndarray) -> np.ndarray:
    """Whether a word goes on and the next word of its piece does so too."""
    found = np.zeros(len(ids), bool)
    found[:-1] = going[:-1] & going[1:] & (piece[:-1] == piece[1:])
    return found


def _pair_ids(ids: np.ndarray) -> np.ndarray:
    """The id of each word with the next; the last one has none that means anything."""
    return mixed(ids * np.uint64(3) + np.append(ids[1:], np.uint64(0)))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words by language with their counts; the empty word counts all of a language."""
    for batch in _texts(batches):
        raw, starts, ends, ids, _, row = _words(batch)
        if not len(ids):
            continue
        known, first, n = np.unique(ids, return_index=True, return_counts=True)
        s, sizes = starts[first], (ends - starts)[first]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        data = raw[np.repeat(s - bounds[:-1], sizes) + np.arange(bounds[-1])].copy()
        data[(data >= 65) & (data <= 90)] += 32
        words = pa.LargeStringArray.from_buffers(
            len(first), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)
        ).cast(pa.string())
        lang = batch.column("lang")
        yield _word_batch(known, lang.take(pa.array(row[first])), words, n)
        rows, each = np.unique(row, return_counts=True)
        totals = pa.table({"lang": lang.take(pa.array(rows)), "n": each}).group_by("lang").aggregate([("n", "sum")])
        k = totals.num_rows
        yield _word_batch(
            np.zeros(k, np.uint64), totals["lang"].combine_chunks(), pa.array([""] * k), totals["n_sum"].to_numpy()
        )


def _word_batch(ids, lang, words, n) -> pa.RecordBatch:
    columns = [pa.array(ids.view(np.int64)), lang, words, pa.array(n.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["id", "lang", "word", "n"])


def _bitmap(rows: DataFrame, column: str) -> np.ndarray:
    """Bits of the ids in a table, 8 to 16 for each but ``MOST_BITS`` at most; as bytes."""
    known = rows.count()
    size = 1 << 15
    while size < MOST_BITS and size < 8 * known:
        size *= 2
    bit = F.col(column).bitwiseAND(F.lit(size - 1))
    cells = rows.groupBy(F.shiftright(bit, 15).alias("cell")).agg(
        F.bitmap_construct_agg(bit.bitwiseAND(F.lit((1 << 15) - 1))).alias("bits")
    )
    whole = np.zeros((size >> 15, 4096), np.uint8)
    for row in cells.toLocalIterator():  # at most MOST_BITS / 2^15 rows of 4 KB
        whole[row["cell"]] = np.frombuffer(row["bits"], np.uint8)
    return whole.ravel()


def _holds(bitmap: np.ndarray, ids: np.ndarray) -> np.ndarray:
    place = (ids & np.uint64(8 * len(bitmap) - 1)).astype(np.int64)
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _count_pairs(words):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _texts(batches):
            _, _, _, ids, piece, _ = _words(batch)
            if len(ids):
                pairs = _pair_ids(ids)[_follow(ids, piece, _holds(words.value, ids))]
                known, n = np.unique(pairs, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(known.view(np.int64)), pa.array(n.astype(np.int64))], ["pair", "n"]
                )

    return count


def _cells(pairs: np.ndarray) -> np.ndarray:
    return (pairs >> np.uint64(48)).astype(np.int64)


def _pack(pairs: DataFrame, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of every cell of the hash order, and the prefixes that are over the budget.

    Both are bounded: ``CELLS`` numbers, and fewer heavy prefixes than groups.
    """
    total = pairs.agg(F.sum("n")).first()[0] or 0
    budget = max(budget, -(-total // MOST_GROUPS))
    heavy = np.array([r["pair"] for r in pairs.where(F.col("n") > budget).select("pair").collect()], np.int64)
    cell = F.shiftrightunsigned("pair", 48).cast("int")
    load = np.zeros(CELLS, np.int64)
    for row in pairs.where(F.col("n") <= budget).groupBy(cell.alias("cell")).agg(F.sum("n").alias("n")).collect():
        load[row["cell"]] = row["n"]
    group, filled = np.zeros(CELLS, np.int32), 0
    number = 0
    for k, n in enumerate(load.tolist()):
        if filled and filled + n > budget:
            number, filled = number + 1, 0
        group[k] = number
        filled += n
    return group, np.sort(heavy.view(np.uint64))


SUFFIXES = "group int, w1 long, w2 long, w3 long, w4 long, n long"


def _suffixes(pairs, packing):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group_of, heavy = packing.value
        groups = int(group_of.max()) + 1
        for batch in _texts(batches):
            _, _, _, ids, piece, _ = _words(batch)
            if len(ids) < 2:
                continue
            pair = _pair_ids(ids)
            going = _follow(ids, piece, np.ones(len(ids), bool)) & _holds(pairs.value, pair)
            at = np.flatnonzero(going)
            if not len(at):
                continue
            longer = np.append(going, [False] * DEPTH)
            w = np.zeros((DEPTH, len(at)), np.uint64)
            w[0], w[1] = ids[at], ids[at + 1]
            open_ = np.ones(len(at), bool)
            for k in range(2, DEPTH):
                open_ &= longer[at + k - 1]
                w[k, open_] = ids[at[open_] + k]
            prefix = pair[at]
            order = np.lexsort(w[::-1])
            w, prefix = w[:, order], prefix[order]
            edge = np.ones(len(at), bool)
            edge[1:] = (w[:, 1:] != w[:, :-1]).any(axis=0)
            first = np.flatnonzero(edge)
            n = np.diff(np.append(first, len(at)))
            w, prefix = w[:, first], prefix[first]
            group = group_of[_cells(prefix)].astype(np.int64)
            split = np.isin(prefix, heavy)
            if split.any():
                whole = mixed(mixed(prefix[split] + w[2, split]) + w[3, split])
                group[split] = (whole % np.uint64(groups)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(group.astype(np.int32)), *(pa.array(x.view(np.int64)) for x in w), pa.array(n)],
                ["group", "w1", "w2", "w3", "w4", "n"],
            )

    return write


NODES = "w1 long, w2 long, w3 long, w4 long, n long"


def _subtrees(packing, least: int):
    """Nodes of two words and more of the suffixes of a group, with the totals of their leaves."""

    def build(table: pa.Table) -> pa.Table:
        _, heavy = packing.value
        w = np.stack([table.column(f"w{k + 1}").to_numpy().view(np.uint64) for k in range(DEPTH)])
        n = table.column("n").to_numpy()
        order = np.lexsort(w[::-1])
        w, n = w[:, order], n[order]
        common = np.zeros(w.shape[1], np.int64)  # words a leaf shares with the one before
        alike = np.ones(w.shape[1] - 1, bool)
        for k in range(DEPTH):
            alike &= w[k, 1:] == w[k, :-1]
            common[1:] += alike
        split = np.isin(mixed(w[0] * np.uint64(3) + w[1]), heavy)
        found = []
        for depth in range(2, DEPTH + 1):
            first = np.flatnonzero(common < depth)
            total = np.add.reduceat(n, first)
            # a suffix that ends before this depth is no node of it
            keep = (w[depth - 1, first] != 0) & ((total >= least) | split[first])
            node = w[:, first[keep]].copy()
            node[depth:] = 0
            found.append([*node, total[keep]])
        columns = [np.concatenate(c) for c in zip(*found)]
        return pa.table([c.view(np.int64) for c in columns], ["w1", "w2", "w3", "w4", "n"])

    return build


def frequent_phrases(documents: DataFrame, least: int, work: WorkTables, budget: int = BUDGET) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words, totals, phrases) of all languages, those with at least ``least`` occurrences.

    words: id, lang, word, n; totals: lang, n; phrases of 2 to ``DEPTH`` words: w1 to w4, n.
    """
    spark = documents.sparkSession
    texts = documents.select("text", F.coalesce("lang", F.lit(NO_LANG)).alias("lang"))
    counted = texts.mapInArrow(_count_words, "id long, lang string, word string, n long")
    known = work.store(
        counted.groupBy("id", "lang", "word").agg(F.sum("n").alias("n"))
        .where((F.col("n") >= least) | (F.col("word") == "")),
        "words",
    )
    words = known.where("word <> ''")
    totals = known.where("word = ''").select("lang", "n")
    going = spark.sparkContext.broadcast(_bitmap(words, "id"))
    pairs = work.store(
        texts.mapInArrow(_count_pairs(going), "pair long, n long")
        .groupBy("pair").agg(F.sum("n").alias("n")).where(F.col("n") >= least),
        "pairs",
    )
    prefixes = spark.sparkContext.broadcast(_bitmap(pairs, "pair"))
    packing = spark.sparkContext.broadcast(_pack(pairs, budget))
    groups = int(packing.value[0].max()) + 1
    suffixes = texts.mapInArrow(_suffixes(prefixes, packing), SUFFIXES)
    nodes = (
        suffixes.repartition(max(groups, wide(spark)), "group").groupBy("group")
        .applyInArrow(_subtrees(packing, least), NODES)
    )
    phrases = nodes.groupBy("w1", "w2", "w3", "w4").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    return words, totals, work.store(phrases, "phrases")


def _part(begin: int, end: int) -> list:
    """The words from ``begin`` up to ``end`` as a phrase of their own."""
    taken = [F.col(f"w{k + 1}") for k in range(begin, end)]
    return [c.alias(f"p{k + 1}") for k, c in enumerate([*taken, *[F.lit(0).cast("long")] * (DEPTH - len(taken))])]


PHRASE = [f"w{k + 1}" for k in range(DEPTH)]
PART = [f"p{k + 1}" for k in range(DEPTH)]


def _cuts(sized: DataFrame) -> DataFrame:
    """Each phrase with each way of cutting it in two: k and both parts."""
    ways = []
    for size in range(2, DEPTH + 1):
        for k in range(1, size):
            ways.append((size, k, F.struct(F.lit(k).alias("k"), F.struct(*_part(0, k)).alias("first"), F.struct(*_part(k, size)).alias("rest"))))
    every = F.array(*[F.when(F.col("size") == size, way) for size, _, way in ways])
    return sized.select(*PHRASE, "size", "a", F.explode(F.filter(every, lambda w: w.isNotNull())).alias("cut"))


def collocations(documents: DataFrame, least: int = 30, top: int = 2000, covered: int = 80, budget: int = BUDGET) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first ``top`` phrases of every language.

    A phrase with at least ``least`` occurrences scores floor(2000000 a / (l + r)) at its worst
    cut, and gives way to a longer one around it that has ``covered`` percent of its occurrences.
    """
    work = WorkTables(documents.sparkSession, "collocations")
    words, totals, phrases = frequent_phrases(documents, least, work, budget)
    none = F.lit(0).cast("long")
    single = words.select(F.col("id").alias("p1"), none.alias("p2"), none.alias("p3"), none.alias("p4"), F.col("n").alias("f"))
    counts = single.union(phrases.select(*[F.col(w).alias(p) for w, p in zip(PHRASE, PART)], F.col("n").alias("f")))
    size = sum((F.col(w) != 0).cast("int") for w in PHRASE)
    sized = phrases.select(*PHRASE, size.alias("size"), F.col("n").alias("a"))

    # both parts of a cut are looked up at once and brought together again by a fold
    sides = _cuts(sized).select(
        *PHRASE, "a", "cut.k",
        F.explode(F.array(
            F.struct(F.lit(0).alias("side"), "cut.first.*"), F.struct(F.lit(1).alias("side"), "cut.rest.*")
        )).alias("s"),
    ).select(*PHRASE, "a", "k", "s.*")
    looked = sides.join(counts, PART)
    both = looked.groupBy(*PHRASE, "a", "k").agg(
        F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"),
        F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r"),
    )
    score = F.expr("cast((cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + r) as long)")
    scored = both.withColumn("score", score).groupBy(*PHRASE, "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("worst")
    )

    inside = [
        (size, begin, end)
        for size in range(3, DEPTH + 1)
        for begin in range(size)
        for end in range(begin + 2, size + 1)
        if end - begin < size
    ]
    parts = F.array(*[
        F.when(F.col("size") == size, F.struct(*_part(begin, end))) for size, begin, end in inside
    ])
    around = (
        sized.where("size > 2")
        .select("a", F.explode(F.filter(parts, lambda p: p.isNotNull())).alias("p"))
        .select(*[F.col(f"p.{p}").alias(w) for p, w in zip(PART, PHRASE)], F.col("a").alias("longer"))
        .groupBy(*PHRASE).agg(F.max("longer").alias("longer"))
    )
    much = F.expr(f"cast(longer as decimal(20,0)) * 100 >= cast(a as decimal(20,0)) * {int(covered)}")
    kept = scored.join(around, PHRASE, "left").where(~F.coalesce(much, F.lit(False)))

    lang = words.select(F.col("id").alias("w1"), "lang")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    ranked = (
        kept.join(lang, "w1").select("lang", *PHRASE, "a", "worst.l", "worst.r", "worst.score")
        .withColumn("place", F.rank().over(best)).where(F.col("place") <= top)
    )
    ranked = work.store(ranked, "ranked")
    spelled = (
        ranked.select(*PHRASE, F.posexplode(F.filter(F.array(*PHRASE), lambda w: w != 0)).alias("at", "id"))
        .join(words.select("id", "word"), "id")
        .groupBy(*PHRASE).agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
        .select(*PHRASE, F.array_join(F.col("words.word"), " ").alias("phrase"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    final = ranked.join(spelled, PHRASE).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    # as many totals as there are languages
    return final.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
