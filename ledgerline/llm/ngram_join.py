"""N-gram Jaccard join: which texts share so many shingles that they count as copies.

Every text becomes the set of its distinct word shingles (A-Z folded, words parted by space
and 0x09 to 0x0D). Two texts are linked when the Jaccard index of their sets is ``num/den``
or more. The result has one row for each document with the size of its set and the component
of the link graph it is in; no list of pairs is made.

How it runs:

1. A pass over the texts gives each set's size and signature; sets with the same signature are
   folded to one. A further pass gives *routing keys*: any two linked sets have one in common
   (the smallest ``a - ceil(t*a) + 1`` of ``a`` shingles in one fixed order). Shingles that very
   many sets have come last in that order, so that passages shared by many texts hardly route.
   The sets under each key so taken are counted, and a key that still gathers many is dealt out
   as pairs of blocks.
2. Sets under a key that no other set of like size has are let go. The others get their point: the counts of
   their shingles by hash group, with more groups the larger the set. The points under a key
   are packed into an R-tree. Searching it by the sum of smaller counts, a bound on the
   overlap, leaves the candidate links, of which a spanning forest is kept.
3. Components of the candidates bring together what could be linked; only there whole shingle
   sets meet, again in an R-tree, and the pairs that survive are verified exactly.

Texts are read once for each pass instead of being moved; only keys, points and the sets of
candidates are shuffled.

Defined cases: a null or empty text, or one without words, has the empty set and is linked
with nothing. Fewer words than a shingle's length make one shingle. Rows with the same doc_id
are one vertex. A row without doc_id is a vertex of its own text; a component of such rows
only has a null id. Further columns are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.components import components
from ledgerline.llm.rtree import spanning_links
from ledgerline.llm.textwords import mixed, shingle_sets, slices
from ledgerline.llm.worktables import WorkTables, wide

# sets of at least so many shingles have so many groups
CLASSES = ((0, 16), (128, 64), (1024, 256), (8192, 1024))
MOST = CLASSES[-1][1]
# sets under one key or in one component that are compared in one task
BLOCK = 500
# shingles or keys counted at a time
COUNTED = 1 << 21
# crowded keys up to which their table is broadcast, and the salts they are joined by beyond
FEW_CROWDED = 500_000
SALTS = 64


def _class_of(size: np.ndarray) -> np.ndarray:
    return np.searchsorted([least for least, _ in CLASSES], size, "right") - 1


def _group_counts(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Counts by the finest groups; coarser ones are sums of neighbours."""
    texts = len(bounds) - 1
    owner = np.repeat(np.arange(texts), np.diff(bounds))
    bits = np.uint64(64 - (MOST - 1).bit_length())
    group = (mixed(hashes ^ np.uint64(0x5DEECE66D)) >> bits).astype(np.int64)
    return np.bincount(owner * MOST + group, minlength=texts * MOST).reshape(texts, MOST)


def _folded(counts: np.ndarray, groups: int) -> np.ndarray:
    return counts.reshape(len(counts), groups, -1).sum(2)


def _packed(counts: np.ndarray, size: np.ndarray, num: int, den: int) -> list[bytes]:
    """Each row with the groups of the largest set it can be linked with."""
    out = []
    for row, kind in zip(counts, _class_of(size * den // num).tolist()):
        row = _folded(row[None, :], CLASSES[kind][1])[0]
        wide_row = row.max(initial=0) > 255
        out.append(bytes([2 * kind + wide_row]) + row.astype(np.uint32 if wide_row else np.uint8).tobytes())
    return out


def _points(packed: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The class of each packed row, and its counts."""
    kinds = np.array([b[0] >> 1 for b in packed], np.int64)
    rows = [
        np.frombuffer(b, np.uint32 if b[0] & 1 else np.uint8, offset=1).astype(np.int64)
        for b in packed
    ]
    return kinds, rows


def _links_by_class(packed: list[bytes], num: int, den: int, linked=None) -> list[tuple[int, int]]:
    """Spanning links of one group, class by class.

    Two linked sets are both in the class of the larger one: the smaller has its groups too.
    """
    stored, rows = _points(packed)
    sizes = np.array([int(r.sum()) for r in rows])
    own = _class_of(sizes)
    found: list[tuple[int, int]] = []
    for kind in np.unique(np.concatenate([own, stored])).tolist():
        here = np.flatnonzero((own == kind) | (stored == kind))
        if len(here) < 2:
            continue
        points = np.stack([_folded(rows[k][None, :], CLASSES[kind][1])[0] for k in here])
        verify = None if linked is None else (lambda a, others: linked(here[a], here[others]))
        found.extend(
            (int(here[a]), int(here[b])) for a, b in spanning_links(points, sizes[here], num, den, verify)
        )
    return found


def _key_count(size: np.ndarray, num: int, den: int) -> np.ndarray:
    return np.where(size > 0, size - -(-num * size // den) + 1, 0)


def _list_array(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(
        pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64))
    )


def _first(values: np.ndarray, bounds: np.ndarray, take: np.ndarray) -> tuple:
    """The first ``take`` values of each list."""
    size = np.diff(bounds)
    place = np.arange(len(values)) - np.repeat(bounds[:-1], size)
    kept = values[place < np.repeat(take, size)]
    return kept, np.concatenate([[0], np.cumsum(np.minimum(take, size))])


def _signer(length: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            hashes, bounds = shingle_sets(batch.column("text"), length)
            sums = [
                np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes ^ np.uint64(s)))])
                for s in (0x243F6A8885A308D3, 0x13198A2E03707344)
            ]
            a, b = ((s[bounds[1:]] - s[bounds[:-1]]).view(np.int64) for s in sums)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vertex"),
                    batch.column("doc_id"),
                    pa.array(np.diff(bounds).astype(np.int32)),
                    pa.array(a),
                    pa.array(b),
                ],
                ["vertex", "doc_id", "size", "sig_a", "sig_b"],
            )

    return sign


def _counted(held: list[np.ndarray], least: int) -> pa.RecordBatch:
    keys, n = np.unique(np.concatenate(held), return_counts=True)
    enough = n >= least
    return pa.RecordBatch.from_arrays(
        [pa.array(keys[enough].view(np.int64)), pa.array(n[enough])], ["key", "n"]
    )


def _shingle_counter(length: int):
    """Shingles that several sets of one task have; one of very many sets is among them.

    All are counted and not only the first of each set: when common ones are moved last, others
    become the first.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [np.zeros(0, np.uint64)], 0
        for batch in slices(batches, "text"):
            held.append(shingle_sets(batch.column("text"), length)[0])
            size += len(held[-1])
            if size > COUNTED:
                yield _counted(held, 2)
                held, size = [np.zeros(0, np.uint64)], 0
        yield _counted(held, 2)

    return count


def _key_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many sets are under every routing key, added up within tasks."""
    held, size = [np.zeros(0, np.uint64)], 0
    for batch in batches:
        keys = batch.column("keys").flatten().to_numpy(zero_copy_only=False)
        held.append(keys.view(np.uint64))
        size += len(keys)
        if size > COUNTED:
            yield _counted(held, 1)
            held, size = [np.zeros(0, np.uint64)], 0
    yield _counted(held, 1)


ROUTED = "set_id long, vertex long, size long, counts binary, keys array<long>"


def _router(length: int, num: int, den: int, shared):
    """Point and routing keys of every set."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late = shared.value
        for batch in slices(batches, "text"):
            hashes, bounds = shingle_sets(batch.column("text"), length)
            size = np.diff(bounds)
            packed = _packed(_group_counts(hashes, bounds), size, num, den)
            owner = np.repeat(np.arange(len(size)), size)
            is_late = np.zeros(len(hashes), bool)
            if len(late):
                place = np.searchsorted(late, hashes)
                is_late = late[np.minimum(place, len(late) - 1)] == hashes
            order = np.lexsort((hashes, is_late, owner))
            take = _key_count(size, num, den)
            keys, cuts = _first(hashes[order], bounds, take)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("set_id"),
                    batch.column("vertex"),
                    pa.array(size),
                    pa.array(packed, pa.binary()),
                    _list_array(keys, cuts),
                ],
                ["set_id", "vertex", "size", "counts", "keys"],
            )

    return route


def _runs(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Tables of whole runs of equal ``by`` values from rows sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(c).to_numpy(zero_copy_only=False) for c in by]
        change = np.zeros(batch.num_rows, bool)
        for v in values:
            change[1:] |= v[1:] != v[:-1]
        last = int(np.flatnonzero(change)[-1]) if change.any() else 0
        if held:
            ahead = any(
                held[-1].column(c)[-1].as_py() != batch.column(c)[0].as_py() for c in by
            )
            if ahead:
                yield pa.Table.from_batches(held)
                held = []
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _groups(table: pa.Table, by: list[str]) -> tuple[np.ndarray, np.ndarray]:
    change = np.ones(table.num_rows, bool)
    if table.num_rows > 1:
        change[1:] = False
        for c in by:
            v = table.column(c).to_numpy()
            change[1:] |= v[1:] != v[:-1]
    starts = np.flatnonzero(change)
    return starts, np.append(starts[1:], table.num_rows)


LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _links_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    u, v = (np.array(x, np.int64) for x in zip(*pairs))
    return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=LINKS)


def _several(num: int, den: int):
    """Rows whose key another set of like size has, from rows sorted by key and size.

    Sizes are alike when the smaller is ``num/den`` of the larger or more; who has such a
    partner has one beside it.
    """

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, as long as it has no partner
        last = (None, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            key, size = batch.column("key").to_numpy(), batch.column("size").to_numpy()
            beside = np.zeros(len(key) + 1, bool)
            beside[1:-1] = (key[1:] == key[:-1]) & (den * size[:-1] >= num * size[1:])
            if key[0] == last[0] and den * last[1] >= num * int(size[0]):
                beside[0] = True
                if held is not None:
                    yield held
            keep = beside[:-1] | beside[1:]
            # whether the last row has a partner may be seen in the next batch only
            held = None if keep[-1] else batch.slice(len(key) - 1)
            last = (key[-1], int(size[-1]))
            yield batch.filter(pa.array(keep))

    return pick


def _candidates(num: int, den: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ["key"]):
            starts, ends = _groups(table, ["key"])
            vertex = table.column("vertex").to_numpy()
            packed = table.column("counts").to_pylist()
            found = []
            for a, b in zip(starts.tolist(), ends.tolist()):
                if b - a > 1:
                    links = _links_by_class(packed[a:b], num, den)
                    found.extend((vertex[a + i], vertex[a + j]) for i, j in links)
            if found:
                yield _links_batch(found)

    return search


def _verified(length: int, num: int, den: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, ["root", "block"]):
            starts, ends = _groups(table, ["root", "block"])
            for start, end in zip(starts, ends):
                if end - start < 2:
                    continue
                part = table.slice(start, end - start).combine_chunks()
                vertex = part.column("vertex").to_numpy()
                hashes, bounds = _sets_of(part)
                sizes = np.diff(bounds)
                sets = [hashes[a:b] for a, b in zip(bounds[:-1], bounds[1:])]

                def linked(here: int, others: np.ndarray) -> np.ndarray:
                    mine = sets[here]
                    out = np.zeros(len(others), bool)
                    for i, other in enumerate(others):
                        theirs = sets[other]
                        at = np.searchsorted(mine, theirs)
                        at[at == len(mine)] = 0
                        both = int((mine[at] == theirs).sum()) if len(mine) else 0
                        union = len(mine) + len(theirs) - both
                        out[i] = den * both >= num * union
                    return out

                points = _packed(_group_counts(hashes, bounds), sizes, num, den)
                links = _links_by_class(points, num, den, linked)
                if links:
                    yield _links_batch([(vertex[a], vertex[b]) for a, b in links])

    return verify


def _sets_of(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    packed = part.column("set").to_pylist()
    bounds = np.concatenate([[0], np.cumsum([len(p) // 8 for p in packed])]).astype(np.int64)
    return np.frombuffer(b"".join(packed), np.uint64), bounds


FILTER_BITS = 26


def _slot():
    return F.shiftrightunsigned(F.xxhash64("vertex"), 64 - FILTER_BITS).alias("slot")


def _vertex_filter(vertices: DataFrame):
    """A bitmap of 8 MB over hashed vertices, whatever their number; broadcast.

    It only saves moving the texts of documents that surely have no candidate. The more
    vertices there are the less it saves; the join behind it decides.
    """

    def paint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn: dict[int, np.ndarray] = {}
        for batch in batches:
            slots = batch.column("slot").to_numpy()
            for tile in np.unique(slots >> 16).tolist():
                bits = drawn.setdefault(tile, np.zeros(1 << 16, np.uint8))
                bits[slots[slots >> 16 == tile] & 0xFFFF] = 1
        tiles = sorted(drawn)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(tiles, pa.int32()),
                pa.array([np.packbits(drawn[t], bitorder="little").tobytes() for t in tiles], pa.binary()),
            ],
            ["tile", "bits"],
        )

    spark = vertices.sparkSession
    # by tile, so that each of the 1024 comes to the driver once
    painted = vertices.select(_slot()).repartition(wide(spark), F.shiftright("slot", 16))
    whole = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for row in painted.mapInArrow(paint, "tile int, bits binary").collect():
        at = row["tile"] << 13
        whole[at : at + (1 << 13)] |= np.frombuffer(row["bits"], np.uint8)
    return spark.sparkContext.broadcast(whole)


def _set_packer(length: int, wanted):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in slices(batches, "text"):
            slots = batch.column("slot").to_numpy()
            batch = batch.filter(pa.array((bits[slots >> 3] >> (slots & 7) & 1).astype(bool)))
            if not batch.num_rows:
                continue
            hashes, bounds = shingle_sets(batch.column("text"), length)
            packed = [hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vertex"), pa.array(packed, pa.binary())], ["vertex", "set"]
            )

    return pack


def _block_pairs(blocks, vertex):
    """Numbers of the pairs of blocks a row takes part in; one pair if there is one block."""
    mine = F.pmod(F.xxhash64(vertex, F.lit(7)), blocks)
    pairs = F.transform(
        F.sequence(F.lit(0), blocks - 1),
        lambda other: F.least(mine, other) * blocks + F.greatest(mine, other),
    )
    return pairs


def vertex_of():
    """The vertex of a row: its doc_id, or a hash of its text."""
    return F.coalesce(
        F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit("")), F.lit("row"))
    )


def ngram_join(
    documents: DataFrame, length: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``documents`` (doc_id, text)."""
    placed = ngram_groups(documents, length, num, den)
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return placed.join(least, "root").select(
        "doc_id", F.col("size").cast("long").alias("n_shingles"), "component_id"
    )


def ngram_groups(
    documents: DataFrame, length: int = 5, num: int = 80, den: int = 100
) -> DataFrame:
    """vertex, doc_id, size and root of every row of ``documents``; linked rows have one root."""
    spark = documents.sparkSession
    work = WorkTables(spark, "ngram-join")
    rows = documents.select(
        vertex_of().alias("vertex"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text"),
    )
    scanned = work.store(
        rows.mapInArrow(_signer(length), "vertex long, doc_id long, size int, sig_a long, sig_b long"),
        "scanned",
    )
    same = ["size", "sig_a", "sig_b"]
    sets = work.store(
        scanned.where("size > 0").groupBy(*same).agg(F.min("vertex").alias("vertex")), "sets"
    )
    routed = _routed(spark, rows, sets, work, length, num, den)
    found = (
        routed.repartition(wide(spark), "key")
        .sortWithinPartitions("key")
        .mapInArrow(_candidates(num, den), "u long, v long")
    )
    candidates = components(spark, found, work, "candidates")
    links = _verify(spark, rows, candidates, work, length, num, den)
    # what has the same signature, or the same doc_id, is connected as well
    twins = scanned.where("size > 0").join(
        sets.select(*same, F.col("vertex").alias("v")), same
    ).select(F.col("vertex").alias("u"), "v")
    roots = components(spark, links.union(twins), work, "links")
    return scanned.select("vertex", "doc_id", "size").join(
        roots.withColumnRenamed("vertex", "member"), F.col("vertex") == F.col("member"), "left"
    ).select("vertex", "doc_id", "size", F.coalesce("root", "vertex").alias("root"))


def _routed(
    spark: SparkSession,
    rows: DataFrame,
    sets: DataFrame,
    work: WorkTables,
    length: int,
    num: int,
    den: int,
) -> DataFrame:
    """(key, vertex, counts): every set under each routing key that it shares.

    A shingle is common from 1/5000 of all sets, and 50, on (as counted within tasks). So there
    are at most 5000 common ones for each shingle that a set has on average, however many sets
    there are; that bounds what is broadcast here. Which are common decides how fast the search
    is, not what it finds: any one order of all shingles is right. How many sets a key gathers
    is counted afterwards, over the keys that the sets really have.
    """
    # a vertex has several sets if rows with different texts share a doc_id
    texts = rows.select("vertex", "text", F.xxhash64("vertex", "text").alias("set_id"))
    least = max(50, sets.count() // 5000)
    counted = texts.mapInArrow(_shingle_counter(length), "key long, n long")
    common = np.array(
        [r[0] for r in counted.groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least).collect()],
        np.int64,
    ).view(np.uint64)
    shared = spark.sparkContext.broadcast(np.sort(common))
    points = work.store(
        texts.mapInArrow(_router(length, num, den, shared), ROUTED)
        .join(sets.select("vertex"), "vertex", "left_semi")
        .dropDuplicates(["vertex", "set_id"]),
        "points",
    )
    keys = points.select(F.explode("keys").alias("key"), "set_id", "size")
    crowded = work.store(
        points.select("keys").mapInArrow(_key_counter, "key long, n long")
        .groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > 2 * BLOCK)
        .select("key", F.ceil(F.col("n") / BLOCK).cast("long").alias("blocks")),
        "crowded",
    )
    many = crowded.count()
    if many:
        if many <= FEW_CROWDED:
            keys = keys.join(F.broadcast(crowded), "key", "left")
        else:
            # a crowded key has more than 2 * BLOCK rows, which meet it in SALTS places
            salted = crowded.withColumn("salt", F.explode(F.array(*[F.lit(k) for k in range(SALTS)])))
            keys = keys.withColumn("salt", F.pmod(F.xxhash64("set_id", F.lit(3)), F.lit(SALTS)).cast("int"))
            keys = keys.join(salted, ["key", "salt"], "left").drop("salt")
        pairs = F.transform(
            _block_pairs(F.col("blocks"), F.col("set_id")), lambda pair: F.xxhash64("key", pair)
        )
        keys = keys.select(
            F.explode(F.when(F.col("blocks").isNull(), F.array("key")).otherwise(pairs)).alias("key"),
            "set_id",
            "size",
        )
    several = (
        keys.repartition(wide(spark), "key").sortWithinPartitions("key", "size")
        .mapInArrow(_several(num, den), "key long, set_id long, size long")
    )
    points = points.select("set_id", "vertex", "counts")
    return several.join(points, "set_id").select("key", "vertex", "counts")


def _verify(
    spark: SparkSession,
    rows: DataFrame,
    candidates: DataFrame,
    work: WorkTables,
    length: int,
    num: int,
    den: int,
) -> DataFrame:
    """Links that hold, as a spanning forest of each candidate component."""
    count = candidates.groupBy("root").count()
    placed = candidates.join(count, "root").select(
        "vertex", "root", F.ceil(F.col("count") / BLOCK).cast("long").alias("blocks")
    )
    packed = rows.select("vertex", "text", _slot()).mapInArrow(
        _set_packer(length, _vertex_filter(candidates)), "vertex long, set binary"
    )
    dealt = packed.join(placed, "vertex").select(
        "root", "vertex", "set", F.explode(_block_pairs(F.col("blocks"), F.col("vertex"))).alias("block")
    )
    found = (
        dealt.repartition(wide(spark), "root", "block")
        .sortWithinPartitions("root", "block")
        .mapInArrow(_verified(length, num, den), "u long, v long")
    )
    return work.store(found, "verified")
