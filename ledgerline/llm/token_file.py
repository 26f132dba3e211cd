"""Token-ID files: one array of ids behind another, with Elias-Fano document boundaries.

The texts are encoded by the tokenizers library and written in ascending doc_id order. The
format is a Parquet table of *shards*, so that Spark's own commit makes a lost executor
harmless and any store that Spark writes to will do. A shard has the ids of consecutive
documents as little-endian numbers of 16 bits (32 where the vocabulary needs it), the ends of
its documents and their doc_ids as Elias-Fano sequences, and the number of ids before it in
its part. Parts are ranges of doc_id; a shard closes at a million ids, or after the document
that goes beyond, so a reader never holds more than that or one document.

Distinct words are encoded once for each worker process (the library encodes words that white
space parts independently, and signs behind a word of Latin letters apart from it); a bounded
table of what they gave is kept, from which the words used least go first. Words are matched with
the table, and ids put together, in Arrow; Python sees new words alone.

Defined cases: a null or empty text has no ids but the end id. Rows with a null doc_id come
first. Rows with the same doc_id stay rows of their own, ordered by a hash of their text.
Very long texts are encoded whole. Columns other than doc_id and text are not looked at.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.elias_fano import EliasFano
from ledgerline.llm.textwords import slices, text_bytes
from ledgerline.llm.worktables import WorkTables, order_bounds, part_of, wide

SHARD_IDS = 1 << 20
KNOWN_WORDS = 600_000
TEXT_BYTES = 4 << 20

SHARDS = (
    "part int, seq int, n_docs int, n_ids long, ids_before long, id_bytes int, ids binary, "
    "end_width int, end_low binary, end_high binary, end_samples binary, "
    "null_docs int, least_doc long, doc_width int, doc_low binary, doc_high binary, "
    "doc_samples binary"
)
SHARD_TYPES = pa.schema(
    [
        (name, {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[kind])
        for name, kind in (f.split() for f in SHARDS.split(", "))
    ]
)

# white space at which texts may be parted without changing what the library gives
_GAPS = bytes.maketrans(b"\n", b" ")
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch

_LETTER, _SIGN, _TRAIL, _OTHER = 1, 2, 3, 4


def _byte_kinds() -> np.ndarray:
    """Letters and signs of ASCII, 0xC3 that leads À to ÿ, bytes that follow a lead, the rest."""
    kinds = np.full(256, _OTHER, np.uint8)
    for b in range(0x21, 0x7F):
        if not chr(b).isdigit():
            kinds[b] = _LETTER if chr(b).isalpha() else _SIGN
    kinds[0x20] = 0
    kinds[0x80:0xC0] = _TRAIL
    kinds[0xC3] = _LETTER
    return kinds


_BYTE_KINDS = _byte_kinds()


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level files."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return {b: chr(b) if b in shown else chr(next(rest)) for b in range(256)}


_BYTE_LETTERS = _byte_letters()


def _tails(raw: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the signs begin in words of Latin letters with signs of ASCII behind them."""
    kinds = _BYTE_KINDS[raw]
    trail = np.flatnonzero(kinds == _TRAIL)
    # × and ÷ are no letters; a trail byte at 0 has none before it and is none in valid UTF-8
    latin = (raw[trail - 1] == 0xC3) & (raw[trail] != 0x97) & (raw[trail] != 0xB7)
    kinds[trail] = np.where(latin, _LETTER, _OTHER)
    before = np.zeros_like(kinds)
    before[1:] = kinds[:-1]
    before[starts] = 0
    mixed = np.flatnonzero((kinds == _OTHER) | ((kinds == _LETTER) & (before == _SIGN)))
    plain = np.ones(len(starts) + 1, bool)
    plain[np.searchsorted(starts, mixed, "right")] = False
    tails = np.flatnonzero((kinds == _SIGN) & (before == _LETTER))
    return tails[plain[np.searchsorted(starts, tails, "right")]]


class WordEncoder:
    """Ids of texts through the ids of their words."""

    def __init__(self, path: str):
        # one thread for each task: Spark runs as many tasks as there are cores
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind = np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32
        self.words = self.ids = pa.array([], pa.large_binary())
        self.uses = np.zeros(0, np.int64)
        self.folds = self._folds_case()
        self.apart = self._by_words()
        tried = ["a", "hello", "école", "straße", "ñandú", "ünübertreffbarkeiten", "naïveté", "µ"]
        signs = [".", ",", "!!", "***", "'", '."']
        tailed = [w + s for w in tried[:-1] for s in signs]
        self.direct = (
            self.folds
            and [self._letters(w) for w in tried] == self._listed(tried)
            and [a + b for a in self._listed(tried[:-1]) for b in self._listed(signs)] == self._listed(tailed)
        )

    def _listed(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _folds_case(self) -> bool:
        """Whether the file lower-cases what it reads; only then are words folded first."""
        import json

        found = json.loads(self.tokenizer.to_str())["normalizer"] or {}
        steps = found.get("normalizers", [found])
        return any(s.get("type") == "Lowercase" for s in steps)

    def _by_words(self) -> bool:
        """Whether a space leaves no trace in the ids, so that words are independent."""
        a, b, both = self._listed(["one", "two", "one  two"])
        return a + b == both

    def _letters(self, word: str) -> list[int]:
        """Ids of a word of Latin letters from the library's model alone.

        Nothing but lower case and the byte letters of such files stands between the two, which
        is tried out before it is relied on.
        """
        word = word.lower()
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return [t.id for t in self.model.tokenize(word)]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of every text, as little-endian numbers; a null is an empty text."""
        if not self.apart:
            found = self._listed([t or "" for t in texts.to_pylist()])
            return [np.array(ids, self.kind).tobytes() for ids in found]
        pieces, firsts = self._cut(texts)
        if not len(pieces):
            return [b""] * len(texts)
        # known words keep their places, new ones follow
        coded = pa.chunked_array([self.words, pieces]).dictionary_encode().chunks[-1]
        words, places = coded.dictionary, coded.indices
        ids = pa.concat_arrays([self.ids, *self._learn(words.slice(len(self.words)))])
        self._keep(words, ids, places.to_numpy())
        _, offsets, data = ids.take(places).buffers()
        ends = np.frombuffer(offsets, np.int64)[firsts].tolist()
        raw = data.to_pybytes() if data is not None else b""
        return [raw[a:b] for a, b in zip(ends, ends[1:])]

    def _cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Words, signs behind a word apart from it, and the first word of each text."""
        raw, offsets = text_bytes(texts)
        data = raw.tobytes()
        if self.folds:
            # special strings are looked for, and marks joined to letters, before letters are folded
            capitals = np.flatnonzero(raw[1:] >= 0xCC)
            capitals = capitals[(raw[capitals] >= ord("A")) & (raw[capitals] <= ord("Z"))]
            spared = set((np.searchsorted(offsets, capitals, "right") - 1).tolist())
            if spared or b"<|" in data:
                each = (data[a:b] for a, b in zip(offsets.tolist(), offsets[1:].tolist()))
                data = b"".join(
                    t if i in spared or b"<|" in t else t.lower() for i, t in enumerate(each)
                )
            else:
                data = data.lower()
        raw = np.frombuffer(data.translate(_GAPS), np.uint8)
        inside = raw != 0x20
        first = np.zeros(len(raw) + 1, bool)
        first[offsets] = True
        first[1:] |= ~inside
        first = first[:-1] & inside
        if self.direct:
            first[_tails(raw, np.flatnonzero(first))] = True
        raw, begins = raw[inside], np.flatnonzero(first[inside])
        offsets = offsets - np.searchsorted(np.flatnonzero(~inside), offsets)
        bounds = np.append(begins, len(raw))
        pieces = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begins), [None, pa.py_buffer(bounds), pa.py_buffer(raw)]
        )
        return pieces, np.searchsorted(begins, offsets)

    def _learn(self, words: pa.Array) -> Iterator[pa.Array]:
        for k in range(0, len(words), 1 << 16):
            asked = [w.decode() for w in words.slice(k, 1 << 16).to_pylist()]
            found = [self._letters(w) if self.direct and _LATIN(w) else None for w in asked]
            rest = [i for i, ids in enumerate(found) if ids is None]
            for i, ids in zip(rest, self._listed([asked[i] for i in rest])):
                found[i] = ids
            flat = np.fromiter(chain.from_iterable(found), self.kind)
            ends = np.cumsum([0, *map(len, found)]) * flat.itemsize
            yield pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(found), [None, pa.py_buffer(ends), pa.py_buffer(flat)]
            )

    def _keep(self, words: pa.Array, ids: pa.Array, places: np.ndarray) -> None:
        """Remembers the words; where they are too many, the half of them used most."""
        uses = np.bincount(places, minlength=len(words))
        uses[: len(self.uses)] += self.uses
        if len(words) > KNOWN_WORDS:
            kept = np.sort(np.argpartition(-uses, KNOWN_WORDS // 2)[: KNOWN_WORDS // 2])
            words, ids, uses = words.take(pa.array(kept)), ids.take(pa.array(kept)), uses[kept] // 2
        self.words, self.ids, self.uses = words, ids, uses


class _Shard:
    def __init__(self, part: int, seq: int, before: int):
        self.part, self.seq, self.before = part, seq, before
        self.chunks: list[bytes] = []
        self.ends: list[int] = []
        self.docs: list[int | None] = []
        self.size = 0

    def add(self, doc: int | None, ids: bytes, count: int) -> None:
        self.chunks.append(ids)
        self.size += count
        self.ends.append(self.size)
        self.docs.append(doc)

    def batch(self, id_bytes: int) -> pa.RecordBatch:
        ends = EliasFano.of(np.array(self.ends))
        nulls = sum(d is None for d in self.docs)
        known = np.array([d for d in self.docs if d is not None], np.int64)
        least = int(known[0]) if len(known) else 0
        docs = EliasFano.of((known.view(np.uint64) - np.uint64(least & ((1 << 64) - 1))))
        row = [
            self.part, self.seq, len(self.docs), self.size, self.before, id_bytes,
            b"".join(self.chunks), ends.width, ends.low, ends.high, ends.samples,
            nulls, least, docs.width, docs.low, docs.high, docs.samples,
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip(row, SHARD_TYPES)], schema=SHARD_TYPES
        )


_WORDS: dict[str, WordEncoder] = {}


def _word_encoder(path: str) -> WordEncoder:
    if path not in _WORDS:
        _WORDS[path] = WordEncoder(path)
    return _WORDS[path]


def _shard_writer(path: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_encoder(path)
        width = np.dtype(words.kind).itemsize
        end = np.array([end_id], words.kind).tobytes()
        shard = None
        for batch in slices(batches, "text", TEXT_BYTES):
            found = words.encode(batch.column("text"))
            docs = batch.column("doc_id").to_pylist()
            for part, doc, ids in zip(batch.column("part").to_pylist(), docs, found):
                if shard is not None and (shard.part != part or shard.size >= SHARD_IDS):
                    yield shard.batch(width)
                    same = shard.part == part
                    shard = _Shard(part, shard.seq + 1, shard.before + shard.size) if same else None
                if shard is None:
                    shard = _Shard(part, 0, 0)
                shard.add(doc, ids + end, len(ids) // width + 1)
        if shard is not None:
            yield shard.batch(width)

    return write


def write_token_file(documents: DataFrame, path: str, folder: str, end_id: int = 1) -> None:
    """Encodes ``documents`` (doc_id, text) into a token file at ``folder``."""
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # four ranges for each partition, so that partitions come out even
    bounds = order_bounds(rows, "doc_id", wide(spark, 4))
    placed = rows.withColumn("part", part_of(F.col("doc_id"), bounds, F.xxhash64("text")))
    ordered = placed.repartition(wide(spark), "part").sortWithinPartitions(
        "part", F.col("doc_id").asc_nulls_first(), F.xxhash64("text")
    )
    ordered.mapInArrow(_shard_writer(path, end_id), SHARDS).write.parquet(folder)


READ = pa.schema(
    [
        ("part", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()),
        ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int32())),
    ]
)


def _shard_reader(with_ids: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard = {f: batch.column(f)[row].as_py() for f in batch.schema.names}
                n, nulls = shard["n_docs"], shard["null_docs"]
                ends = EliasFano(
                    n, shard["end_width"], shard["end_low"], shard["end_high"], shard["end_samples"]
                ).values().astype(np.int64)
                docs = EliasFano(
                    n - nulls, shard["doc_width"], shard["doc_low"], shard["doc_high"], shard["doc_samples"]
                ).values()
                docs = (docs + np.uint64(shard["least_doc"] & ((1 << 64) - 1))).view(np.int64)
                kind = np.uint16 if shard["id_bytes"] == 2 else np.uint32
                ids = np.frombuffer(shard["ids"], kind).astype("<u4")
                raw = memoryview(ids).cast("B")
                starts = np.concatenate([[0], ends[:-1]])
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                known = pa.array([None] * nulls + docs.tolist(), pa.int64())
                columns = [
                    pa.array(np.full(n, shard["part"], np.int32)), known,
                    pa.array(starts + shard["ids_before"]), pa.array(ends - starts),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    columns.append(
                        pa.ListArray.from_arrays(
                            pa.array(np.append(0, ends).astype(np.int32)), pa.array(ids.view(np.int32))
                        )
                    )
                yield pa.RecordBatch.from_arrays(columns, READ.names[: len(columns)])

    return read


def read_token_file(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of every document of a token file."""
    shards = spark.read.parquet(folder)
    columns = "part int, doc_id long, start long, n_tokens long, ids_crc32 long"
    rows = shards.mapInArrow(_shard_reader(with_ids), columns + (", ids array<int>" if with_ids else ""))
    # a row for each range of doc_ids: as many as the writer had partitions, times four
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select(
        "part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before")
    )
    placed = rows.join(F.broadcast(before), "part").withColumn("start", F.col("start") + F.col("before"))
    return placed.drop("part", "before")


def token_file_digest(documents: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """Writes a token file into the shared folder and reads it back."""
    work = WorkTables(documents.sparkSession, "token-file")
    folder = f"{work.folder}/tokens"
    write_token_file(documents, path, folder, end_id)
    return read_token_file(documents.sparkSession, folder)
