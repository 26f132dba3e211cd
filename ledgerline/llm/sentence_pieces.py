"""SentencePiece encoding and decoding of whole texts, in batches of numpy arrays.

The model file gives pieces and scores; pieces are never trained here. A text becomes words (a
run of space marks and what follows up to the next), and the distinct words of a batch are
encoded by a Viterbi search in which all words of one length advance together: hashes of the
substrings from a place on probe the sorted hashes of all pieces and of their beginnings, and a
vectorised maximum over the probes stores, for every later place, the length of the piece that
ends there.

The model's pieces come from byte-pair merging, so the score of a path is not a sum over its
pieces: what counts is whether greedy merging would have made it. ``PairRule`` answers that for
two neighbours. A piece that may not follow the survivor at its start scores zero, so at each
place one piece is left, and the path is exactly what merging gives.

Characters that no piece has become bytes. Texts are taken as they are (the model has no
normalisation) behind one added space.

Defined cases: a null text is an empty one; an empty text has no ids, and no ids decode to the
empty text. A space mark (U+2581) in a text is taken as a space, so such a text comes back with
a space. Bytes that are no UTF-8 decode to U+FFFD each. Very long words advance alone, in the
same way. Repeated rows stay repeated, and no column but ``text`` or ``ids`` is looked at.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm.bpe_pairs import PairRule, Remembered
from ledgerline.llm.textwords import BASE, mixed, slices

MARK = 0x2581
codecs.register_error("each_byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))
SLICE = 2 << 20
_INVERSE = pow(BASE, -1, 1 << 64)


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Concatenated ranges ``starts[i] .. starts[i] + sizes[i]``."""
    total = int(sizes.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return np.arange(total) + shift


class PieceTable:
    """What the search needs of a model: hashes of pieces, byte ids and the pair rule."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(count)]
        special = [model.is_control(i) or model.is_unknown(i) for i in range(count)]
        is_byte = [model.is_byte(i) for i in range(count)]
        ids = {p: i for i, p in enumerate(names) if not special[i] and not is_byte[i]}
        scores = {i: model.get_score(i) for i in ids.values()}
        rank_of = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        merges = {}
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                a, b = ids.get(piece[:cut]), ids.get(piece[cut:])
                if a is not None and b is not None:
                    merges[a, b] = (rank_of[scores[i]], i)
        spelling: list[list[int] | None] = [None] * count
        for piece, i in ids.items():
            spelling[i] = [ids[c] for c in piece] if all(c in ids for c in piece) else None
        if any(spelling[i] is None for i in ids.values()):
            raise ValueError("a piece has a character that is no piece")
        if any(chr(MARK) in p.lstrip(chr(MARK)) for p in ids):
            raise ValueError("a piece goes over a word's end")
        self.rule = PairRule(spelling, merges)
        self.bytes = np.full(256, -1, np.int64)
        for i in np.flatnonzero(is_byte):
            self.bytes[int(names[i][1:-1], 16)] = i
        inner = {c for p in ids if len(p) > 1 for c in p}
        # characters of longer pieces; any other one is a word of its own
        self.inner = np.zeros(0x110000, bool)
        self.inner[[ord(c) for c in inner]] = True
        self.single = np.full(0x110000, -1, np.int32)
        for p, i in ids.items():
            if len(p) == 1:
                self.single[ord(p)] = i
        self.longest = max(map(len, ids))
        beginnings = {p[:k]: -1 for p in ids for k in range(1, len(p) + 1)}
        beginnings |= {p: i if self.rule.whole[i] else -1 for p, i in ids.items()}
        keyed = sorted((int(self._key(p)), len(p), i) for p, i in beginnings.items())
        self.keys = np.array([k for k, _, _ in keyed], np.uint64)
        if len(set(self.keys.tolist())) != len(keyed):
            raise ValueError("two pieces share a hash")
        self.ids = np.array([i for _, _, i in keyed], np.int64)
        self.output = [
            b"" if special[i] else bytes([int(n[1:-1], 16)]) if is_byte[i] else n.encode()
            for i, n in enumerate(names)
        ]
        unknown = model.unk_id()
        if 0 <= unknown < count:
            self.output[unknown] = " ⁇ ".encode()

    @staticmethod
    def _key(text: str) -> np.uint64:
        value = 0
        for k, c in enumerate(text):
            value += (ord(c) + 1) * pow(BASE, k, 1 << 64)
        return mixed(np.array([value & ((1 << 64) - 1)], np.uint64))[0]


class Encoder:
    def __init__(self, table: PieceTable):
        self.table, self.pairs = table, Remembered(table.rule)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the offsets of the texts."""
        marked = [" " + t if t else "" for t in texts]
        chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
        chars = np.where(chars == 0x20, np.uint32(MARK), chars)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in marked])]).astype(np.int64)
        if not len(chars):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        inner, mark = self.table.inner[chars], chars == MARK
        cut = np.zeros(len(chars) + 1, bool)
        cut[bounds] = True
        cut[:-1] |= ~inner
        cut[1:] |= ~inner
        cut[1:-1] |= mark[1:] & ~mark[:-1]
        starts = np.flatnonzero(cut[:-1])
        sizes = np.diff(np.append(starts, len(chars)))
        sums, down = self._sums(chars)
        ends = starts + sizes
        keys = mixed((sums[ends] - sums[starts]) * down[starts] + sizes.astype(np.uint64))
        _, first, word = np.unique(keys, return_index=True, return_inverse=True)
        ids, cuts = self._words(chars, starts[first], sizes[first])
        count = np.diff(cuts)[word]
        flat = ids[_ragged(cuts[:-1][word], count)]
        ends_of = np.concatenate([[0], np.cumsum(count)])
        return flat, ends_of[np.searchsorted(starts, bounds)]

    @staticmethod
    def _sums(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        up, down = np.full(len(chars), BASE, np.uint64), np.full(len(chars) + 1, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        np.multiply.accumulate(up, out=up)
        np.multiply.accumulate(down, out=down)
        sums = np.zeros(len(chars) + 1, np.uint64)
        np.cumsum((chars.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
        return sums, down

    def _words(self, chars, starts, sizes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words and their offsets; words of one length go together."""
        counts = np.zeros(len(starts), np.int64)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        outer = (sizes == 1) & (self.table.single[chars[starts]] < 0)
        for i in np.flatnonzero(outer):
            raw = chr(chars[starts[i]]).encode("utf-8", "surrogatepass")
            counts[i] = len(raw)
            found.append((np.array([i]), np.array([len(raw)]), self.table.bytes[list(raw)]))
        rest = np.flatnonzero(~outer)
        order = rest[np.argsort(sizes[rest], kind="stable")]
        lengths, at = np.unique(sizes[order], return_index=True)
        for length, a, b in zip(lengths, at, [*at[1:], len(order)]):
            rows = order[a:b]
            step = max(1, (1 << 20) // int(length))
            for k in range(0, len(rows), step):
                part = rows[k : k + step]
                number, flat = self._advance(chars[starts[part][:, None] + np.arange(length)])
                counts[part] = number
                found.append((part, number, flat))
        bounds = np.concatenate([[0], np.cumsum(counts)])
        ids = np.empty(int(bounds[-1]), np.int32)
        for rows, number, flat in found:
            ids[_ragged(bounds[:-1][rows], number)] = flat
        return ids, bounds

    def _advance(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Viterbi over words of one length: (ids in each word, all ids)."""
        table = self.table
        n, length = words.shape
        step = np.array([pow(BASE, k, 1 << 64) for k in range(min(length, table.longest))], np.uint64)
        last = np.full((length + 1, n), -1, np.int64)  # the piece that ends at a place
        back = np.zeros((length + 1, n), np.int32)  # and its length
        codes = words.T.astype(np.uint64) + np.uint64(1)
        for place in range(length):
            open_words = np.arange(n)
            if place:
                open_words = np.flatnonzero(back[place] > 0)
            value = np.zeros(len(open_words), np.uint64)
            for size in range(1, min(table.longest, length - place) + 1):
                value = value + codes[place + size - 1, open_words] * step[size - 1]
                key = mixed(value)
                slot = np.searchsorted(table.keys, key)
                slot[slot == len(table.keys)] = 0
                known = table.keys[slot] == key
                if not known.all():
                    open_words, value, slot = open_words[known], value[known], slot[known]
                if not len(open_words):
                    break
                piece = table.ids[slot]
                here = np.flatnonzero(piece >= 0)
                if place and len(here):
                    fits = self.pairs.apart(last[place, open_words[here]], piece[here])
                    here = here[fits]
                rows, end = open_words[here], place + size
                back[end, rows] = np.maximum(back[end, rows], size)
                last[end, rows] = piece[here]
        return self._traced(last, back, n, length)

    @staticmethod
    def _traced(last, back, n, length) -> tuple[np.ndarray, np.ndarray]:
        place, rows = np.full(n, length), np.arange(n)
        number, columns = np.zeros(n, np.int64), []
        while len(rows):
            columns.append((rows, last[place, rows]))
            number[rows] += 1
            place = place - back[place, rows]
            more = place > 0
            rows, place = rows[more], place[more]
        bounds = np.cumsum(number)
        flat = np.empty(int(bounds[-1]) if n else 0, np.int64)
        for k, (rows, ids) in enumerate(columns):
            flat[bounds[rows] - 1 - k] = ids
        return number, flat

    def decode(self, ids: np.ndarray) -> str:
        output = self.table.output
        text = b"".join([output[i] for i in ids.tolist()]).decode("utf-8", "each_byte")
        text = text.replace(chr(MARK), " ")
        return text[1:] if text.startswith(" ") else text


def _shared(frame: DataFrame, path: str):
    # bounded by the vocabulary of the model, a few MB
    return frame.sparkSession.sparkContext.broadcast(PieceTable(path))


_ENCODERS: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One encoder for each worker process and model, so that its answers are kept."""
    table = shared.value
    if id(table) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[id(table)] = Encoder(table)
    return _ENCODERS[id(table)]


def _with(batch: pa.RecordBatch, keep: list[str], extra: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*(batch.column(c) for c in keep), *extra.values()], [*keep, *extra]
    )


def _schema(frame: DataFrame, keep: list[str], extra: str) -> str:
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name in keep]
    return ", ".join([*kept, extra])


def encode(documents: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), check: bool = False) -> DataFrame:
    """The columns ``keep`` with ``ids`` and ``n_tokens`` of ``text``.

    ``check`` adds ``restored``: whether decoding the ids gives the text again.
    """
    shared, keep = _shared(documents, path), list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in slices(batches, "text", SLICE):
            texts = batch.column("text").to_pylist()
            ids, bounds = encoder.encode(texts)
            lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
            extra = {"ids": lists, "n_tokens": pa.array(np.diff(bounds))}
            if check:
                back = [encoder.decode(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
                extra["restored"] = pa.array([t == (o or "") for t, o in zip(back, texts)])
            yield _with(batch, keep, extra)

    rows = documents.select(*keep, *(["text"] if "text" not in keep else []))
    extra = "ids array<int>, n_tokens long" + (", restored boolean" if check else "")
    return rows.mapInArrow(run, _schema(rows, keep, extra))


def decode(encoded: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with the ``text`` of ``ids``."""
    shared, keep = _shared(encoded, path), list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared)
        for batch in batches:
            texts = [
                encoder.decode(np.array(row or [], np.int64))
                for row in batch.column("ids").to_pylist()
            ]
            yield _with(batch, keep, {"text": pa.array(texts, pa.string())})

    rows = encoded.select(*keep, "ids")
    return rows.mapInArrow(run, _schema(rows, keep, "text string"))
