"""Words and word sequences of Arrow text columns, hashed in numpy.

A word is a run of bytes other than space and 0x09 to 0x0D; every byte of a longer UTF-8
character belongs to the word around it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15 | 1


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about ``limit`` bytes of text; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(
            zero_copy_only=False
        )
        total = np.cumsum(sizes, dtype=np.int64)
        begin = 0
        while begin < batch.num_rows:
            before = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, before + limit, "right")))
            yield batch.slice(begin, end - begin)
            begin = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and the offsets of the texts; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]]
    return raw, bounds - bounds[0]


IS_WORD = np.ones(256, bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


def word_bounds(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word."""
    if not len(raw):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = IS_WORD[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    left = np.empty_like(inside)
    left[0], left[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~left | edge[:-1]))
    right = np.empty_like(inside)
    right[-1], right[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~right | edge[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers after which all bits depend on all bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_codes(fold: bool) -> np.ndarray:
    codes = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
    if fold:
        codes[ord("A") : ord("Z") + 1] = codes[ord("a") : ord("z") + 1]
    return codes


CODES = {fold: _byte_codes(fold) for fold in (False, True)}


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base, inverse = BASE, pow(BASE, -1, 1 << 64)
    up, down = np.full(n, base, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def span_hashes(
    raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = False
) -> np.ndarray:
    """64-bit hashes of byte spans, from prefix sums; ``fold`` takes A-Z as a-z."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(1 << max(21, int(len(raw)).bit_length()))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(CODES[fold][raw] * up[: len(raw)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def sequence_hashes(
    words: np.ndarray, owner: np.ndarray, texts: int, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``length`` words and the text of each, texts ascending.

    A text with fewer words has one run, the whole; one without words has none.
    """
    counts = np.bincount(owner, minlength=texts)
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    factor = np.uint64(BASE)
    total = np.zeros(n, np.uint64)
    seen = np.zeros(n, np.uint64)
    last = np.cumsum(counts)[owner]  # one past the last word of the same text
    place = np.arange(n)
    for k in range(length):
        here = place + k < last
        total[here] = total[here] * factor + words[place[here] + k]
        seen[here] += np.uint64(1)
    first = np.zeros(n, bool)
    first[(np.cumsum(counts) - counts)[counts > 0]] = True
    take = (seen == length) | (first & (counts[owner] < length))
    return mixed(total[take] + seen[take]), owner[take]


def distinct_runs(hashes: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct hashes of each text, and the offsets of the texts among them."""
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    hashes, owner = hashes[order], owner[order]
    if len(hashes):
        keep = np.ones(len(hashes), bool)
        keep[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        hashes, owner = hashes[keep], owner[keep]
    return hashes, np.searchsorted(owner, np.arange(texts + 1))


def shingle_sets(column: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text with A-Z folded, ascending, and their offsets."""
    raw, offsets = text_bytes(column)
    starts, ends, owner = word_bounds(raw, offsets)
    words = span_hashes(raw, starts, ends, fold=True)
    return distinct_runs(*sequence_hashes(words, owner, len(column), length), len(column))
