"""Multikey quicksort in numpy: all parts of a depth are split by one vectorised pass."""

from __future__ import annotations

import numpy as np

WIDTH = 8  # bytes of a character


def characters(raw: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position of ``raw`` (of at least 8 bytes) as one ordered number."""
    return np.ndarray(len(raw) - WIDTH + 1, ">u8", raw, strides=(1,))


def equal_classes(
    raw: np.ndarray, starts: np.ndarray, length: int, part: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Strings of ``length`` bytes (at least 8) that have an equal within their part.

    Returns their numbers and the class of each, one class after another. A string is compared
    by characters of 8 bytes, the last of which may overlap the one before. Every part is split
    into less than, equal to and greater than its pivot; what is equal goes on with the next
    character, and a string that stands alone is left.
    """
    letters = characters(raw)
    steps = -(-length // WIDTH)
    found, classes, next_class = [], [], 0
    who = np.argsort(part, kind="stable")
    key = part[who]
    depth = np.zeros(len(who), np.int16)
    while len(who):
        edge = np.ones(len(key), bool)
        edge[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(edge)
        size = np.diff(np.append(first, len(key)))
        seg = np.repeat(np.arange(len(first)), size)
        several = size[seg] > 1
        through = several & (depth == steps)
        if through.any():
            found.append(who[through])
            classes.append(np.cumsum(edge[through]) - 1 + next_class)
            next_class = int(classes[-1][-1]) + 1
        on = several & ~through
        who, depth, seg, edge = who[on], depth[on], seg[on], edge[on]
        if not len(who):
            break
        first = np.flatnonzero(edge)
        size = np.diff(np.append(first, len(who)))
        seg = np.repeat(np.arange(len(first)), size)
        place = np.minimum(depth.astype(np.int64) * WIDTH, length - WIDTH)
        char = letters[starts[who] + place].astype(np.uint64)
        pivot = char[first + size // 2][seg]
        key = seg * 3 + 1 + (char > pivot) - (char < pivot)
        same = key == seg * 3 + 1
        depth = depth + same
        if not same.all():
            order = np.argsort(key, kind="stable")
            who, key, depth = who[order], key[order], depth[order]
    if not found:
        none = np.zeros(0, np.int64)
        return none, none
    return np.concatenate(found), np.concatenate(classes)
