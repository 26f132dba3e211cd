"""Which tokens may stand side by side in a byte-pair encoding.

Greedy merging (lowest rank first, leftmost on ties) is local: a token sequence is the encoding
of its text exactly when every token encodes to itself and every two neighbours encode to just
those two. So the last token of each prefix of a word is fixed by the last token of a shorter
prefix, which is what makes encoding a search along the word with one survivor for each place.

Two neighbours stay apart unless, at some moment of the merging, the symbol at the right edge
of the first and the symbol at the left edge of the second are both there and their merge is
the next in line. When each of those edge symbols comes and goes is tabulated for every token.
"""

from __future__ import annotations

import numpy as np

NEVER = 1 << 30


def merged(symbols: list[int], merges: dict[tuple[int, int], tuple[int, int]]):
    """Greedy merging; gives the remaining symbols and the steps (rank, left, right, place)."""
    symbols, steps = list(symbols), []
    while len(symbols) > 1:
        best = min(
            (
                (merges[pair][0], i)
                for i, pair in enumerate(zip(symbols, symbols[1:]))
                if pair in merges
            ),
            default=None,
        )
        if best is None:
            break
        rank, i = best
        steps.append((rank, symbols[i], symbols[i + 1], i, len(symbols)))
        symbols[i : i + 2] = [merges[symbols[i], symbols[i + 1]][1]]
    return symbols, steps


class PairRule:
    """``apart(a, b)``: whether tokens a and b stay two tokens when their texts are joined.

    ``spelling`` has the first symbols of every token (None for one that takes no part) and
    ``merges`` maps two symbols to (rank, result). ``whole`` marks tokens that encode to
    themselves. Tables are a few entries for each token, so they are broadcast as they are.
    """

    def __init__(self, spelling: list[list[int] | None], merges: dict[tuple[int, int], tuple[int, int]]):
        self.tokens = len(spelling)
        self.whole = np.zeros(self.tokens, bool)
        uneven = False
        edges: tuple[list, list] = ([], [])
        for token, symbols in enumerate(spelling):
            left, right = [], []
            if symbols:
                rest, steps = merged(symbols, merges)
                self.whole[token] = rest == [token]
                if self.whole[token]:
                    left, right = self._edges(symbols, steps, merges)
                    ranks = [s[0] for s in steps]
                    uneven |= any(b < a for a, b in zip(ranks, ranks[1:]))
            edges[0].append(left)
            edges[1].append(right)
        self.left, self.right = (self._table(e) for e in edges)
        order = sorted((a * self.tokens + b, rank) for (a, b), (rank, _) in merges.items())
        self.keys = np.array([k for k, _ in order], np.int64)
        self.ranks = np.array([r for _, r in order], np.int64)
        if uneven:
            raise ValueError("a token's own merges are out of rank order")

    @staticmethod
    def _edges(symbols, steps, merges):
        """(symbol, comes, goes) of the left and right edge."""
        left, right = [[symbols[0], -1, NEVER]], [[symbols[-1], -1, NEVER]]
        for rank, a, b, place, length in steps:
            made = merges[a, b][1]
            if place == 0:
                left[-1][2] = rank
                left.append([made, rank, NEVER])
            if place + 2 == length:
                right[-1][2] = rank
                right.append([made, rank, NEVER])
        return left, right

    @staticmethod
    def _table(edges: list[list]) -> np.ndarray:
        depth = max(map(len, edges), default=1) or 1
        table = np.full((3, depth, len(edges)), -1, np.int64)
        for token, rows in enumerate(edges):
            for i, row in enumerate(rows):
                table[:, i, token] = row
        return table

    def _ranks(self, keys: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.keys, keys)
        place[place == len(self.keys)] = 0
        return np.where(self.keys[place] == keys, self.ranks[place], NEVER)

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        stays = np.ones(len(a), bool)
        for x, x_comes, x_goes in self.right.transpose(1, 0, 2):
            here = np.flatnonzero(stays & (x[a] >= 0))
            if not len(here):
                break
            for y, y_comes, y_goes in self.left.transpose(1, 0, 2):
                at = here[(y[b[here]] >= 0) & stays[here]]
                if not len(at):
                    break
                p, q = a[at], b[at]
                # on equal ranks the merge further left is done first
                meet = (x_comes[p] <= y_goes[q]) & (y_comes[q] < x_goes[p])
                at, p, q = at[meet], p[meet], q[meet]
                rank = self._ranks(x[p] * self.tokens + y[q])
                stays[at[(rank < x_goes[p]) & (rank <= y_goes[q])]] = False
        return stays


class Remembered:
    """``apart`` through a table of answers; its size is fixed, newer answers replace older."""

    def __init__(self, rule: PairRule, bits: int = 20):
        self.rule, self.bits = rule, bits
        self.seen = np.full(1 << bits, -1, np.int64)
        self.answer = np.zeros(1 << bits, bool)

    def apart(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        code = a * self.rule.tokens + b
        slot = (code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)
        miss = np.flatnonzero(self.seen[slot] != code)
        out = self.answer[slot]
        if len(miss):
            new, back = np.unique(code[miss], return_inverse=True)
            fresh = self.rule.apart(new // self.rule.tokens, new % self.rule.tokens)
            out[miss] = fresh[back]
            self.seen[slot[miss]] = code[miss]
            # two new codes in one slot: whichever was written last is what the slot answers
            kept = self.seen[slot[miss]] == code[miss]
            self.answer[slot[miss][kept]] = out[miss][kept]
        return out
