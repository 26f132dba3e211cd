"""A packed R-tree over vectors of group counts, searched by a bound on set overlap."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

FANOUT = 24


def overlap_needed(a, b, num: int, den: int):
    """Least intersection of sets of sizes a and b whose Jaccard index is num/den or more."""
    return -(-num * (a + b) // (den + num))


class CountTree:
    """Points are the counts of a set's elements by hash group.

    Two sets cannot share more elements than the sum over the groups of the smaller count.
    For a node that sum is taken with the largest counts below it, and the overlap asked for
    with the smallest set size below it, so a node is left out only if all its sets are.
    Packed bottom up: sorted by set size, tiles of that by the widest coordinate.
    """

    def __init__(self, counts: np.ndarray, sizes: np.ndarray, num: int, den: int):
        self.num, self.den = num, den
        n = len(sizes)
        tile = max(FANOUT, int(np.sqrt(n / FANOUT) + 1) * FANOUT)
        by_size = np.argsort(sizes, kind="stable")
        widest = int(np.argmax(counts.max(0) - counts.min(0))) if n else 0
        tiles = np.arange(n) // tile
        self.order = by_size[np.lexsort((counts[by_size, widest], tiles))]
        self.counts, self.sizes = counts[self.order], sizes[self.order]
        self.levels = []
        top, least = self.counts, self.sizes
        while len(least) > FANOUT:
            cut = np.arange(0, len(least), FANOUT)
            top, least = np.maximum.reduceat(top, cut, axis=0), np.minimum.reduceat(least, cut)
            self.levels.append((top, least))
        self.alive = np.ones(n, bool)

    def remove(self, places: np.ndarray) -> None:
        self.alive[places] = False

    def search(self, counts: np.ndarray, size: int) -> np.ndarray:
        """Places of remaining entries whose bound allows the overlap that is needed."""
        nodes = None
        for top, least in reversed(self.levels):
            nodes = np.arange(len(least)) if nodes is None else self._below(nodes, len(least))
            nodes = nodes[self._passes(top[nodes], least[nodes], counts, size)]
            if not len(nodes):
                return nodes
        entries = np.arange(len(self.sizes)) if nodes is None else self._below(nodes, len(self.sizes))
        entries = entries[self.alive[entries]]
        return entries[self._passes(self.counts[entries], self.sizes[entries], counts, size)]

    @staticmethod
    def _below(nodes: np.ndarray, limit: int) -> np.ndarray:
        children = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
        return children[children < limit]

    def _passes(self, top, least, counts, size):
        bound = np.minimum(top, counts).sum(1, dtype=np.int64)
        # a set cannot share more than it has, which is what holds small and large ones apart
        needed = overlap_needed(size, least.astype(np.int64), self.num, self.den)
        return bound >= needed


def spanning_links(
    counts: np.ndarray,
    sizes: np.ndarray,
    num: int,
    den: int,
    linked: Callable[[int, np.ndarray], np.ndarray] | None = None,
) -> list[tuple[int, int]]:
    """A spanning forest of the links within one group.

    Every entry is searched for once among the entries not reached yet. ``linked`` verifies
    candidates exactly; without it the bound alone decides. A pair is passed over only when
    both ends are connected already, so components are those of all links, and a group of
    near copies costs a search for each member and not one for each pair.
    """
    tree = CountTree(counts, sizes, num, den)
    found, place = [], np.empty(len(sizes), np.int64)
    place[tree.order] = np.arange(len(sizes))
    for seed in range(len(sizes)):
        if not tree.alive[place[seed]]:
            continue
        tree.remove(place[seed])
        queue = [seed]
        while queue:
            here = queue.pop()
            near = tree.search(counts[here], int(sizes[here]))
            if len(near) and linked is not None:
                near = near[linked(here, tree.order[near])]
            if len(near):
                tree.remove(near)
                reached = tree.order[near].tolist()
                found.extend((here, other) for other in reached)
                queue.extend(reached)
    return found
