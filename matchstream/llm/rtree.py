"""An R-tree over count vectors that bounds set overlaps."""

from __future__ import annotations

import numpy as np

#: Children of a node, and (query, node) pairs bounded at once.
FAN = 16
PAIRS_AT_ONCE = 1 << 14

#: Groups that the tokens are hashed into.
GROUPS = 256


def count_vector(tokens: np.ndarray) -> np.ndarray:
    """How many tokens of a set fall in each group."""
    return np.bincount((tokens & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS).astype(np.uint32)


class CountRTree:
    """Bulk-loaded tree of points; each node has the largest coordinates below it.

    Two sets share at most the sum, over the groups, of the smaller of their
    counts; for a node the largest counts below it take the place of the
    second set's.  A node is entered if that reaches the overlap which a set of
    the smallest size below it would need.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, share: tuple[int, int]) -> None:
        self.share = share
        self.order = self._packed(points, sizes)
        high, small, large = points[self.order], sizes[self.order], sizes[self.order]
        self.levels = [(high, small, large)]
        while len(high) > 1:
            cuts = np.arange(0, len(high), FAN)
            high = np.maximum.reduceat(high, cuts, axis=0)
            small, large = np.minimum.reduceat(small, cuts), np.maximum.reduceat(large, cuts)
            self.levels.append((high, small, large))

    @staticmethod
    def _packed(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """An order in which neighbours are alike: tiles by size, then by the widest coordinates."""
        order = np.argsort(sizes, kind="stable")
        tiles = [order[i : i + FAN**3] for i in range(0, len(order), FAN**3)]
        for depth in range(2):
            split = []
            for tile in tiles:
                spread = points[tile].astype(np.float32).var(axis=0)
                axis = np.argsort(-spread, kind="stable")[depth]
                tile = tile[np.argsort(points[tile, axis], kind="stable")]
                step = FAN ** (2 - depth)
                split += [tile[i : i + step] for i in range(0, len(tile), step)]
            tiles = split
        return np.concatenate(tiles) if tiles else order

    def _needed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The least overlap of linked sets of sizes a and b."""
        x, y = self.share
        return -((-x * (a + b)) // (x + y))

    def candidates(self, points: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, point) whose bound allows a link."""
        x, y = self.share
        query = np.arange(len(points))
        node = np.zeros(len(points), np.int64)
        for depth in range(len(self.levels) - 1, -1, -1):
            high, small, large = self.levels[depth]
            keep = (large[node] * y >= sizes[query] * x) & (small[node] * x <= sizes[query] * y)
            query, node = query[keep], node[keep]
            enough = np.empty(len(query), bool)
            for i in range(0, len(query), PAIRS_AT_ONCE):
                q, k = query[i : i + PAIRS_AT_ONCE], node[i : i + PAIRS_AT_ONCE]
                bound = np.minimum(points[q], high[k]).sum(axis=1, dtype=np.int64)
                enough[i : i + PAIRS_AT_ONCE] = bound >= self._needed(sizes[q], small[k])
            query, node = query[enough], node[enough]
            if depth:
                below = len(self.levels[depth - 1][0])
                first = node * FAN
                n = np.minimum(FAN, below - first)
                query = np.repeat(query, n)
                ends = np.cumsum(n)
                node = np.repeat(first - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)
        return query, self.order[node]
