"""A packed R-tree over count vectors, searched by an upper bound of the overlap."""

from __future__ import annotations

import numpy as np

LEAF, FAN = 32, 16
#: Counts are kept in four bits; a point with a greater one says nothing, that is, each of its counts is MOST.
MOST = 14


def groups_for(sizes: np.ndarray) -> np.ndarray:
    """Coordinates of a point: a power of two, half of the set's size or more, so that counts tell sets apart at any size."""
    return 1 << np.maximum(6, np.ceil(np.log2(np.maximum(sizes, 1) / 2)).astype(np.int64))


def packed_counts(counts: np.ndarray) -> bytes:
    """Two counts in a byte."""
    low = counts.astype(np.uint8) if counts.max(initial=0) <= MOST else np.full(len(counts), MOST, np.uint8)
    return (low[0::2] | (low[1::2] << 4)).tobytes()


def as_counts(raw: bytes) -> np.ndarray:
    pairs = np.frombuffer(raw, np.uint8)
    return np.stack([pairs & 15, pairs >> 4], 1).ravel()


def folded(points: np.ndarray, groups: int) -> np.ndarray:
    """Points with fewer groups; a group is a hash modulo their number."""
    if points.shape[-1] == groups:
        return points
    return points.reshape(*points.shape[:-1], -1, groups).sum(-2, dtype=np.uint16)


def least_overlap(a, b, percent: int):
    """Shingles that sets of a and b must share at least for 100 * both >= percent * either."""
    return -(-percent * (a + b) // (100 + percent))


class CountTree:
    """Points are counts of a set's tokens by hashed group, so the sum of coordinate minima bounds what two sets share.

    Points are packed by size and then by their most varying coordinates; a node
    keeps the greatest count of each group and the least and greatest size below it.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, percent: int):
        self.points, self.sizes, self.percent = points, sizes, percent
        self.order = np.arange(len(points))
        if len(points) > LEAF:
            spread = np.argsort(-points.var(0))[:3]
            tiles = [points[:, g] // max(1, int(points[:, g].std())) for g in spread]
            self.order = np.lexsort([*tiles, np.log(np.maximum(sizes, 1)) // 0.1])
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        top, low, high = points[self.order], sizes[self.order], sizes[self.order]
        fan = LEAF
        while len(low) > 1 or not self.levels:
            at = np.arange(0, len(low), fan)
            top, low, high = np.maximum.reduceat(top, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((top, low, high))
            fan = FAN

    def passing(self, point: np.ndarray, size: int, top: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which boxes (or points, if low is high) may hold a set that links to this one."""
        fit = np.maximum(low, -(-self.percent * size // 100))
        bound = np.minimum(top, point).sum(1, dtype=np.int64)
        return (fit <= high) & (100 * fit <= (10000 * size) // self.percent) & (bound >= least_overlap(size, fit, self.percent))

    def search(self, point: np.ndarray, size: int) -> np.ndarray:
        """Indices of the points whose sets may link to the set of this point."""
        nodes = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            top, low, high = self.levels[depth]
            nodes = nodes[self.passing(point, size, top[nodes], low[nodes], high[nodes])]
            if not len(nodes):
                return nodes
            fan = FAN if depth else LEAF
            below = len(self.levels[depth - 1][1]) if depth else len(self.order)
            nodes = (nodes[:, None] * fan + np.arange(fan)).ravel()
            nodes = nodes[nodes < below]
        found = self.order[nodes]
        sizes = self.sizes[found]
        return found[self.passing(point, size, self.points[found], sizes, sizes)]
