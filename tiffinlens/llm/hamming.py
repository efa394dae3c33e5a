"""BK-trees over 64-bit fingerprints, built and searched for many shards at once in numpy.

In a BK-tree the child of a node under edge d, and all below it, lie at Hamming
distance d from the node. A point at distance x from the node has neighbours
within radius r only under edges x - r to x + r.
"""

from __future__ import annotations

import numpy as np

# (point, node) pairs looked at in one step of a search: what bounds its memory.
FRONTIER = 1 << 19


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class Forest:
    """One tree per shard; ``shards`` must be sorted, and a shard's values differ."""

    def __init__(self, shards: np.ndarray, values: np.ndarray) -> None:
        self.values = values
        n = len(values)
        first = np.r_[True, shards[1:] != shards[:-1]] if n else np.zeros(0, bool)
        self.roots = np.flatnonzero(first)[np.cumsum(first) - 1]
        at = self.roots.copy()
        waiting = np.flatnonzero(~first)
        edges, children = [], []
        while len(waiting):
            parent = at[waiting]
            key = parent * 65 + distance(values[waiting], values[parent])
            edge, chosen, which = np.unique(key, return_index=True, return_inverse=True)
            child = waiting[chosen]
            edges.append(edge)
            children.append(child)
            at[waiting] = child[which]
            waiting = waiting[child[which] != waiting]
        self.edges = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        self.children = np.concatenate(children) if children else np.zeros(0, np.int64)
        order = np.argsort(self.edges)
        self.edges, self.children = self.edges[order], self.children[order]

    def near(self, points: np.ndarray, radius: int):
        """Yields arrays (point, node) of all pairs within ``radius`` in the point's own shard."""
        stack = [
            (points[at : at + FRONTIER], self.roots[points[at : at + FRONTIER]])
            for at in range(0, len(points), FRONTIER)
        ]
        while stack:
            point, node = stack.pop()
            d = distance(self.values[point], self.values[node])
            hit = (d <= radius) & (point != node)
            if hit.any():
                yield point[hit], node[hit]
            low = np.searchsorted(self.edges, node * 65 + np.maximum(d - radius, 0), "left")
            high = np.searchsorted(self.edges, node * 65 + np.minimum(d + radius, 64), "right")
            count = high - low
            ends = np.cumsum(count)
            if not len(ends) or not ends[-1]:
                continue
            at = 0
            while at < len(count):  # as many points at once as the frontier holds
                base = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, base + FRONTIER, "right")))
                c = count[at:to]
                if c.sum():
                    offset = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
                    stack.append((np.repeat(point[at:to], c), self.children[np.repeat(low[at:to], c) + offset]))
                at = to


def linked(shards: np.ndarray, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(value, lowest value of its component in the shard) for values with a neighbour in their shard.

    Pairs are merged as they are found, so a dense shard of n values gives n links, not n * n.
    """
    forest = Forest(shards, values)
    label = np.arange(len(values))
    for point, node in forest.near(np.arange(len(values)), radius):
        merge(label, point, node)
    root = label
    while True:
        up = root[root]
        if (up == root).all():
            break
        root = up
    low = values.copy()
    np.minimum.at(low, root, values)
    mine = low[root] != values
    return values[mine], low[root][mine]


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the components of a[i] and b[i]; ``label`` points to lower members, the lowest to itself."""
    while True:
        ra, rb = label[a], label[b]
        while True:
            ua, ub = label[ra], label[rb]
            if (ua == ra).all() and (ub == rb).all():
                break
            ra, rb = ua, ub
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(label, np.maximum(ra, rb), np.minimum(ra, rb))
