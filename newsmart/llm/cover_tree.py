"""A cover tree for exact inner-product search over integer vectors.

Vectors are augmented by one component, ``sqrt(M^2 - |x|^2)``, so that all have the length
``M`` of the longest; a query's is zero. Then ``2 <q, x> = |q|^2 + M^2 - d(q, x)^2``: a bound on
the distance is one on the inner product. A node is a point with all points in its covering
radius. Its children are a net of its points, more than ``radius / BASE`` apart, each with the
points nearer than that to it, the node's own point first; so radii shrink level by level. A
child of one point needs no node: it is a leaf of its parent.

A search goes best first, by the largest product that a node may hold. A node whose products all
lie outside what a window still needs is skipped; leaves are verified by their exact integer
products. Distances carry a margin for rounding, products are integers, so none is lost."""

from __future__ import annotations

import heapq

import numpy as np

BASE = 2.0
#: Nodes of so many points are not divided.
LEAF = 32


class Products:
    """Exact integer products with the rows of a matrix: by floating point while every sum is below
    2^53, else by integers; sums beyond 2^63 are an error."""

    def __init__(self, rows: np.ndarray):
        self.rows, self.most = rows, _most(rows)
        self.real = rows.astype(np.float64)

    def __call__(self, q: np.ndarray, of: np.ndarray | slice = slice(None)) -> np.ndarray:
        bound = self.most * _most(q) * max(1, self.rows.shape[1])
        if bound < 1 << 53:
            return (self.real[of] @ q.astype(np.float64)).astype(np.int64)
        if bound < 1 << 63:
            return self.rows[of] @ q
        raise OverflowError("an inner product does not fit a 64-bit integer")


def _most(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


class Node:
    __slots__ = ("radius", "leaves", "centers", "radii", "children")


class CoverTree:
    """The tree over ``points``, an integer matrix, with an id and a label a row."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        self.ids, self.labels, self.products = ids, labels, Products(points)
        real = self.products.real
        squares = (real * real).sum(axis=1)
        self.length = float(squares.max(initial=0.0))  # M^2
        self.augmented = np.column_stack([real, np.sqrt(np.maximum(self.length - squares, 0))])
        self.root = self._grow() if len(points) else None

    def _apart(self, of: np.ndarray) -> np.ndarray:
        """Distances of points from the first; all have the same length, so a product tells it. Rounding
        may not make one too short: a covering radius must cover."""
        gap = 2 * (self.length - of @ of[0])
        return np.sqrt(np.maximum(gap, 0) + 1e-9 * self.length)

    def _grow(self) -> Node:
        top = Node()
        todo = [(top, np.arange(len(self.augmented)))]
        while todo:
            node, of = todo.pop()
            at = self.augmented[of]
            apart = self._apart(at)
            node.radius = float(apart.max(initial=0.0))
            node.children, leaves, centers = [], [], []
            near = node.radius / BASE
            flat = len(of) <= LEAF or float((apart * apart).max(initial=0.0)) <= 4e-9 * self.length
            if flat:
                leaves.append(of)
            while not flat and len(of):
                mine = apart <= near
                mine[0] = True
                if mine.sum() == 1:
                    leaves.append(of[:1])
                    of, at = of[1:], at[1:]
                else:
                    child = Node()
                    node.children.append(child)
                    centers.append(int(of[0]))
                    todo.append((child, of[mine]))
                    of, at = of[~mine], at[~mine]
                apart = self._apart(at) if len(of) else apart[:0]
            node.leaves = np.concatenate(leaves) if leaves else of[:0]
            node.centers = np.array(centers, np.int64)
        stack = [top]
        while stack:
            node = stack.pop()
            node.radii = np.array([c.radius for c in node.children])
            stack += node.children
        return top

    def best(self, q: np.ndarray, label: int, same: bool, own: int, low: list[int], high: list[int], k: int) -> list[list[tuple[int, int]]]:
        """Per window ``low <= product <= high``: its ``k`` first ``(product, id)``, larger products
        first, ties by smaller id, of the points with the label (``same``) or another, less ``own``."""
        found: list[list[tuple[int, int]]] = [[] for _ in low]
        if self.root is None or not low:
            return found
        need = list(low)  # smaller products can't get in any more
        ceiling, square = max(high), float((q.astype(np.float64) ** 2).sum())
        total = square + self.length
        margin = 0.5 + 1e-9 * total
        heap: list[tuple[float, int, Node]] = [(-np.inf, 0, self.root)]
        tick = 0
        while heap:
            bound, _, node = heapq.heappop(heap)
            if -bound < min(need):
                break
            if len(node.leaves):
                self._verify(q, node.leaves, label, same, own, found, need, low, high, k)
            if node.children:
                d = np.sqrt(np.maximum(total - 2.0 * self.products(q, node.centers), 0))
                upper = (total - np.maximum(d - node.radii, 0) ** 2) / 2 + margin
                lower = (total - (d + node.radii) ** 2) / 2 - margin
                useful = np.zeros(len(d), bool)
                for n, h in zip(need, high, strict=True):
                    useful |= (upper >= n) & (lower <= h)
                for c in np.flatnonzero(useful).tolist():
                    tick += 1
                    heapq.heappush(heap, (-min(float(upper[c]), ceiling + margin), tick, node.children[c]))
        return found

    def _verify(self, q, leaves, label, same, own, found, need, low, high, k) -> None:
        scores = self.products(q, leaves)
        ok = scores >= min(need)
        if ok.any():
            leaves, scores = leaves[ok], scores[ok]
            ids = self.ids[leaves]
            ok = ((self.labels[leaves] == label) == same) & (ids != own)
            ids, scores = ids[ok], scores[ok]
            order = np.lexsort((ids, -scores))
            ids, scores = ids[order], scores[order]
            for w, h in enumerate(high):
                start = int(np.searchsorted(-scores, -h, "left"))
                some = [(s, i) for s, i in zip(scores[start : start + k].tolist(), ids[start : start + k].tolist(), strict=True) if s >= need[w]]
                if some:
                    found[w] = sorted(found[w] + some, key=lambda x: (-x[0], x[1]))[:k]
                    if len(found[w]) == k:
                        need[w] = max(low[w], found[w][-1][0])
