"""Flat proximity graphs of unit vectors: robust pruning and greedy search, many queries at once."""

from __future__ import annotations

import numpy as np

_UNSEEN, _DONE = -2.0, -3.0
STARTS = 16  # medoids of a graph
_STEP_PAIRS = 1 << 14  # (query, node) pairs that are expanded together


class Search:
    """Greedy searches of several queries in one graph, side by side.

    ``neighbours`` has a row of node numbers for each node, filled up with -1.
    ``similarity`` holds the cosine of every (query, node) pair that was looked at.
    """

    def __init__(self, nodes: np.ndarray, neighbours: np.ndarray, queries: np.ndarray):
        self._nodes, self._neighbours, self._queries = nodes, neighbours, queries
        self.similarity = np.full((len(queries), len(nodes)), _UNSEEN)
        self._open = np.full((len(queries), len(nodes)), _UNSEEN)

    def visit(self, query: np.ndarray, node: np.ndarray) -> None:
        """Compare queries with nodes that they have not met yet."""
        fresh = (node >= 0) & (self.similarity[query, node] == _UNSEEN)
        pairs = np.unique(query[fresh] * len(self._nodes) + node[fresh])
        query, node = np.divmod(pairs, len(self._nodes))
        cosine = np.einsum("ij,ij->i", self._queries[query], self._nodes[node])
        self.similarity[query, node] = self._open[query, node] = cosine

    def start(self, nodes: np.ndarray) -> None:
        """Every query meets the same first nodes."""
        self.visit(np.repeat(np.arange(len(self._queries)), len(nodes)), np.tile(nodes, len(self._queries)))

    def _expand(self, query: np.ndarray, node: np.ndarray) -> None:
        self._open[query, node] = _DONE
        near = self._neighbours[node]
        self.visit(np.repeat(query, near.shape[1]), near.reshape(-1))

    def descend(self, beam: int) -> np.ndarray:
        """Expand the best open node of every query until its ``beam`` best ones are expanded.

        Gives the nodes expanded, a row for each query, filled up with -1.
        """
        active = np.arange(len(self._queries))
        path = []
        values = np.full((len(self._queries), 0), _DONE)
        while len(active):
            best = self._open[active].argmax(1)
            value = self._open[active, best]
            go = (value > _UNSEEN) & ((values[active] >= value[:, None]).sum(1) < beam)
            active, best, value = active[go], best[go], value[go]
            step = np.full(len(self._queries), -1)
            step[active] = best
            path.append(step)
            column = np.full((len(self._queries), 1), _DONE)
            column[active, 0] = value
            values = np.hstack([values, column])
            self._expand(active, best)
        return np.column_stack(path)

    def widen(self, reach: float) -> None:
        """Expand every node of at least this similarity, until no further one turns up."""
        while True:
            query, node = np.nonzero(self._open >= reach)
            if not len(query):
                return
            for i in range(0, len(query), _STEP_PAIRS):
                self._expand(query[i : i + _STEP_PAIRS], node[i : i + _STEP_PAIRS])


def medoids(nodes: np.ndarray, k: int, seed: int) -> np.ndarray:
    """The nodes closest to the centres of ``k`` cells, where searches start."""
    centres = split_centres(nodes, k, seed)
    return np.unique(to_centres(nodes, centres).argmin(0))


def _robust_prune(nodes: np.ndarray, candidates: np.ndarray, degree: int, slack: float) -> np.ndarray:
    """Up to ``degree`` of each node's candidates, nearest first.

    A chosen neighbour rules out the candidates that are ``slack`` times closer to it than to
    the node, which keeps edges in all directions.
    """
    n = len(nodes)
    own = np.arange(n)[:, None]
    candidates = np.sort(candidates, 1)
    valid = (candidates >= 0) & (candidates != own)
    valid[:, 1:] &= candidates[:, 1:] != candidates[:, :-1]
    points = nodes[candidates]
    far = np.where(valid, 2 - 2 * np.einsum("nd,ncd->nc", nodes, points), np.inf)
    order = np.argsort(far, 1, kind="stable")[:, : max(64, 2 * degree)]
    far, candidates = np.take_along_axis(far, order, 1), np.take_along_axis(candidates, order, 1)
    points = np.take_along_axis(points, order[:, :, None], 1)
    between = 2 - 2 * points @ points.transpose(0, 2, 1)
    alive, taken = np.isfinite(far), np.zeros(far.shape, bool)
    kept = np.full((n, degree), -1)
    count = np.zeros(n, int)
    for j in range(candidates.shape[1]):
        take = np.flatnonzero(alive[:, j] & (count < degree))
        kept[take, count[take]] = candidates[take, j]
        count[take] += 1
        alive[take] &= slack * slack * between[take, j] > far[take]
        taken[take, j] = True
    # Places that are left go to the nearest of the others, which keeps close groups together.
    spare = np.cumsum(np.isfinite(far) & ~taken, 1)
    row, column = np.nonzero(np.isfinite(far) & ~taken & (spare <= (degree - count)[:, None]))
    kept[row, count[row] + spare[row, column] - 1] = candidates[row, column]
    return kept


def _both_ways(neighbours: np.ndarray) -> np.ndarray:
    """Each node's neighbours and the nodes it is a neighbour of, filled up with -1."""
    n, degree = neighbours.shape
    source, target = np.repeat(np.arange(n), degree), neighbours.reshape(-1)
    source, target = source[target >= 0], target[target >= 0]
    a, b = np.concatenate([source, target]), np.concatenate([target, source])
    order = np.argsort(a, kind="stable")
    a, b = a[order], b[order]
    count = np.bincount(a, minlength=n)
    out = np.full((n, max(1, int(count.max(initial=0)))), -1)
    out[a, np.arange(len(a)) - np.repeat(np.cumsum(count) - count, count)] = b
    return out


def build(nodes: np.ndarray, degree: int, beam: int, seed: int) -> np.ndarray:
    """The neighbours of every node, from a random graph in two rounds of search and pruning."""
    n = len(nodes)
    draw = np.random.Generator(np.random.PCG64(seed & 0xFFFFFFFF))
    neighbours = draw.integers(0, n, (n, degree))
    starts = medoids(nodes, STARTS, seed)
    for slack in (1.2, 1.2):
        search = Search(nodes, neighbours, nodes)
        search.start(starts)
        path = search.descend(beam)
        neighbours = _robust_prune(nodes, np.hstack([path, neighbours]), degree, slack)
        neighbours = _robust_prune(nodes, _both_ways(neighbours), degree, slack)
    return neighbours


def split_centres(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Up to ``k`` centres of a sample by a few rounds of k-means."""
    points = np.unique(points, axis=0)
    draw = np.random.Generator(np.random.PCG64(seed & 0xFFFFFFFF))
    centres = points[draw.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(5):
        nearest = to_centres(points, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        count = np.bincount(nearest, minlength=len(centres))
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def to_centres(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances from centres, less a term that all centres share.

    Taken from the middle of the centres, so that points close together are still told apart.
    """
    middle = centres.mean(0)
    centres = centres - middle
    return (centres * centres).sum(1) - 2 * (points - middle) @ centres.T
