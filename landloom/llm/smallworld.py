"""Navigable small-world graphs over points of a line, searched by greedy routing and widened beams.

A point's links are its two neighbours in order and long links whose lengths
fall off harmonically, so that greedy routing needs about log^2 n steps.
Searching many queries at once keeps every step in numpy.
"""

from __future__ import annotations

import numpy as np

#: Long links of a node.
LINKS = 2
#: Nodes of a beam at first; it is doubled as long as all of them lie within the radius.
BEAM = 4


def build_links(n: int, links: int = LINKS, seed: int = 11) -> np.ndarray:
    """Long links of n nodes in order: ranks, one row per node, as many before it as after it."""
    rng = np.random.default_rng(seed)
    jump = np.exp(rng.random((n, links)) * np.log(max(n, 2))).astype(np.int64)
    jump[:, ::2] *= -1
    return np.clip(np.arange(n)[:, None] + jump, 0, max(n - 1, 0)).astype(np.int32)


class Graph:
    """A graph over unsigned 64-bit points; equal points may be repeated.

    `order` gives for each rank the place of its point in what was given.
    """

    def __init__(self, points: np.ndarray) -> None:
        self.order = np.argsort(points, kind="stable")
        self.points = points[self.order].astype(np.uint64)
        self.links = build_links(len(points))

    @classmethod
    def stored(cls, points: bytes, links: bytes) -> Graph:
        """A graph as `points.tobytes()` and `links.tobytes()` hold it; its nodes are in order."""
        graph = cls.__new__(cls)
        graph.points = np.frombuffer(points, np.uint64)
        graph.links = np.frombuffer(links, np.int32).reshape(len(graph.points), -1)
        graph.order = np.arange(len(graph.points))
        return graph

    def _far(self, at: np.ndarray, query: np.ndarray) -> np.ndarray:
        p = self.points[at]
        return np.where(p > query, p - query, query - p)

    def route(self, queries: np.ndarray) -> np.ndarray:
        """Greedy routing from the middle of the graph: the rank of a nearest node of each query.

        In one dimension the links to the neighbours leave no local minimum
        except among equal points; a run of those is passed towards the query.
        """
        n = len(self.points)
        at = np.full(len(queries), n // 2, np.int64)
        far = self._far(at, queries)
        active = np.argsort(queries)  # near queries go by the same nodes
        active = active[far[active] > 0]
        while len(active):
            here = at[active]
            side = np.where(self.points[here] < queries[active], 1, -1)
            links = np.concatenate([np.clip(here + side, 0, n - 1)[:, None], self.links[here]], 1)
            d = self._far(links, queries[active, None])
            best = d.argmin(1)
            row = np.arange(len(active))
            new, near = links[row, best], d[row, best]
            # Among equal points, on by the longest link on the query's side that stays among them.
            equal = self.points[links] == self.points[here][:, None]
            flat = (near >= far[active]) & (links[:, 0] != here) & equal[:, 0]
            ahead = np.where(equal, (links - here[:, None]) * side[:, None], 0)
            new = np.where(flat, links[row, ahead.argmax(1)], new)
            go = (near < far[active]) | flat
            at[active[go]] = new[go]
            far[active[go]] = np.minimum(near, far[active])[go]
            active = active[go]
            active = active[far[active] > 0]
        return at

    def within(self, queries: np.ndarray, radius: np.ndarray, beam: int = BEAM, rounds: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (query number, node number) no farther apart than the query's radius.

        From the routed node a beam goes along the neighbours on either side and
        is doubled as long as all its nodes lie within the radius, so no node is
        missed whatever the number in reach. `rounds` ends it after so many
        beams: for measuring what a beam of fixed width would miss.
        """
        n = len(self.points)
        if not len(queries) or not n:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        start = self.route(queries)
        out_q, out_n = [], []
        for side in (-1, 1):
            cursor = start + (side > 0)
            active, width, turn = np.arange(len(queries)), beam, 0
            while len(active) and (rounds is None or turn < rounds):
                spots = cursor[active, None] + side * np.arange(width)
                there = (spots >= 0) & (spots < n)
                inside = there & (self._far(np.clip(spots, 0, n - 1), queries[active, None]) <= radius[active, None])
                row, col = np.nonzero(inside)
                out_q.append(active[row])
                out_n.append(spots[row, col])
                go = inside[:, -1]
                cursor[active] += side * width
                active = active[go]
                width, turn = min(2 * width, max(beam, 4_000_000 // max(len(active), 1))), turn + 1
        return np.concatenate(out_q), self.order[np.concatenate(out_n)]
