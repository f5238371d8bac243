"""Minimum cuts of small graphs, by augmenting along shortest paths (Dinic)."""

from __future__ import annotations


class CutGraph:
    """Nodes that cost something on either side, and edges that cost something when they are cut."""

    def __init__(self, nodes: int):
        self._excess = [0.0] * nodes  # cost of the sink side minus that of the source side
        self._edges: list[list[int]] = [[] for _ in range(nodes)]
        self._to: list[int] = []
        self._free: list[float] = []

    def cost(self, node: int, source_side: float, sink_side: float) -> None:
        """What it costs to put ``node`` on either side; only the difference decides."""
        self._excess[node] += sink_side - source_side

    def edge(self, a: int, b: int, capacity: float) -> None:
        """What it costs to put ``a`` and ``b`` on different sides."""
        for start, end in ((a, b), (b, a)):
            self._edges[start].append(len(self._to))
            self._to.append(end)
            self._free.append(capacity)

    def source_side(self) -> list[bool]:
        """Per node whether a minimum cut leaves it on the source side; of several cuts the smallest source side."""
        excess, edges, to, free = self._excess, self._edges, self._to, self._free
        while True:
            # Distance from the nodes that still have something to send, up to the nearest that can take something.
            level = [0 if e > 0 else -1 for e in excess]
            reached, ends = [n for n, e in enumerate(excess) if e > 0], False
            depth = 0
            while reached and not ends:
                depth += 1
                further = []
                for node in reached:
                    for arc in edges[node]:
                        other = to[arc]
                        if level[other] < 0 and free[arc] > 0:
                            level[other] = depth
                            further.append(other)
                            ends = ends or excess[other] < 0
                reached = further
            if not ends:
                return [place >= 0 for place in level]
            self._block(level)

    def _block(self, level: list[int]) -> None:
        """Send along paths of rising level until each is blocked."""
        excess, edges, to, free = self._excess, self._edges, self._to, self._free
        tried = [0] * len(level)
        for start in [n for n, e in enumerate(excess) if e > 0 and level[n] == 0]:
            path: list[int] = []
            node = start
            while excess[start] > 0:
                if excess[node] < 0 and path:
                    sent = min(excess[start], -excess[node], min(free[arc] for arc in path))
                    excess[start] -= sent
                    excess[node] += sent
                    for arc in path:
                        free[arc] -= sent
                        free[arc ^ 1] += sent
                    # Go on from the first edge that is full now.
                    full = next((k for k, arc in enumerate(path) if free[arc] <= 0), len(path))
                    path = path[:full]
                    node = to[path[-1]] if path else start
                    continue
                arcs, at = edges[node], tried[node]
                while at < len(arcs) and not (free[arcs[at]] > 0 and level[to[arcs[at]]] == level[node] + 1):
                    at += 1
                tried[node] = at
                if at < len(arcs):
                    path.append(arcs[at])
                    node = to[arcs[at]]
                elif path:
                    node = to[path.pop() ^ 1]
                    tried[node] += 1
                else:
                    break
