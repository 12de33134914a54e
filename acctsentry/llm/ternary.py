"""Ternary search trees over sequences of numbers, and their prefixes' totals.

One block holds sorted sequences of a range shard. Each run of sequences that
go on from the same place becomes a tree, balanced by inserting the median
first; a traversal without recursion adds the weights from the leaves up.
"""

from __future__ import annotations

import numpy as np


class Tree:
    """Symbols at nodes; ``lo`` and ``hi`` lead to siblings, ``eq`` to what follows."""

    def __init__(self) -> None:
        self.symbol: list[int] = []
        self.lo: list[int] = []
        self.hi: list[int] = []
        self.eq: list[int] = []
        self.parent: list[int] = []
        self.top = -1

    def node(self, symbol: int, parent: int) -> int:
        self.symbol.append(symbol)
        self.lo.append(-1)
        self.hi.append(-1)
        self.eq.append(-1)
        self.parent.append(parent)
        return len(self.symbol) - 1

    def insert(self, sequence: list[int]) -> int:
        """The node of the sequence's last symbol, made where it isn't there."""
        above, links, at = -1, None, self.top
        for symbol in sequence:
            while at >= 0 and self.symbol[at] != symbol:
                links, slot = (self.lo if symbol < self.symbol[at] else self.hi), at
                at = links[at]
            if at < 0:
                at = self.node(symbol, above)
                if links is None:
                    self.top = at
                else:
                    links[slot] = at
            above, links, slot = at, self.eq, at
            at = self.eq[at]
        return above

    def traversal(self) -> list[int]:
        """All nodes in the order of their prefixes, each after the prefix above it."""
        out, todo = [], [(self.top, False)]
        while todo:
            at, seen = todo.pop()
            if at < 0:
                continue
            if seen:
                out.append(at)
                todo += [(self.hi[at], False), (self.eq[at], False)]
            else:
                todo += [(at, True), (self.lo[at], False)]
        return out


def medians(n: int) -> list[int]:
    """0 .. n-1, the median first, then the medians of both halves, and so on."""
    out, todo = [], [(0, n)]
    while todo:
        lo, hi = todo.pop()
        if lo < hi:
            mid = (lo + hi) // 2
            out.append(mid)
            todo += [(mid + 1, hi), (lo, mid)]
    return out


def prefix_totals(
    sequences: list[list[int]], sums: np.ndarray, least: list[tuple[int, int]],
) -> dict[str, np.ndarray]:
    """The distinct prefixes (not the empty one) of sorted, distinct sequences.

    ``sums`` (sequences x columns) is added over a prefix's sequences, of
    ``least`` the smallest is taken. Per prefix, in order: ``of`` and
    ``length`` (it is the first ``length`` symbols of that sequence),
    ``parent`` (row of the prefix one shorter, -1 for the empty one),
    ``children``, ``sums``, ``least``, and ``edge``: whether the first or the
    last sequence has it, so that a neighbouring block may have it too.
    """
    tree, end = Tree(), [-1] * len(sequences)
    for i in medians(len(sequences)):
        end[i] = tree.insert(sequences[i])
    order = tree.traversal()
    row = {at: k for k, at in enumerate(order)}
    parent = [row.get(tree.parent[at], -1) for at in order]
    total = np.zeros((len(order), sums.shape[1]), np.int64)
    low: list[tuple[int, int] | None] = [None] * len(order)
    of, length = [0] * len(order), [0] * len(order)
    for i, at in enumerate(end):
        if at >= 0:
            k = row[at]
            total[k] += sums[i]
            low[k] = least[i]
            of[k], length[k] = i, len(sequences[i])
    totals, children = total.tolist(), [0] * len(order)
    for k in range(len(order) - 1, -1, -1):  # what is below a prefix comes after it
        p = parent[k]
        if p >= 0:
            totals[p] = [a + b for a, b in zip(totals[p], totals[k])]
            children[p] += 1
            if low[p] is None or low[k] < low[p]:
                low[p] = low[k]
            if not length[p]:
                of[p], length[p] = of[k], length[k] - 1
    edge = np.zeros(len(order), bool)
    for i in (0, len(sequences) - 1):
        k = row.get(end[i], -1)
        while k >= 0:
            edge[k] = True
            k = parent[k]
    return {"of": np.array(of, np.int64), "length": np.array(length, np.int64), "parent": np.array(parent, np.int64),
            "children": np.array(children, np.int64), "sums": np.array(totals, np.int64).reshape(len(order), sums.shape[1]),
            "least": np.array(low, np.int64).reshape(len(order), 2), "edge": edge}
