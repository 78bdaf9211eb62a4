"""A double-array trie of sequences of turns, for one shard.

Turns are numbered densely, in the order in which their siblings are first met, so that siblings
mostly have neighbouring numbers. The child of a node by turn t is slot ``base[node] + t``, if
``check`` there names the node. Families of children are placed from the largest to the smallest;
only children fill what is left free.
"""

from __future__ import annotations

import numpy as np

FREE, ROOT = -1, -2


def number_turns(turns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """Numbers from 0 of turns, equal ones alike, and how many there are. Turns of all first
    positions come before those of second positions, and so on."""
    _, first, same = np.unique(turns, return_index=True, return_inverse=True)
    starts = np.cumsum(lengths) - lengths
    position = np.arange(len(turns)) - np.repeat(starts, lengths)
    met = np.lexsort((np.arange(len(turns)), position))
    rank = np.full(len(first), len(turns), dtype=np.int64)
    np.minimum.at(rank, same[met], np.arange(len(turns)))
    order = np.empty(len(first), dtype=np.int64)
    order[np.argsort(rank)] = np.arange(len(first))
    return order[same], len(first)


class DoubleArray:
    """``base`` and ``check`` over the sequences ``labels``, of the given lengths."""

    def __init__(self, labels: np.ndarray, lengths: np.ndarray):
        self.labels, self.lengths = labels, lengths
        self.starts = np.cumsum(lengths) - lengths
        parents, children = self._families()
        nodes = 1 + len(parents)
        slots = self._place(parents, children, nodes)
        size = int(slots.max()) + 1
        self.base, self.check = np.zeros(size, dtype=np.int64), np.full(size, FREE, dtype=np.int64)
        self.check[slots[0]] = ROOT
        if len(parents):
            self.base[slots[parents]] = slots[1:] - children
            self.check[slots[1:]] = slots[parents]
        self.root = int(slots[0])

    def _at(self, depth: int) -> np.ndarray:
        return np.flatnonzero(self.lengths > depth)

    def _families(self) -> tuple[np.ndarray, np.ndarray]:
        """The parent and the label of every node but the root, which is node 0; level by level."""
        parents, children, made = [], [], 1
        node = np.zeros(len(self.lengths), dtype=np.int64)
        for depth in range(int(self.lengths.max(initial=0))):
            live = self._at(depth)
            pairs = np.stack([node[live], self.labels[self.starts[live] + depth]], axis=1)
            found, which = np.unique(pairs, axis=0, return_inverse=True)
            node[live] = made + which.ravel()
            parents.append(found[:, 0])
            children.append(found[:, 1])
            made += len(found)
        empty = np.zeros(0, dtype=np.int64)
        return np.concatenate([empty, *parents]), np.concatenate([empty, *children])

    def _place(self, parents: np.ndarray, children: np.ndarray, nodes: int) -> np.ndarray:
        """The slot of every node. Nodes with the same parent stand together in ``parents``."""
        slots = np.zeros(nodes, dtype=np.int64)
        if not len(parents):
            return slots
        edges = np.concatenate(([0], np.flatnonzero(np.diff(parents)) + 1, [len(parents)]))
        sizes = np.diff(edges)
        taken = np.zeros(2 * nodes + int(children.max()) + 2, dtype=bool)
        taken[0] = True
        drawn = np.random.default_rng(nodes)
        begin = 1
        for family in np.argsort(-sizes, kind="stable")[: int((sizes > 1).sum())].tolist():
            at = slice(edges[family], edges[family + 1])
            apart = children[at] - children[at][0]
            width = int(apart[-1])
            place = None
            for _ in range(16):
                tried = drawn.integers(begin, max(begin + 1, len(taken) - width), 256)
                tried = tried[tried + width < len(taken)]
                fits = np.flatnonzero(~taken[tried[:, None] + apart].any(axis=1))
                if len(fits):
                    place = int(tried[fits[0]])
                    break
            if place is None:
                # Crowded: go on in new room, where the next families are tried as well.
                begin = place = len(taken)
                taken = np.concatenate([taken, np.zeros(width + 1 + len(taken) // 2, dtype=bool)])
            taken[place + apart] = True
            slots[1:][at] = place + apart
        single = np.flatnonzero(np.repeat(sizes, sizes) == 1)
        slots[1:][single] = np.flatnonzero(~taken)[: len(single)] if (~taken).sum() >= len(single) else self._more(taken, len(single))
        return slots

    @staticmethod
    def _more(taken: np.ndarray, wanted: int) -> np.ndarray:
        free = np.flatnonzero(~taken)
        return np.concatenate([free, len(taken) + np.arange(wanted - len(free))])

    def walk(self) -> np.ndarray:
        """The slot that every sequence reaches with each of its turns, in the layout of ``labels``."""
        reached = np.full(len(self.labels), self.root, dtype=np.int64)
        now = np.full(len(self.lengths), self.root, dtype=np.int64)
        for depth in range(int(self.lengths.max(initial=0))):
            live = self._at(depth)
            at = self.starts[live] + depth
            slot = self.base[now[live]] + self.labels[at]
            if (self.check[slot] != now[live]).any():
                raise AssertionError("a sequence is not in its own trie")
            reached[at] = now[live] = slot
        return reached
