"""Byte tries as flat arrays, for vectorised walks over many strings."""

from __future__ import annotations

import numpy as np


class ByteTrie:
    """Dense next-node table (node, symbol) -> node, 0 where there is none
    (the root is node 0 and nobody's child), and the entry ending at a node."""

    def __init__(self, entries: list[tuple[bytes | tuple[int, ...], int]], symbols: int = 256):
        kids: list[dict[int, int]] = [{}]
        ends: dict[int, int] = {}
        parent, label = [0], [0]
        for key, value in entries:
            node = 0
            for c in key:
                nxt = kids[node].get(c)
                if nxt is None:
                    nxt = kids[node][c] = len(kids)
                    kids.append({})
                    parent.append(node)
                    label.append(c)
                node = nxt
            ends[node] = value
        self.next = np.zeros((len(kids), symbols), np.int32)
        for node, k in enumerate(kids):
            for c, to in k.items():
                self.next[node, c] = to
        self.entry = np.full(len(kids), -1, np.int32)
        for node, value in ends.items():
            self.entry[node] = value
        self.parent, self.label = np.array(parent), np.array(label)
        depth = np.zeros(len(kids), np.int32)
        for node in range(1, len(kids)):  # parents come before children
            depth[node] = depth[parent[node]] + 1
        self.depth = depth
