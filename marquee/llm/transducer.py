"""Weighted acyclic automata over label sequences.

A ``Tree`` holds n-grams level by level: the arcs of level d carry the
(d + 1)-th label, the sum of the counts of all n-grams that start this way,
and the arc of level d - 1 they follow. ``Counts`` is the same with equal
states shared: the minimal count transducer. An n-gram may be the start of
others; its own count is what its last arc carries beyond its successors.

Trees are made from sorted n-grams in one sweep: of every n-gram only what
differs from the one before is new. States are frozen from the deepest
level up; one that equals a frozen state (same labels, counts and targets,
told apart by 128 bits of hash) is replaced by it. Labels are unsigned
64-bit integers other than 0; sequences end in zeros where rows of one
length are needed. Everything is numpy on whole levels.
"""

from __future__ import annotations

import struct

import numpy as np

from marquee.llm.shingles import mix

U = np.uint64


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers first[i] ... first[i] + count[i] - 1, side by side."""
    close = np.cumsum(count)
    return np.arange(close[-1] if len(close) else 0) + np.repeat(first - (close - count), count)


class Tree:
    """Levels of (parent, label, weight); arcs in order of parent and label."""

    def __init__(self, parent: list, label: list, weight: list):
        self.parent, self.label, self.weight = parent, label, weight

    @property
    def depth(self) -> int:
        return len(self.label)

    @classmethod
    def of_sequence(cls, symbols: np.ndarray, heads: np.ndarray, items: np.ndarray, room: np.ndarray, order: int):
        """All n-grams of a sequence: at every position its head and the next
        ``room`` items (at most ``order``). Heads and items are numbers of
        the sorted ``symbols``. Sorted level by level."""
        parent, label, weight = [], [], []
        spots = np.flatnonzero(room > 0)
        node = np.zeros(len(spots), np.int64)
        for d in range(order + 1):
            if d:
                on = room[spots] >= d
                spots, node = spots[on], node[on]
            key = (node << 32) | (items[spots + d - 1] if d else heads[spots])
            arcs, node, count = np.unique(key, return_inverse=True, return_counts=True)
            parent.append(arcs >> 32)
            label.append(symbols[arcs & 0xFFFFFFFF])
            weight.append(count.astype(np.int64))
        return cls(parent, label, weight)

    @classmethod
    def of_rows(cls, rows: np.ndarray, counts: np.ndarray):
        """From distinct n-grams in sorted order (rows of labels, zeros at
        the end) and their counts."""
        parent, label, weight = [], [], []
        n, depth = rows.shape
        new = np.zeros(n, bool)
        above = np.zeros(n, np.int64)
        for d in range(depth):
            # what differs from the row before, here or earlier
            if n:
                new[0] = True
                new[1:] |= rows[1:, d] != rows[:-1, d]
            start = np.flatnonzero(new)
            total = np.add.reduceat(counts, start) if n else counts
            real = rows[start, d] != 0
            parent.append(above[start][real])
            label.append(rows[start, d][real])
            weight.append(total[real])
            at = np.cumsum(real) - 1
            above = at[np.cumsum(new) - 1] if n else above
        return cls(parent, label, weight)

    def own(self) -> list:
        """Per level, the counts of the n-grams that end there."""
        out = []
        for d in range(self.depth):
            left = self.weight[d].copy()
            if d + 1 < self.depth:
                total = np.append(0, np.cumsum(self.weight[d + 1]))
                edge = np.searchsorted(self.parent[d + 1], np.arange(len(left) + 1))
                left -= total[edge[1:]] - total[edge[:-1]]
            out.append(left)
        return out

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct n-grams in sorted order, and their counts."""
        own = self.own()
        inside = [None] * self.depth  # n-grams at and under every arc
        for d in reversed(range(self.depth)):
            inside[d] = (own[d] > 0).astype(np.int64)
            if d + 1 < self.depth:
                total = np.append(0, np.cumsum(inside[d + 1]))
                edge = np.searchsorted(self.parent[d + 1], np.arange(len(own[d]) + 1))
                inside[d] += total[edge[1:]] - total[edge[:-1]]
        n = int(inside[0].sum()) if self.depth else 0
        rows, counts = np.zeros((n, self.depth), U), np.zeros(n, np.int64)
        base = np.zeros(1, np.int64)
        for d in range(self.depth):
            size = inside[d]
            before = np.cumsum(size) - size
            lead = np.searchsorted(self.parent[d], self.parent[d])
            at = base[self.parent[d]] + before - before[lead]
            rows[ranges(at, size), d] = np.repeat(self.label[d], size)
            ends = own[d] > 0
            counts[at[ends]] = own[d][ends]
            base = at + ends
        return rows, counts

    def paths(self, level: int, arcs: np.ndarray) -> np.ndarray:
        """Labels from the root to the given arcs of a level, as rows."""
        out = np.zeros((len(arcs), level + 1), U)
        for d in range(level, -1, -1):
            out[:, d] = self.label[d][arcs]
            arcs = self.parent[d][arcs]
        return out

    def on(self, path: np.ndarray) -> list:
        """The arcs that lie on a path: (level, arc) while it goes on."""
        out, low, high = [], 0, len(self.label[0])
        for d in range(self.depth):
            at = low + int(np.searchsorted(self.label[d][low:high], path[d]))
            if at == high or self.label[d][at] != path[d]:
                break
            out.append((d, at))
            if d + 1 < self.depth:
                low, high = np.searchsorted(self.parent[d + 1], [at, at + 1]).tolist()
        return out


def union(trees: list[Tree]) -> Tree:
    """Sum of trees: counts of equal n-grams add up."""
    rows, counts = zip(*(t.rows() for t in trees), strict=True)
    return union_of_rows(np.asfortranarray(np.concatenate(rows)), np.concatenate(counts))


def union_of_rows(rows: np.ndarray, counts: np.ndarray) -> Tree:
    """The tree of n-grams in any order, some of them repeated: one sort,
    however many parts they come from. ``rows`` (column by column in memory)
    are sorted in place, so they are held once."""
    order = np.lexsort(rows.T[::-1])
    counts = counts[order]
    new = np.zeros(len(rows), bool)
    new[:1] = True
    for d in range(rows.shape[1]):
        rows[:, d] = rows[order, d]
        new[1:] |= rows[1:, d] != rows[:-1, d]
    del order
    start = np.flatnonzero(new)
    for d in range(rows.shape[1]):
        rows[:len(start), d] = rows[start, d]
    return Tree.of_rows(rows[:len(start)], np.add.reduceat(counts, start) if len(start) else counts)


class Counts:
    """A minimal count transducer. Per level: the first arc of every state
    (and the end), and label number, weight and target state of every arc."""

    def __init__(self, symbols, first: list, label: list, weight: list, target: list):
        self.symbols, self.first, self.label, self.weight, self.target = symbols, first, label, weight, target

    @classmethod
    def of(cls, tree: Tree):
        depth = tree.depth
        symbols = np.unique(np.concatenate([*tree.label, np.zeros(0, U)]))
        first, label, weight, target = [None] * depth, [None] * depth, [None] * depth, [None] * depth
        goal = np.zeros(len(tree.label[-1]), np.int64)
        for d in reversed(range(depth)):
            states = len(tree.label[d - 1]) if d else 1
            edge = np.searchsorted(tree.parent[d], np.arange(states + 1))
            number = np.searchsorted(symbols, tree.label[d])
            marks = []
            for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
                arc = mix(mix(mix(tree.label[d] * U(k)) + tree.weight[d].astype(U)) + goal.astype(U))
                total = np.append(U(0), np.cumsum(arc))
                marks.append(mix(total[edge[1:]] - total[edge[:-1]] + np.diff(edge).astype(U)))
            _, one, same = np.unique(marks[0], return_index=True, return_inverse=True)
            if not np.array_equal(marks[1][one][same], marks[1]):  # a clash of 64 bits: share nothing here
                one = same = np.arange(states)
            size = np.diff(edge)[one]
            arcs = ranges(edge[:-1][one], size)
            first[d], label[d] = np.append(0, np.cumsum(size)), number[arcs]
            weight[d], target[d] = tree.weight[d][arcs], goal[arcs]
            goal = same
        return cls(symbols, first, label, weight, target)

    def tree(self) -> Tree:
        parent, label, weight = [], [], []
        state = np.zeros(1, np.int64)
        for d in range(len(self.first)):
            size = self.first[d][state + 1] - self.first[d][state]
            arcs = ranges(self.first[d][state], size)
            parent.append(np.repeat(np.arange(len(state)), size))
            label.append(self.symbols[self.label[d][arcs]])
            weight.append(self.weight[d][arcs])
            state = self.target[d][arcs]
        return Tree(parent, label, weight)

    def compose(self, rows: np.ndarray) -> np.ndarray:
        """Own counts of the n-grams in ``rows`` (zeros at the end), 0 for
        one that is not there."""
        state, out = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        alive = np.ones(len(rows), bool)
        for d in range(len(self.first)):
            owner = np.repeat(np.arange(len(self.first[d]) - 1), np.diff(self.first[d]))
            keys = (owner << 32) | self.label[d]
            here = np.flatnonzero(alive & (rows[:, d] != 0)) if d < rows.shape[1] else np.zeros(0, np.int64)
            # an n-gram ends where it has no further label
            alive[:] = False
            out[here] = 0
            if not len(here) or not len(keys):
                break
            number = np.searchsorted(self.symbols, rows[here, d])
            known = number < len(self.symbols)
            known[known] = self.symbols[number[known]] == rows[here, d][known]
            want = (state[here] << 32) | number
            at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            hit = known & (keys[at] == want)
            on, at = here[hit], at[hit]
            out[on] = self.weight[d][at]
            if d + 1 < len(self.first):
                state[on] = self.target[d][at]
                total = np.append(0, np.cumsum(self.weight[d + 1]))
                edge = self.first[d + 1]
                ends = on if d + 1 == rows.shape[1] else on[rows[on, d + 1] == 0]
                out[ends] -= total[edge[state[ends] + 1]] - total[edge[state[ends]]]
            alive[on] = True
        return out

    def dump(self) -> bytes:
        """As bytes: numbers in as few bytes as they need, in byte planes,
        compressed."""
        import pyarrow as pa

        parts = [self.symbols]
        for d in range(len(self.first)):
            parts += [np.diff(self.first[d]), self.label[d], self.weight[d], self.target[d]]
        out = [struct.pack("<I", len(self.first))]
        for p in parts:
            p = p.astype("<u8")
            width = next(w for w in (1, 2, 4, 8) if not len(p) or w == 8 or int(p.max()) >> (8 * w) == 0)
            planes = np.ascontiguousarray(p.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
            out += [struct.pack("<QB", len(p), width), planes.tobytes()]
        body = b"".join(out)
        return struct.pack("<Q", len(body)) + pa.compress(body, codec="zstd", asbytes=True)

    @classmethod
    def load(cls, data: bytes):
        import pyarrow as pa

        body = pa.decompress(data[8:], decompressed_size=struct.unpack_from("<Q", data)[0], codec="zstd", asbytes=True)
        depth, at, parts = struct.unpack_from("<I", body)[0], 4, []
        for _ in range(1 + 4 * depth):
            n, width = struct.unpack_from("<QB", body, at)
            planes = np.frombuffer(body, np.uint8, n * width, at + 9).reshape(width, n)
            parts.append(np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(n).astype(U))
            at += 9 + n * width
        levels = [parts[1 + 4 * d:5 + 4 * d] for d in range(depth)]
        signed = [[p.astype(np.int64) for p in level] for level in levels]
        return cls(parts[0], [np.append(0, np.cumsum(s[0])) for s in signed], [s[1] for s in signed],
                   [s[2] for s in signed], [s[3] for s in signed])
