"""Words of whole texts by byte classes, with their bytes: shared by the
operators that count words."""

from __future__ import annotations

import numpy as np

from marquee.llm.shingles import span_hashes

BLOCK = 2 << 20


def classes(chars: str | bytes | range) -> np.ndarray:
    """A table of the byte values that belong to a class."""
    table = np.zeros(256, bool)
    table[[ord(c) if isinstance(c, str) else c for c in chars]] = True
    return table


class Words:
    """Words of the texts between ``offsets``: maximal runs of bytes outside
    ``gaps``, inside one text. Hashes (A-Z as a-z, never 0), byte spans and
    the text of every word."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray):
        self.raw = data[offsets[0]:offsets[-1]]
        at = offsets - offsets[0]
        n = len(self.raw)
        inside = ~gaps[self.raw]
        edge = np.zeros(n + 1, bool)
        edge[at] = True
        start = inside.copy()
        start[1:] &= ~inside[:-1] | edge[1:n]
        end = inside.copy()
        end[:-1] &= ~inside[1:] | edge[1:n]
        self.starts, self.ends = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.hashes = np.maximum(span_hashes(self.raw, self.starts, self.ends), np.uint64(1)) if n else np.zeros(
            0, np.uint64)
        self.first = np.searchsorted(self.starts, at)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def __len__(self):
        return len(self.starts)

    def breaks(self, cuts: np.ndarray) -> np.ndarray:
        """Whether a cut byte, or the end of a text, lies before a word and
        after the word before it."""
        out = np.ones(len(self), bool)
        if len(self):
            passed = np.append(0, np.cumsum(cuts[self.raw]))[self.starts]
            out[1:] = (passed[1:] != passed[:-1]) | (self.doc[1:] != self.doc[:-1])
        return out

    def strings(self, which: np.ndarray):
        """The given words, A-Z lower-cased, as an Arrow string array."""
        import pyarrow as pa

        size = self.ends[which] - self.starts[which]
        close = np.cumsum(size)
        at = np.arange(close[-1] if len(close) else 0) + np.repeat(self.starts[which] - (close - size), size)
        found = self.raw[at].copy()
        found[(found >= 65) & (found <= 90)] += 32
        return pa.StringArray.from_buffers(len(size), pa.py_buffer(np.append(0, close).astype(np.int32)),
                                           pa.py_buffer(found))


def blocks(column, cuts: np.ndarray, size: int = BLOCK):
    """(bytes, offsets, numbers of the texts) of an Arrow string column in
    blocks of about ``size`` bytes. A longer text is divided after cut bytes;
    where it has none it is taken whole, so memory is bounded by the longest
    stretch without a cut."""
    from marquee.llm.shingles import text_bytes

    data, offsets = text_bytes(column)
    edges, owner = [int(offsets[0])], []
    for i in np.arange(len(offsets) - 1) if (np.diff(offsets) > size).any() else ():
        a, b = int(offsets[i]), int(offsets[i + 1])
        while b - a > size:
            stop = a + size
            found = np.flatnonzero(cuts[data[a:stop]])
            if len(found):
                stop = a + int(found[-1]) + 1
            else:
                later = np.flatnonzero(cuts[data[stop:b]])
                stop = stop + int(later[0]) + 1 if len(later) else b
            if stop >= b:
                break
            edges.append(stop)
            owner.append(i)
            a = stop
        edges.append(b)
        owner.append(i)
    if owner:
        offsets, owner = np.array(edges, np.int64), np.array(owner)
    else:
        owner = np.arange(len(offsets) - 1)
    first, n = 0, len(owner)
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        last = min(last, n)
        yield data, offsets[first:last + 1], owner[first:last]
        first = last
