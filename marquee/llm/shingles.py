"""Word and shingle hashes of whole texts, vectorised over Arrow batches.

The kernels work on the UTF-8 bytes of a batch: blanks are space and
\\x09-\\x0D, A-Z is lower-cased, and a word is hashed by a polynomial over
its bytes modulo 2**64 (a random table maps the bytes first) and mixed.
Texts are taken in pieces of about ``CHUNK`` bytes, cut between documents
only, so memory is bounded by the longest text.
"""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 18
# text bytes of a batch that are worked on at once: what is made of them is
# many times their size, and a worker keeps the most it ever held
SLICE = 1 << 19
U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
for _c in range(65, 91):
    _BYTE[_c] = _BYTE[_c + 32]
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_STEP = _rng.integers(1, 2**63, 64, dtype=np.uint64) * U(2) + U(1)


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate([[U(1)], np.multiply.accumulate(np.full(n, base, np.uint64))])


class _Powers:
    up = _powers(_BASE, 1024)
    down = _powers(_BASE_INVERSE, 1024)

    @classmethod
    def of(cls, n: int):
        if len(cls.up) <= n:
            cls.up, cls.down = _powers(_BASE, n), _powers(_BASE_INVERSE, n)
        return cls.up, cls.down


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def text_bytes(column):
    """(bytes, offsets) of an Arrow string column; nulls are empty."""
    import pyarrow.compute as pc

    column = pc.fill_null(column, "") if column.null_count else column
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def slices(batch, column: int, limit: int = SLICE):
    """A record batch in parts of about ``limit`` text bytes, so that what
    is made of a part stays small; a longer text is a part of its own."""
    _, offsets = text_bytes(batch.column(column))
    first, n = 0, batch.num_rows
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield batch.slice(first, min(last, n) - first)
        first = last


def small_parts(batches, column: int):
    """The record batches in ``slices``. After each batch, what Arrow's pool
    keeps of it goes back: a worker outlives its task."""
    import pyarrow as pa

    for batch in batches:
        yield from slices(batch, column)
        del batch
        pa.default_memory_pool().release_unused()


def chunks(offsets: np.ndarray):
    """Ranges of documents of about CHUNK bytes."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1)
        yield first, min(last, n)
        first = min(last, n)


#: separates words of ASCII letters and digits and anything beyond ASCII
NOT_ALPHANUMERIC = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def word_hashes(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = _BLANK, prefixes: tuple[int, ...] = ()):
    """Hashes of the words of the documents between ``offsets``, and the
    first word of each document (one more for the end). With ``prefixes``
    also, for each of these byte lengths, (hashes of the prefixes of all
    longer words, the words they belong to)."""
    low = int(offsets[0])
    raw = data[low:int(offsets[-1])]
    at = offsets - low
    n = len(raw)
    if not n:
        empty = np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
        return (*empty, [(empty[0], empty[0].astype(np.int64))] * len(prefixes)) if prefixes else empty
    inside = ~gaps[raw]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end)
    up, down = _Powers.of(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:n], out=total[1:])
    size = ends + 1 - starts
    words = mix((total[ends + 1] - total[starts]) * down[starts] + size.astype(np.uint64))
    first = np.searchsorted(starts, at)
    if not prefixes:
        return words, first
    cut = []
    for length in prefixes:
        of = np.flatnonzero(size > length)
        begin = starts[of]
        cut.append((mix((total[begin + length] - total[begin]) * down[begin] + U(length << 32)), of))
    return words, first, cut


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans [start, end) of ``raw``; A-Z and a-z count
    as equal."""
    up, down = _Powers.of(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * up[:len(raw)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(words: np.ndarray, first: np.ndarray, size: int):
    """Hashes of ``size`` consecutive words, and the first shingle of each
    document. A document of fewer words, but not none, has one shingle: its
    whole sequence."""
    n = np.diff(first)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    begin = np.concatenate([[0], np.cumsum(count)])
    at = np.arange(begin[-1]) - np.repeat(begin[:-1] - first[:-1], count)
    full = np.repeat(n >= size, count)
    out = np.zeros(len(at), np.uint64)
    last = len(words) - 1
    length = np.repeat(np.minimum(n, size), count)
    for j in range(size):
        part = words[np.minimum(at + j, last)] * _STEP[j] if len(words) else out
        out += np.where(full | (j < length), part, U(0))
    return mix(out + length.astype(np.uint64)), begin


def shingle_sets(column, size: int):
    """The sorted distinct shingle hashes of every text of an Arrow column."""
    data, offsets = text_bytes(column)
    for a, b in chunks(offsets):
        words, first = word_hashes(data, offsets[a:b + 1])
        hashes, begin = shingles(words, first, size)
        for i in range(b - a):
            part = hashes[begin[i]:begin[i + 1]]
            part.sort()
            if len(part) > 1:
                new = np.empty(len(part), bool)
                new[0] = True
                np.not_equal(part[1:], part[:-1], out=new[1:])
                part = part[new]
            yield part
