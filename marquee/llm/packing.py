"""Packing by power-of-two decomposition.

A document of n tokens (its ids and an end id) is cut into pieces whose
lengths are powers of two: full windows first, then the binary digits of
what is left, longest first. A piece is a sequence of its own, so no
sequence crosses documents and none needs padding; training takes batches
from buckets of equal length (``write_buckets``, ``buckets``).

Encoding works on batches of texts in numpy. The tokenizer drops white space,
lower-cases, and matches runs of letters, single digits and runs of other
characters; every match is merged on its own, by the ranks of its file. So
the ids of a text are those of its matches one after another, and each
distinct match of a batch is merged once, all of them side by side. Parts
between blanks that hold anything but ASCII and Latin-1 letters, or an
apostrophe, go through the tokenizer itself (neither composition nor a match
crosses a blank). Tests compare whole texts with the tokenizer.

Rows are independent: one map without a shuffle, and no state between rows
but a bounded memo of ids. ``sequence_id`` is the number of the input partition
times 2**33 and a running number in it, so a task that runs again gives the
same ids; read from a table, as the query does, they are stable.

Defined results: null texts are empty and have one piece, the end id;
texts of any length are encoded whole; repeated rows and ids, and null ids,
are documents of their own; an empty table gives an empty table; other
columns are not returned, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import held, ship

WINDOW = 4096
END_ID = 2
MEMO = 400_000
MEMO_IDS = 8_000_000
NONE = 1 << 40
SLOT_BITS = 20
BLANK, LETTER, DIGIT, OTHER, PART = range(5)
MAX_VOCABULARY_BYTES = 64 << 20


def decompose(n: int, window: int = WINDOW) -> list[int]:
    """Lengths of the pieces of n tokens: full windows, then the binary
    digits of the rest from the highest. ``window`` is a power of two."""
    full, rest = divmod(n, window)
    return [window] * full + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


class Merges:
    """The merge ranks of a BPE model with an end-of-word mark."""

    def __init__(self, model: dict):
        import numpy as np

        vocabulary, end = model["vocab"], model["end_of_word_suffix"]
        pairs = [m if isinstance(m, (list, tuple)) else m.split(" ") for m in model["merges"]]
        known = {(vocabulary[a] << 32) | vocabulary[b]: (rank, vocabulary[a + b]) for rank, (a, b) in
                 reversed(list(enumerate(pairs)))}
        self.keys = np.array(sorted(known), np.int64)
        self.rank = np.array([known[k][0] for k in self.keys.tolist()], np.int64)
        self.made = np.array([known[k][1] for k in self.keys.tolist()], np.int64)
        # a table of slots in front of the sorted keys: most pairs are settled
        # by one look; -1 is an empty slot, -2 one of several keys
        slot = self._slot(self.keys)
        self.slots = np.full(1 << SLOT_BITS, -1, np.int64)
        self.slots[slot] = np.arange(len(self.keys))
        self.slots[np.flatnonzero(np.bincount(slot, minlength=1 << SLOT_BITS) > 1)] = -2
        # the characters that stand for bytes: printable Latin-1 as it is,
        # the other bytes from U+0100 on
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        other = [b for b in range(256) if b not in plain]
        letter = {**{b: chr(b) for b in plain}, **{b: chr(256 + i) for i, b in enumerate(other)}}
        self.inner = np.array([vocabulary[letter[b]] for b in range(256)], np.int64)
        self.last = np.array([vocabulary[letter[b] + end] for b in range(256)], np.int64)

    def _slot(self, keys):
        import numpy as np

        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def find(self, left, right):
        """Rank and product of every pair; NONE where there is no merge."""
        import numpy as np

        key = (left << 32) | right
        at = self.slots[self._slot(key)]
        many = np.flatnonzero(at == -2)
        at[many] = np.minimum(np.searchsorted(self.keys, key[many]), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.rank[at], NONE), self.made[at]

    def merge(self, symbols, count):
        """Merged ids of words given as flat symbols, ``count`` of each word
        (1 at least): (flat ids, ids of each word). In every round each word
        merges its pair of lowest rank, the leftmost of equals."""
        import numpy as np

        word = np.repeat(np.arange(len(count)), count)
        done_word, done_symbol = [], []
        rank = np.full(len(symbols), NONE)
        made = np.zeros(len(symbols), np.int64)
        same = np.flatnonzero(word[1:] == word[:-1])
        rank[same], made[same] = self.find(symbols[same], symbols[same + 1])
        while len(word):
            first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            low = np.minimum.reduceat(rank, first)
            low = np.repeat(low, np.diff(np.append(first, len(word))))
            over = low == NONE
            if over.any():
                done_word.append(word[over])
                done_symbol.append(symbols[over])
                left = ~over
                word, symbols, rank, made, low = word[left], symbols[left], rank[left], made[left], low[left]
                if not len(word):
                    break
            at = np.flatnonzero(rank == low)
            at = at[np.concatenate([[True], word[at[1:]] != word[at[:-1]]])]
            symbols[at] = made[at]
            # the pair of a merged symbol is that of the one it took in
            keep = np.ones(len(word), bool)
            keep[at + 1] = False
            new = (np.cumsum(keep) - 1)[at]
            word, symbols, rank, made = word[keep], symbols[keep], rank[keep], made[keep]
            rank[new] = NONE
            for p in (new, new - 1):
                p = p[(p >= 0) & (p + 1 < len(word))]
                p = p[word[p] == word[p + 1]]
                rank[p], made[p] = self.find(symbols[p], symbols[p + 1])
        # a word is done all at once, so its symbols lie side by side
        words = np.concatenate([*done_word, np.zeros(0, np.int64)]).astype(np.int64)
        size = np.bincount(words, minlength=len(count))
        first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])[:len(words)])
        within = np.arange(len(words)) - np.repeat(first, np.diff(np.append(first, len(words))))
        out = np.zeros(len(words), np.uint32)
        out[(np.cumsum(size) - size)[words] + within] = np.concatenate([*done_symbol, np.zeros(0, np.int64)])
        return out, size


class Encoder:
    """Ids of the texts of Arrow columns."""

    def __init__(self, data: bytes, plain_specials: bool = True):
        import json
        import os

        import numpy as np

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(data.decode())
        # the strings of special tokens inside a text are ordinary text
        self.tokenizer.encode_special_tokens = plain_specials
        self.merges = Merges(json.loads(data)["model"])
        self._forget()
        kind = np.full(256, OTHER, np.uint8)
        kind[[9, 10, 11, 12, 13, 32]] = BLANK
        kind[[*range(65, 91), *range(97, 123), *range(128, 256)]] = LETTER
        kind[48:58] = DIGIT
        self.kind = kind
        self.odd = np.zeros(256, bool)
        self.odd[[*range(9), *range(14, 32), ord("'"), ord("<"), 127, *range(128, 256)]] = True

    def _forget(self):
        """Start the memo anew: sorted hashes of matches, and where their
        ids lie in ``flat``."""
        import numpy as np

        self.hash, self.first = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.size, self.flat = np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def _ids(self, hashes, raw, begins, sizes, whole):
        """Where the ids of distinct matches lie in ``flat``, and how many
        they are; ``whole`` ones go through the tokenizer."""
        import numpy as np

        if len(self.hash) + len(hashes) > MEMO or len(self.flat) > MEMO_IDS:
            self._forget()
        at = np.minimum(np.searchsorted(self.hash, hashes), max(len(self.hash) - 1, 0))
        new = np.flatnonzero(self.hash[at] != hashes) if len(self.hash) else np.arange(len(hashes))
        parts = new[whole[new]]
        plain = new[~whole[new]]
        b, s = begins[plain], sizes[plain]
        flat, count = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        if len(s):
            close = np.cumsum(s)
            spots = np.arange(close[-1]) + np.repeat(b - (close - s), s)
            symbols = self.merges.inner[raw[spots]]
            symbols[close - 1] = self.merges.last[raw[spots[close - 1]]]
            flat, count = self.merges.merge(symbols, s)
        ids = [np.array(self.tokenizer.encode(raw[x:x + n].tobytes().decode(), add_special_tokens=False).ids,
                        np.uint32) for x, n in zip(begins[parts].tolist(), sizes[parts].tolist(), strict=True)]
        count = np.concatenate([count, np.array([len(x) for x in ids], np.int64)])
        merged = np.concatenate([self.hash, hashes[plain], hashes[parts]])
        order = np.argsort(merged, kind="stable")
        self.first = np.concatenate([self.first, len(self.flat) + np.cumsum(count) - count])[order]
        self.size = np.concatenate([self.size, count])[order]
        self.hash, self.flat = merged[order], np.concatenate([self.flat, flat, *ids])
        at = np.searchsorted(self.hash, hashes)
        return self.first[at], self.size[at]

    def encode(self, data, offsets):
        """(flat ids, first id of every text and the end) of the texts
        between ``offsets`` of UTF-8 bytes."""
        import numpy as np

        from marquee.llm.shingles import span_hashes

        raw = data[offsets[0]:offsets[-1]].copy()
        at = offsets - offsets[0]
        n = len(raw)
        if not n:
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        kind = self.kind[raw]
        edge = np.zeros(n + 1, bool)
        edge[at] = True
        # parts between blanks, and those that hold something odd
        inside = kind != BLANK
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | edge[1:n]
        part = np.cumsum(begin) - 1
        latin = np.zeros(n, bool)
        lead = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] != 0x97) & (raw[1:] != 0xB7))
        latin[lead] = latin[lead + 1] = True
        odd = np.flatnonzero(self.odd[raw] & ~latin)
        strange = np.zeros(part[-1] + 2, bool)
        strange[part[odd]] = True
        strange = strange[part] & inside
        # lower case: A-Z, and the second byte of the Latin-1 capitals
        lower = raw.copy()
        lower[(raw >= 65) & (raw <= 90)] += 32
        tail = lead + 1
        lower[tail[raw[tail] <= 0x9E]] += 32
        lower[strange] = raw[strange]
        # matches: runs of one kind, digits alone, odd parts whole
        kind[strange] = PART
        start = inside.copy()
        start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT) | edge[1:n] | begin[1:]
        starts = np.flatnonzero(start)
        stop = np.append(starts[1:], n)
        blank = np.append(np.flatnonzero(~inside), n)
        ends = np.minimum(stop, blank[np.searchsorted(blank, starts)])
        # a part may equal a match: kept apart by the hash
        hashes, index, of = np.unique(span_hashes(lower, starts, ends) ^ (kind[starts] == PART).astype(np.uint64),
                                      return_index=True, return_inverse=True)
        first, lengths = self._ids(hashes, lower, starts[index], (ends - starts)[index], kind[starts[index]] == PART)
        # every match of the texts in order
        size = lengths[of]
        close = np.cumsum(size)
        out = self.flat[np.arange(close[-1] if len(close) else 0) + np.repeat(first[of] - (close - size), size)]
        return out, np.append(0, close)[np.searchsorted(starts, at)]


def encoded(encoder: Encoder, batches):
    """(part, flat ids, first id of every text and the end) of small parts
    of record batches of (id, text)."""
    from marquee.llm.shingles import slices, text_bytes

    for batch in (part for whole in batches for part in slices(whole, 1)):
        yield batch, *encoder.encode(*text_bytes(batch.column(1)))


def pack(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID, id_col: str = "doc_id",
         text_col: str = "text", outputs: tuple[str, ...] = ("ids",), plain_specials: bool = True) -> DataFrame:
    """One row per piece: id_col, start, length, doc_tokens, sequence_id,
    offset and the ``outputs`` wanted: ``ids`` (array<int>), ``ids_crc32``
    (of the ids as little-endian unsigned 32-bit integers). ``path`` names
    a tokenizer file, read on the driver and broadcast
    (``MAX_VOCABULARY_BYTES`` at most)."""
    if window < 1 or window & (window - 1):
        raise ValueError("window must be a power of two")
    with open(path, "rb") as file:
        data = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path}: a vocabulary of over {MAX_VOCABULARY_BYTES} bytes is not broadcast")
    id_type = docs.schema[id_col].dataType.simpleString()
    types = {"ids": "array<int>", "ids_crc32": "bigint"}
    schema = ", ".join([f"`{id_col}` {id_type}", "start bigint", "length bigint", "doc_tokens bigint",
                        "sequence_id bigint", "offset bigint", *(f"{o} {types[o]}" for o in outputs)])
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(data)

    def run(batches):
        import zlib

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = held("packing", (shared.value, plain_specials), lambda: Encoder(shared.value, plain_specials))
        end = end_id.to_bytes(4, "little")
        number = TaskContext.get().partitionId() << 33
        for batch, flat, first in encoded(encoder, batches):
            of, start, length, total, bodies = [], [], [], [], []
            for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), strict=True)):
                ids = flat[a:b].tobytes() + end
                at, n = 0, b - a + 1
                for size in decompose(n, window):
                    of.append(i)
                    start.append(at)
                    length.append(size)
                    total.append(n)
                    bodies.append(ids[4 * at:4 * (at + size)])
                    at += size
            n = len(of)
            want = {}
            if "ids" in outputs:
                ends = np.cumsum([0, *length]).astype(np.int32)
                want["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(
                    np.frombuffer(b"".join(bodies), "<i4")))
            if "ids_crc32" in outputs:
                want["ids_crc32"] = pa.array([zlib.crc32(b) for b in bodies], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of, pa.int64())), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(total, pa.int64()),
                 pa.array(np.arange(number, number + n, dtype=np.int64)), pa.array(np.zeros(n, np.int64)),
                 *(want[o] for o in outputs)],
                [id_col, "start", "length", "doc_tokens", "sequence_id", "offset", *outputs])
            number += n

    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string").alias("__text")).mapInArrow(
        run, schema)


def buckets(pieces: DataFrame) -> DataFrame:
    """What the buckets of equal length hold: length, sequences, tokens."""
    return pieces.groupBy("length").agg(F.count(F.lit(1)).alias("sequences"), F.sum("length").alias("tokens"))


def write_buckets(pieces: DataFrame, path: str) -> None:
    """The sequences as Parquet, one folder per length, so that a loader
    takes each batch from one bucket."""
    pieces.write.partitionBy("length").parquet(path)
