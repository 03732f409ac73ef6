"""Byte-level BPE encoding and decoding by tree reduction.

A text is cut by the tokenizer's pattern; each match is encoded on its own.
A match is encoded as a monoid: up to ``LEAF`` bytes are merged directly,
lowest rank first; a longer one is halved, both halves are encoded, and the
results are joined. The join re-encodes a window of k tokens on each side
of the seam and doubles k until the tokens next to the window are stable.

Why the result is exact: a sequence of tokens is the encoding of its bytes
if and only if every two neighbours are the encoding of their own bytes,
since the first merge across a seam would also happen in the two neighbours
alone. So it is enough to look at the pair on either edge of the window;
all other pairs come from an encoding and hold already.

Decoding concatenates the bytes of the tokens up a tree of halves.

Rows are independent: no shuffle, no state between rows but a bounded memo
of the pieces seen by a worker. The vocabulary (a file of some 50,000
ranks, ``MAX_VOCABULARY_BYTES`` at most) is read on the driver, by the path
given, and broadcast.

Defined results: null texts are empty (no ids, empty decoded text); texts
of any length are encoded whole; repeated rows and ids stay; an empty table
gives an empty table; other columns are not returned.
"""

from __future__ import annotations

import base64
import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import held, ship

LEAF = 24
MEMO = 300_000
MEMO_CHARS = 64
MAX_VOCABULARY_BYTES = 64 << 20
# Unicode White_Space, which \s stands for
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def load_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a vocabulary file: lines of base64 token and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


class Tree:
    """Encodes and decodes byte strings by the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int], leaf: int = LEAF):
        self.ranks = ranks
        self.token = {i: t for t, i in ranks.items()}
        self.leaf = leaf
        self._stable: dict[tuple[int, int], bool] = {}

    def merge(self, data: bytes) -> list[int]:
        """Direct encoding: merge the neighbours of lowest rank, the leftmost
        of equals, until no merge is left."""
        ranks = self.ranks
        parts = [data[i:i + 1] for i in range(len(data))]
        none = len(ranks)
        pairs = [ranks.get(parts[i] + parts[i + 1], none) for i in range(len(parts) - 1)]
        while pairs:
            low = min(pairs)
            if low == none:
                break
            i = pairs.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], none)
        return [ranks[p] for p in parts]

    def stable(self, left: int, right: int) -> bool:
        """Whether two neighbours are the encoding of their own bytes."""
        known = self._stable.get((left, right))
        if known is None:
            if len(self._stable) > MEMO:
                self._stable.clear()
            known = self._stable[left, right] = self.merge(self.token[left] + self.token[right]) == [left, right]
        return known

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Encoding of the concatenation of two encoded strings."""
        if not left or not right or self.stable(left[-1], right[0]):
            return left + right
        k = 1
        while True:
            window = self.merge(b"".join(map(self.token.__getitem__, left[-k:] + right[:k])))
            if ((k >= len(left) or self.stable(left[-k - 1], window[0]))
                    and (k >= len(right) or self.stable(window[-1], right[k]))):
                return left[:-k] + window + right[k:]
            k *= 2

    def reduce(self, data: bytes) -> list[int]:
        if len(data) <= self.leaf:
            return self.merge(data)
        half = len(data) // 2
        return self.join(self.reduce(data[:half]), self.reduce(data[half:]))

    def encode(self, data: bytes) -> list[int]:
        """Encoding of one match; one that is a token itself is that token."""
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.reduce(data)

    def decode(self, ids: list[int]) -> bytes:
        if len(ids) <= 65536:
            return b"".join(map(self.token.__getitem__, ids))
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


class Encoder(dict):
    """Memo from a piece of text to its ids (little-endian, 32 bits each).
    Two generations of at most ``memo`` short pieces each."""

    def __init__(self, tree: Tree, pattern: str, memo: int = MEMO):
        import regex

        self.tree, self.old, self.memo = tree, {}, memo
        own = (pattern.replace(r"[^\s", f"[^{SPACE}").replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]"))
        self.matches = regex.compile(own).findall
        # what the usual pattern never matches across: a blank and the run of
        # other characters behind it. Other patterns are applied as they are.
        cut = f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
        usual = pattern.endswith(r"| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
        import re

        self.pieces = re.compile(cut).findall if usual else self.matches

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            found = self.matches(piece)
            if len(found) == 1:
                ids = b"".join(i.to_bytes(4, "little") for i in self.tree.encode(piece.encode()))
            else:
                ids = b"".join(map(self.__getitem__, found))
        if len(piece) <= MEMO_CHARS:
            if len(self) >= self.memo:
                self.old = dict(self)
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self.pieces(text)))


def tokenize(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id",
             text_col: str = "text", outputs: tuple[str, ...] = ("ids",), memo: int = MEMO) -> DataFrame:
    """Encode every text. Returns id_col, n_tokens and the ``outputs``
    wanted: ``ids`` (array<int>), ``decoded`` (the text decoded from the
    ids), ``ids_sha256`` and ``decoded_sha256`` (of the ids as little-endian
    unsigned 32-bit integers, and of the decoded bytes). ``memo`` trades a
    worker's memory (some 300 bytes a piece) for time."""
    with open(path, "rb") as file:
        data = file.read(MAX_VOCABULARY_BYTES + 1)
    if len(data) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path}: a vocabulary of over {MAX_VOCABULARY_BYTES} bytes is not broadcast")
    types = {"ids": "array<int>", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"`{id_col}` {id_type}", "n_tokens bigint", *(f"{o} {types[o]}" for o in outputs)])
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(data)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        from marquee.llm.shingles import small_parts

        encoder = held("bpe", (shared.value, pattern, memo),
                       lambda: Encoder(Tree(load_ranks(shared.value)), pattern, memo))
        for batch in small_parts(batches, 1):
            ids = [encoder.encode(t or "") for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64())]
            want = {}
            if "ids" in outputs:
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                want["ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(
                    np.frombuffer(b"".join(ids), "<i4")))
            if {"decoded", "decoded_sha256"} & set(outputs):
                texts = [encoder.tree.decode(np.frombuffer(x, "<u4").tolist()) for x in ids]
                want["decoded"] = pa.array([t.decode() for t in texts], pa.string()) if "decoded" in outputs else None
                want["decoded_sha256"] = pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())
            want["ids_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*columns, *(want[o] for o in outputs)],
                                             [id_col, "n_tokens", *outputs])

    return docs.select(id_col, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)
