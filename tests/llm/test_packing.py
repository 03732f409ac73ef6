"""Packing by power-of-two decomposition."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marquee.llm import packing
from marquee.llm.queries import queries
from marquee.llm.shingles import text_bytes
from tests.conftest import SF_SMALL
from tests.llm.helpers import ODD, documents

tokenizers = pytest.importorskip("public_tokenizers")
PATH = tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def encoder():
    with open(PATH, "rb") as file:
        return packing.Encoder(file.read())


def plain(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids


def batch(encoder, texts):
    flat, first = encoder.encode(*text_bytes(pa.array(texts, pa.string())))
    return [flat[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]


ROWS = [*ODD, (50, "word and " * 4500)]
HARD = ["", None, "\n\n  ", "I'll don't 'tis 123 ... é\n", "á ́b  ΣΑΣ\x1cx\x85y z　w", "ÀÉÎ×÷ß ÿ ABC-12.5%,(x)", "é a.́",
        "İstanbul ẞ ς", "ﬁ ½​﻿日本 語 \U0001f600", "<|endoftext|> <|startoftext|>", "a" * 5000, "?!?!... --", "\x00\x1f \x7f",
        "ab cd ef", "x" * 70 + "Ж " + "y" * 70]


def test_ids_equal_the_tokenizer_on_hard_texts(encoder):
    assert batch(encoder, HARD) == [plain(encoder, t) for t in HARD]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_ids_equal_the_tokenizer(encoder, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert batch(encoder, texts) == [plain(encoder, t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abAB é'.,12\nÀ", max_size=200))
def test_ids_equal_the_tokenizer_on_latin_texts(encoder, text):
    assert batch(encoder, [text]) == [plain(encoder, text)]


def test_the_memo_is_bounded(encoder, monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 50)
    for i in range(20):
        texts = [f"word{chr(97 + i)}{chr(97 + j)} some" for j in range(20)]
        assert batch(encoder, texts) == [plain(encoder, t) for t in texts]
    assert len(encoder.hash) <= 100


@given(st.integers(1, 10**6))
def test_decomposition_is_binary(n):
    sizes = packing.decompose(n)
    assert sum(sizes) == n and all(s & (s - 1) == 0 and s <= 4096 for s in sizes)
    assert sizes == sorted(sizes, reverse=True)
    assert all(sizes.count(s) == 1 for s in sizes if s < 4096)


def check(rows, texts, encoder, outputs):
    """Pieces tile every document and sequences hold one piece each."""
    want = sorted(zlib.crc32(np.array([*plain(encoder, t), 2], "<u4").tobytes()) for t in texts)
    assert len({r.sequence_id for r in rows}) == len(rows)
    assert all(r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 4096 for r in rows)
    documents, at = [], 0
    rows = sorted(rows, key=lambda r: r.sequence_id)
    while at < len(rows):
        ids, doc = [], rows[at]
        assert doc.start == 0
        while at < len(rows) and len(ids) < doc.doc_tokens:
            r = rows[at]
            assert r.doc_id == doc.doc_id and r.start == len(ids) and r.doc_tokens == doc.doc_tokens
            if "ids_crc32" in outputs:
                assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
            ids += r.ids
            at += 1
        assert len(ids) == doc.doc_tokens
        documents.append(zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert sorted(documents) == want


def test_pieces_of_odd_rows(spark, encoder):
    docs = documents(spark, ROWS).repartition(3)
    rows = packing.pack(docs, PATH, outputs=("ids", "ids_crc32")).collect()
    check(rows, [t for _, t in ROWS], encoder, ("ids", "ids_crc32"))
    report = {r["length"]: r.sequences for r in packing.buckets(packing.pack(docs, PATH)).collect()}
    assert sum(report.values()) == len(rows) and report[4096] == sum(r.length == 4096 for r in rows) >= 1


def test_small_windows_and_bad_ones(spark, encoder):
    rows = packing.pack(documents(spark, ROWS), PATH, window=8).collect()
    assert max(r.length for r in rows) == 8
    with pytest.raises(ValueError):
        packing.pack(documents(spark, ROWS), PATH, window=12)


def test_empty_table(spark):
    out = packing.pack(documents(spark, []), PATH, outputs=("ids_crc32",))
    assert out.columns == ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids_crc32"]
    assert out.count() == 0


def test_buckets_are_written_by_length(spark, tmp_path):
    pieces = packing.pack(documents(spark, ROWS), PATH)
    packing.write_buckets(pieces, f"{tmp_path}/buckets")
    back = spark.read.parquet(f"{tmp_path}/buckets")
    assert back.count() == pieces.count()
    assert back.where("size(ids) != length").count() == 0


def test_query_covers_all_documents(spark, encoder):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    rows = queries()["op13_packing"](spark, SF_SMALL).collect()
    want = {d.doc_id: [*plain(encoder, d.text), 2] for d in docs}
    assert sum(r.length for r in rows) == sum(map(len, want.values()))
    for r in rows:
        part = np.array(want[r.doc_id][r.start:r.start + r.length], "<u4")
        assert r.ids_crc32 == zlib.crc32(part.tobytes()) and r.doc_tokens == len(want[r.doc_id])


def test_memory_of_a_large_batch(encoder):
    import tracemalloc

    rows = pa.RecordBatch.from_arrays(
        [pa.array(range(60)), pa.array([f"row {i} of some words, and more: " * 3000 for i in range(60)])], ["id", "text"])
    tracemalloc.start()
    n = sum(len(first) - 1 for _, _, first in packing.encoded(encoder, [rows]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 60 and peak < 150e6


def test_a_worker_holds_one_model():
    from marquee.llm.common import held

    one = held("a", 1, list)
    assert held("a", 1, list) is one
    two = held("b", 1, list)
    assert two is not one and held("a", 1, list) is not one
    assert held(None) is None and held("b", 1, list) is not two
