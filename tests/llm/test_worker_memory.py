"""What Python workers keep is small: they stay beside a full heap."""

import pyarrow as pa
import public_tokenizers
import pytest

import corpus_pipeline
from marquee.llm import bpe, neardup, pii, shingles
from tests.llm.helpers import ODD, documents

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_no_rows_from_python(spark, monkeypatch):
    """Rows made by the driver's Python cost every executor a second daemon."""
    rows = [(i, " ".join(f"w{j}" for j in range(i % 4, 40))) for i in range(12)]
    docs = documents(spark, rows + ODD)
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **b: pytest.fail("rows from Python"))
    got = {(r.doc_id, r.component_id) for r in neardup.deduplicate(docs).collect() if r.doc_id in range(4, 12)}
    assert {c for d, c in got if d in (9, 10, 11)} == {0}


def test_memo_is_bounded_and_changes_nothing():
    with open(VOCABULARY, "rb") as file:
        ranks = bpe.load_ranks(file.read())
    text = " ".join(f"word{i % 70}, x{i}" for i in range(400))
    large = bpe.Encoder(bpe.Tree(ranks), public_tokenizers.PATTERN)
    small = bpe.Encoder(bpe.Tree(ranks), public_tokenizers.PATTERN, 50)
    assert small.encode(text) == large.encode(text)
    assert len(large) > 400 and len(small) <= 50 and len(small.old) <= 50


def test_pipeline_asks_for_a_small_memo(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(bpe, "tokenize", lambda *a, **b: asked.append(b["memo"]))
    corpus_pipeline.byte_bpe(spark, None, None)
    assert asked[0] < bpe.MEMO


def test_small_parts_are_whole_and_given_back():
    texts = ["a" * 300_000, None, "", "b" * 900_000, *["c" * 200_000] * 5]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string())], ["i", "text"])
    parts = list(shingles.small_parts(iter([batch, batch]), 1))
    assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist() * 2
    assert all(p.num_rows == 1 or p.column(1).nbytes <= shingles.SLICE + 8 * p.num_rows + 8 for p in parts)


def test_masks_by_small_parts(spark):
    seen = []
    docs = documents(spark, ODD)

    class Docs:
        columns, schema, sparkSession = docs.columns, docs.schema, spark

        def mapInArrow(self, run, schema):
            texts = ["m" * 300_000 + " a.b@c.example ", "x" * 400_000, "n@d.example"]
            whole = pa.RecordBatch.from_arrays([pa.array(texts if c == "text" else [None] * 3) for c in self.columns],
                                               self.columns)
            seen.extend(run(iter([whole])))

    pii.mask(Docs(), None)
    assert len(seen) > 1
    assert [t for b in seen for t in b.column(docs.columns.index("text")).to_pylist()] == [
        "m" * 300_000 + " <EMAIL> ", "x" * 400_000, "<EMAIL>"]
