"""Input columns that have the operators' internal names."""

import pytest
from pyspark.sql import functions as F

from marquee.llm import decontam, neardup, rules
from marquee.llm.common import free_name

NAMES = ["__id", "__row", "__hit", "__key", "__one", "__rules", "row", "key", "top", "label", "n"]
ITEM = "one two three four five six seven eight nine ten eleven"
CLEAN = " ".join(f"word{i}" for i in range(30))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, f"before {ITEM} after"), (2, CLEAN), (2, CLEAN), (3, CLEAN), (None, "x")]
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")
    return df.withColumns({name: F.lit(f"kept {name}") for name in NAMES})


def test_free_names(docs):
    assert free_name(docs, "__ID") == "__ID_" and free_name(docs, "other") == "other"


def test_clashing_names_change_nothing(spark, docs):
    items = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    results = {
        "documents": decontam.remove_documents(docs, items), "spans": decontam.remove_spans(docs, items),
        "copies": neardup.keep_one(docs), "rules": rules.filter_documents(docs, labels)}
    for name, out in results.items():
        assert out.columns == docs.columns, name
        assert all(r[n] == f"kept {n}" for r in out.collect() for n in NAMES), name
    count = {name: out.count() for name, out in results.items()}
    assert count == {"documents": 4, "spans": 5, "copies": 3, "rules": 3}
    assert results["spans"].where("doc_id = 1").first().text == "before   after"
