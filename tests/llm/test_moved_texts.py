"""Few keys are joined to texts without moving the texts; links that are
stars already need no round."""

import pytest

from marquee.llm import common, components, decontam, neardup
from tests.llm.helpers import documents

LONG = " ".join(f"w{i}" for i in range(40))
ROWS = [(1, LONG), (2, LONG + " more"), (3, "other words of a text that stays " * 3), (4, None), (None, LONG)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def unhinted(spark):
    """Only what is hinted is broadcast."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield spark
    spark.conf.set(name, before)


def test_few_keys_leave_texts_in_place(unhinted, monkeypatch):
    docs = documents(unhinted, ROWS)
    items = unhinted.createDataFrame([(1, " ".join(f"w{i}" for i in range(20, 32)))], "item_id long, text string")
    for stage in (neardup.keep_one, lambda d: decontam.remove_documents(d, items)):
        few = stage(docs)
        assert "SortMergeJoin" not in _plan(few)
        want = sorted(map(str, few.collect()))
        with monkeypatch.context() as m:
            m.setattr(common, "MAX_BROADCAST_KEYS", -1)
            many = stage(docs)
            assert "SortMergeJoin" in _plan(many)
            assert sorted(map(str, many.collect())) == want


def test_stars_need_no_round(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(components, "materialize", lambda df, tag: stored.append(tag) or common.materialize(df, tag))
    links = spark.createDataFrame([(i, 0) for i in range(1, 20)] + [(31, 30)], "u long, v long")
    got = dict(map(tuple, components.connected(links).collect()))
    assert got == dict.fromkeys(range(20), 0) | {30: 30, 31: 30}
    assert len(stored) == 2  # the links as given, and in one partition
