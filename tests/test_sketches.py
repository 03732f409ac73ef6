"""Stored sketches against exact answers."""

import datetime as dt

import pytest

from marquee.operators import groups, sketches
from tests.helpers import kpi_frame, title


def test_medians_from_stored_sketches(spark, tmp_dir):
    rows = [title(i, f"T{i}", budget_musd=10.0, revenue_musd=float((i * 7919) % 3001), genres="A|B" if i % 3 else "B",
                  release_date=None if i % 50 == 0 else dt.date(2000 + i % 5, 1, 1)) for i in range(1, 3001)]
    df = kpi_frame(spark, rows)
    sketches.roi_sketches(df).write.parquet(f"{tmp_dir}/s")
    stored = spark.read.parquet(f"{tmp_dir}/s")
    assert stored.count() == 12  # two genres, five years and none
    report = {r.genre: r for r in sketches.median_report(df, stored).collect()}
    exact = {r.genres: r.median_roi for r in groups.roi_by_genre(df).collect()}
    assert set(report) == {"A", "B", None} and report["B"].n == 3000 and report[None].n == 5000
    for genre, r in report.items():
        assert r.rank_error <= 3 * sketches.rank_error()
        assert genre is None or r.exact_median == pytest.approx(exact[genre])
    # a larger sketch has a smaller bound, and small groups are exact
    assert sketches.rank_error(800) < sketches.rank_error() / 3
    few = kpi_frame(spark, rows[:99])
    assert all(r.rank_error <= 0.5 / 33 for r in sketches.median_report(few, sketches.roi_sketches(few)).collect())


def test_overlaps_of_landings_from_sketches_alone(spark):
    ids = [("a", i) for i in range(20000)] + [("b", i) for i in range(15000, 40000)] + [("c", "x"), ("c", None)]
    df = spark.createDataFrame([(k, None if i is None else str(i)) for k, i in ids], "landing string, id string")
    stored = sketches.landing_sketches(df)
    assert {r.landing: r["rows"] for r in stored.collect()} == {"a": 20000, "b": 25000, "c": 2}
    rows = {(r["first"], r["second"]): r for r in sketches.landing_overlaps(stored).collect()}
    r, room = rows["a", "b"], sketches.distinct_error() * 40000
    assert abs(r.union_ids - 40000) <= room and abs(r.shared_ids - 5000) <= room and abs(r.only_ids - 15000) <= room
    assert rows["a", "c"].shared_ids == 0 and len(rows) == 3
    small = sketches.landing_overlaps(sketches.landing_sketches(df.where("try_cast(id AS INT) % 100 = 0"))).first()
    assert (small.union_ids, small.shared_ids, small.only_ids) == (400, 50, 150)  # exact while small
