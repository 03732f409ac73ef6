"""Reports from partial aggregates equal a recompute after any change."""

import datetime as dt
import random
import re

import pytest

from marquee.operators import groups
from marquee.plans import kpi_state
from tests.helpers import kpi_frame, title


def _rows(seed, ids):
    rnd = random.Random(seed)

    def some(*values):
        return rnd.choice(values)

    return [title(i, f"T{i}", budget_musd=some(None, 0.0, 10.0, 20.5), revenue_musd=some(None, 30.0, 64.123457, 1e-9, 2e18),
                  vote_average=some(None, 5.5, 7.0), popularity=some(None, 1.0, float("nan")),
                  genres=some(None, "A", "A|B", "B|C|A"), director=some(None, "X", "X|Y"),
                  belongs_to_collection=some(None, "C1", "C2"),
                  release_date=some(None, dt.date(2001, 2, 3), dt.date(2002, 2, 3))) for i in ids]


def _direct(df):
    return {"membership": groups.franchise_vs_standalone(df), "collection": groups.franchise_summary(df),
            "director": groups.director_summary(df), "genre": groups.roi_by_genre(df),
            "year": groups.yearly_box_office(df)}


def _same(spark, base, df):
    got = kpi_state.kpi_reports(spark, base)
    for name, report in _direct(df).items():
        want, have = report.collect(), got[name].collect()
        assert got[name].columns == report.columns, name
        assert len(want) == len(have), name
        for a, b in zip(sorted(map(tuple, want), key=str), sorted(map(tuple, have), key=str), strict=True):
            assert a == pytest.approx(b, nan_ok=True), name


def test_refresh_equals_recompute_for_adds_changes_and_removals(spark, tmp_dir):
    base = f"{tmp_dir}/kpis"
    now = {r["id"]: r for r in _rows(1, range(1, 31))}
    kpi_state.build_kpis(spark, kpi_frame(spark, list(now.values())), base)
    _same(spark, base, kpi_frame(spark, list(now.values())))
    changes = [({r["id"]: r for r in _rows(2, [3, 7, 40, 41])}, [9, 10]),  # changes and adds; removals
               ({r["id"]: r for r in _rows(3, [9, 40, 50])}, [41, 3]), ({}, []), ({}, list(range(1, 31)))]
    for version, (put, gone) in enumerate(changes, 2):
        for i in gone:
            now.pop(i, None)
        now |= put
        ids = spark.createDataFrame([(str(i),) for i in [*put, *gone, 999]] + [("x",), (None,)], "id string")
        assert kpi_state.refresh_kpis(spark, base, ids, kpi_frame(spark, list(now.values()))) == version
        _same(spark, base, kpi_frame(spark, list(now.values())))


def test_refresh_reads_only_the_buckets_of_touched_ids(spark, tmp_dir):
    base = f"{tmp_dir}/kpis"
    kpi_state.build_kpis(spark, kpi_frame(spark, _rows(1, range(1, 200))), base)
    df = kpi_state.touched_facts(spark, base, spark.createDataFrame([(5,), (6,)], "id long"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "bucket" in filters and len(re.findall(r"\b\d+\b", filters.split("bucket", 1)[1].split(" IN (")[-1])) <= 4
    assert sorted(r.id for r in df.collect()) == [5, 6]


def test_a_half_written_version_is_ignored_and_done_again(spark, tmp_dir):
    base = f"{tmp_dir}/kpis"
    rows = _rows(1, range(1, 20))
    kpi_state.build_kpis(spark, kpi_frame(spark, rows), base)
    # a refresh that stopped before its marker
    kpi_frame(spark, _rows(5, [4])).selectExpr("'x' AS report").write.parquet(f"{base}/sums/version=2")
    changed = _rows(6, [4])
    kpi_state.refresh_kpis(spark, base, spark.createDataFrame([(4,)], "id long"), kpi_frame(spark, changed))
    _same(spark, base, kpi_frame(spark, [r for r in rows if r["id"] != 4] + changed))


def test_refresh_needs_a_store(spark, tmp_dir):
    with pytest.raises(ValueError):
        kpi_state.refresh_kpis(spark, f"{tmp_dir}/none", spark.createDataFrame([(1,)], "id long"), kpi_frame(spark, []))
