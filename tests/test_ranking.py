import pytest

from marquee.operators import metrics, ranking
from tests.helpers import kpi_frame, title


def test_metrics_profit_and_roi(spark):
    row = metrics.add_metrics(kpi_frame(spark, [title(1, "A", budget_musd=100.0, revenue_musd=250.0)])).first()
    assert row["profit_musd"] == pytest.approx(150.0)
    assert row["roi"] == pytest.approx(2.5)


def test_metrics_null_or_zero_budget_gives_null_roi(spark):
    rows = metrics.add_metrics(kpi_frame(spark, [title(1, "A", budget_musd=None),
                                                 title(2, "B", budget_musd=0.0)])).collect()
    assert [r["roi"] for r in rows] == [None, None]


def test_top_and_bottom(spark):
    df = kpi_frame(spark, [title(i, f"T{i}", revenue_musd=float(i)) for i in range(1, 8)])
    assert [r["revenue_musd"] for r in ranking.highest_revenue(df, n=3).collect()] == [7.0, 6.0, 5.0]
    low = ranking.rank_titles(df, "revenue_musd", ascending=True, n=2).collect()
    assert [r["revenue_musd"] for r in low] == [1.0, 2.0]


def test_min_budget_and_min_votes(spark):
    df = kpi_frame(spark, [title(1, "Cheap", budget_musd=1.0, revenue_musd=100.0),
                           title(2, "Big", budget_musd=50.0, revenue_musd=200.0)])
    assert [r["title"] for r in ranking.highest_roi(df).collect()] == ["Big"]
    df = kpi_frame(spark, [title(1, "Few", vote_count=2, vote_average=9.9),
                           title(2, "Many", vote_count=500, vote_average=8.0)])
    assert [r["title"] for r in ranking.highest_rated(df).collect()] == ["Many"]


def test_short_input_and_nonpositive_n(spark):
    df = kpi_frame(spark, [title(1, "Only")])
    assert ranking.highest_revenue(df, n=5).count() == 1
    assert ranking.highest_revenue(df, n=0).count() == 0
    assert ranking.highest_revenue(df, n=-3).count() == 0


def test_ties_broken_by_id(spark):
    df = kpi_frame(spark, [title(i, f"T{i}", revenue_musd=100.0) for i in (5, 3, 4, 1, 2)])
    assert [r["title"] for r in ranking.highest_revenue(df).collect()] == [f"T{i}" for i in range(1, 6)]


def test_nulls_left_out_and_columns(spark):
    df = kpi_frame(spark, [title(1, "A", revenue_musd=None), title(2, "B")])
    out = ranking.highest_profit(df)
    assert out.columns == ["title", "profit_musd", "revenue_musd", "budget_musd"]
    assert [r["title"] for r in out.collect()] == ["B"]


def test_rank_by_title_has_no_repeated_column(spark):
    df = kpi_frame(spark, [title(1, "B"), title(2, "A")])
    assert ranking.rank_titles(df, "title", ascending=True).columns == ["title"]


def test_top_per_group(spark):
    rows = [title(i, f"T{i}", revenue_musd=float(i), belongs_to_collection="C" if i % 2 else "D")
            for i in range(1, 11)]
    out = ranking.top_per_group(kpi_frame(spark, rows), "belongs_to_collection", "revenue_musd", n=2)
    got = sorted((r["belongs_to_collection"], r["title"], r["rank"]) for r in out.collect())
    assert got == [("C", "T7", 2), ("C", "T9", 1), ("D", "T10", 1), ("D", "T8", 2)]


def test_all_ten_rankings_run(spark):
    df = kpi_frame(spark, [title(i, f"T{i}", revenue_musd=float(i * 10), budget_musd=float(i + 10),
                                 vote_count=10 + i, vote_average=float(i % 10), popularity=float(i))
                           for i in range(1, 12)])
    for name, fn in ranking.ALL_RANKINGS.items():
        assert fn(df).count() == 5, name


def test_top_level_api_exports():
    import marquee as mq

    assert all(hasattr(mq, name) for name in mq.__all__)
