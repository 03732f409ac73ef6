"""Several rankings in one scan, and mergeable samples of point feeds."""

import datetime as dt

import pytest

from marquee.operators import feeds, ranking, topn
from marquee.plans import job
from tests.helpers import kpi_frame, title


def _catalogue(spark, n=40):
    return kpi_frame(spark, [title(i, f"T{i}", budget_musd=None if i % 9 == 0 else float(i % 7 * 4),
                                   revenue_musd=None if i % 11 == 0 else float(i * 13 % 50), vote_count=i % 23,
                                   vote_average=None if i % 23 == 0 else (i * 7 % 30) / 3, popularity=float(i % 5),
                                   release_date=None if i % 10 == 0 else dt.date(2000 + i % 4, 1, 1))
                             for i in range(1, n + 1)])


def test_rank_all_equals_the_ten_rankings(spark):
    df = _catalogue(spark)
    ranked = ranking.rank_all(df, 6).cache()
    for name, fn in ranking.ALL_RANKINGS.items():
        assert ranking.ranking_of(ranked, name).collect() == fn(df, 6).collect(), name
    assert ranking.rank_all(df, 0).count() == 0
    ranked.unpersist()


def test_rank_all_sorts_nan_as_the_largest_value(spark):
    df = kpi_frame(spark, [title(1, "A", popularity=float("nan")), title(2, "B", popularity=9.0), title(3, "C")])
    only = {"most_popular": ranking.RANKINGS["most_popular"]}
    assert [r.title for r in ranking.rank_all(df, 3, only).orderBy("rank").collect()] == [
        r.title for r in ranking.most_popular(df, 3).collect()] == ["A", "B", "C"]


def test_rank_all_is_one_scan_cut_before_the_shuffle(spark, tmp_dir):
    _catalogue(spark).write.parquet(f"{tmp_dir}/clean")
    df = ranking.rank_all(spark.read.parquet(f"{tmp_dir}/clean"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and plan.count("Exchange") == 1
    assert plan.count("WindowGroupLimit") == 2  # before and after the shuffle
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")
    assert "overview" not in plan


def test_large_n_is_spread_first(spark, monkeypatch):
    df = _catalogue(spark)
    want = ranking.rank_all(df, 12).collect()
    monkeypatch.setattr(topn, "GROUP_LIMIT", 5)
    assert sorted(ranking.rank_all(df, 12).collect()) == sorted(want)


def test_sample_takes_k_a_year_whatever_the_partitions(spark):
    df = _catalogue(spark, 60)
    want = None
    for parts in (1, 7, 200):
        got = sorted(feeds.sampled(df.repartition(parts), "budget_musd", "revenue_musd", 4).collect(), key=str)
        want = want or got
        assert got == want
    points = df.where("budget_musd IS NOT NULL AND revenue_musd IS NOT NULL")
    sizes = {r["y"]: r["n"] for r in points.selectExpr("year(release_date) AS y").groupBy("y").count()
             .withColumnRenamed("count", "n").collect()}
    by_year = {}
    for r in want:
        by_year.setdefault(r.year, []).append(r)
    assert set(by_year) == set(sizes) and None in sizes
    assert all(len(rows) == min(4, sizes[y]) and {r.stratum_rows for r in rows} == {sizes[y]}
               for y, rows in by_year.items())


def test_samples_of_parts_merge_to_the_sample_of_the_whole(spark):
    df = _catalogue(spark, 60)
    parts = [feeds.sampled(df.where(f"id % 3 = {i}"), "vote_average", "popularity", 5) for i in range(3)]
    whole = feeds.sampled(df, "vote_average", "popularity", 5)
    assert sorted(feeds.merge_samples(parts, 5).collect(), key=str) == sorted(whole.collect(), key=str)
    # and a smaller one from a larger one
    assert sorted(feeds.merge_samples([whole], 2).collect(), key=str) == sorted(
        feeds.sampled(df, "vote_average", "popularity", 2).collect(), key=str)


def test_sampled_feeds_are_cut_before_the_shuffle_and_never_sorted_whole(spark):
    plan = feeds.sampled(_catalogue(spark), "budget_musd", "revenue_musd", 4)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "rangepartitioning" not in plan


def test_job_writes_rankings_once_and_samples(spark, tmp_dir):
    from tests.helpers import raw_frame, raw_record

    recs = [raw_record(id=i, title=f"T{i}", budget=20_000_000 + i, release_date=f"20{i:02d}-01-01") for i in range(1, 9)]
    paths = job.run(spark, raw_frame(spark, recs), f"{tmp_dir}/out", points_per_year=1)
    ranked = spark.read.parquet(paths["rankings"])
    assert ranked.count() == sum(spark.read.parquet(paths[n]).count() for n in ranking.RANKINGS) > 30
    assert "stratum_rows" in spark.read.parquet(paths["feed_01-revenue-vs-budget"]).columns


def test_rankings_are_data():
    assert set(ranking.ALL_RANKINGS) == set(ranking.RANKINGS) and len(ranking.RANKINGS) == 10
    with pytest.raises(AttributeError):
        ranking.RANKINGS["most_voted"].by = "id"
