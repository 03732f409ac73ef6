import random
import statistics

import pytest
from pyspark.sql import functions as F

from marquee.operators import groups
from tests.helpers import USUAL, kpi_frame, title


def test_membership_labels_and_means(spark):
    df = kpi_frame(spark, [title(1, "In", budget_musd=20.0, revenue_musd=100.0, belongs_to_collection="C"),
                           title(2, "Out", revenue_musd=200.0)])
    rows = {r["is_franchise"]: r for r in groups.franchise_vs_standalone(df).collect()}
    assert rows["Franchise"]["mean_revenue"] == pytest.approx(100.0)
    assert rows["Standalone"]["mean_revenue"] == pytest.approx(200.0)
    assert rows["Franchise"]["median_roi"] == pytest.approx(5.0)


def test_collection_min_movies(spark):
    df = kpi_frame(spark, [title(1, "A", belongs_to_collection="One"),
                           title(2, "B", belongs_to_collection="Two"),
                           title(3, "C", belongs_to_collection="Two")])
    rows = groups.franchise_summary(df, min_movies=2).collect()
    assert [(r["belongs_to_collection"], r["num_movies"]) for r in rows] == [("Two", 2)]
    assert rows[0]["total_budget"] == pytest.approx(2 * USUAL["budget_musd"])


def test_codirectors_count_in_full(spark):
    df = kpi_frame(spark, [title(1, "A", revenue_musd=100.0, director="Director X|Director Y"),
                           title(2, "B", revenue_musd=50.0, director="Director X")])
    rows = {r["director"]: r for r in groups.director_summary(df).collect()}
    assert (rows["Director X"]["num_movies"], rows["Director X"]["total_revenue"]) == (2, pytest.approx(150.0))
    assert (rows["Director Y"]["num_movies"], rows["Director Y"]["total_revenue"]) == (1, pytest.approx(100.0))


def test_genre_roi_counts_each_genre(spark):
    df = kpi_frame(spark, [title(1, "A", genres="Action|Drama", budget_musd=100.0, revenue_musd=200.0)])
    rows = {r["genres"]: r["median_roi"] for r in groups.roi_by_genre(df).collect()}
    assert rows == {"Action": pytest.approx(2.0), "Drama": pytest.approx(2.0)}


def test_by_year_option(spark):
    import datetime as dt

    df = kpi_frame(spark, [title(1, "A", director="X", release_date=dt.date(2019, 1, 1)),
                           title(2, "B", director="X", release_date=dt.date(2020, 1, 1))])
    rows = groups.director_summary(df, by_year=True).collect()
    assert sorted((r["director"], r["year"], r["num_movies"]) for r in rows) == [("X", 2019, 1), ("X", 2020, 1)]


def test_value_counts(spark):
    df = kpi_frame(spark, [title(1, "A", genres="Action|Drama"), title(2, "B", genres="Drama"),
                           title(3, "C", genres=None)])
    rows = [(r["genres"], r["n"]) for r in groups.value_counts(df, "genres", multi=True).collect()]
    assert rows == [("Drama", 2), (None, 1), ("Action", 1)]


def test_impute_from_similar(spark):
    df = kpi_frame(spark, [title(1, "A", budget_musd=10.0, belongs_to_collection="C"),
                           title(2, "B", budget_musd=30.0, belongs_to_collection="C"),
                           title(3, "C", budget_musd=None, belongs_to_collection="C"),
                           title(4, "D", budget_musd=None)])
    rows = {r["id"]: r for r in groups.impute_from_similar(df, "budget_musd").collect()}
    assert rows[3]["budget_musd"] == pytest.approx(20.0) and rows[3]["budget_musd_imputed"]
    assert rows[4]["budget_musd"] is None and not rows[4]["budget_musd_imputed"]
    assert not rows[1]["budget_musd_imputed"]


@pytest.mark.parametrize("seed", [1, 2])
def test_group_median_matches_exact_on_skewed_groups(spark, seed):
    rnd = random.Random(seed)
    data = []
    # one hot group with most rows, many small groups, a null key, ties and nulls
    for i in range(3000):
        data.append(("hot", float(rnd.randint(0, 500))))
    for g in range(40):
        for _ in range(rnd.randint(1, 6)):
            data.append((f"g{g}", rnd.uniform(-5, 5)))
    data += [(None, 1.0), (None, 3.0), ("hot", None), ("nulls", None)]
    df = spark.createDataFrame(data, "k string, v double").repartition(7)
    got = {r["k"]: r["m"] for r in groups.group_median(df, ["k"], "v", "m").collect()}
    want = {}
    for k in {k for k, _ in data}:
        vals = [v for kk, v in data if kk == k and v is not None]
        if vals:
            want[k] = statistics.median(vals)
    assert set(got) == set(want)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, rel=1e-12, abs=1e-12), k
    spark_exact = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.median("v").alias("m")).collect()
                   if r["m"] is not None}
    for k, v in spark_exact.items():
        assert got[k] == pytest.approx(v, rel=1e-12, abs=1e-12)


def test_group_median_multi_key_and_approx(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 2.0), ("a", 2, 5.0), ("b", 1, 7.0)],
                               "k string, y int, v double")
    got = {(r["k"], r["y"]): r["m"] for r in groups.group_median(df, ["k", "y"], "v", "m").collect()}
    assert got == {("a", 1): 1.5, ("a", 2): 5.0, ("b", 1): 7.0}
    approx = {(r["k"], r["y"]): r["m"] for r in
              groups.group_median(df, ["k", "y"], "v", "m", approx=True).collect()}
    assert approx[("a", 2)] == 5.0


def test_median_of_a_hot_run_of_identical_values(spark):
    rows = [("hot", 5.0)] * 2000 + [("hot", float(i)) for i in range(10)] + [("few", 1.0), ("few", 4.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: r["m"] for r in groups.group_median(df, ["k"], "v", "m").collect()}
    assert got == {"hot": 5.0, "few": 2.5}


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("adaptive", ["true", "false"])
@pytest.mark.parametrize("parts", ["1", "7", "200"])
def test_median_does_not_depend_on_the_plan(spark, reuse, adaptive, parts):
    values = [((i * 7919) % 1009 - 500) / 7 for i in range(3000)] + [float("inf"), float("-inf"), 0.0, -0.0, 5e-324,
                                                                    1e300, -1e300, float("nan"), None]
    rows = [("hot" if i % 3 else None if i % 2 else f"g{i % 11}", v) for i, v in enumerate(values)]
    keep = {k: spark.conf.get(k) for k in ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled",
                                           "spark.sql.shuffle.partitions")}
    try:
        for k, v in zip(keep, (reuse, adaptive, parts), strict=True):
            spark.conf.set(k, v)
        got = {r["k"]: r["m"] for r in groups.group_median(
            spark.createDataFrame(rows, "k string, v double"), ["k"], "v", "m").collect()}
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    want = {}
    for k, v in rows:
        if v is not None and v == v:
            want.setdefault(k, []).append(v)
    assert got == {k: pytest.approx(statistics.median(v)) for k, v in want.items()}


def test_sums_and_means_of_unusual_values(spark):
    from marquee.functions.aggregates import exact_mean, exact_sum

    inf = float("inf")
    rows = [("inf", inf), ("inf", 10.0), ("large", 1e30), ("large", 1.0), ("small", 1e-9), ("small", 3e-9),
            ("nan", float("nan")), ("nan", 4.0), ("none", None), ("money", 0.1), ("money", 0.2)]
    for parts in (1, 200):
        df = spark.createDataFrame(rows, "k string, v double").repartition(parts).groupBy("k").agg(
            exact_sum("v").alias("s"), exact_mean("v").alias("m"))
        got = {r["k"]: (r["s"], r["m"]) for r in df.collect()}
        assert got == {"inf": (inf, inf), "large": (1e30, 5e29), "small": (4e-9, 2e-9), "nan": (4.0, 4.0),
                       "none": (None, None), "money": (0.3, 0.15)}


def test_median_is_deterministic_across_partitionings(spark):
    rows = [("a", float(i % 97)) for i in range(5000)]
    a = groups.group_median(spark.createDataFrame(rows, "k string, v double").repartition(3), ["k"], "v", "m")
    b = groups.group_median(spark.createDataFrame(rows, "k string, v double").repartition(11), ["k"], "v", "m")
    assert a.collect() == b.collect()
