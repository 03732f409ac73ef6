"""Over-time reports, lattice imputation and value variants on small frames."""

import datetime as dt

from marquee.operators import lattice, trends, variants
from tests.helpers import kpi_frame, title


def _dated(id, year, **facts):
    return title(id, f"T{id}", release_date=None if year is None else dt.date(year, 6, 1), **facts)


def test_years_without_titles_are_filled_and_totals_run(spark):
    df = kpi_frame(spark, [_dated(1, 2001, director="X|Y", revenue_musd=10.0), _dated(2, 2004, director="X", revenue_musd=4.5),
                           _dated(3, 2004, director="X", revenue_musd=None), _dated(4, None, director="X"),
                           _dated(5, 2002, director=None)])
    rows = sorted(tuple(r) for r in trends.over_time(df, "director", multi=True).collect())
    assert rows == [("X", 2001, 1, 10.0, 1, 10.0, None), ("X", 2002, 0, 0.0, 1, 10.0, -10.0),
                    ("X", 2003, 0, 0.0, 1, 10.0, 0.0), ("X", 2004, 2, 4.5, 3, 14.5, 4.5),
                    ("Y", 2001, 1, 10.0, 1, 10.0, None)]
    assert trends.over_time(df.where("id = 4"), "director", multi=True).collect() == []


def test_the_finest_level_with_enough_support_fills(spark):
    known = [_dated(i, 2001, budget_musd=float(i), genres="A|B", director="X", belongs_to_collection="C") for i in (1, 2, 4)]
    known += [_dated(i, 2002, budget_musd=50.0, genres="B", director="Z") for i in (5, 6, 7)]
    gaps = [_dated(20, 2002, budget_musd=None, belongs_to_collection="C"),                       # collection
            _dated(21, 2002, budget_musd=None, genres="B", director="X|Q", belongs_to_collection="D"),  # director, genre
            _dated(22, 2002, budget_musd=None, genres="B", director="Q"),                        # genre: 6 known
            _dated(23, 2002, budget_musd=None, genres="Q", director=None),                       # year
            _dated(24, None, budget_musd=None, genres=None, director=None), _dated(25, 1999, budget_musd=None, genres="Q")]
    rows = {r.id: (r.budget_musd, r.budget_musd_level)
            for r in lattice.impute_from_lattice(kpi_frame(spark, known + gaps), "budget_musd").collect()}
    assert rows[20] == (2.0, "collection") and rows[21] == (2.0, "director and genre")
    assert rows[22] == (27.0, "genre") and rows[23] == (50.0, "year")
    assert rows[24] == rows[25] == (None, None) and rows[1] == (1.0, None)
    none = lattice.impute_from_lattice(kpi_frame(spark, known + gaps), "budget_musd", min_support=99)
    assert none.where("budget_musd IS NULL").count() == len(gaps) and none.columns[:3] == ["id", "title", "budget_musd"]


def test_spellings_meet_their_most_frequent_one(spark):
    values = ["Warner Bros."] * 5 + ["warner  bros"] * 2 + ["Bros. Warner", "WarnerBros", "Universal", "Universsal", None, "",
                                                         "--", "A24", "A 24", "A42"]
    df = spark.createDataFrame([(v,) for v in values], "company string")
    rows = {r.value: (r.n, r.canonical) for r in variants.value_variants(df, "company").collect()}
    assert rows == {"Warner Bros.": (5, "Warner Bros."), "warner  bros": (2, "Warner Bros."),
                    "Bros. Warner": (1, "Warner Bros."), "WarnerBros": (1, "Warner Bros."), "A 24": (1, "A 24"),
                    "A24": (1, "A 24")}
    plan = variants.value_variants(df, "company")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert variants.value_variants(df.where("company IS NULL"), "company").collect() == []
