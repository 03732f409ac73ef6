"""Golden check on an 18-title catalogue with known KPI values.

The rows are the golden input rebuilt in FIXTURES.md section 6; the
expected values are the published snapshot of that catalogue's KPIs.
"""

import pytest

from marquee.operators import groups, ranking, search
from tests.helpers import kpi_frame, title

# FIXED VALUES: (title, budget_musd, revenue_musd, collection, director)
GOLDEN = [
    ("Avatar", 237, 2923.706026, "single 1", "James Cameron"),
    ("Avengers: Endgame", 356, 2799.4391, "The Avengers Collection", "Anthony Russo|Joe Russo"),
    ("Titanic", 200, 2264.162353, None, "James Cameron"),
    ("Star Wars: The Force Awakens", 245, 2068.223624, "Star Wars Collection", "J.J. Abrams"),
    ("Avengers: Infinity War", 300, 2052.415039, "The Avengers Collection", "Anthony Russo|Joe Russo"),
    ("Jurassic World", 150, 1671.537444, "Jurassic Park Collection", "Colin Trevorrow"),
    ("The Lion King", 260, 1662.020819, "single 2", "Jon Favreau"),
    ("Untitled", 190, 1515.4, "single 3", "James Wan"),
    ("The Avengers", 220, 1518.815574, "The Avengers Collection", "Joss Whedon"),
    ("Avengers: Age of Ultron", 235, 1405.403635, "The Avengers Collection", "Joss Whedon"),
    ("Frozen II", 150, 1453.683476, "Frozen Collection", "Jennifer Lee|Chris Buck"),
    ("Black Panther", 200, 1349.926083, "single 4", "Ryan Coogler"),
    ("Harry Potter and the Deathly Hallows: Part 2", 125, 1341.511219, "single 5", "David Yates"),
    ("Star Wars: The Last Jedi", 300, 1334.407706, "Star Wars Collection", "Rian Johnson"),
    ("Jurassic World: Fallen Kingdom", 170, 1310.469037, "Jurassic Park Collection", "J. A. Bayona"),
    ("Frozen", 150, 1274.219009, "Frozen Collection", "Chris Buck|Jennifer Lee"),
    ("Beauty and the Beast", 160, 1266.115964, None, "Bill Condon"),
    ("Incredibles 2", 200, 1243.225667, "single 6", "Brad Bird"),
]


@pytest.fixture(scope="module")
def golden(spark):
    rows = [title(i + 1, t, budget_musd=float(b), revenue_musd=r, belongs_to_collection=c, director=d)
            for i, (t, b, r, c, d) in enumerate(GOLDEN)]
    return kpi_frame(spark, rows)


def _check(rows, expected, key):
    assert [r["title"] for r in rows] == [e[0] for e in expected]
    for r, (_, v) in zip(rows, expected):
        assert r[key] == pytest.approx(v, rel=1e-4)


def test_highest_revenue(golden):
    _check(ranking.highest_revenue(golden).collect(), [
        ("Avatar", 2923.706026), ("Avengers: Endgame", 2799.4391), ("Titanic", 2264.162353),
        ("Star Wars: The Force Awakens", 2068.223624), ("Avengers: Infinity War", 2052.415039)],
        "revenue_musd")


def test_highest_budget_as_set(golden):
    got = {r["title"]: r["budget_musd"] for r in ranking.highest_budget(golden).collect()}
    assert got == {"Avengers: Endgame": 356.0, "Avengers: Infinity War": 300.0,
                   "Star Wars: The Last Jedi": 300.0, "The Lion King": 260.0,
                   "Star Wars: The Force Awakens": 245.0}


def test_profit_rankings(golden):
    _check(ranking.highest_profit(golden).collect(), [
        ("Avatar", 2686.706026), ("Avengers: Endgame", 2443.4391), ("Titanic", 2064.162353),
        ("Star Wars: The Force Awakens", 1823.223624), ("Avengers: Infinity War", 1752.415039)],
        "profit_musd")
    _check(ranking.lowest_profit(golden).collect(), [
        ("Star Wars: The Last Jedi", 1034.407706), ("Incredibles 2", 1043.225667),
        ("Beauty and the Beast", 1106.115964), ("Frozen", 1124.219009),
        ("Jurassic World: Fallen Kingdom", 1140.469037)], "profit_musd")


def test_roi_rankings(golden):
    _check(ranking.highest_roi(golden).collect(), [
        ("Avatar", 12.336312), ("Titanic", 11.320812), ("Jurassic World", 11.143583),
        ("Harry Potter and the Deathly Hallows: Part 2", 10.73209), ("Frozen II", 9.691223)], "roi")
    _check(ranking.lowest_roi(golden).collect(), [
        ("Star Wars: The Last Jedi", 4.448026), ("Avengers: Age of Ultron", 5.980441),
        ("Incredibles 2", 6.216128), ("The Lion King", 6.392388), ("Black Panther", 6.74963)], "roi")


def test_franchise_summary(golden):
    rows = {r["belongs_to_collection"]: r for r in groups.franchise_summary(golden).collect()}
    for name, n, budget, revenue in [("The Avengers Collection", 4, 1111.0, 7776.073348),
                                     ("Star Wars Collection", 2, 545.0, 3402.63133),
                                     ("Jurassic Park Collection", 2, 320.0, 2982.006481),
                                     ("Frozen Collection", 2, 300.0, 2727.902485)]:
        assert rows[name]["num_movies"] == n
        assert rows[name]["total_budget"] == pytest.approx(budget, rel=1e-4)
        assert rows[name]["total_revenue"] == pytest.approx(revenue, rel=1e-4)
    assert len(rows) == 4


def test_director_summary(golden):
    rows = {r["director"]: r for r in groups.director_summary(golden).collect()}
    for name, n, revenue in [("James Cameron", 2, 5187.868379), ("Anthony Russo", 2, 4851.854139),
                             ("Joe Russo", 2, 4851.854139), ("Joss Whedon", 2, 2924.219209),
                             ("Jennifer Lee", 2, 2727.902485), ("Chris Buck", 2, 2727.902485),
                             ("J.J. Abrams", 1, 2068.223624), ("Brad Bird", 1, 1243.225667)]:
        assert rows[name]["num_movies"] == n
        assert rows[name]["total_revenue"] == pytest.approx(revenue, rel=1e-4)
    assert len(rows) == 16


def test_franchise_vs_standalone(golden):
    rows = {r["is_franchise"]: r for r in groups.franchise_vs_standalone(golden).collect()}
    for label, rev, bud, med in [("Franchise", 1682.775216, 218.0, 7.786117),
                                 ("Standalone", 1765.139159, 180.0, 9.617018)]:
        assert rows[label]["mean_revenue"] == pytest.approx(rev, rel=1e-4)
        assert rows[label]["mean_budget"] == pytest.approx(bud, rel=1e-4)
        assert rows[label]["median_roi"] == pytest.approx(med, rel=1e-4)


def test_named_searches_empty(golden):
    assert search.search_scifi_action_bruce_willis(golden).count() == 0
    assert search.search_thurman_tarantino(golden).count() == 0
