"""Plan-shape checks: the physical plans we rely on for scale."""

from marquee.operators import groups, ranking
from marquee.sources import starview
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df) -> str:
    df.collect()
    return _plan(df)


def test_clean_chain_has_no_python_worker_and_prunes_scans(spark):
    clean = starview.clean_titles(spark, SF_SMALL)
    plan = _plan(clean)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    # dedupe keeps one row per id before the shuffle
    assert plan.count("WindowGroupLimit") >= 2
    # lineitem is read with only the needed columns
    lineitem_schema = [ln for ln in clean._jdf.queryExecution().toString().splitlines()
                       if "ReadSchema" in ln and "l_partkey" in ln]
    assert lineitem_schema and all("l_comment" not in ln and "l_orderkey" not in ln
                                   for ln in lineitem_schema)


def test_ranking_is_take_ordered(spark):
    clean = starview.clean_titles(spark, SF_SMALL)
    plan = _plan(ranking.highest_roi(clean))
    assert "TakeOrderedAndProject" in plan
    assert "Window [row_number" not in plan.split("TakeOrderedAndProject")[0]


def test_median_range_partitions_weighted_values(spark):
    clean = starview.clean_titles(spark, SF_SMALL)
    plan = _final_plan(groups.roi_by_genre(clean))
    final = plan.split("Initial Plan")[0]
    assert "rangepartitioning" in final
    assert "monotonically_increasing_id" not in plan
    # no aggregate that holds a whole group's values
    assert "percentile" not in plan


def test_group_sums_are_partial_then_final(spark):
    clean = starview.clean_titles(spark, SF_SMALL)
    plan = _plan(groups.director_summary(clean))
    # map-side partial aggregation before the shuffle on the director key
    assert "partial_sum" in plan and "partial_count" in plan


def test_title_facts_collect_one_set_and_sort_natively(spark):
    from marquee.sources import starview
    from tests.conftest import SF_SMALL

    plan = starview.title_facts(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_set(") == 1 and "array_sort(" not in plan
