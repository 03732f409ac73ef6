"""Property-based checks of the exact aggregates and the dedupe rule."""

import statistics
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.functions.aggregates import exact_mean, exact_sum
from marquee.operators import clean, groups

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.sampled_from(["a", "b", "c", None])
values = st.one_of(st.none(), st.integers(-3, 3).map(float),
                   st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False))


@SETTINGS
@given(rows=st.lists(st.tuples(keys, values), min_size=1, max_size=60),
       parts=st.integers(1, 6))
def test_group_median_equals_statistics_median(spark, rows, parts):
    df = spark.createDataFrame(rows, "k string, v double").repartition(parts)
    got = {r["k"]: r["m"] for r in groups.group_median(df, ["k"], "v", "m").collect()}
    want = {}
    for k in {k for k, _ in rows}:
        vals = [v for kk, v in rows if kk == k and v is not None]
        if vals:
            want[k] = statistics.median(vals)
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k], rel=1e-12, abs=1e-9)


money = st.decimals(min_value=Decimal("-1000000"), max_value=Decimal("1000000"), places=6,
                    allow_nan=False, allow_infinity=False)


@SETTINGS
@given(vals=st.lists(money, min_size=1, max_size=80), parts=st.integers(1, 8))
def test_fixed_point_sum_and_mean_are_exact_and_partition_free(spark, vals, parts):
    df = spark.createDataFrame([(float(v),) for v in vals], "v double").repartition(parts)
    row = df.agg(exact_sum("v").alias("s"), exact_mean("v").alias("m")).first()
    total = sum(Decimal(str(float(v))).quantize(Decimal("0.000001")) for v in vals)
    assert row["s"] == float(total)
    assert row["m"] == float(total) / len(vals)


@SETTINGS
@given(pops=st.lists(st.tuples(st.integers(1, 4), st.one_of(st.none(), st.integers(0, 5))),
                     min_size=1, max_size=30),
       parts=st.integers(1, 5))
def test_dedupe_keeps_most_popular_whatever_the_order(spark, pops, parts):
    rows = [(str(i), f"t{i}", None if p is None else float(p)) for i, p in pops]
    df = spark.createDataFrame(rows, "id string, title string, popularity double")
    a = sorted(tuple(r) for r in clean.dedupe_by_id(df.repartition(parts)).collect())
    b = sorted(tuple(r) for r in clean.dedupe_by_id(df.orderBy(F.rand(7)).repartition(parts + 1)).collect())
    assert a == b
    for id_, _, pop in a:
        cands = [p for i, p in pops if str(i) == id_]
        best = max((p for p in cands if p is not None), default=None)
        assert pop == (None if best is None else float(best))
