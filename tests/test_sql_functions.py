from marquee.functions.sql import register_catalogue, register_sql_functions
from tests.helpers import kpi_frame, title


def test_sql_functions_inline_without_python(spark):
    register_sql_functions(spark)
    df = spark.sql("""
        SELECT mq_directors(array(named_struct('name', 'a', 'job', 'Director'),
                                  named_struct('name', 'b', 'job', 'Writer'),
                                  named_struct('name', CAST(NULL AS STRING), 'job', 'Director'),
                                  named_struct('name', 'c', 'job', 'Director'))) AS d,
               mq_joined_names(array()) AS e, mq_roi(10.0, 0.0) AS r, mq_musd(0.0) AS z,
               mq_placeholder_null('No Data') AS p, mq_has_item('Action|Drama', 'drama') AS h""")
    assert tuple(df.first()) == ("a|c", None, None, None, None, True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_catalogue_view(spark):
    df = kpi_frame(spark, [title(1, "A", belongs_to_collection="C"), title(2, "B")])
    view = register_catalogue(df, "t_view")
    rows = spark.sql(f"SELECT mq_membership(belongs_to_collection) AS m, count(*) AS n "
                     f"FROM {view} GROUP BY 1 ORDER BY 1").collect()
    assert [tuple(r) for r in rows] == [("Franchise", 1), ("Standalone", 1)]
