from marquee.operators import search
from tests.helpers import kpi_frame, title


def test_all_genres_must_match(spark):
    df = kpi_frame(spark, [title(1, "A", genres="Action|Science Fiction"), title(2, "B", genres="Action|Comedy")])
    out = search.search_titles(df, genres=["Action", "Science Fiction"])
    assert [r["title"] for r in out.collect()] == ["A"]


def test_case_insensitive_and_null_never_matches(spark):
    df = kpi_frame(spark, [title(1, "A", cast="Bruce Willis|Alan Rickman"), title(2, "B", director=None)])
    assert search.search_titles(df, cast="bruce willis").count() == 1
    assert search.search_titles(df, director="MAKER").count() == 1


def test_substring_vs_token(spark):
    df = kpi_frame(spark, [title(1, "A", genres="Melodrama"), title(2, "B", genres="Drama|Comedy")])
    assert search.search_titles(df, genres="drama").count() == 2
    assert [r["title"] for r in search.search_titles(df, genres="drama", match="token").collect()] == ["B"]


def test_named_searches(spark):
    df = kpi_frame(spark, [
        title(1, "The Fifth Element", genres="Science Fiction|Action|Adventure",
              cast="Bruce Willis|Milla Jovovich", vote_average=7.5),
        title(2, "Pulp Fiction", genres="Crime|Drama", cast="Bruce Willis|Uma Thurman",
              director="Quentin Tarantino", runtime=154.0),
        title(3, "Kill Bill", cast="Uma Thurman", director="Quentin Tarantino", runtime=111.0),
        title(4, "Other", cast="Uma Thurman", director="Someone Else", runtime=90.0),
    ])
    s1 = search.search_scifi_action_bruce_willis(df)
    assert s1.columns == ["title", "vote_average", "genres", "cast"]
    assert [r["title"] for r in s1.collect()] == ["The Fifth Element"]
    s2 = search.search_thurman_tarantino(df)
    assert s2.columns == ["title", "runtime", "director", "cast"]
    assert [r["title"] for r in s2.collect()] == ["Kill Bill", "Pulp Fiction"]


def test_ascending_sort_puts_nulls_last(spark):
    df = kpi_frame(spark, [title(1, "A", runtime=None), title(2, "B", runtime=90.0)])
    out = search.search_titles(df, sort_by="runtime", ascending=True)
    assert [r["title"] for r in out.collect()] == ["B", "A"]


def test_indexed_search_equals_the_plain_one_and_prunes(spark, tmp_dir):
    from marquee.operators import postings

    df = kpi_frame(spark, [title(i, f"T{i}", genres=["Action|Drama", "Melodrama", "Comedy", None][i % 4],
                                 cast=["Ann Lee|Bo", "ANNA LEE", "Zed", "É Ünï"][i % 3], director=["Al", "Dr. Ama", None][i % 3])
                           for i in range(1, 25)])
    postings.build_postings(df, f"{tmp_dir}/p")
    asks = [dict(genres="drama"), dict(genres=["Action", "DRAMA"], cast="lee"), dict(cast="ann lee|b"), dict(cast="Al"),
            dict(director="dr. ama", genres="co"), dict(cast="nobody here"), dict(), dict(genres="drama", match="token"),
            dict(cast="ünï", sort_by="popularity", ascending=True)]
    for ask in asks:
        assert postings.search_indexed(df, f"{tmp_dir}/p", **ask).collect() == search.search_titles(df, **ask).collect(), ask
    found = postings.candidates(spark, f"{tmp_dir}/p", postings.asked_grams(genres="drama"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "PushedFilters" in plan
    assert postings.asked_grams(cast=["ab", "abcd"], genres=None) == {("cast", "abc"), ("cast", "bcd")}
