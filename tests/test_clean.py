import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marquee.operators import clean, nested, quality
from marquee.plans.job import preprocess
from marquee.schemas import CLEAN_COLUMNS, IRRELEVANT_COLUMNS, MIN_POPULATED_FIELDS, PLACEHOLDER_TEXT
from tests.helpers import credits, named, raw_frame, raw_record


def _typed(spark, records):
    return clean.fix_types(nested.flatten(nested.parse_nested(raw_frame(spark, records))))


def _cells(spark, columns, **overrides):
    return tuple(_typed(spark, [raw_record(**overrides)]).select(*columns).first())


@pytest.mark.parametrize("raw,columns,want", [
    # zero stands for unknown; money is in millions
    (dict(budget=0, revenue=0, runtime=0), ("budget_musd", "revenue_musd", "runtime"), (None, None, None)),
    (dict(budget=1_250_000, revenue=37_500_000), ("budget_musd", "revenue_musd"), (1.25, 37.5)),
    # a rating nobody voted for is none
    (dict(vote_count=0, vote_average=3.5), ("vote_average", "vote_count"), (None, 0)),
    (dict(vote_count=1, vote_average=3.5), ("vote_average", "vote_count"), (3.5, 1)),
    # malformed cells
    (dict(budget="many", popularity="NaN", vote_count="2.0", release_date="soon"),
     ("budget_musd", "popularity", "vote_count", "release_date"), (None, None, None, None)),
    # nested values
    (dict(belongs_to_collection={"name": "Trilogy", "id": 3}), ("belongs_to_collection",), ("Trilogy",)),
    (dict(belongs_to_collection=None), ("belongs_to_collection",), (None,)),
    (dict(genres=named("Noir", "Farce")), ("genres",), ("Noir|Farce",)),
    (dict(genres=[]), ("genres",), (None,)),
    (dict(credits=credits(("p", "q", "r"))), ("cast", "cast_size", "crew_size", "director"), ("p|q|r", 3, 0, None)),
    # directors in crew order, by the exact job, without nameless ones
    (dict(credits=credits((), [("z", "Director"), ("c", "Camera"), ("l", "director"), (None, "Director"),
                               ("b", "Director")])), ("director", "crew_size"), ("z|b", 5)),
])
def test_cells(spark, raw, columns, want):
    assert _cells(spark, columns, **raw) == want


def test_a_year_is_its_first_day(spark):
    assert str(_cells(spark, ["release_date"], release_date="1974")[0]) == "1974-01-01"


@pytest.mark.parametrize("column", ["overview", "tagline"])
def test_placeholders_are_missing_and_other_text_stays(spark, column):
    texts = [*PLACEHOLDER_TEXT, "Data", "no data", " "]
    rows = _typed(spark, [raw_record(id=i, **{column: t}) for i, t in enumerate(texts)]).orderBy("id").collect()
    assert [r[column] for r in rows] == [None] * len(PLACEHOLDER_TEXT) + texts[len(PLACEHOLDER_TEXT):]


def test_irrelevant_columns_are_dropped(spark):
    assert not {*IRRELEVANT_COLUMNS, "credits"} & set(_typed(spark, [raw_record()]).columns)


def _flat(spark, *rows):
    """Typed rows before row cleaning: (id, filled columns, changes). Filled
    counts the non-null contract columns, title and id among them."""
    columns = [*CLEAN_COLUMNS, "status"]
    out = []
    for key, filled, changes in rows:
        row = {"id": key, "title": f"title {key}", "status": "Released"}
        for c in CLEAN_COLUMNS:
            if c not in row and sum(row.get(x) is not None for x in CLEAN_COLUMNS) < filled:
                row[c] = "1"
        out.append(tuple((row | changes).get(c) for c in columns))
    frame = spark.createDataFrame(out, StructType([StructField(c, StringType()) for c in columns]))
    return frame.withColumn("popularity", F.col("popularity").cast("double"))


def _kept(frame):
    return sorted(r["id"] for r in clean.clean_rows(frame).collect())


def test_rows_need_enough_populated_fields(spark):
    least = MIN_POPULATED_FIELDS
    around = _flat(spark, *[(str(n), n, {}) for n in (least - 2, least, least + 1)])
    kept = _kept(around)
    assert str(least - 2) not in kept and str(least + 1) in kept


def test_rows_without_key_title_or_release_go(spark):
    frame = _flat(spark, ("a", 15, {"id": None}), ("b", 15, {"title": None}), ("c", 15, {"status": "Rumored"}),
                  ("d", 15, {"status": None}), ("e", 15, {}))
    assert _kept(frame) == ["e"]
    assert clean.clean_rows(frame).columns == CLEAN_COLUMNS


def test_survivor_of_an_id_is_the_fullest_then_the_most_popular(spark):
    frame = _flat(spark, ("x", 13, {"popularity": "80"}), ("x", 16, {"popularity": "2"}), ("x", 16, {"popularity": "3"}),
                  ("y", 14, {}), ("y", 14, {}))
    rows = {r["id"]: r["popularity"] for r in clean.dedupe_by_id(frame).collect()}
    assert rows["x"] == 3.0 and len(rows) == 2


def test_a_fuller_unreleased_row_shadows_a_released_one(spark):
    frame = _flat(spark, ("x", 14, {}), ("x", 18, {"status": "Planned"}))
    assert _kept(frame) == []


def test_contract_and_id_checks_raise(spark):
    df = clean.to_contract(_typed(spark, [raw_record(id=9), raw_record(id=9)]))
    with pytest.raises(quality.QualityError):
        quality.check_clean(df)
    with pytest.raises(quality.QualityError):
        quality.check_contract(df.select(*reversed(df.columns)))


def test_value_checks_count_and_keep(spark):
    odd = [raw_record(id=1, vote_average=12.5), raw_record(id=2, budget=-4_000_000), raw_record(id=3, revenue=-1),
           raw_record(id=4, runtime=-5), raw_record(id=5, release_date="2999-12-31"),
           raw_record(id=6, release_date="1800-01-01"), raw_record(id=7)]
    df = _typed(spark, odd)
    found = {r["check"]: r["bad_rows"] for r in quality.quality_report(df, as_of="2020-01-01").collect()}
    value = [n for n in found if n in quality.value_checks()]
    assert {found[n] for n in value if n != "rating_needs_votes"} == {1}
    assert clean.clean_rows(df).count() == len(odd)


def test_preprocess_one_write_with_metrics(spark, tmp_dir):
    records = [raw_record(id=i, title=f"N{i}") for i in (3, 4, 5, 3)] + [raw_record(id=8, status="Planned")]
    out, run = preprocess(spark, raw_frame(spark, records), f"{tmp_dir}/clean")
    assert out.count() == 3 and out.columns == CLEAN_COLUMNS
    assert run.stage_rows == {"raw": 5, "keyed": 5, "deduplicated": 4, "populated": 4, "released": 3}
    assert run.parse == {"rows": 5, "genres_parsed": 5, "credits_parsed": 5}


@pytest.mark.parametrize("column", ["genres", "credits"])
def test_unparseable_nesting_raises_and_leaves_the_old_table(spark, tmp_dir, column):
    from marquee.sources.raw import read_clean

    good = raw_frame(spark, [raw_record(id=i) for i in (1, 2, 3)])
    preprocess(spark, good, f"{tmp_dir}/table")
    with pytest.raises(quality.QualityError):
        preprocess(spark, good.limit(2).withColumn(column, F.lit("{broken")), f"{tmp_dir}/table")
    assert read_clean(spark, f"{tmp_dir}/table", require_checked=True).count() == 3
    # nothing else is left beside it
    import os

    assert sorted(os.listdir(tmp_dir)) == ["table"]


def test_missing_credits_column_raises(spark, tmp_dir):
    with pytest.raises(Exception):
        preprocess(spark, raw_frame(spark, [raw_record()]).drop("credits"), f"{tmp_dir}/none")


def test_csv_catalogue_reads_back_as_written(spark, tmp_dir):
    texts = ["  padded  ", 'say "hi", twice', "two\nlines", "back\\slash", "comma, semicolon; pipe|"]
    raw = raw_frame(spark, [raw_record(id=i, title=t, tagline=t) for i, t in enumerate(texts)])
    parquet, _ = preprocess(spark, raw, f"{tmp_dir}/p")
    csv, run = preprocess(spark, raw, f"{tmp_dir}/c", fmt="csv")
    assert csv.columns == CLEAN_COLUMNS and run.stage_rows["released"] == len(texts)
    assert csv.schema.simpleString() == parquet.schema.simpleString()
    assert sorted(csv.collect(), key=str) == sorted(parquet.collect(), key=str)


def test_preprocess_is_a_single_action(spark, tmp_dir):
    raw = raw_frame(spark, [raw_record(id=i) for i in range(1, 6)])
    tracker, jobs = spark.sparkContext.statusTracker(), {}
    for group, check in (("plain", False), ("checked", True)):
        spark.sparkContext.setJobGroup(group, group)
        preprocess(spark, raw, f"{tmp_dir}/{group}", verify_ids=check)
        jobs[group] = len(tracker.getJobIdsForGroup(group))
    # the id re-check adds jobs; without it everything rides on the write
    assert jobs["checked"] > jobs["plain"] >= 1
