import json

import pytest
from pyspark.sql import functions as F

from marquee.sources import ingest, raw, sinks
from marquee.streaming import ingest_folder
from tests.helpers import raw_frame, raw_record

KEYS = sorted(raw_record().keys())


def _lines(spark, records):
    return spark.createDataFrame([(json.dumps(r),) for r in records], "value string")


def test_missing_required_key_rejected_null_value_accepted(spark):
    rec_missing = raw_record(id=2)
    del rec_missing["credits"]
    lines = _lines(spark, [raw_record(id=1), rec_missing, raw_record(id=3, budget=None)])
    good, bad = ingest.ingest(lines, KEYS)
    assert sorted(r["id"] for r in good.collect()) == ["1", "3"]
    assert [r["missing"] for r in bad.collect()] == [["credits"]]


def test_not_json_lacks_every_key(spark):
    _, bad = ingest.split_records(spark.createDataFrame([("oops",)], "value string"))
    assert bad.first()["missing"] == ["id", "title", "status", "budget", "revenue", "genres", "credits",
                                       "release_date"]


def test_nested_values_come_back_as_json_text(spark):
    good, _ = ingest.ingest(_lines(spark, [raw_record()]), KEYS)
    assert json.loads(good.first()["genres"]) == raw_record()["genres"]


def test_require_usable(spark):
    empty = spark.createDataFrame([], "id string")
    with pytest.raises(ingest.NoUsableRecords):
        ingest.require_usable(empty)
    ingest.require_usable(empty, cache=spark.createDataFrame([("1",)], "id string"))


def test_csv_round_trip_quotes_commas_and_large_cell(spark, tmp_dir):
    big = {"cast": [{"name": f"Actor {i}"} for i in range(6000)], "crew": []}
    recs = [raw_record(id=1, title='A "Quoted", Tricky Title', overview="line one\nline two"),
            raw_record(id=2, credits=big)]
    sinks.write_raw(raw_frame(spark, recs), f"{tmp_dir}/raw.csv", mode="overwrite", fmt="csv")
    back = raw.read_raw(spark, f"{tmp_dir}/raw.csv", fmt="csv")
    rows = {r["id"]: r for r in back.collect()}
    assert rows["1"]["title"] == 'A "Quoted", Tricky Title'
    assert rows["1"]["overview"] == "line one\nline two"
    assert len(rows["2"]["credits"]) > 131072
    assert len(json.loads(rows["2"]["credits"])["cast"]) == 6000


def test_encode_raw_sorted_and_json(spark):
    df = spark.createDataFrame([(1, ["a"], {"k": "v"})], "z int, a array<string>, m map<string,string>")
    enc = sinks.encode_raw(df)
    assert enc.columns == ["a", "m", "z"]
    assert tuple(enc.first()) == ('["a"]', '{"k":"v"}', "1")


def test_union_records_fills_missing_columns(spark):
    a = spark.createDataFrame([("1", "x")], "id string, title string")
    b = spark.createDataFrame([("2", "y")], "id string, extra string")
    rows = sorted(tuple(r) for r in sinks.union_records(a, b).collect())
    assert rows == [("1", "x", None), ("2", None, "y")]


def _cache(spark, ids):
    return spark.createDataFrame([(str(i), f"T{i}") for i in ids], "id string, title string")


def _req(spark, ids):
    return spark.createDataFrame([(str(i),) for i in ids], "id string")


def test_gap_fill_outcomes(spark):
    landing = _cache(spark, [1, 2, 3])
    # cache {1,2}, requested {1,2,0}, 0 unavailable -> unchanged
    allr, new = ingest.gap_fill(_cache(spark, [1, 2]), landing, _req(spark, [1, 2, 0]))
    assert new.count() == 0 and allr.count() == 2
    # cache {1}, requested {1,2} -> only 2 is loaded
    allr, new = ingest.gap_fill(_cache(spark, [1]), landing, _req(spark, [1, 2, 2, "x"]))
    assert [r["id"] for r in new.collect()] == ["2"] and allr.count() == 2
    # full hit -> nothing loaded
    _, new = ingest.gap_fill(_cache(spark, [1, 2, 3]), landing, _req(spark, [3, 1]))
    assert new.count() == 0
    # no cache -> everything requested
    allr, _ = ingest.gap_fill(spark.createDataFrame([], "id string, title string"), landing, _req(spark, [1, 3]))
    assert sorted(r["id"] for r in allr.collect()) == ["1", "3"]


def test_read_raw_if_exists(spark, tmp_dir):
    assert raw.read_raw_if_exists(spark, f"{tmp_dir}/none").count() == 0


def test_stream_ingest_is_incremental(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    _lines(spark, [raw_record(id=1), raw_record(id=2)]).write.mode("append").text(land)
    cache = ingest_folder(spark, land, f"{tmp_dir}/cache", f"{tmp_dir}/rej", f"{tmp_dir}/ck", KEYS)
    assert sorted(r["id"] for r in cache.collect()) == ["1", "2"]
    bad = raw_record(id=4)
    del bad["title"]
    _lines(spark, [raw_record(id=2), raw_record(id=3), bad]).write.mode("append").text(land)
    cache = ingest_folder(spark, land, f"{tmp_dir}/cache", f"{tmp_dir}/rej", f"{tmp_dir}/ck", KEYS)
    assert sorted(r["id"] for r in cache.collect()) == ["1", "2", "3"]
    rej = spark.read.parquet(f"{tmp_dir}/rej").collect()
    assert [r["missing"] for r in rej] == ["title"]
    # replaying the same batch (same epoch) writes nothing twice
    from marquee.streaming import append_new

    batch = _lines(spark, [raw_record(id=3), bad])
    append_new(batch, f"{tmp_dir}/cache", f"{tmp_dir}/rej", KEYS, epoch=1)
    append_new(batch, f"{tmp_dir}/cache", f"{tmp_dir}/rej", KEYS, epoch=1)
    assert spark.read.parquet(f"{tmp_dir}/rej").count() == 1
    assert spark.read.parquet(f"{tmp_dir}/cache").where(F.col("id") == "3").count() == 1
    assert cache.where(F.col("genres").isNull()).count() == 0


def test_batch_ingest_job_counts_and_gap_fill(spark, tmp_dir):
    from marquee.plans.job import ingest_landing

    land = f"{tmp_dir}/land"
    bad = raw_record(id=9)
    del bad["genres"]
    _lines(spark, [raw_record(id=1), raw_record(id=2), bad]).write.mode("append").text(land)
    run = ingest_landing(spark, land, f"{tmp_dir}/cache", KEYS, rejects_path=f"{tmp_dir}/rej")
    assert (run.accepted, run.rejected, run.appended) == (2, 1, 2)
    # second pass over the same landing: nothing new, rejects not doubled
    run = ingest_landing(spark, land, f"{tmp_dir}/cache", KEYS, rejects_path=f"{tmp_dir}/rej")
    assert run.appended == 0
    assert spark.read.parquet(f"{tmp_dir}/rej").count() == 1
    # only requested ids are loaded
    _lines(spark, [raw_record(id=3), raw_record(id=4)]).write.mode("append").text(land)
    run = ingest_landing(spark, land, f"{tmp_dir}/cache", KEYS,
                         requested=spark.createDataFrame([("3",), ("7",)], "id string"))
    assert run.appended == 1
    assert sorted(r["id"] for r in spark.read.parquet(f"{tmp_dir}/cache").collect()) == ["1", "2", "3"]


def test_batch_ingest_raises_when_nothing_usable(spark, tmp_dir):
    from marquee.plans.job import ingest_landing

    land = f"{tmp_dir}/land2"
    spark.createDataFrame([("not json",)], "value string").write.text(land)
    with pytest.raises(ingest.NoUsableRecords):
        ingest_landing(spark, land, f"{tmp_dir}/cache2", KEYS)


def test_gap_report_outcomes(spark):
    rep = ingest.gap_report(_cache(spark, [1, 2]), _cache(spark, [2, 3]), _req(spark, [1, 3, 0, 0, "x"]))
    assert sorted(tuple(r) for r in rep.collect()) == [(0, "unavailable"), (1, "cached"), (3, "loaded")]


def test_stream_ingest_continuous_trigger(spark, tmp_dir):
    from marquee.streaming import start_ingest

    land = f"{tmp_dir}/land_c"
    _lines(spark, [raw_record(id=11), raw_record(id=12)]).write.mode("append").text(land)
    q = start_ingest(spark, land, f"{tmp_dir}/cache_c", f"{tmp_dir}/rej_c", f"{tmp_dir}/ck_c", KEYS,
                     once=False, max_files_per_trigger=1, interval="1 second")
    try:
        q.processAllAvailable()
        _lines(spark, [raw_record(id=13)]).write.mode("append").text(land)
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r["id"] for r in spark.read.parquet(f"{tmp_dir}/cache_c").collect()) == ["11", "12", "13"]
