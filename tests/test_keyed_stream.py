"""Stream ingest by keyed state: repeats, late records, restarts."""

import json

from marquee.streaming import keyed
from tests.helpers import raw_record

KEYS = ["id", "title", "release_date"]
REQUIRED = ["id", "title"]


def _drop(spark, path, *rows):
    spark.createDataFrame([(json.dumps({k: v for k, v in r.items()}),) for r in rows], "value string") \
        .coalesce(1).write.mode("append").text(path)


def _title(id, day, name="t"):
    return {"id": id, "title": name, "release_date": day}


def _loaded(spark, base):
    return sorted((r.id, r.release_date) for r in keyed.keyed_cache(spark, base, KEYS).collect())


def _late(spark, base):
    return sorted((json.loads(r.value)["id"], str(r.event)[:10], r.epoch) for r in keyed.late_records(spark, base).collect())


def _take(spark, land, base):
    return keyed.ingest_keyed(spark, land, base, "release_date", "10 days", REQUIRED)


def test_three_batches_with_repeats_late_records_and_restarts(spark, tmp_dir):
    land, base = f"{tmp_dir}/land", f"{tmp_dir}/out"
    _drop(spark, land, _title(1, "2020-01-20"), _title(1, "2020-01-20"), _title(2, "2020-01-01"))
    _take(spark, land, base)
    # nothing is late in the first batch, however far apart
    assert _loaded(spark, base) == [("1", "2020-01-20"), ("2", "2020-01-01")] and _late(spark, base) == []
    # watermark 2020-01-10: a repeat inside it, a late new id, a late repeat
    _drop(spark, land, _title(1, "2020-01-20"), _title(3, "2020-01-05"), _title(2, "2020-01-01"), _title(4, "2020-01-11"))
    second = _take(spark, land, base)
    assert [i for i, _ in _loaded(spark, base)] == ["1", "2", "4"]
    assert [x[:2] for x in _late(spark, base)] == [(2, "2020-01-01"), (3, "2020-01-05")]
    _drop(spark, land, _title(4, "2020-01-11"), _title(5, "2020-03-01"), _title(6, "2020-01-12"))
    _take(spark, land, base)
    assert [i for i, _ in _loaded(spark, base)] == ["1", "2", "4", "5", "6"]
    # a plan reads the batch's files and the state, not what was ingested
    plan = second._jsq.explainInternal(True)
    assert f"{base}/rows" not in plan and "DeduplicateWithinWatermark" in plan


def test_expired_ids_count_as_new(spark, tmp_dir):
    land, base = f"{tmp_dir}/land", f"{tmp_dir}/out"
    for day in ("2020-01-01", "2020-02-01", "2020-03-01"):
        _drop(spark, land, _title(7, day))
        _take(spark, land, base)
    # 2020-02-01 came while the entry of 2020-01-01 was still kept
    assert ("7", "2020-01-01") in _loaded(spark, base) and len(_loaded(spark, base)) == 2


def test_unusable_records_go_to_rejects(spark, tmp_dir):
    land, base = f"{tmp_dir}/land", f"{tmp_dir}/out"
    _drop(spark, land, {"id": 1}, _title("x", "2020-01-01"), _title(2, "soon"), raw_record(id=3, release_date="2020-01-01"))
    _take(spark, land, base)
    got = {json.loads(r.record).get("id"): r.missing for r in keyed.rejected_records(spark, base).collect()}
    assert got == {1: "title|release_date", "x": "id", 2: "release_date"}
    assert [i for i, _ in _loaded(spark, base)] == ["3"]


def test_a_replayed_epoch_writes_nothing_twice(spark, tmp_dir):
    rows = spark.createDataFrame([("{}", [], "seen"), ("{}", [], "new")], "value string, missing array<string>, kind string") \
        .selectExpr("value", "missing", "timestamp '2020-01-01' AS event", "kind")
    for _ in range(2):
        keyed._write(rows, 4, f"{tmp_dir}/out", "10 days")
    assert spark.read.parquet(f"{tmp_dir}/out/rows").count() == 2
    assert spark.read.parquet(f"{tmp_dir}/out/marks").count() == 1
    later = rows.selectExpr("value", "missing", "timestamp '2019-12-01' AS event", "kind")
    keyed._write(later, 5, f"{tmp_dir}/out", "10 days")
    keyed._write(later, 5, f"{tmp_dir}/out", "10 days")
    assert keyed.late_records(spark, f"{tmp_dir}/out").count() == 1


def test_a_text_is_stored_once(spark, tmp_dir):
    land, base = f"{tmp_dir}/land", f"{tmp_dir}/out"
    _drop(spark, land, _title(1, "2020-01-20"), _title(1, "2020-01-20"), _title(2, "soon"))
    _take(spark, land, base)
    _drop(spark, land, _title(3, "2020-01-21"), _title(4, "2020-01-01"))
    _take(spark, land, base)
    rows = spark.read.parquet(f"{base}/rows")
    # texts beside the accepted ones: one reject, one late record
    kept = rows.where("kind = 'seen' AND value IS NOT NULL").collect()
    assert sorted(json.loads(r.value)["id"] for r in kept) == [2, 4]
    assert rows.where("kind = 'seen'").count() == 5
    assert [i for i, _ in _loaded(spark, base)] == ["1", "3"] and [x[0] for x in _late(spark, base)] == [4]
