import json

import pytest

from marquee.plans import job
from marquee.plans.session import scale_settings
from marquee.sources import raw
from tests.helpers import raw_frame, raw_record


def test_run_writes_every_kpi_table(spark, tmp_dir):
    recs = [raw_record(id=i, title=f"T{i}", revenue=1_000_000 * (i + 1), budget=500_000 * (i + 2),
                       belongs_to_collection={"name": "C"} if i % 2 else None) for i in range(1, 9)]
    paths = job.run(spark, raw_frame(spark, recs), f"{tmp_dir}/out")
    assert "clean" in paths and "highest_revenue" in paths and "feed_02-roi-by-genre" in paths
    assert spark.read.parquet(paths["highest_revenue"]).count() == 5
    assert spark.read.parquet(paths["clean"]).count() == 8
    metrics = {(r["group"], r["metric"]): r["value"] for r in spark.read.parquet(paths["metrics"]).collect()}
    assert metrics[("stage_rows", "released")] == 8 and metrics[("parse", "rows")] == 8


def test_run_names_the_failed_stage(spark, tmp_dir):
    df = raw_frame(spark, [raw_record()]).drop("credits")
    with pytest.raises(job.StageError) as e:
        job.run(spark, df, f"{tmp_dir}/bad")
    assert e.value.stage == "preprocessing"


def test_json_raw_read(spark, tmp_dir):
    path = f"{tmp_dir}/land.json"
    with open(path, "w") as f:
        for r in [raw_record(id=1), raw_record(id=2, genres=[])]:
            f.write(json.dumps(r) + "\n")
    df = raw.read_raw(spark, path, fmt="json")
    rows = {r["id"]: r for r in df.collect()}
    assert json.loads(rows["1"]["genres"]) == raw_record()["genres"]
    assert rows["2"]["genres"] == "[]"
    assert isinstance(rows["1"]["budget"], str)


def test_scale_settings():
    s = scale_settings(100 * 1024 ** 4, total_cores=8000)
    assert int(s["spark.sql.shuffle.partitions"]) == 409600
    assert int(scale_settings(10, total_cores=8)["spark.sql.shuffle.partitions"]) == 16


def test_command_line_run(spark, tmp_dir, capsys):
    from marquee.__main__ import main
    from marquee.sources.sinks import write_raw

    write_raw(raw_frame(spark, [raw_record(id=i, title=f"T{i}") for i in range(1, 4)]),
              f"{tmp_dir}/raw", mode="overwrite")
    assert main(["--raw", f"{tmp_dir}/raw", "--out", f"{tmp_dir}/out"]) == 0
    assert "highest_revenue" in capsys.readouterr().out
    write_raw(raw_frame(spark, [raw_record()]).drop("credits"), f"{tmp_dir}/bad", mode="overwrite")
    assert main(["--raw", f"{tmp_dir}/bad", "--out", f"{tmp_dir}/out2"]) == 1
    # incremental: one new title on top of the first run's clean output
    write_raw(raw_frame(spark, [raw_record(id=i, title=f"T{i}") for i in range(1, 5)]),
              f"{tmp_dir}/raw2", mode="overwrite")
    write_raw(raw_frame(spark, [raw_record(id=4, title="T4")]).select("id"), f"{tmp_dir}/changed",
              mode="overwrite")
    assert main(["--raw", f"{tmp_dir}/raw2", "--out", f"{tmp_dir}/out3", "--refresh-from",
                 f"{tmp_dir}/out/clean", "--changed", f"{tmp_dir}/changed"]) == 0
    assert spark.read.parquet(f"{tmp_dir}/out3/clean").count() == 4


def test_run_with_approximate_medians(spark, tmp_dir):
    recs = [raw_record(id=i, title=f"T{i}", revenue=1_000_000 * (i + 1), budget=500_000 * (i + 2))
            for i in range(1, 6)]
    paths = job.run(spark, raw_frame(spark, recs), f"{tmp_dir}/approx", approx_median=True)
    plan_free = spark.read.parquet(paths["feed_02-roi-by-genre"]).collect()
    assert len(plan_free) == 1 and plan_free[0]["median_roi"] > 0


def test_refresh_clean_equals_full_recompute(spark, tmp_dir):
    from pyspark.sql import functions as F

    from marquee.sources import starview

    raw = starview.raw_catalogue(spark, "/root/testdata/sf0.001")
    # an earlier cache: titles released before 2000; the new records: the rest,
    # plus a second copy of a cached title with higher popularity (an update)
    old = raw.where(F.col("release_date") < "2000-01-01")
    update = old.where(F.col("id") == "6").withColumn("popularity", F.lit("99999.0"))
    new = raw.where(~(F.col("release_date") < "2000-01-01") | F.col("release_date").isNull()).unionByName(update)
    everything = old.unionByName(new)
    job.preprocess(spark, old, f"{tmp_dir}/clean_old")
    refreshed = job.refresh_clean(spark, everything, new.select("id"), f"{tmp_dir}/clean_old",
                                  f"{tmp_dir}/clean_new")
    full, _ = job.preprocess(spark, everything, f"{tmp_dir}/clean_full")
    a = sorted(tuple(r) for r in refreshed.collect())
    b = sorted(tuple(r) for r in full.collect())
    assert a == b and len(a) > 100
    assert refreshed.where(F.col("id") == 6).first()["popularity"] == 99999.0
    from marquee.sources.raw import read_clean

    assert read_clean(spark, f"{tmp_dir}/clean_new", require_checked=True).count() == len(a)
    # any superset of the touched ids gives the same result
    every = job.refresh_clean(spark, everything, everything.select("id"), f"{tmp_dir}/clean_old",
                              f"{tmp_dir}/clean_all")
    assert sorted(tuple(r) for r in every.collect()) == b
    with pytest.raises(ValueError):
        job.refresh_clean(spark, everything, new.select("id"), f"{tmp_dir}/clean_old", f"{tmp_dir}/clean_old")


def test_cut_lineage_uses_the_shared_checkpoint_folder(spark):
    from marquee.plans.session import CHECKPOINT_KEY, cut_lineage, ensure_checkpoint_dir

    folder = ensure_checkpoint_dir(spark)
    assert spark.conf.get(CHECKPOINT_KEY, None) or folder
    df = spark.range(100).selectExpr("id", "id * 2 AS twice")
    cut = cut_lineage(df)
    assert cut.count() == 100
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan  # lineage now starts at the checkpoint


def test_apply_scale_settings_to_a_session(spark):
    from marquee.plans.session import apply_settings, scale_settings

    settings = scale_settings(10 * 1024 ** 3, total_cores=8)
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        apply_settings(spark, settings)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_gates_do_not_pass_unreported_metrics(spark, tmp_dir, monkeypatch):
    from marquee.operators.quality import QualityError

    recs = raw_frame(spark, [raw_record(id=1, title="A"), raw_record(id=2, title="B")])
    monkeypatch.setattr(job, "observed", lambda obs: {})
    with pytest.raises(QualityError, match="no metrics"):
        job.preprocess(spark, recs, f"{tmp_dir}/clean")
    # an empty output is empty indeed
    out, run = job.preprocess(spark, recs.where("id = '9'"), f"{tmp_dir}/none")
    assert out.count() == 0 and run.stage_rows["released"] == 0
