"""Batch job: raw records -> clean catalogue -> KPI tables.

``preprocess`` runs the whole cleaning chain as ONE write. Stage counts,
parse gates and value checks ride on that write as observed metrics
(``DataFrame.observe``), so they cost no extra pass over the raw data.
The caller gets the catalogue re-read from the sink: every later KPI
starts from the written Parquet (column pruning, no recomputation of
the cleaning chain, nothing lost with an executor).

``run`` writes every KPI table and chart feed next to it.
"""

from __future__ import annotations

import contextlib
import datetime as _dt
import logging
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from marquee.operators import feeds, groups, quality, ranking, search
from marquee.operators.clean import (
    clean_catalogue,
    dedupe_by_id,
    drop_missing_keys,
    fix_types,
    keep_populated,
    keep_released,
    to_contract,
)
from marquee.operators.nested import flatten, parse_health, parse_nested
from marquee.sources import ingest as ingest_ops
from marquee.sources.raw import read_clean, read_raw_if_exists
from marquee.sources.sinks import CSV_WRITE, write_clean

log = logging.getLogger("marquee.job")


class StageError(RuntimeError):
    """A job stage failed; ``stage`` names it."""

    def __init__(self, stage: str, cause: BaseException):
        super().__init__(f"stage '{stage}' failed: {cause}")
        self.stage = stage


def observed(obs: Observation) -> dict:
    """Metrics of an observation. When AQE finds a shuffle empty at run
    time it replaces the plan above it by an empty relation, dropping the
    observation with it; the rows it would have counted are then none,
    so an unreported observation reads as empty (all counts 0). The gates
    confirm this from what was written (``_confirm``)."""
    try:
        return dict(obs.get)
    except Exception:  # noqa: BLE001 - dropped with an empty relation
        return {}


@dataclass
class CleanRun:
    path: str
    stage_rows: dict[str, int] = field(default_factory=dict)
    parse: dict[str, int] = field(default_factory=dict)
    value_checks: dict[str, int] = field(default_factory=dict)

    def as_rows(self) -> list[tuple[str, str, int]]:
        """(group, metric, value) rows: stage counts, parse gates, checks."""
        out = [("stage_rows", k, v) for k, v in self.stage_rows.items()]
        out += [("parse", k, v) for k, v in self.parse.items()]
        out += [("value_checks", k, v) for k, v in self.value_checks.items()]
        return out


MARKER_JOB = "marquee: quality marker"


def _write_marker(spark: SparkSession, rows: list[tuple[str, str, int]], out_path: str) -> None:
    """Write the ``_checked`` marker (a few rows) as its own, labelled job,
    restoring the caller's job description afterwards."""
    try:
        sc = spark.sparkContext
        previous = sc.getLocalProperty("spark.job.description")
        sc.setJobDescription(MARKER_JOB)
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext, no label
        sc = previous = None
    try:
        spark.createDataFrame(rows or [("run", "rows", 0)], "group string, metric string, value bigint") \
            .coalesce(1).write.mode("overwrite").parquet(checked_marker(out_path))
    finally:
        if sc is not None:
            sc.setJobDescription(previous)


def _run_of(obs: dict[str, Observation], path: str) -> CleanRun:
    """The metrics observed on a clean write."""
    run = CleanRun(path=path)
    for stage in ("raw", "keyed", "deduplicated", "populated", "released"):
        run.stage_rows[stage] = int(observed(obs[stage]).get("rows", 0))
    run.parse = {k: int(v or 0) for k, v in observed(obs["parse"]).items()}
    run.value_checks = {k: int(v or 0) for k, v in observed(obs["values"]).items()}
    return run


def clean_with_metrics(raw: DataFrame, as_of: str | _dt.date | None = None):
    """The clean chain with observed metrics attached; returns
    (clean frame, observations). Nothing runs until the frame is written."""
    obs = {k: Observation(k) for k in ("raw", "parse", "values", "keyed", "deduplicated",
                                       "populated", "released", "final")}
    df = raw.observe(obs["raw"], F.count(F.lit(1)).alias("rows"))
    df = parse_nested(df)
    df = df.observe(obs["parse"], *[c.alias(n) for n, c in parse_health(df).items()])
    df = fix_types(flatten(df))
    checks = quality.value_checks(as_of)
    df = df.observe(obs["values"], *[F.count_if(c).alias(n) for n, c in checks.items()])
    df = drop_missing_keys(df).observe(obs["keyed"], F.count(F.lit(1)).alias("rows"))
    df = dedupe_by_id(df).observe(obs["deduplicated"], F.count(F.lit(1)).alias("rows"))
    df = keep_populated(df).observe(obs["populated"], F.count(F.lit(1)).alias("rows"))
    df = keep_released(df).observe(obs["released"], F.count(F.lit(1)).alias("rows"))
    out = to_contract(df).observe(obs["final"], F.count_if(F.col("id").isNull()).alias("null_ids"))
    return out, obs


def preprocess(spark: SparkSession, raw: DataFrame, out_path: str, fmt: str = "parquet",
               as_of: str | _dt.date | None = None, expected_rows: int | None = None,
               tolerance: int = 2, verify_ids: bool = False) -> tuple[DataFrame, CleanRun]:
    """Clean ``raw`` and write it once to ``out_path``; returns the
    catalogue read back from the sink and the run's metrics. The data is
    read and written in one pass: every count and check rides on that
    write as observed metrics. Ids are unique and non-null by construction
    (dedupe, key filter); the null-id count is observed on the write, and
    ``verify_ids`` adds one pass over the written id column to re-check
    uniqueness. The write goes to a staging folder beside the output, which
    takes its place only when every gate has passed: schema-tier failures
    raise ``QualityError`` and leave an earlier output as it was; value-tier
    findings are logged. The ``_checked`` marker (the run's metrics, a few
    rows) is published with the output."""
    clean, obs = clean_with_metrics(raw, as_of)
    quality.check_contract(clean)
    with staged(spark, out_path) as stage:
        run, released = _gated_write(spark, clean, obs, stage, out_path, fmt, verify_ids)
    if expected_rows is not None and abs(released - expected_rows) > tolerance:
        log.warning("clean row count %d is not within %d of %d", released, tolerance, expected_rows)
    return read_clean(spark, out_path, fmt), run


def _confirm(obs: dict[str, Observation], written: DataFrame, whole: bool) -> None:
    """Refuse an output whose metrics were not reported although it holds
    rows. ``whole``: all of it came through the observed chain; otherwise
    only its ids can be judged."""
    missing = [name for name, o in obs.items() if not observed(o)]
    if not missing:
        return
    bad = written if whole else written.where(F.col("id").isNull())
    if not bad.isEmpty():
        raise quality.QualityError(f"no metrics were reported for {', '.join(missing)}, and the output is not empty")


def _gated_write(spark: SparkSession, clean: DataFrame, obs: dict[str, Observation], stage: str, out_path: str,
                 fmt: str, verify_ids: bool) -> tuple[CleanRun, int]:
    """Write to the staging folder and pass every gate there."""
    write_clean(clean, stage, fmt)
    run = _run_of(obs, out_path)
    _confirm(obs, read_clean(spark, stage, fmt), whole=True)
    log.info("clean rows by stage: %s", run.stage_rows)
    quality.check_parse(run.parse)
    for name, bad in run.value_checks.items():
        if bad:
            log.warning("value check failed for %d row(s): %s", bad, name)
    if int(observed(obs["final"]).get("null_ids") or 0):
        raise quality.QualityError("null ids in the clean catalogue")
    if verify_ids:  # one pass over the written id column
        quality.enforce(quality.quality_report(read_clean(spark, stage, fmt).select("id"), values=False)
                        .where(F.col("tier") == "schema").collect())
    # every schema gate passed: mark the output as checked (a few rows)
    _write_marker(spark, run.as_rows(), stage)
    return run, run.stage_rows["released"]


@contextlib.contextmanager
def staged(spark: SparkSession, out_path: str):
    """A folder beside ``out_path`` to write to; it takes the place of
    ``out_path`` when the block ends, and is removed when it raises, so a
    failed run leaves the published table as it was."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    base = out_path.rstrip("/")
    target, stage, old = (hadoop.Path(f"{base}{x}") for x in ("", f"__staging-{uuid.uuid4().hex}",
                                                             f"__old-{uuid.uuid4().hex}"))
    fs = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    try:
        yield stage.toString()
    except BaseException:
        fs.delete(stage, True)
        raise
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"{base} could not be set aside")
    if not fs.rename(stage, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"{stage} could not be published as {base}")
    if had:
        fs.delete(old, True)


@dataclass
class IngestRun:
    cache_path: str
    accepted: int = 0
    rejected: int = 0
    appended: int = 0


def ingest_landing(spark: SparkSession, landing_path: str, cache_path: str, keys,
                   requested: DataFrame | None = None, rejects_path: str | None = None) -> IngestRun:
    """Batch gap-fill of the raw cache from a landing folder of JSON lines.

    Lines lacking a required key are rejected (written to ``rejects_path``
    when given); of the accepted records only ids that are requested (all,
    when ``requested`` is None) and not cached yet are appended. Counts
    ride on the append as observed metrics. Raises ``NoUsableRecords``
    when nothing was usable and there is no cache."""
    lines = spark.read.text(landing_path)
    obs = Observation("ingest")
    tagged = lines.withColumn("missing", ingest_ops.missing_keys("value")).observe(
        obs, F.count_if(F.size("missing") == 0).alias("accepted"),
        F.count_if(F.size("missing") > 0).alias("rejected"))
    good = ingest_ops.parse_records(tagged.where(F.size("missing") == 0), keys)
    cache = read_raw_if_exists(spark, cache_path)
    has_cache = "id" in cache.columns and not cache.isEmpty()
    cached = cache.select("id") if has_cache else spark.createDataFrame([], "id string")
    if requested is not None:
        _, new = ingest_ops.gap_fill(cached, good, requested)
    else:  # every accepted id not cached yet (the observed frame appears once)
        known = cached.select(F.col("id").try_cast("bigint").alias("_id")).where(F.col("_id").isNotNull())
        new = good.withColumn("_id", F.col("id").try_cast("bigint")) \
            .join(known, "_id", "left_anti").drop("_id")
    appended = Observation("appended")
    new.observe(appended, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(cache_path)
    counts, added = observed(obs), observed(appended)
    run = IngestRun(cache_path=cache_path, accepted=int(counts.get("accepted") or 0),
                    rejected=int(counts.get("rejected") or 0), appended=int(added.get("rows") or 0))
    if rejects_path and run.rejected:
        # the landing folder is read whole each run: its rejects replace the last run's
        tagged.where(F.size("missing") > 0).select(
            F.col("value").alias("record"), F.array_join("missing", "|").alias("missing")) \
            .write.mode("overwrite").parquet(rejects_path)
    if run.accepted == 0 and not has_cache:
        raise ingest_ops.NoUsableRecords("no usable title record in the landing folder and no cache")
    if run.appended == 0 and has_cache:
        log.warning("nothing new to load; keeping the %s cache as it is", cache_path)
    log.info("ingest: %d accepted, %d rejected, %d appended", run.accepted, run.rejected, run.appended)
    return run


def refresh_clean(spark: SparkSession, raw_all: DataFrame, changed: DataFrame, clean_path: str,
                  out_path: str, fmt: str = "parquet",
                  as_of: str | _dt.date | None = None) -> DataFrame:
    """The clean catalogue after new raw records arrived, recomputing only
    the ids they touch; equal to cleaning ``raw_all`` from scratch.

    Every cleaning rule is per row or per id (the dedupe), so the clean
    rows of untouched ids cannot change: they are kept from
    ``clean_path`` by an anti-join, the touched ids' raw rows (all of
    them, old and new) are cleaned again, and the union is written to
    ``out_path`` (a new location: ``clean_path`` is being read). ``changed``
    holds the ``id`` of every new raw record, e.g. the ids in the landing
    folder ``ingest_landing`` read. Any superset is fine: an extra id is
    simply cleaned again, to the same rows. The re-cleaned part passes the same gates as ``preprocess``
    (observed on the one write) before the output is marked checked."""
    if out_path.rstrip("/") == clean_path.rstrip("/"):
        raise ValueError("refresh_clean must write to a new location")
    touched = changed.select(F.col("id").try_cast("bigint").alias("_id")) \
        .where(F.col("_id").isNotNull()).distinct()
    affected = raw_all.withColumn("_id", F.col("id").try_cast("bigint")) \
        .join(touched, "_id", "left_semi").drop("_id")
    recleaned, obs = clean_with_metrics(affected, as_of)
    kept = read_clean(spark, clean_path, fmt).join(touched.withColumnRenamed("_id", "id"), "id", "left_anti")
    with staged(spark, out_path) as stage:
        write_clean(kept.unionByName(recleaned), stage, fmt)
        # the parse gates judge a whole catalogue; a delta may well hold no
        # genre at all, so only its ids are gated
        run = _run_of(obs, out_path)
        _confirm({"final": obs["final"]}, read_clean(spark, stage, fmt), whole=False)
        if int(observed(obs["final"]).get("null_ids") or 0):
            raise quality.QualityError("null ids in the refreshed catalogue")
        _write_marker(spark, [("refresh", k, v) for _, k, v in run.as_rows()], stage)
    return read_clean(spark, out_path, fmt)


def checked_marker(out_path: str) -> str:
    """Where ``preprocess`` records that an output passed its gates: a
    ``_checked`` folder inside the output, which Spark's file listing
    ignores (names starting with ``_``)."""
    return f"{out_path.rstrip('/')}/_checked"


def kpi_tables(clean: DataFrame, approx_median: bool = False, ranked: DataFrame | None = None,
               points_per_year: int | None = None) -> dict[str, DataFrame]:
    """Every report of the catalogue, by name. ``approx_median`` trades the
    exact medians for bounded-memory ``percentile_approx``; ``ranked``
    (``rank_all`` of the catalogue, stored) serves the ten rankings without
    another scan; ``points_per_year`` samples the point feeds."""
    if ranked is None:
        out = {name: fn(clean) for name, fn in ranking.ALL_RANKINGS.items()}
    else:
        out = {name: ranking.ranking_of(ranked, name) for name in ranking.RANKINGS}
    out["search_scifi_action_bruce_willis"] = search.search_scifi_action_bruce_willis(clean)
    out["search_thurman_tarantino"] = search.search_thurman_tarantino(clean)
    out["franchise_vs_standalone"] = groups.franchise_vs_standalone(clean, approx=approx_median)
    out["franchise_summary"] = groups.franchise_summary(clean)
    out["director_summary"] = groups.director_summary(clean)
    for name, feed in feeds.all_feeds(clean, approx_median, points_per_year).items():
        out[f"feed_{name}"] = feed
    out["feed_breakeven"] = feeds.breakeven_end(clean)
    return out


def run(spark: SparkSession, raw: DataFrame, out_dir: str, fmt: str = "parquet",
        as_of: str | _dt.date | None = None, expected_rows: int | None = None,
        parallel: int = 4, approx_median: bool = False,
        refresh_from: str | None = None, changed: DataFrame | None = None,
        points_per_year: int | None = None) -> dict[str, str]:
    """Whole job: clean once, then write every KPI table under
    ``out_dir``. With ``refresh_from`` (an earlier clean output) and
    ``changed`` (ids of the new raw records) only the touched ids are
    cleaned again (``refresh_clean``). The ten rankings come from one scan,
    written as ``rankings``. The KPI writes are independent reads of the
    clean table; up to ``parallel`` are submitted at once and Spark's scheduler shares
    the cluster between them. A failure names the stage it happened in."""
    import queue

    from pyspark import InheritableThread

    base = out_dir.rstrip("/")
    stage = "preprocessing"
    if (refresh_from is None) != (changed is None):
        raise ValueError("an incremental run needs both refresh_from and changed")
    try:
        if refresh_from is not None and changed is not None:
            clean = refresh_clean(spark, raw, changed, refresh_from, f"{base}/clean", fmt, as_of)
        else:
            clean, _ = preprocess(spark, raw, f"{base}/clean", fmt, as_of, expected_rows)
        stage = "analysis"
        paths = {"clean": f"{base}/clean", "metrics": checked_marker(f"{base}/clean")}
        ranked = f"{base}/rankings"
        ranking.rank_all(clean).write.mode("overwrite").parquet(ranked)
        paths["rankings"] = ranked
        tables = kpi_tables(clean, approx_median, spark.read.parquet(ranked), points_per_year)

        todo: queue.Queue = queue.Queue()
        for name in tables:
            todo.put(name)
        failures: list[StageError] = []

        def worker() -> None:
            # InheritableThread carries the caller's job group / description,
            # so these jobs can be tracked and cancelled with the caller's
            while not failures:
                try:
                    name = todo.get_nowait()
                except queue.Empty:
                    return
                path = f"{base}/{name}"
                try:
                    tables[name].write.mode("overwrite").options(
                        **(CSV_WRITE if fmt == "csv" else {})).format(fmt).save(path)
                    paths[name] = path
                except Exception as e:  # noqa: BLE001 - re-raised with the KPI's name
                    failures.append(StageError(f"analysis:{name}", e))

        threads = [InheritableThread(target=worker) for _ in range(max(1, parallel))]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
        if failures:
            raise failures[0]
        return {"clean": paths["clean"], "metrics": paths["metrics"], "rankings": paths["rankings"],
                **{n: paths[n] for n in tables}}
    except StageError:
        raise
    except Exception as e:  # noqa: BLE001 - re-raised with the stage name
        log.exception("job failed during the '%s' stage", stage)
        raise StageError(stage, e) from e
