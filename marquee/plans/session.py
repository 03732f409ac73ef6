"""Session settings and lineage cuts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "marquee",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on, UTC)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "8g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_settings(input_bytes: int, total_cores: int,
                   target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Settings sized for an input of ``input_bytes`` on ``total_cores``.

    Shuffle partitions: enough that each holds about
    ``target_partition_bytes`` of the (pre-aggregation) input, and at least
    two waves of tasks, so partitions fit executor memory without spilling
    at 100 TB (about 400k partitions) and AQE can coalesce small ones.
    Scan splits match the same size. Skew handling splits any shuffle
    partition five times the median and above 1 GiB."""
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }


def apply_settings(spark: SparkSession, settings: dict[str, str]) -> None:
    """Set runtime SQL settings on a session (shuffle sizing, AQE)."""
    for k, v in settings.items():
        spark.conf.set(k, v)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``. Only when it is unset (local runs, tests) is
    a fresh scratch folder created for it; elsewhere that folder would be
    another one on every machine, so an unset setting raises. Works on Spark
    Connect sessions too (no SparkContext there: the setting is only read)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    d = spark.conf.get(CHECKPOINT_KEY, None) or (sc.getCheckpointDir() if sc else None)
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not str(master).startswith("local") or str(master).startswith("local-cluster"):
            raise RuntimeError(f"{CHECKPOINT_KEY} must name a folder that all machines share")
        d = tempfile.mkdtemp(prefix="marquee-ckpt-")
        try:
            spark.conf.set(CHECKPOINT_KEY, d)
        except Exception:  # noqa: BLE001 - some deployments reject core confs at run time
            pass
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives
    executor loss, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else f"{base.rstrip('/')}/{name}"
