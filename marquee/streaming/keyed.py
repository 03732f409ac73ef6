"""Ingest of an unbounded stream by keyed state.

``landing`` compares every micro-batch with all cached ids, so a batch costs
more as the cache grows. Here Spark keeps one state entry per id for as long
as a repeat can still be told from a late record: ids are deduplicated
within the watermark, and entries are dropped once it has passed. A batch
reads its own files and the state, never the cache.

A record is *late* when its event time is not after the watermark, the
greatest event time of earlier batches less ``delay``; Spark drops it from
the state's input, and it is kept in a side table. After the delay a
repeated id is a new record to the stream; the cleaning keeps one row per id
in any case.

Every epoch writes folders of its own and replaces them when it is run
again, so a replayed batch leaves nothing twice. For many ids set
``spark.sql.streaming.stateStore.providerClass`` to the RocksDB provider.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.schemas import REQUIRED_KEYS
from marquee.sources.ingest import missing_keys, parse_records


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    return spark.createDataFrame([], schema)


ROWS = "value string, missing array<string>, event timestamp, kind string, epoch bigint"
MARKS = "greatest timestamp, epoch bigint"


def _watermark(spark: SparkSession, base: str, epoch: int, delay: str):
    """The watermark that ``epoch`` runs with; null in the first one."""
    marks = _read(spark, f"{base}/marks", MARKS).where(F.col("epoch") < epoch)
    return marks.agg((F.max("greatest") - F.expr(f"INTERVAL {delay}")).alias("at")).first()["at"]


def _write(batch: DataFrame, epoch: int, base: str, delay: str) -> None:
    """One micro-batch: its rows (one action), then, from what was written,
    the late records and the greatest event time. Of a usable record in time
    the row ``seen`` holds the event time alone: its text is in the row
    ``new``, once an id."""
    spark = batch.sparkSession
    at = f"{base}/rows/epoch={epoch}"
    low = _watermark(spark, base, epoch, delay)
    is_late = F.lit(low is not None) & (F.size("missing") == 0) & (F.col("event") <= F.lit(low))
    is_kept = (F.col("kind") != "seen") | (F.size("missing") > 0) | F.coalesce(is_late, F.lit(False))
    batch.withColumn("value", F.when(is_kept, F.col("value"))).write.mode("overwrite").partitionBy("kind").parquet(at)
    own = _read(spark, at, ROWS.removesuffix(", epoch bigint"))
    seen = own.where("kind = 'seen'")
    late = seen.where(is_late)
    late.select("value", "event").write.mode("overwrite").parquet(f"{base}/late/epoch={epoch}")
    seen.where(F.size("missing") == 0).agg(F.max("event").alias("greatest")).where(
        "greatest IS NOT NULL").write.mode("overwrite").parquet(f"{base}/marks/epoch={epoch}")


def start_keyed(spark: SparkSession, landing_dir: str, base: str, event_key: str, delay: str,
                required: Sequence[str] = REQUIRED_KEYS, once: bool = True,
                max_files_per_trigger: int | None = None, interval: str = "30 seconds") -> StreamingQuery:
    """Start the stream from ``landing_dir`` into the folders under ``base``.
    ``event_key`` names the key of a record's event time; a record without a
    usable one, or without an integer id, is rejected."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    base = base.rstrip("/")
    text = F.col("value")
    event = F.try_to_timestamp(F.get_json_object(text, f"$.{event_key}"))
    key = F.get_json_object(text, "$.id").try_cast("bigint")
    unusable = F.filter(F.array(F.when(event.isNull(), F.lit(event_key)), F.when(key.isNull(), F.lit("id"))),
                        lambda x: x.isNotNull())
    seen = reader.load(landing_dir).select(
        text, F.array_union(missing_keys("value", required), unusable).alias("missing"), event.alias("event"),
        key.alias("key"))
    # nothing is missing here: not worked out again
    fresh = (seen.where(F.size("missing") == 0).withColumn("missing", F.array().cast("array<string>")).withWatermark("event", delay)
             .dropDuplicatesWithinWatermark(["key"]).withColumn("kind", F.lit("new")))
    rows = seen.withColumn("kind", F.lit("seen")).unionByName(fresh).drop("key")
    writer = (rows.writeStream.outputMode("append")
              .foreachBatch(lambda df, epoch: _write(df, epoch, base, delay))
              .option("checkpointLocation", f"{base}/checkpoint"))
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start()


def ingest_keyed(spark: SparkSession, landing_dir: str, base: str, event_key: str, delay: str,
                 required: Sequence[str] = REQUIRED_KEYS) -> StreamingQuery:
    """Take in what the landing folder holds now, from where the checkpoint
    stands; returns the finished query."""
    q = start_keyed(spark, landing_dir, base, event_key, delay, required)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return q


def keyed_cache(spark: SparkSession, base: str, keys: Sequence[str]) -> DataFrame:
    """The accepted records in raw-cache shape."""
    return parse_records(_read(spark, f"{base.rstrip('/')}/rows", ROWS).where("kind = 'new'"), keys)


def late_records(spark: SparkSession, base: str) -> DataFrame:
    """(value, event, epoch) of the records that came after the watermark."""
    return _read(spark, f"{base.rstrip('/')}/late", "value string, event timestamp, epoch bigint")


def rejected_records(spark: SparkSession, base: str) -> DataFrame:
    """(record, missing, epoch) of the records that lack a key or a usable
    event time or id."""
    return _read(spark, f"{base.rstrip('/')}/rows", ROWS).where("kind = 'seen' AND size(missing) > 0").select(
        F.col("value").alias("record"), F.array_join("missing", "|").alias("missing"), "epoch")
