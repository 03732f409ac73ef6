"""Incremental ingest of a landing folder with Structured Streaming.

New JSON-lines files in the landing folder are picked up by a file
stream; each micro-batch is validated (required keys), parsed into the
raw-cache shape and appended to the cache, taking only ids the cache
does not hold yet. Rejected lines go to a rejects table with the keys
they lack.

Exactly-once in effect: the stream's checkpoint records which files were
processed, the Parquet commit protocol makes each write all-or-nothing,
the anti-join on cached ids makes a replayed batch append no record
twice, and a batch's rejects overwrite their own ``epoch=<n>`` folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.sources.ingest import ingest
from marquee.sources.raw import read_raw_if_exists


def append_new(batch: DataFrame, cache_path: str, rejects_path: str, keys: Sequence[str],
               epoch: int | None = None) -> None:
    """One micro-batch: validate, parse, append the ids not cached yet.
    Rejects of a batch go to their own ``epoch=<n>`` folder, overwritten
    on a replay of that batch, so they are never written twice."""
    spark = batch.sparkSession
    good, bad = ingest(batch, keys)
    cache = read_raw_if_exists(spark, cache_path)
    if "id" in cache.columns:
        cached = cache.select(F.col("id").try_cast("bigint").alias("_id")).where(F.col("_id").isNotNull())
        good = good.withColumn("_id", F.col("id").try_cast("bigint")) \
            .join(cached, "_id", "left_anti").drop("_id")
    good.write.mode("append").parquet(cache_path)
    rejects = bad.select(F.col("value").alias("record"), F.array_join("missing", "|").alias("missing"))
    if epoch is None:
        rejects.write.mode("append").parquet(rejects_path)
    else:
        rejects.write.mode("overwrite").parquet(f"{rejects_path.rstrip('/')}/epoch={epoch}")


def start_ingest(spark: SparkSession, landing_dir: str, cache_path: str, rejects_path: str,
                 checkpoint: str, keys: Sequence[str], once: bool = True,
                 max_files_per_trigger: int | None = None,
                 interval: str = "30 seconds") -> StreamingQuery:
    """Start the landing -> cache stream. ``once`` processes what is there
    now and stops (``availableNow``); otherwise it polls every ``interval``."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(landing_dir)
    writer = (lines.writeStream
              .foreachBatch(lambda df, epoch: append_new(df, cache_path, rejects_path, keys, epoch))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)
    return writer.start()


def ingest_folder(spark: SparkSession, landing_dir: str, cache_path: str, rejects_path: str,
                  checkpoint: str, keys: Sequence[str]) -> DataFrame:
    """Run the stream over what the landing folder holds now; returns the
    cache."""
    q = start_ingest(spark, landing_dir, cache_path, rejects_path, checkpoint, keys, once=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(cache_path)
