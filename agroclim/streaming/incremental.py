"""Incremental bronze -> silver weather with Structured Streaming.

New payload files are picked up by the file source, exploded to daily rows, typed,
reduced to the newest ingestion per (region_code, date) inside the micro-batch, and
merged into silver so that the newer of batch and table wins per key. Late data is
not dropped by a watermark: a correction arriving days later (newer ingest_date)
replaces the stored day, while an older re-delivery never overwrites a newer one.
Only the months that a micro-batch touches are read and rewritten, and a micro-batch
that was applied before (its number is kept with the table) does nothing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agroclim.operators.silver import coerce_raw_weather, explode_daily, latest_wins, stg_weather
from agroclim.plans.upsert import apply_once, month_of, upsert
from agroclim.schemas import BRONZE_WEATHER, WEATHER_KEYS
from agroclim.sources.bronze import WEATHER_INGEST_ORDER, WEATHER_LAYOUT

INGEST_ORDER = WEATHER_INGEST_ORDER

# Payload fields plus the partition columns of the bronze layout (text).
STREAM_SCHEMA = T.StructType(
    BRONZE_WEATHER.fields
    + [T.StructField(name, T.StringType()) for name in ("ingest_date", "region_code", "range_start")]
)


def bronze_to_raw(payloads: DataFrame) -> DataFrame:
    """Payload rows (with ingest_date, region_code, range_start, _file) -> typed raw
    daily rows carrying their ingest order."""
    daily = explode_daily(payloads, extra=list(INGEST_ORDER))
    return coerce_raw_weather(daily)


def silver_rows(payloads: DataFrame) -> DataFrame:
    """Newest ingestion per (region_code, date) of a set of payloads, as silver rows
    (plus the ingest-order columns used to compare with the stored rows)."""
    newest = latest_wins(bronze_to_raw(payloads), WEATHER_KEYS, INGEST_ORDER)
    # same silver columns as the batch job, so both can maintain one table
    return stg_weather(newest.withColumn("_ingested_at", F.to_timestamp("ingest_date")), keep=INGEST_ORDER)


def merge_into_silver(spark: SparkSession, batch: DataFrame, silver_path: str) -> int:
    """Merge one micro-batch into silver (touched months only); returns the days it brought."""
    return upsert(
        spark,
        silver_path,
        silver_rows(batch),
        ["region_code", "observation_date"],
        partitions=month_of("observation_date"),
        newest_wins=list(INGEST_ORDER),
    )


def apply_batch(batch: DataFrame, batch_id: int, silver_path: str, stream: str) -> int | None:
    """Merge micro-batch ``batch_id`` of ``stream`` once; None if it was applied before."""
    spark = batch.sparkSession
    return apply_once(spark, silver_path, f"{stream}-{batch_id:012d}", lambda: merge_into_silver(spark, batch, silver_path))


def stream_bronze_to_silver(
    spark: SparkSession,
    bronze_root: str,
    silver_path: str,
    checkpoint_location: str,
    max_files_per_trigger: int = 1000,
    available_now: bool = True,
):
    """Start the incremental job; returns the StreamingQuery.

    ``trigger(availableNow=True)`` processes everything new in bounded micro-batches
    and stops (the daily schedule); ``available_now=False`` keeps it running.
    """
    base = bronze_root.rstrip("/")
    source = (
        spark.readStream.schema(STREAM_SCHEMA)
        .option("multiLine", True)
        .option("basePath", base)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .json(f"{base}/{WEATHER_LAYOUT}")
        .withColumn("_file", F.input_file_name())
    )

    # the checkpoint's place names the stream: a new checkpoint counts its batches anew
    stream = hashlib.sha256(checkpoint_location.rstrip("/").encode()).hexdigest()[:16]

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, silver_path, stream)

    writer = source.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
