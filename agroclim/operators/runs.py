"""Ingestion runs: one record per batch id with its rows, failed chunks and one status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agroclim.constants import SOURCE_AGRI_FALLBACK

WEATHER, AGRICULTURE = "weather_daily", "agriculture_regional"
STATUS_OK, STATUS_DEGRADED, STATUS_FAILED = 0, 1, 2
SKIPPED = "skipped"


def run_status(failed_chunks, agriculture_source):
    """The status column of a run that ended: degraded when a chunk failed or agriculture
    fell back to the mock after a read error, else ok (a run that raised is ``STATUS_FAILED``)."""
    degraded = (F.coalesce(failed_chunks, F.lit(0)) > 0) | F.coalesce(agriculture_source == SOURCE_AGRI_FALLBACK, F.lit(False))
    return F.when(degraded, STATUS_DEGRADED).otherwise(STATUS_OK)


def ingest_summary(loads: DataFrame, failed: DataFrame) -> DataFrame:
    """One row per run: batch_id, weather_rows, agriculture_rows, failed_chunks,
    agriculture_source and status.

    ``loads``: batch_id, table, source, rows (any number of rows per batch); ``failed``:
    batch_id, failed_chunks. A run that loaded nothing but failed chunks is listed too.
    Of several agriculture sources in a run the fallback is shown, else the greatest.
    """
    def rows_of(table: str):
        return F.coalesce(F.sum(F.when(F.col("table") == table, F.col("rows"))), F.lit(0))

    source = F.when(F.col("table") == AGRICULTURE, F.col("source"))
    runs = loads.groupBy("batch_id").agg(
        rows_of(WEATHER).alias("weather_rows"),
        rows_of(AGRICULTURE).alias("agriculture_rows"),
        F.when(F.count_if(source == SOURCE_AGRI_FALLBACK) > 0, F.lit(SOURCE_AGRI_FALLBACK)).otherwise(F.max(source)).alias("agriculture_source"),
    )
    failures = failed.groupBy("batch_id").agg(F.sum("failed_chunks").alias("failed_chunks"))
    both = runs.join(failures, "batch_id", "full")
    failed_chunks, rows = F.coalesce("failed_chunks", F.lit(0)), [F.coalesce(c, F.lit(0)).alias(c) for c in ("weather_rows", "agriculture_rows")]
    return both.select(
        "batch_id", *rows, failed_chunks.alias("failed_chunks"),
        F.coalesce("agriculture_source", F.lit(SKIPPED)).alias("agriculture_source"),
        run_status(failed_chunks, F.col("agriculture_source")).alias("status"),
    )
