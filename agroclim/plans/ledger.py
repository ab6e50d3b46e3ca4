"""The run ledger: one record per ingestion run, written by the run itself.

A run loads its sources one after the other, each in its own upsert, so a source that
fails does not undo another. Its record (batch id, rows per source, failed chunks,
agriculture source, status, message) is appended to ``<root>/runs`` at the end, also when
the run raises: status 2, and the error goes on to the caller.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroclim.constants import SOURCE_AGRI_FALLBACK
from agroclim.operators import runs
from agroclim.plans.upsert import new_batch_id

RUN_SCHEMA = "batch_id string, weather_rows bigint, agriculture_rows bigint, rejected_rows bigint, failed_chunks bigint, agriculture_source string, status int, message string"


class Run:
    """One ingestion run; use as a context manager."""

    def __init__(self, spark: SparkSession, root: str, batch_id: str | None = None):
        self.spark, self.root, self.batch_id = spark, root.rstrip("/"), batch_id or new_batch_id()
        self.rows = {runs.WEATHER: 0, runs.AGRICULTURE: 0}
        self.rejected = self.failed_chunks = 0
        self.agriculture_source = runs.SKIPPED
        self.status, self.message = runs.STATUS_OK, ""

    def loaded(self, table: str, rows: int, source: str | None = None) -> None:
        self.rows[table] += rows
        if table == runs.AGRICULTURE and source:
            self.agriculture_source = source

    def failed(self, chunks: int) -> None:
        self.failed_chunks += chunks

    def __enter__(self) -> Run:
        return self

    def __exit__(self, kind, error, trace) -> bool:
        if error is not None:
            self.status, self.message = runs.STATUS_FAILED, f"{kind.__name__}: {error}"[:1000]
        elif self.failed_chunks or self.agriculture_source == SOURCE_AGRI_FALLBACK:
            self.status = runs.STATUS_DEGRADED
        record = (self.batch_id, self.rows[runs.WEATHER], self.rows[runs.AGRICULTURE], self.rejected, self.failed_chunks, self.agriculture_source, self.status, self.message)
        self.spark.createDataFrame([record], RUN_SCHEMA).withColumn("ended_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{self.root}/runs")
        return False


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/runs")
