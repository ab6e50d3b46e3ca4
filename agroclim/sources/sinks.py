"""Sinks: bronze landing, silver writes, CSV exports and the JDBC staging load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroclim.constants import REGIONS, SERVING_COLUMNS
from agroclim.operators.silver import PARTITIONS, with_partitions
from agroclim.schemas import DIM_REGION

BOM = "\ufeff"


def land_bronze_weather(payloads: DataFrame, root: str, ingest_date: str) -> None:
    """Land raw payloads under ingest_date=/region_code=/range_start=; landing one of
    these again replaces it, so the newest landing of a day counts.

    ``payloads``: region_code, range_start, and the payload fields (daily, ...). The
    range start in the path keeps two same-day backfills of one region apart.
    """
    (
        payloads.withColumn("ingest_date", F.lit(ingest_date))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_date", "region_code", "range_start")
        .json(root)
    )


def land_bronze_agriculture(rows: DataFrame, root: str, ingest_date: str, source: str) -> None:
    """Land the CSV drop under ingest_date=/source=, header, every field quoted; a
    repeated landing of the same day and source replaces the earlier one."""
    (
        rows.withColumn("ingest_date", F.lit(ingest_date))
        .withColumn("source", F.lit(source))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_date", "source")
        .option("header", True)
        .option("quoteAll", True)
        .option("escape", '"')
        .csv(root)
    )


def write_silver_weather(df: DataFrame, path: str, full: bool = False) -> None:
    """Silver weather as Parquet partitioned by year and month, rows sorted by region and
    day inside each file (the (region, date) access path). A ``full`` recompute replaces
    the whole table; otherwise only the months present in ``df`` are replaced.

    The rebalance hint deals the rows by month; adaptive execution splits a month beyond
    the advisory partition size over several tasks and packs small ones together, so no
    month is one task and files are neither tiny nor unbounded.
    """
    out = with_partitions(df).hint("rebalance", *[F.col(c) for c in PARTITIONS])
    (
        out.sortWithinPartitions(*PARTITIONS, "region_code", "observation_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if full else "dynamic")
        .partitionBy(*PARTITIONS)
        .parquet(path)
    )


def write_silver_agriculture(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def export_csv(view: DataFrame, path: str) -> None:
    """One CSV file with a header and a UTF-8 byte-order mark (spreadsheet export).

    For report views (region x year rows): the view is written by one task so the
    mark opens the single file. The mark is carried by the first header name.
    """
    first, *rest = view.columns
    marked = view.withColumnRenamed(first, BOM + first)
    marked.coalesce(1).write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def region_rows(spark: SparkSession) -> DataFrame:
    """The fixed region reference rows (altitude as a float)."""
    return spark.createDataFrame([tuple(r) for r in REGIONS], DIM_REGION)


def export_dim_region(spark: SparkSession, path: str) -> None:
    """Write the region reference rows as the seed CSV."""
    region_rows(spark).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def staging_frame(df: DataFrame, table: str) -> DataFrame:
    """The serving projection of ``table``; refuses an empty frame (a failed upstream
    load must never empty the serving tables)."""
    selected = df.select(*SERVING_COLUMNS[table])
    if selected.isEmpty():
        raise ValueError(f"gold/{table} is empty: staging load cancelled")
    return selected


def write_jdbc_staging(df: DataFrame, table: str, url: str, properties: dict[str, str], batchsize: int = 5000) -> None:
    """Replace staging.<table> over JDBC, keeping the table definition (truncate)."""
    (
        staging_frame(df, table)
        .write.format("jdbc")
        .option("url", url)
        .option("dbtable", f"staging.{table}")
        .options(**properties)
        .option("truncate", "true")
        .option("batchsize", batchsize)
        .mode("overwrite")
        .save()
    )
