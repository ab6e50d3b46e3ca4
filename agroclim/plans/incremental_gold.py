"""Gold kept current from corrections: totals per region and month, touched months only.

The gold tables are derived from sums and counts of days (``gold.DAILY_TOTALS``), which
merge by addition. They are stored per region and month beside the gold tables; after a
correction only the months it touched are read from silver and their totals replaced, and
the marts are rebuilt from the stored totals, a few rows per region and year. Sums are
DECIMAL, so the result equals a full run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroclim.operators import gold
from agroclim.operators.silver import PARTITIONS
from agroclim.plans import serving
from agroclim.plans.upsert import in_partitions
from agroclim.schemas import SILVER_WEATHER

TOTALS = "region_month_totals"


def touched_months(batch: DataFrame, date_col: str = "observation_date") -> list[tuple[int, int]]:
    """The (year, month) pairs of a batch: calendar months, a short list."""
    months = batch.select(F.year(date_col).alias("year"), F.month(date_col).alias("month")).distinct()
    return sorted(tuple(r) for r in months.collect())


def store_totals(spark: SparkSession, silver_root: str, gold_root: str, months: Sequence[tuple[int, int]] | None = None) -> None:
    """Compute the totals of the listed months (default: all) and replace them in the store."""
    # an explicit schema: not even a footer of another month is opened
    weather = spark.read.schema(SILVER_WEATHER).parquet(f"{silver_root.rstrip('/')}/weather_daily")
    if months is not None:
        weather = in_partitions(weather, PARTITIONS, months)
    totals = gold.day_totals(weather, F.year("observation_date").alias("year"), F.month("observation_date").alias("month"))
    writer = totals.write.mode("overwrite").option("partitionOverwriteMode", "static" if months is None else "dynamic")
    writer.partitionBy(*PARTITIONS).parquet(f"{gold_root.rstrip('/')}/{TOTALS}")


def stored_region_years(spark: SparkSession, silver_root: str, gold_root: str) -> DataFrame:
    """The region x year table from the stored totals and silver agriculture."""
    totals = spark.read.parquet(f"{gold_root.rstrip('/')}/{TOTALS}")
    merged = gold.merge_totals(totals.withColumn("year", F.col("year").cast("int")))
    return gold.region_year_of(merged, spark.read.parquet(f"{silver_root.rstrip('/')}/agriculture_regional"))


def refresh_gold(
    spark: SparkSession, silver_root: str, dim_region: DataFrame, gold_root: str, months: Sequence[tuple[int, int]] | None = None
) -> dict[str, int]:
    """Refresh the totals of ``months`` (default: all) and rebuild the gold tables from the
    stored totals; returns the row counts."""
    store_totals(spark, silver_root, gold_root, months)
    return serving.write_gold(spark, stored_region_years(spark, silver_root, gold_root), dim_region, gold_root)
