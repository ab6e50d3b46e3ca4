"""The batch jobs of a deployment: bronze -> silver, silver -> gold, gold -> serving.

Each job reads what the previous one wrote (no in-memory hand-off), so a failed job
is re-run alone and a lost executor recomputes from files, not from a long lineage.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroclim.constants import ISO_CODE_PATTERN, LOOKBACK_DAYS, MOCK_PREFIX
from agroclim.functions.numbers import parse_decimal, parse_year
from agroclim.operators import cleaning, gold, planning, runs, silver
from agroclim.operators.quality import assert_clean, missing_from
from agroclim.operators.report import merge_kpis
from agroclim.plans import serving
from agroclim.plans.ledger import Run
from agroclim.plans.upsert import assert_unique_keys, counted_write, in_partitions, upsert_agriculture, upsert_weather
from agroclim.schemas import AGRICULTURE_KEYS, SILVER_WEATHER, WEATHER_KEYS
from agroclim.sources import bronze, files, sinks

from agroclim.sources.bronze import WEATHER_INGEST_ORDER  # noqa: E402


def silver_weather_from_bronze(spark: SparkSession, bronze_root: str) -> DataFrame:
    """Bronze payloads -> daily rows (region from the path) -> NUMERIC typing ->
    newest ingestion per (region_code, date) -> silver columns + ``year``."""
    payloads = bronze.read_bronze_weather(spark, f"{bronze_root.rstrip('/')}/openmeteo")
    daily = silver.coerce_raw_weather(silver.explode_daily(payloads, extra=list(WEATHER_INGEST_ORDER)))
    newest = silver.latest_wins(daily, WEATHER_KEYS, WEATHER_INGEST_ORDER)
    return silver.with_partitions(
        silver.stg_weather(newest.withColumn("_ingested_at", F.to_timestamp("ingest_date")), keep=WEATHER_INGEST_ORDER)
    )


def silver_agriculture_from_bronze(
    spark: SparkSession, bronze_root: str, aliases: DataFrame, code_pattern: str = ISO_CODE_PATTERN
) -> DataFrame:
    """Bronze CSV drops -> region code by alias (accent/case-insensitive) -> parsed
    year and numbers -> newest ingest per (region_code, annee), ties broken by
    source with real data before mock -> silver columns."""
    raw = bronze.read_bronze_agriculture(spark, f"{bronze_root.rstrip('/')}/agriculture")
    renamed = cleaning.normalize_columns(raw)
    cleaning.validate_columns(renamed, origin=bronze_root)
    resolved = cleaning.resolve_region(renamed, "region_code", aliases, code_pattern, out_col="_code")
    rows = resolved.select(
        F.col("_code").alias("region_code"),
        parse_year(F.col("annee")).alias("annee"),
        *[parse_decimal(F.col(m)).alias(m) for m in cleaning.MEASURES],
        F.col("source").alias("_source"),
        "ingest_date",
        (~F.col("source").startswith(MOCK_PREFIX)).alias("_real"),
    ).where(F.col("region_code").isNotNull() & F.col("annee").isNotNull())
    # Two labels of one load resolving to the same region-year (legacy names) would
    # make the result depend on row order: refuse, as a keyed insert would.
    assert_unique_keys(rows, [*AGRICULTURE_KEYS, "ingest_date", "_source"])
    newest = silver.latest_wins(rows, AGRICULTURE_KEYS, ["ingest_date", "_real", "_source"])
    typed = silver.coerce_raw_agriculture(newest.drop("_real"))
    return silver.stg_agriculture(typed.withColumn("_ingested_at", F.to_timestamp("ingest_date")))


def bronze_to_silver(spark: SparkSession, bronze_root: str, silver_root: str, aliases: DataFrame) -> dict[str, int]:
    root = silver_root.rstrip("/")
    weather = silver_weather_from_bronze(spark, bronze_root)
    agriculture = silver_agriculture_from_bronze(spark, bronze_root, aliases)
    sinks.write_silver_weather(weather, f"{root}/weather_daily", full=True)
    sinks.write_silver_agriculture(agriculture, f"{root}/agriculture_regional")
    return {
        "weather_daily": spark.read.parquet(f"{root}/weather_daily").count(),
        "agriculture_regional": spark.read.parquet(f"{root}/agriculture_regional").count(),
    }


def record_rejects(rows: DataFrame, aliases: DataFrame, dim: DataFrame, root: str, batch_id: str, code_pattern: str = ISO_CODE_PATTERN) -> int:
    """Keep what cleaning drops: rows of unknown region or year (``agriculture_rejects``) and
    the regions of ``dim`` without any clean row (``agriculture_absent``), by batch id.
    Returns the number of rejected rows."""
    base = root.rstrip("/")
    rejects = cleaning.agriculture_rejects(rows, aliases, code_pattern).withColumn("batch_id", F.lit(batch_id))
    n = counted_write(rejects, f"{base}/agriculture_rejects", mode="append")
    absent = missing_from(dim, cleaning.clean_agriculture(rows, aliases, code_pattern)).withColumn("batch_id", F.lit(batch_id))
    counted_write(absent, f"{base}/agriculture_absent", mode="append")
    return n


def ingest(
    spark: SparkSession,
    root: str,
    weather: DataFrame | None = None,
    agriculture: tuple[DataFrame, str] | None = None,
    aliases: DataFrame | None = None,
    dim: DataFrame | None = None,
    failed_chunks: DataFrame | None = None,
    batch_id: str | None = None,
) -> Run:
    """One ingestion run into the raw tables under ``root``, with its record in the ledger.

    ``weather``: daily rows (region_code, date, measures); ``agriculture``: canonical text
    rows and their source tag (``bronze.load_agriculture``), with ``aliases`` and ``dim``
    to resolve and check regions; ``failed_chunks``: the request chunks that failed. A
    source left out is skipped. Returns the run (its ``status`` is 0 or 1); an error is
    recorded as status 2 and raised. Both sources carry the run's batch id.
    """
    base = root.rstrip("/")
    with Run(spark, base, batch_id) as run:
        if failed_chunks is not None:
            run.failed(failed_chunks.count())
        if weather is not None:
            rows = silver.coerce_raw_weather(weather)
            run.loaded(runs.WEATHER, upsert_weather(spark, f"{base}/{runs.WEATHER}", rows, run.batch_id))
        if agriculture is not None:
            rows, source = agriculture
            run.rejected = record_rejects(rows, aliases, dim, base, run.batch_id)
            clean = silver.coerce_raw_agriculture(cleaning.clean_agriculture(rows, aliases))
            run.loaded(runs.AGRICULTURE, upsert_agriculture(spark, f"{base}/{runs.AGRICULTURE}", clean, source, run.batch_id), source)
    return run


def read_silver(spark: SparkSession, silver_root: str) -> tuple[DataFrame, DataFrame]:
    root = silver_root.rstrip("/")
    return spark.read.parquet(f"{root}/weather_daily"), spark.read.parquet(f"{root}/agriculture_regional")


def newest_day(spark: SparkSession, silver_root: str):
    """The newest observed day of silver weather: the newest month is told by the partition
    folders' names, and of its files one column is read."""
    root = f"{silver_root.rstrip('/')}/weather_daily"

    def newest(folder: str, key: str) -> int | None:
        return max((int(n.split("=")[1]) for n in files.names(spark, folder) if n.startswith(f"{key}=") and n.split("=")[1].isdigit()), default=None)

    year = newest(root, "year")
    month = None if year is None else newest(f"{root}/year={year}", "month")
    if month is None:
        return None
    days = spark.read.schema(SILVER_WEATHER).parquet(root).where((F.col("year") == str(year)) & (F.col("month") == str(month)))
    return days.agg(F.max("observation_date")).first()[0]


def recent_weather(spark: SparkSession, silver_root: str, lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """Silver weather of the last days up to the newest one; only the months of the window
    are opened. Empty where nothing is stored."""
    weather = spark.read.schema(SILVER_WEATHER).parquet(f"{silver_root.rstrip('/')}/weather_daily")
    end = newest_day(spark, silver_root)
    if end is None:
        return weather.where(F.lit(False))
    start = end - dt.timedelta(days=lookback - 1)
    first, last = start.year * 12 + start.month - 1, end.year * 12 + end.month - 1
    months = [(k // 12, k % 12 + 1) for k in range(first, last + 1)]
    return planning.date_window(in_partitions(weather, silver.PARTITIONS, months), F.lit(end), lookback, date_col="observation_date")


def silver_to_gold(spark: SparkSession, silver_root: str, dim_region: DataFrame, gold_root: str) -> dict[str, int]:
    weather, agriculture = read_silver(spark, silver_root)
    region_year = gold.region_year(weather, agriculture)
    return serving.write_gold(spark, region_year, dim_region, gold_root)


def check_stored(spark: SparkSession, silver_root: str, gold_root: str, region_codes: Sequence[str], fail: bool = True) -> DataFrame:
    """The 51 declared tests over stored silver and gold, one pass per table, after the
    gold job. The report replaces ``<gold_root>/quality_report``; a violation raises
    ``QualityError`` (after the report is written) unless ``fail`` is off."""
    from agroclim.plans.checks import check_tables

    root = gold_root.rstrip("/")
    weather, agriculture = read_silver(spark, silver_root)
    tables = {
        "stg_weather_daily": weather, "stg_agriculture_regional": agriculture,
        **{name: spark.read.parquet(f"{root}/{name}") for name in (serving.REGION_YEAR, "fct_region_climate_kpi", "fct_solar_potential", "dim_region")},
    }
    check_tables(tables, region_codes).write.mode("overwrite").parquet(f"{root}/quality_report")
    report = spark.read.parquet(f"{root}/quality_report")
    if fail:
        assert_clean(report)
    return report


def read_marts(spark: SparkSession, gold_root: str) -> DataFrame:
    """Both facts read back and merged for the report layer."""
    root = gold_root.rstrip("/")
    climate = spark.read.parquet(f"{root}/fct_region_climate_kpi")
    solar = spark.read.parquet(f"{root}/fct_solar_potential")
    dim = spark.read.parquet(f"{root}/dim_region").select("region_code", "latitude", "longitude", "altitude_m")
    return merge_kpis(climate, solar.join(dim, "region_code", "left") if "latitude" not in solar.columns else solar)


def gold_to_serving(spark: SparkSession, gold_root: str, serving_root: str) -> str:
    """Publish the four gold tables as one new serving version."""
    root = gold_root.rstrip("/")
    frames = {name: spark.read.parquet(f"{root}/{name}") for name in
              ("dim_region", "dim_year", "fct_region_climate_kpi", "fct_solar_potential")}
    return serving.publish(spark, frames, serving_root)
