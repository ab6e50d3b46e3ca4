"""The medallion chain over the proxy panel: raw -> silver -> gold, lazily.

Every function takes (spark, root) and returns a DataFrame plan; nothing runs until
an action. Shared sub-plans are simply re-declared: Catalyst reuses identical
exchanges inside one query, and the writer (``plans.gold_job``) persists the one
table (region_year) that feeds several outputs.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from agroclim.operators import gold, silver
from agroclim.schemas import WEATHER_KEYS
from agroclim.session import session_key
from agroclim.sources import proxy, tables


_PLANS: dict[tuple[str, str, str], DataFrame] = {}
tables.on_change(_PLANS.clear)


def shared(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Build a panel plan once per (session, root) and hand out the same lazy DataFrame
    until an input table changes: rebuilding identical plans costs hundreds of driver
    round trips."""

    @functools.wraps(fn)
    def get(spark: SparkSession, root: str) -> DataFrame:
        tables.refresh(spark, root)
        key = (fn.__name__, session_key(spark), root)
        if key not in _PLANS:
            _PLANS[key] = fn(spark, root)
        return _PLANS[key]

    return get


@shared
def raw_weather(spark: SparkSession, root: str) -> DataFrame:
    """raw.weather_daily: newest ingestion per (region_code, date)."""
    newest = silver.latest_wins(proxy.ingestions(spark, root), WEATHER_KEYS, proxy.INGEST_ORDER)
    return proxy.with_measures(newest).drop(*proxy.INGEST_ORDER)


@shared
def raw_agriculture(spark: SparkSession, root: str) -> DataFrame:
    return proxy.agriculture_rows(spark, root)


@shared
def dim_region(spark: SparkSession, root: str) -> DataFrame:
    return proxy.dim_region(spark, root)


@shared
def silver_weather(spark: SparkSession, root: str) -> DataFrame:
    return silver.stg_weather(raw_weather(spark, root))


@shared
def silver_agriculture(spark: SparkSession, root: str) -> DataFrame:
    return silver.stg_agriculture(raw_agriculture(spark, root))


@shared
def region_year(spark: SparkSession, root: str) -> DataFrame:
    return gold.region_year(silver_weather(spark, root), silver_agriculture(spark, root))


@shared
def kpi_marts(spark: SparkSession, root: str) -> DataFrame:
    """Both gold marts from one pass over region_year."""
    return gold.kpi_marts(region_year(spark, root), dim_region(spark, root))


@shared
def climate_kpi(spark: SparkSession, root: str) -> DataFrame:
    return gold.climate_of(kpi_marts(spark, root))


@shared
def solar_potential(spark: SparkSession, root: str) -> DataFrame:
    return gold.solar_of(kpi_marts(spark, root))


@shared
def dim_year(spark: SparkSession, root: str) -> DataFrame:
    return gold.dim_year(region_year(spark, root))


@shared
def merged_kpis(spark: SparkSession, root: str) -> DataFrame:
    """Dashboard frame: climate and solar facts per region x year, both marts of one
    pass (``merge_kpis`` joins the two marts when they are read back from storage)."""
    from agroclim.operators.report import merged_marts

    return merged_marts(kpi_marts(spark, root))


@shared
def place_aliases(spark: SparkSession, root: str) -> DataFrame:
    """Place names (nations) -> region code: the proxy's capital-like aliases."""
    from pyspark.sql import functions as F

    nations = proxy.nation_region(spark, root)
    return nations.select(F.col("n_name").alias("place_name"), proxy.region_code(F.col("n_regionkey")).alias("region_code"))


@shared
def region_aliases(spark: SparkSession, root: str) -> DataFrame:
    from agroclim.operators.cleaning import aliases_from_dimension

    return aliases_from_dimension(dim_region(spark, root), place_aliases(spark, root))


@shared
def dirty_agriculture_csv(spark: SparkSession, root: str) -> DataFrame:
    """The messy agriculture text rows, after header normalisation (region -> region_code)."""
    from agroclim.operators.cleaning import normalize_columns

    return normalize_columns(proxy.dirty_agriculture(spark, root))
