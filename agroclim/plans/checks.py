"""The declarative test suite (source, staging, intermediate, marts, seed), over stored
tables: of a deployment after its gold job, of a staged serving version before it is
published, or of the proxy panel."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from agroclim.constants import DROUGHT_CLASSES
from agroclim.operators import gold
from agroclim.operators.quality import REPORT, TableChecks, observe_rules, observed_report, run_checks
from agroclim.plans import panel
from agroclim.session import checkpoint_dir
from agroclim.sources import files

WEATHER, AGRICULTURE, REGION_YEAR = "stg_weather_daily", "stg_agriculture_regional", "int_weather_agriculture_join"
CLIMATE, SOLAR, REGIONS, YEARS = "fct_region_climate_kpi", "fct_solar_potential", "dim_region", "dim_year"


def suite(tables: Mapping[str, DataFrame], region_codes: Sequence[str]) -> list[TableChecks]:
    """The 51 tests of the seven tables given by name. Raw weather and agriculture are
    the staging rows under their raw names, so their tests mirror the staging tests."""
    rel = [("region_code", tables[REGIONS], "region_code")]
    key = [("region_code", "year")]
    return [
        TableChecks(
            WEATHER, tables[WEATHER],
            unique=[("region_code", "observation_date")],
            not_null=["region_code", "observation_date"],
            ranges=[("precipitation_mm", 0, None), ("et0_mm", 0, None), ("solar_radiation_mj_m2", 0, None),
                    ("humidity_mean_pct", 0, 100), ("temp_mean_c", -20, 55)],
            relationships=rel,
            mirrors={"raw_weather_daily": {"region_code": "region_code", "observation_date": "date"}},
        ),
        TableChecks(
            AGRICULTURE, tables[AGRICULTURE],
            unique=key,
            not_null=["region_code", "year", "is_mock"],
            ranges=[("production_tonnes", 0, None), ("irrigated_area_ha", 0, None), ("water_resource_m3", 0, None)],
            relationships=rel,
            mirrors={"raw_agriculture_regional": {"region_code": "region_code", "year": "annee"}},
        ),
        TableChecks(
            REGION_YEAR, tables[REGION_YEAR],
            unique=key,
            not_null=["region_code", "year"],
            ranges=[("water_balance_coverage", 0, 1), ("solar_coverage", 0, 1)],
            relationships=rel,
        ),
        TableChecks(
            CLIMATE, tables[CLIMATE],
            unique=key,
            not_null=["region_code", "region_name", "year"],
            ranges=[("precip_et0_ratio", 0, None), ("dry_days_ratio", 0, 1)],
            accepted=[("drought_class", DROUGHT_CLASSES)],
            relationships=rel,
        ),
        TableChecks(
            SOLAR, tables[SOLAR],
            unique=key,
            not_null=["region_code", "year"],
            ranges=[("solar_radiation_avg_kwh_m2_day", 0, 12), ("solar_potential_score", 0, 100)],
            relationships=rel,
        ),
        TableChecks(
            REGIONS, tables[REGIONS],
            unique=[("region_code",)],
            not_null=["region_code", "region_name", "capital", "latitude", "longitude", "altitude_m"],
            accepted=[("region_code", tuple(region_codes))],
        ),
    ]


def serving_suite(tables: Mapping[str, DataFrame]) -> list[TableChecks]:
    """The keys, references and checks of the four serving tables (their DDL): primary
    keys, NOT NULL columns, facts to both dimensions, class domain, score range."""
    rel = [("region_code", tables[REGIONS], "region_code"), ("year", tables[YEARS], "year")]
    key = [("region_code", "year")]
    return [
        TableChecks(REGIONS, tables[REGIONS], unique=[("region_code",)],
                    not_null=["region_code", "region_name", "capital", "latitude", "longitude", "altitude_m"]),
        TableChecks(YEARS, tables[YEARS], unique=[("year",)], not_null=["year", "is_complete_year", "year_label"], ranges=[("year", 1900, 2100)]),
        TableChecks(CLIMATE, tables[CLIMATE], unique=key,
                    not_null=["region_code", "year", "is_complete_year", "water_balance_days", "water_balance_coverage", "dry_days", "has_agriculture_data"],
                    accepted=[("drought_class", DROUGHT_CLASSES)], relationships=rel),
        TableChecks(SOLAR, tables[SOLAR], unique=key,
                    not_null=["region_code", "year", "is_complete_year", "solar_days", "solar_coverage", "sunny_days"],
                    ranges=[("solar_potential_score", 0, 100)], relationships=rel),
    ]


def check_tables(tables: Mapping[str, DataFrame], region_codes: Sequence[str]) -> DataFrame:
    """The report of the suite over stored tables: one pass over each."""
    return run_checks(suite(tables, region_codes))


def proxy_report(spark: SparkSession, root: str, region_codes: Sequence[str]) -> DataFrame:
    """The suite over the proxy panel, run as a deployment runs: every table is written
    once into a scratch folder of the run, counting its row rules in the write, and read
    back, so the facts are read once; the tests on keys read the stored key columns.

    The result is one row per test; the folder is removed.
    """
    work = f"{checkpoint_dir(spark).rstrip('/')}/suite-{uuid.uuid4().hex}"
    report: list[tuple[str, str, str, int]] = []
    tables: dict[str, DataFrame] = {}

    def store(name: str, df: DataFrame) -> None:
        # a table is declared with the tables it refers to, which are stored already
        later = {n: df for n in (WEATHER, AGRICULTURE, REGION_YEAR, CLIMATE, SOLAR, REGIONS) if n not in tables}
        declared = next(t for t in suite({**later, **tables, name: df}, region_codes) if t.name == name)
        watched, seen = observe_rules(declared)
        watched.write.parquet(f"{work}/{name}")
        report.extend(observed_report(declared, seen))
        tables[name] = spark.read.parquet(f"{work}/{name}")

    try:
        store(REGIONS, panel.dim_region(spark, root))
        store(WEATHER, panel.silver_weather(spark, root))
        store(AGRICULTURE, panel.silver_agriculture(spark, root))
        store(REGION_YEAR, gold.region_year(tables[WEATHER], tables[AGRICULTURE]))
        marts = gold.kpi_marts(tables[REGION_YEAR], tables[REGIONS])
        store(CLIMATE, gold.climate_of(marts))
        store(SOLAR, gold.solar_of(marts))
        keys = run_checks(suite(tables, region_codes), row_rules=False)
        report += [tuple(r) for r in keys.select("check", "table", "column", "violations").collect()]
    finally:
        files.delete(spark, work)
    return spark.createDataFrame(report, REPORT)
