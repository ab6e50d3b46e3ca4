"""Serving layer: star-schema projections, the region x year view, the non-empty
guard, gold writes and the all-or-nothing publish of a new serving version."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroclim.constants import SERVING_COLUMNS
from agroclim.functions.display import drought_label, drought_sort, year_label
from agroclim.operators import gold
from agroclim.operators.joins import join_bounded
from agroclim.operators.quality import QualityError, assert_clean, run_checks
from agroclim.sources import files

DIM_MAX_ROWS = 100_000


def select_serving(df: DataFrame, table: str) -> DataFrame:
    """The fixed column list of a serving table (region attributes live in dim_region only)."""
    return df.select(*SERVING_COLUMNS[table])


def region_year_view(climate: DataFrame, solar: DataFrame, dim_region: DataFrame, dim_year: DataFrame) -> DataFrame:
    """One row per region x year: both facts joined, region and year attributes,
    French class label and its sort key. Dimensions are broadcast after a size check."""
    k = select_serving(climate, "fct_region_climate_kpi").alias("k")
    s = select_serving(solar, "fct_solar_potential").select(
        "region_code", "year", F.col("is_complete_year").alias("solar_complete_year"), *_VIEW_SOLAR
    )
    facts = join_bounded(k.join(s, ["region_code", "year"]), dim_year.select("year", "year_label"), "year", max_rows=DIM_MAX_ROWS)
    return _view(facts, dim_region)


_VIEW_SOLAR = ("solar_radiation_avg_kwh_m2_day", "sunny_days_pct", "solar_potential_score")


def region_year_view_of_marts(marts: DataFrame, dim_region: DataFrame) -> DataFrame:
    """``region_year_view`` over ``gold.kpi_marts`` (both facts of one pass, same
    rows as the fact join, dim_year's flag carried per row): the facts are read
    once, not once per fact table and once more for the year dimension."""
    climate = [F.col("climate_complete_year").alias(c) if c == "is_complete_year" else F.col(c)
               for c in SERVING_COLUMNS["fct_region_climate_kpi"]]
    label = year_label(F.col("year"), F.col(gold.YEAR_FLAG)).alias("year_label")
    return _view(marts.select(*climate, "solar_complete_year", *_VIEW_SOLAR, label), dim_region)


def _view(facts: DataFrame, dim_region: DataFrame) -> DataFrame:
    full = join_bounded(facts, select_serving(dim_region, "dim_region"), "region_code", max_rows=DIM_MAX_ROWS)
    return full.select(
        "region_code", "region_name", "capital", "latitude", "longitude", "altitude_m",
        "year", "year_label",
        F.col("is_complete_year").alias("climate_complete_year"),
        "solar_complete_year",
        "precip_et0_ratio", "drought_class",
        drought_label(F.col("drought_class")).alias("drought_class_label"),
        drought_sort(F.col("drought_class")).alias("drought_class_sort"),
        "precipitation_total_mm", "et0_total_mm", "dry_days", "dry_days_ratio", "spi_simplified",
        "solar_radiation_avg_kwh_m2_day", "sunny_days_pct", "solar_potential_score",
        "production_tonnes", "irrigated_area_ha", "water_resource_m3", "agriculture_is_mock",
    )


REQUIRED = tuple(SERVING_COLUMNS)  # a serving version holds all four tables


def assert_non_empty(frames: Mapping[str, DataFrame]) -> None:
    """Refuse to publish when any staged table is empty (``isEmpty`` reads at most
    one row per table)."""
    empty = [name for name, df in frames.items() if df.isEmpty()]
    if empty:
        raise ValueError(f"staged tables are empty, publish cancelled: {empty}")


def write_tables(frames: Mapping[str, DataFrame], root: str) -> dict[str, int]:
    """Write each frame as Parquet under ``root/<name>`` and return row counts taken
    from the write itself (``observe``), not from a second scan."""
    from pyspark.sql import Observation

    counts: dict[str, int] = {}
    for name, df in frames.items():
        obs = Observation(f"rows_{name}")
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{root.rstrip('/')}/{name}")
        counts[name] = int(obs.get["rows"])
    return counts


def gold_frames(region_year: DataFrame, dim_region: DataFrame) -> dict[str, DataFrame]:
    """The four gold outputs from one region x year table."""
    from agroclim.operators import gold

    return {
        "dim_region": select_serving(dim_region, "dim_region"),
        "dim_year": gold.dim_year(region_year),
        "fct_region_climate_kpi": gold.climate_kpi(region_year, dim_region),
        "fct_solar_potential": gold.solar_potential(region_year, dim_region),
    }


REGION_YEAR = "int_weather_agriculture_join"


def write_gold(spark: SparkSession, region_year: DataFrame, dim_region: DataFrame, root: str) -> dict[str, int]:
    """Store region_year once (it feeds three outputs and the quality suite) and write the
    gold tables from the stored rows. Counts come from the writes."""
    write_tables({REGION_YEAR: region_year}, root)
    stored = spark.read.parquet(f"{root.rstrip('/')}/{REGION_YEAR}")
    return write_tables(gold_frames(stored, dim_region), root)


# --- publish: versions, and commits numbered without gaps ---------------------------------

COMMITS = "_commits"


def commits(spark: SparkSession, serving_root: str) -> list[tuple[int, str]]:
    """(number, version) of the commits, oldest first. A commit whose file is not
    complete yet (a publisher is writing it) does not count."""
    out = []
    folder = f"{serving_root.rstrip('/')}/{COMMITS}"
    for name in files.names(spark, folder):
        if not name.isdigit():
            continue
        try:
            out.append((int(name), json.loads(files.read_text(spark, f"{folder}/{name}"))["version"]))
        except (ValueError, KeyError):
            continue
    return out


def current_version(spark: SparkSession, serving_root: str) -> str | None:
    """The version of the newest commit (None before the first publish)."""
    done = commits(spark, serving_root)
    return done[-1][1] if done else None


def read_serving(spark: SparkSession, serving_root: str, table: str, version: str | None = None) -> DataFrame:
    """Read a table of the current serving version, or of a given one. A reader that
    joins tables takes ``current_version`` once and passes it to every read."""
    version = version or current_version(spark, serving_root)
    if version is None:
        raise FileNotFoundError(f"nothing published under {serving_root}")
    return spark.read.parquet(f"{serving_root.rstrip('/')}/{version}/{table}")


def stage(spark: SparkSession, frames: Mapping[str, DataFrame], serving_root: str) -> str:
    """Write all four tables into the folder of a new version that no reader sees yet."""
    missing, unknown = sorted(set(REQUIRED) - set(frames)), sorted(set(frames) - set(REQUIRED))
    if missing or unknown:
        raise ValueError(f"publish cancelled: missing tables {missing}, unknown tables {unknown}")
    version = f"v-{uuid.uuid4().hex}"
    folder = f"{serving_root.rstrip('/')}/{version}"
    counts = write_tables({name: select_serving(df, name) for name, df in frames.items()}, folder)
    empty = [name for name, n in counts.items() if n == 0]
    if empty:
        files.delete(spark, folder)
        raise ValueError(f"staged tables are empty, publish cancelled: {empty}")
    return version


def validate(spark: SparkSession, serving_root: str, version: str) -> None:
    """Run the declared checks on the staged files; a violation raises and removes them."""
    from agroclim.plans.checks import serving_suite

    tables = {name: read_serving(spark, serving_root, name, version) for name in REQUIRED}
    try:
        assert_clean(run_checks(serving_suite(tables)))
    except QualityError:
        files.delete(spark, f"{serving_root.rstrip('/')}/{version}")
        raise


def commit(spark: SparkSession, serving_root: str, version: str) -> int:
    """Make a staged version the current one: create the commit of the next number, a
    file that must not exist yet. Of two publishers at once one gets the number, the
    other the next; nothing is renamed or replaced, so object stores serve as well."""
    folder = f"{serving_root.rstrip('/')}/{COMMITS}"
    number = max((int(n) for n in files.names(spark, folder) if n.isdigit()), default=0) + 1
    while not files.create_new(spark, f"{folder}/{number:012d}", json.dumps({"version": version})):
        number += 1
    return number


def publish(spark: SparkSession, frames: Mapping[str, DataFrame], serving_root: str) -> str:
    """All-or-nothing replacement of every serving table: stage all four, check the
    staged files, commit. Readers see the old version until the commit exists and the
    new one from then on; whatever fails before leaves them the old one."""
    version = stage(spark, frames, serving_root)
    validate(spark, serving_root, version)
    commit(spark, serving_root, version)
    return version
