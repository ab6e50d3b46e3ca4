"""Agriculture CSV cleaning: header aliases, required columns, region resolution,
year and number parsing, with the rejected rows kept in their own frame."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroclim.constants import AGRI_COLUMNS, COLUMN_ALIASES, ISO_CODE_PATTERN, REGION_ALIASES
from agroclim.functions.labels import code_or_null, column_key, label_key, normalize_label
from agroclim.functions.numbers import parse_decimal, parse_year
from agroclim.operators.joins import join_bounded

# Alias tables map labels of administrative regions; they stay small by nature.
ALIAS_MAX_ROWS = 100_000
MEASURES = ("production_tonnes", "surface_irriguee_ha", "ressource_hydrique_m3")


def normalize_columns(df: DataFrame, aliases: dict[str, str] = COLUMN_ALIASES) -> DataFrame:
    """Rename columns whose normalised header is a known alias; others are kept.
    Works on the schema only (no data is read)."""
    mapping = {}
    for name in df.columns:
        key = column_key(name)
        if key in aliases:
            mapping[name] = aliases[key]
    return df.withColumnsRenamed(mapping) if mapping else df


def validate_columns(df: DataFrame, origin: str, required: Iterable[str] = AGRI_COLUMNS) -> None:
    """Raise ValueError naming every required column the frame lacks."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing columns in CSV {origin}: {missing}")


def alias_table(spark: SparkSession, aliases: dict[str, str] = REGION_ALIASES) -> DataFrame:
    """(alias_key, region_code) rows of a fixed alias dictionary."""
    return spark.createDataFrame(sorted(aliases.items()), "alias_key string, region_code string")


def aliases_from_dimension(dim: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """Alias table derived from data: each region name, plus optional place names
    (``places``: place_name, region_code), under their normalised key."""
    out = dim.select(normalize_label(F.col("region_name")).alias("alias_key"), "region_code")
    if places is not None:
        out = out.unionByName(places.select(normalize_label(F.col("place_name")).alias("alias_key"), "region_code"))
    return out.distinct()


def resolve_region(
    df: DataFrame,
    label_col: str,
    aliases: DataFrame,
    code_pattern: str = ISO_CODE_PATTERN,
    out_col: str = "resolved_code",
) -> DataFrame:
    """Label -> region code: a label already shaped like a code passes upper-cased
    (even if unknown), else the alias of its normalised form, else null."""
    keyed = df.withColumn("_alias_key", normalize_label(F.col(label_col)))
    lookup = aliases.select(F.col("alias_key").alias("_alias_key"), F.col("region_code").alias("_alias_code"))
    joined = join_bounded(keyed, lookup, "_alias_key", how="left", max_rows=ALIAS_MAX_ROWS)
    code = F.coalesce(code_or_null(F.col(label_col), code_pattern), F.col("_alias_code"))
    return joined.withColumn(out_col, code).drop("_alias_key", "_alias_code")


def _resolved(df: DataFrame, aliases: DataFrame, code_pattern: str) -> DataFrame:
    out = resolve_region(df, "region_code", aliases, code_pattern, out_col="_code")
    return out.withColumn("_year", parse_year(F.col("annee")))


def clean_agriculture(df: DataFrame, aliases: DataFrame, code_pattern: str = ISO_CODE_PATTERN) -> DataFrame:
    """Rows with a resolved region and a parsed year, measures parsed to DOUBLE
    (junk numbers raise), projected to the 5 canonical columns."""
    base = _resolved(df, aliases, code_pattern)
    good = base.where(F.col("_code").isNotNull() & F.col("_year").isNotNull())
    return good.select(
        F.col("_code").alias("region_code"),
        F.col("_year").alias("annee"),
        *[parse_decimal(F.col(m)).alias(m) for m in MEASURES],
    )


def agriculture_rejects(df: DataFrame, aliases: DataFrame, code_pattern: str = ISO_CODE_PATTERN) -> DataFrame:
    """The rows ``clean_agriculture`` drops, with the reason (region first)."""
    base = _resolved(df, aliases, code_pattern)
    reason = F.when(F.col("_code").isNull(), F.lit("unknown_region")).when(F.col("_year").isNull(), F.lit("invalid_year"))
    return base.where(reason.isNotNull()).select(
        F.col("region_code").alias("label"), F.col("annee").alias("year_text"), reason.alias("reject_reason")
    )


def join_by_label(agri: DataFrame, dim: DataFrame, label_col: str = "region") -> DataFrame:
    """Agriculture rows INNER dim_region on the strict label key (every run of
    characters outside [a-z0-9] is one space); unmatched labels drop out."""
    right = dim.select(label_key(F.col("region_name")).alias("_label_key"), "region_code")
    left = agri.withColumn("_label_key", label_key(F.col(label_col)))
    return join_bounded(left, right, "_label_key", max_rows=ALIAS_MAX_ROWS).drop("_label_key")
