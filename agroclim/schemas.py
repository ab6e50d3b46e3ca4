"""Explicit schemas for every table the library reads or writes (no inference)."""

from __future__ import annotations

from pyspark.sql import types as T

from agroclim.constants import DAILY_VARIABLES

# Bronze weather payload: parallel arrays under ``daily``. Integers in the payload
# are read as DOUBLE by this schema, nulls stay null.
BRONZE_WEATHER = T.StructType(
    [
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("elevation", T.DoubleType()),
        T.StructField("timezone", T.StringType()),
        T.StructField(
            "daily",
            T.StructType(
                [T.StructField("time", T.ArrayType(T.StringType()))]
                + [T.StructField(name, T.ArrayType(T.DoubleType())) for name in DAILY_VARIABLES]
            ),
        ),
    ]
)

# Bronze agriculture CSV: text only; typing happens in the cleaning step.
BRONZE_AGRICULTURE = T.StructType(
    [
        T.StructField("region", T.StringType()),
        T.StructField("annee", T.StringType()),
        T.StructField("production_tonnes", T.StringType()),
        T.StructField("surface_irriguee_ha", T.StringType()),
        T.StructField("ressource_hydrique_m3", T.StringType()),
    ]
)

# raw.weather_daily measures and their NUMERIC(p, s) types.
WEATHER_MEASURE_TYPES: dict[str, T.DecimalType] = {
    "temperature_2m_max": T.DecimalType(5, 2),
    "temperature_2m_min": T.DecimalType(5, 2),
    "temperature_2m_mean": T.DecimalType(5, 2),
    "precipitation_sum": T.DecimalType(6, 2),
    "et0_fao_evapotranspiration": T.DecimalType(6, 2),
    "shortwave_radiation_sum": T.DecimalType(7, 2),
    "relative_humidity_2m_mean": T.DecimalType(5, 2),
    "wind_speed_10m_max": T.DecimalType(5, 2),
}

AUDIT_FIELDS = [
    T.StructField("_source", T.StringType(), False),
    T.StructField("_source_url", T.StringType()),
    T.StructField("_ingested_at", T.TimestampType(), False),
    T.StructField("_batch_id", T.StringType(), False),
]

RAW_WEATHER = T.StructType(
    [T.StructField("region_code", T.StringType(), False), T.StructField("date", T.DateType(), False)]
    + [T.StructField(name, dtype) for name, dtype in WEATHER_MEASURE_TYPES.items()]
    + AUDIT_FIELDS
)

AGRI_MEASURE_TYPES: dict[str, T.DecimalType] = {
    "production_tonnes": T.DecimalType(12, 2),
    "surface_irriguee_ha": T.DecimalType(12, 2),
    "ressource_hydrique_m3": T.DecimalType(14, 2),
}

RAW_AGRICULTURE = T.StructType(
    [T.StructField("region_code", T.StringType(), False), T.StructField("annee", T.IntegerType(), False)]
    + [T.StructField(name, dtype) for name, dtype in AGRI_MEASURE_TYPES.items()]
    + AUDIT_FIELDS
)

DIM_REGION = T.StructType(
    [
        T.StructField("region_code", T.StringType(), False),
        T.StructField("region_name", T.StringType(), False),
        T.StructField("capital", T.StringType(), False),
        T.StructField("latitude", T.DoubleType(), False),
        T.StructField("longitude", T.DoubleType(), False),
        T.StructField("altitude_m", T.DoubleType(), False),
    ]
)

# Keys of each raw table (upsert conflict targets and uniqueness checks).
WEATHER_KEYS = ("region_code", "date")
AGRICULTURE_KEYS = ("region_code", "annee")

# Silver weather as the jobs write it (columns that the gold tables read).
SILVER_WEATHER = T.StructType(
    [
        T.StructField("region_code", T.StringType()),
        T.StructField("observation_date", T.DateType()),
        T.StructField("temp_mean_c", T.DecimalType(5, 2)),
        T.StructField("precipitation_mm", T.DecimalType(6, 2)),
        T.StructField("et0_mm", T.DecimalType(6, 2)),
        T.StructField("solar_radiation_kwh_m2", T.DecimalType(10, 3)),
        T.StructField("humidity_mean_pct", T.DecimalType(5, 2)),
        T.StructField("has_water_balance_data", T.BooleanType()),
        T.StructField("has_solar_data", T.BooleanType()),
        T.StructField("year", T.StringType()),
        T.StructField("month", T.StringType()),
    ]
)
