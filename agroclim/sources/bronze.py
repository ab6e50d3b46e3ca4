"""Bronze sources: weather JSON payloads and agriculture CSV drops in hive-style
folders, CSV files of unknown separator and encoding, the region seed, and the
agriculture source precedence (configured path, else a mock fixture)."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agroclim.constants import (
    AGRI_COLUMNS,
    SOURCE_AGRI_FALLBACK,
    SOURCE_AGRI_MOCK,
    SOURCE_AGRI_REAL,
)
from agroclim.functions.numbers import na_to_null
from agroclim.operators.cleaning import normalize_columns, validate_columns
from agroclim.schemas import BRONZE_AGRICULTURE, BRONZE_WEATHER, DIM_REGION

WEATHER_LAYOUT = "ingest_date=*/region_code=*/range_start=*/*.json"
AGRICULTURE_LAYOUT = "ingest_date=*/source=*/*.csv"
# A quoted field doubles its quotes and may hold line breaks.
QUOTED = {"quote": '"', "escape": '"', "multiLine": True}
SEPARATORS = (",", ";", "\t", "|")
# Newest ingestion first for weather payloads: ingest date, request range, file.
# Kept on silver rows by the batch job and the stream alike (provenance + merge order).
WEATHER_INGEST_ORDER = ("ingest_date", "range_start", "_file")


def read_bronze_weather(spark: SparkSession, root: str) -> DataFrame:
    """Multi-line JSON payloads under ingest_date=/region_code=/range_start=.

    Explicit schema (integers read as DOUBLE, all-null arrays typed); partition
    values stay text; the payload coordinates are never used downstream.
    """
    base = root.rstrip("/")
    return (
        spark.read.schema(BRONZE_WEATHER)
        .option("multiLine", True)
        .option("basePath", base)
        .json(f"{base}/{WEATHER_LAYOUT}")
        .withColumn("_file", F.input_file_name())
    )


def read_bronze_agriculture(spark: SparkSession, root: str) -> DataFrame:
    """Header CSV (UTF-8, all text) under ingest_date=/source=."""
    base = root.rstrip("/")
    return (
        spark.read.schema(BRONZE_AGRICULTURE)
        .option("header", True)
        .option("encoding", "UTF-8")
        .options(**QUOTED)
        .option("basePath", base)
        .csv(f"{base}/{AGRICULTURE_LAYOUT}")
    )


def load_dim_region(spark: SparkSession, path: str) -> DataFrame:
    """Region seed CSV typed to string / double."""
    return spark.read.schema(DIM_REGION).option("header", True).option("encoding", "UTF-8").csv(path)


# --- CSV of unknown separator and encoding --------------------------------------------------


def sniff_csv_files(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """One row per file: path, encoding, header line and separator (empty files give none).

    The files are read as lines, so a file of any size is split and never held whole.
    Encoding: UTF-8 when the bytes of every line are valid UTF-8, else ISO-8859-1 (which
    decodes any byte, so it is the last resort). Header: the first line of the file's
    first block. Separator: the candidate among ``, ; TAB |`` occurring most often in it
    (ties: comma first). Only the per-file metadata comes back to the driver, never rows.
    """
    # one line: its bytes as they are, its file, the block it lies in and its order there
    lines = spark.read.text(list(paths) if not isinstance(paths, str) else paths).select(
        F.col("value"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("order"),
    )
    found = lines.groupBy("path").agg(
        # a set of at most two values; it makes the aggregate a hash aggregate of objects,
        # where a text buffer alone would sort all lines
        (~F.array_contains(F.collect_set(F.is_valid_utf8("value")), F.lit(False))).alias("valid"),
        F.min_by(F.when(F.col("block") == 0, F.col("value")), F.when(F.col("block") == 0, F.col("order"))).alias("first"),
    )
    header = F.when(F.col("valid"), F.col("first")).otherwise(F.decode(F.col("first").cast("binary"), "ISO-8859-1"))
    counts = [F.size(F.split(F.col("header"), "\\" + s if s in "|" else s)) - 1 for s in SEPARATORS]
    best = F.lit(SEPARATORS[0])
    best_n = counts[0]
    for sep, n in zip(SEPARATORS[1:], counts[1:]):
        best = F.when(n > best_n, F.lit(sep)).otherwise(best)
        best_n = F.greatest(best_n, n)
    return found.select(
        "path", F.when(F.col("valid"), F.lit("UTF-8")).otherwise(F.lit("ISO-8859-1")).alias("encoding"), F.regexp_replace(header, "^\ufeff", "").alias("header")
    ).withColumn("sep", best)


def read_tabular_csv(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Read CSV drops whose separator and encoding vary per file; all columns text,
    pandas' default missing-value tokens read as null, headers alias-normalised.

    Files sharing (separator, encoding, header) are read by one ``spark.read.csv``
    call; the groups are ``unionByName``-ed (missing columns allowed).
    """
    groups = (
        sniff_csv_files(spark, paths)
        .groupBy("sep", "encoding", "header")
        .agg(F.sort_array(F.collect_list("path")).alias("paths"))
        .collect()  # one row per distinct file layout, not per data row
    )
    frames = []
    for g in groups:
        df = (
            spark.read.option("header", True)
            .option("sep", g["sep"])
            .option("encoding", g["encoding"])
            .option("inferSchema", False)
            .options(**QUOTED)
            .csv(list(g["paths"]))
        )
        df = df.select(*[na_to_null(F.col(f"`{c}`")).alias(c) for c in df.columns])
        frames.append(normalize_columns(df))
    if not frames:
        raise FileNotFoundError(f"no CSV file found in {paths}")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


# --- agriculture source precedence -------------------------------------------------------


def load_agriculture(spark: SparkSession, fixture_path: str, path: str | None = None) -> tuple[DataFrame, str]:
    """(rows, source tag) following the source precedence:

    * no path configured -> the mock fixture, ``mock-not-configured`` (normal state);
    * path configured (a file, folder or glob) but unreadable, also where a file is listed
      and cannot be read -> the fixture, ``mock-fallback-network-error`` (degraded run);
    * readable but required columns missing -> ValueError, never a fallback;
    * else the file, ``datagovma``.

    Rows keep the 5 canonical text columns; cleaning (region, year, numbers) is
    ``operators.cleaning.clean_agriculture``.
    """
    if not path:
        return _fixture(spark, fixture_path), SOURCE_AGRI_MOCK
    try:
        df = read_tabular_csv(spark, path)  # reads every line of the files to tell their layout
    except (FileNotFoundError, PySparkException, Py4JJavaError) as error:
        if isinstance(error, Py4JJavaError) and "FAILED_READ_FILE" not in str(error.java_exception):
            raise
        return _fixture(spark, fixture_path), SOURCE_AGRI_FALLBACK
    validate_columns(df, origin=path)
    return df.select(*AGRI_COLUMNS), SOURCE_AGRI_REAL


def _fixture(spark: SparkSession, fixture_path: str) -> DataFrame:
    df = read_tabular_csv(spark, fixture_path)
    validate_columns(df, origin=fixture_path)
    return df.select(*AGRI_COLUMNS)
