"""Idempotent upserts on Parquet tables (INSERT .. ON CONFLICT DO UPDATE semantics).

Plain Parquet has no MERGE, so an upsert is a rewrite of the touched part:

* the batch must not repeat a key (the database would reject the statement);
* every non-key column of a conflicting row is replaced, nulls included, and the
  ingestion time is refreshed;
* every upsert stamps its rows with source, URL, batch id and time;
* of a partitioned table only the partitions that the batch touches are read and
  rewritten (dynamic partition overwrite); an unpartitioned table is written beside
  the old one and takes its place by renames, so it is never half there.

Batch and merged rows are written into the cluster's shared checkpoint folder first:
the write never reads the files it replaces, and a lost executor reads them again. The
folder is removed at the end.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from agroclim.constants import SOURCE_WEATHER
from agroclim.operators.joins import forget_sizes
from agroclim.operators.quality import check_unique
from agroclim.operators.silver import latest_wins, with_audit
from agroclim.schemas import AGRI_MEASURE_TYPES, AGRICULTURE_KEYS, WEATHER_KEYS, WEATHER_MEASURE_TYPES
from agroclim.session import checkpoint_dir
from agroclim.sources import files


def assert_unique_keys(batch: DataFrame, keys: Sequence[str]) -> None:
    """Raise when the batch holds the same key twice (checked with one aggregate)."""
    dup = check_unique(batch, keys).limit(1).collect()
    if dup:
        raise ValueError(f"batch repeats key {tuple(dup[0][k] for k in keys)}")


def upsert_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows after ``INSERT .. ON CONFLICT (keys) DO UPDATE`` of every column:
    target rows whose key the batch does not carry, plus all batch rows."""
    keys = list(keys)
    return target.join(batch.select(*keys), keys, "left_anti").unionByName(batch.select(*target.columns))


def counted_write(df: DataFrame, path: str, partitions: Sequence[str] = (), mode: str = "overwrite") -> int:
    """Write Parquet (touched partitions only, if partitioned); the rows are counted in the write."""
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)
    writer.parquet(path)
    return int(seen.get["rows"])


def in_partitions(df: DataFrame, partitions: Sequence[str], touched: Sequence[Sequence]) -> DataFrame:
    """The rows of the listed partitions, by literals, so that the scan opens no other file."""
    if not touched:
        return df.where(F.lit(False))
    values = [F.concat_ws("/", *[F.lit(str(v)) for v in row]) for row in touched]
    pruned = df.where(F.col(partitions[0]).cast("string").isin(sorted({str(row[0]) for row in touched})))
    if len(partitions) == 1:
        return pruned
    return pruned.where(F.concat_ws("/", *[F.col(c).cast("string") for c in partitions]).isin(values))


def upsert(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    partitions: Mapping[str, Column] | None = None,
    newest_wins: Sequence[str] | None = None,
) -> int:
    """Upsert ``batch`` into the Parquet table at ``path``; returns the batch row count.

    ``partitions``: the table's partition columns and how a batch row computes them
    (e.g. year and month of the date; a table that exists keeps those of them it has).
    ``newest_wins``: when given, a conflicting row is replaced only if the batch row is
    newer by these columns (late, older data never overwrites newer data); by default
    the batch always wins.
    """
    keys, partitions = list(keys), dict(partitions or {})
    work = f"{checkpoint_dir(spark).rstrip('/')}/upsert-{uuid.uuid4().hex}"
    files.recover(spark, path)
    try:
        n = counted_write(batch.withColumns(partitions) if partitions else batch, f"{work}/batch")
        if n == 0:
            return 0
        batch = spark.read.parquet(f"{work}/batch")
        assert_unique_keys(batch, keys)
        if not files.exists(spark, path):
            counted_write(batch, path, list(partitions))
            return n
        target = spark.read.parquet(path)
        held = [c for c in partitions if c in target.columns]
        aligned = batch.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])
        if held:
            # the distinct partition values of one batch: calendar years or months
            touched = [tuple(r) for r in aligned.select(*held).distinct().collect()]
            target = in_partitions(target, held, touched)
        if newest_wins:
            merged = latest_wins(target.unionByName(aligned), keys, list(newest_wins))
        else:
            merged = upsert_rows(target, aligned, keys)
        if held:
            merged.write.parquet(f"{work}/merged")
            counted_write(spark.read.schema(merged.schema).parquet(f"{work}/merged"), path, held)
        else:
            staged = files.beside(path)
            counted_write(merged, staged)
            files.switch(spark, staged, path)
        forget_sizes()
        return n
    finally:
        files.delete(spark, work)


def apply_once(spark: SparkSession, path: str, token: str, work: Callable[[], int]) -> int | None:
    """Run ``work`` for the table at ``path`` unless ``token`` was applied before (then None).

    The token is a file under ``_applied`` in the table, created after the work: a stop in
    between repeats the work, which must be idempotent, and a replay does nothing.
    """
    marker = f"{path.rstrip('/')}/_applied/{token}"
    if files.exists(spark, marker):
        return None
    done = work()
    files.create_new(spark, marker, str(done))
    return done


def new_batch_id() -> str:
    return str(uuid.uuid4())


MONTHS = {"year": lambda day: F.year(day), "month": lambda day: F.month(day)}


def month_of(date_col: str) -> dict[str, Column]:
    """The partition columns of daily tables: year and month of the day."""
    return {name: of(date_col) for name, of in MONTHS.items()}


def upsert_weather(
    spark: SparkSession, path: str, batch: DataFrame, batch_id: str | None = None,
    source: str = SOURCE_WEATHER, source_url: str | None = None,
) -> int:
    """Upsert raw weather rows on (region_code, date), stamped with the batch (id, source,
    URL, time); a ``source_url`` column of the rows wins over the parameter."""
    known = [*WEATHER_KEYS, *WEATHER_MEASURE_TYPES]
    fresh = with_audit(batch, known, batch_id or new_batch_id(), source, source_url)
    return upsert(spark, path, fresh, WEATHER_KEYS, partitions=month_of("date"))


def upsert_agriculture(
    spark: SparkSession, path: str, batch: DataFrame, source: str, batch_id: str | None = None, source_url: str | None = None
) -> int:
    """Upsert raw agriculture rows on (region_code, annee); ``source`` is mandatory."""
    if not source:
        raise ValueError("source is mandatory for agriculture rows")
    known = [*AGRICULTURE_KEYS, *AGRI_MEASURE_TYPES]
    return upsert(spark, path, with_audit(batch, known, batch_id or new_batch_id(), source, source_url), AGRICULTURE_KEYS)


def overwrite_table(spark: SparkSession, df: DataFrame, path: str) -> int:
    """Full recompute of the table at ``path`` (idempotent), also of one that ``df`` reads:
    the rows are written beside it and take its place. Returns the row count."""
    files.recover(spark, path)
    staged = files.beside(path)
    try:
        n = counted_write(df, staged)
        files.switch(spark, staged, path)
    finally:
        files.delete(spark, staged)
    forget_sizes()
    return n
