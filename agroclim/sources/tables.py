"""Parquet table access with explicit column lists (pruning reaches the scan)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from agroclim.operators.joins import forget_sizes
from agroclim.session import session_key

# Readers of input tables, per session: listing the files and reading the Parquet footer
# once per table instead of once per sub-plan, as long as the folder stays as it is.
_READERS: dict[tuple[str, str], DataFrame] = {}
_STATES: dict[tuple[str, str], tuple] = {}
# What else is kept per folder of input tables and must go when it changes.
_ON_CHANGE: list[Callable[[], None]] = []


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}.parquet"


def on_change(forget: Callable[[], None]) -> None:
    _ON_CHANGE.append(forget)


def _state(spark: SparkSession, root: str) -> tuple:
    """Name, size and time of change of every table in the folder (one listing)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in system.listStatus(path)))


def refresh(spark: SparkSession, root: str) -> None:
    """Forget readers, plans and size verdicts if the tables under ``root`` have changed."""
    key, state = (session_key(spark), root.rstrip("/")), _state(spark, root)
    if _STATES.get(key, state) != state:
        _READERS.clear()
        forget_sizes()
        for forget in _ON_CHANGE:
            forget()
    _STATES[key] = state


def read_table(spark: SparkSession, root: str, name: str, columns: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    """Read one parquet table; ``columns`` become the scan's ReadSchema."""
    refresh(spark, root)
    path = table_path(root, name)
    key = (session_key(spark), path)
    df = _READERS.get(key)
    if df is None:
        df = _READERS[key] = spark.read.parquet(path)
    return df.select(*columns) if columns else df
