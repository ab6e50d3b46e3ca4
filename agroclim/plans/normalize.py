"""Boundary typing for results handed to other engines (the SQL oracle, CSV, JDBC):
integers as BIGINT, decimals and floats as DOUBLE, timestamps as DATE."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.DecimalType, T.FloatType, T.DoubleType)


def _target(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, _INTEGRAL):
        return T.LongType()
    if isinstance(dtype, _FRACTIONAL):
        return T.DoubleType()
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return T.DateType()
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_target(dtype.elementType), dtype.containsNull)
    return dtype


def portable(df: DataFrame) -> DataFrame:
    """Cast every column to its portable type (no-op casts are skipped)."""
    cols = []
    for field in df.schema.fields:
        target = _target(field.dataType)
        col = F.col(f"`{field.name}`")
        cols.append(col if target == field.dataType else col.cast(target).alias(field.name))
    return df.select(*cols)
