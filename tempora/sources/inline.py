"""Inline rows (SQL ``VALUES``) and RAW tables read with their fixed schema."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tempora import schemas as S


def _coerce(value, dtype: T.DataType):
    """Accept ISO strings for dates / timestamps and numbers for money."""
    if value is None:
        return None
    if isinstance(dtype, T.DateType) and isinstance(value, str):
        return dt.date.fromisoformat(value)
    if isinstance(dtype, T.TimestampNTZType) and isinstance(value, str):
        return dt.datetime.fromisoformat(value)
    if isinstance(dtype, T.DecimalType) and not isinstance(value, str):
        import decimal
        return decimal.Decimal(str(value)).quantize(decimal.Decimal(1).scaleb(-dtype.scale))
    return value


def from_rows(spark: SparkSession, table: str, columns: Sequence[str], rows: Iterable[Sequence]) -> DataFrame:
    """``INSERT INTO raw.<table> (columns) VALUES (...)``: unnamed columns are NULL."""
    schema = S.raw_schema(table)
    types = {f.name: f.dataType for f in schema}
    full = []
    for r in rows:
        given = dict(zip(columns, r))
        full.append(tuple(_coerce(given.get(f.name), types[f.name]) for f in schema))
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    return spark.createDataFrame(full, nullable)


def read_cdc(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Scan a RAW CDC parquet table with its fixed schema (no inference)."""
    return spark.read.schema(S.raw_schema(table)).parquet(path)
