"""Type conforming, renames and fills: plain projections that Catalyst
collapses into one Project above the scan."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql.types import DataType, DecimalType


def cast_sql(col: str, to: str, safe: bool = False) -> str:
    return f"{'try_cast' if safe else 'CAST'}(`{col}` AS {to})"


def cast_columns(df: DataFrame, cols: Iterable[str], to: str, safe: bool = False) -> DataFrame:
    """Cast ``cols`` to type ``to`` in one projection. Decimal/double -> int
    truncates toward zero; decimal narrowing rounds HALF_UP. ``safe`` uses
    try_cast so that dirty values become NULL instead of failing the job."""
    wanted = set(cols)
    return df.selectExpr(*[f"{cast_sql(c, to, safe)} AS `{c}`" if c in wanted else f"`{c}`"
                           for c in df.columns])


def fill_default(df: DataFrame, value, cols: Iterable[str]) -> DataFrame:
    """NULL -> ``value`` in the given columns."""
    return df.fillna(value, subset=[c for c in cols if c in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def prefix_names(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + c for c in df.columns])


def columns_of_type(df: DataFrame, kind: type[DataType] = DecimalType) -> list[str]:
    """Names of the columns whose type is ``kind`` (driver-side schema only)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind)]


def schema_rows(df: DataFrame) -> list[tuple[str, str]]:
    """(column, type) pairs, the content of ``printSchema``."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
