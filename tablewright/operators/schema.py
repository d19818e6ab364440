"""Enforcing a target schema before publishing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablewright.model import REQUIRED_COLUMNS, wide_schema


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> None:
    """Raise before any job runs if ``df`` lacks a required column."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def _cast(field: T.StructField, current: str) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, T.DateType) and current == "string":
        return F.try_to_date(value)
    return value.try_cast(field.dataType)


def enforce_schema(
    df: DataFrame, schema: T.StructType | None = None, required: Sequence[str] = REQUIRED_COLUMNS
) -> DataFrame:
    """Select and cast the columns of ``schema``; values that do not fit become NULL."""
    schema = schema or wide_schema()
    require_columns(df, required)
    require_columns(df, schema.names)
    types = dict(df.dtypes)
    return df.select([_cast(f, types[f.name]).alias(f.name) for f in schema.fields])


def cast_failures(df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Per column of ``schema``: values present before the cast and NULL after it. A column that has its type already loses
    none and is not read."""
    schema = schema or wide_schema()
    require_columns(df, schema.names)
    types = dict(df.dtypes)

    def lost(field: T.StructField) -> Column:
        if types[field.name] == field.dataType.simpleString():
            return F.lit(False)
        return F.col(field.name).isNotNull() & _cast(field, types[field.name]).isNull()

    counts = df.agg(*[F.count_if(lost(f)).alias(f.name) for f in schema.fields])
    rows = [F.struct(F.lit(n).alias("column"), F.col(n).alias("failed_count")) for n in schema.names]
    return counts.select(F.inline(F.array(*rows)))
