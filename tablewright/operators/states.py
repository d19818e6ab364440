"""Profiles and checks of tables that grow: what a part of the rows adds is stored, and the parts are merged.

A part is a landing date or a run. Storing a part again replaces it, so a repeated landing counts once. A profile or a score of the grown table reads the new part and the stored
states, whose size depends on columns and keys, never on the rows seen before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablewright.functions.formats import bad_format
from tablewright.model import EMAIL_COLUMNS, PHONE_COLUMNS
from tablewright.operators.quality import RowCheck, check_rows
from tablewright.sinks.runs import write_run

#: Buckets of a sketch as a power of two: distinct counts err by about 1.04 / sqrt(2 ** 14), 0.8 percent.
SKETCH = 14


# -- profiles --------------------------------------------------------------------------------


def column_states(
    df: DataFrame, email_columns: Sequence[str] = EMAIL_COLUMNS, phone_columns: Sequence[str] = PHONE_COLUMNS
) -> DataFrame:
    """One row per column that merges with others of its kind: counts, sum, least and greatest value, and a sketch of the
    distinct values. One scan, and a row a task."""
    wide, names = [], ["column", "dtype", "rows", "nulls", "sketch", "least", "greatest", "total", "bad_email", "bad_phone"]
    for i, field in enumerate(df.schema.fields):
        columns = _state(field, field.name in email_columns, field.name in phone_columns)
        wide += [column.alias(f"{name}_{i}") for name, column in zip(names, columns)]
    per_column = [F.struct(*[F.col(f"{name}_{i}").alias(name) for name in names]) for i in range(len(df.columns))]
    return df.agg(*wide).select(F.inline(F.array(*per_column)))


def _state(field: T.StructField, email: bool, phone: bool) -> list[Column]:
    value = F.col(f"`{field.name}`")
    numeric = isinstance(field.dataType, T.NumericType)
    # Doubles order all numbers; the decimal tells apart integers that are the same double.
    ordered = F.struct(
        value.cast("double").alias("number"), value.try_cast("decimal(38,10)").alias("exact"), value.cast("string").alias("text")
    )
    ends = F.when(value.isNotNull(), ordered) if numeric else F.lit(None).cast("struct<number: double, exact: decimal(38,10), text: string>")
    sketched = value if isinstance(field.dataType, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)) else value.cast("string")
    zero = F.lit(0).cast("long")
    return [
        F.lit(field.name),
        F.lit(field.dataType.simpleString()),
        F.count(F.lit(1)),
        F.coalesce(F.count_if(value.isNull()), zero),
        F.hll_sketch_agg(sketched, F.lit(SKETCH)),
        F.min(ends),
        F.max(ends),
        F.sum(value.cast("double")) if numeric else F.lit(None).cast("double"),
        F.count_if(bad_format(field.name, "email")) if email else F.lit(None).cast("long"),
        F.count_if(bad_format(field.name, "phone")) if phone else F.lit(None).cast("long"),
    ]


def merge_columns(states: DataFrame) -> DataFrame:
    """The rows of ``profile_columns`` from the states of any number of parts; distinct counts are those of the merged
    sketches, with NULL as a value, everything else is exact."""
    merged = states.groupBy("column", "dtype").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("values"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.sum("total").alias("total"),
        F.sum("bad_email").alias("invalid_email_count"),
        F.sum("bad_phone").alias("invalid_phone_count"),
    )
    return merged.select(
        "column",
        "dtype",
        "null_count",
        (F.coalesce("values", F.lit(0).cast("long")) + (F.col("null_count") > 0).cast("long")).alias("distinct_count"),
        F.col("least.text").alias("min"),
        F.col("greatest.text").alias("max"),
        F.round(F.try_divide(F.col("total"), F.col("rows") - F.col("null_count")), 2).alias("mean"),
        "invalid_email_count",
        "invalid_phone_count",
    )


def store_profile(df: DataFrame, base: str, part: str, **formats: Sequence[str]) -> None:
    """Store what a part adds to the profile of its table."""
    write_run(column_states(df, **formats), f"{base}/columns", part)


def merged_profile(spark: SparkSession, base: str) -> DataFrame:
    """The profile of all stored parts."""
    return merge_columns(spark.read.parquet(f"{base}/columns"))


# -- checks ----------------------------------------------------------------------------------


def store_checks(df: DataFrame, checks: Sequence[RowCheck], base: str, part: str) -> None:
    """Store how many rows of a part fail each check that looks at one row at a time."""
    write_run(check_rows(df, checks).select("check", "column", "failed_count"), f"{base}/checks", part)


def store_keys(df: DataFrame, key: str, base: str, name: str, part: str) -> None:
    """Store the rows per key of a part, for checks that compare keys across parts; a hot key is one row."""
    write_run(df.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("rows")), f"{base}/keys/{name}", part)


def merged_checks(spark: SparkSession, base: str) -> DataFrame:
    """The check rows of all stored parts."""
    counts = spark.read.parquet(f"{base}/checks").groupBy("check", "column").agg(F.sum("failed_count").alias("failed_count"))
    return counts.withColumn("passed", F.col("failed_count") == 0)


def _keys(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Rows per key over all parts: keys are merged, rows are not seen again."""
    return spark.read.parquet(f"{base}/keys/{name}").groupBy("key").agg(F.sum("rows").alias("rows"))


def merged_duplicates(spark: SparkSession, base: str, name: str, column: str, enforce: bool = False) -> DataFrame:
    """The check row for surplus rows per key, copies in different parts included; rows without a key have none."""
    surplus = F.sum(F.when(F.col("key").isNotNull(), F.col("rows") - 1))
    counts = _keys(spark, base, name).agg(F.coalesce(surplus, F.lit(0)).cast("long").alias("failed_count"))
    return _row(counts, "duplicate_check", column, F.lit(not enforce) | (F.col("failed_count") == 0))


def merged_orphans(spark: SparkSession, base: str, child: str, parent: str, column: str) -> DataFrame:
    """The check row for rows of ``child`` whose key no part of ``parent`` has."""
    lost = _keys(spark, base, child).join(_keys(spark, base, parent).select("key"), "key", "left_anti")
    counts = lost.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("failed_count"))
    return _row(counts, "referential_integrity", column, F.col("failed_count") == 0)


def _row(counts: DataFrame, check: str, column: str, passed: Column) -> DataFrame:
    return counts.select(F.lit(check).alias("check"), F.lit(column).alias("column"), "failed_count", passed.alias("passed"))


def store_landing(tables: Mapping[str, DataFrame], checks: Mapping[str, Sequence[RowCheck]], base: str, part: str) -> None:
    """Store all that a landing of raw tables adds: the row checks of each, customers and the orders of each customer."""
    for name, df in tables.items():
        if checks.get(name):
            store_checks(df, checks[name], f"{base}/{name}", part)
    for name in ("orders", "customer"):
        if name in tables:
            store_keys(tables[name], "customer_id", base, name, part)
