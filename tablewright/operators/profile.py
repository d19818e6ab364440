"""Table and column statistics.

Exact distinct counts of many columns in one aggregate make Spark copy every row once per
column with all other columns attached. Here each column gets its own ``groupBy(value)``
branch instead: a branch reads only its column's chunks, so together the branches read the
table once, equal values are folded before the shuffle (a value that fills a third of the
rows costs one row per map task), and all other statistics come from the folded values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablewright.functions.bitmaps import bits_for, flag_maybe, key_bits
from tablewright.functions.formats import bad_format
from tablewright.model import EMAIL_COLUMNS, PHONE_COLUMNS
from tablewright.session import shared_dir

COLUMN_METRICS = T.StructType(
    [
        T.StructField("column", T.StringType()),
        T.StructField("dtype", T.StringType()),
        T.StructField("null_count", T.LongType()),
        T.StructField("distinct_count", T.LongType()),
        T.StructField("min", T.StringType()),
        T.StructField("max", T.StringType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("invalid_email_count", T.LongType()),
        T.StructField("invalid_phone_count", T.LongType()),
    ]
)
_N = "_rows_with_value"


def _count(condition: Column, weight: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, weight)), F.lit(0).cast("long"))


def _absent(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _statistics(field: T.StructField, distinct: Column, weight: Column, email: bool, phone: bool) -> list[Column]:
    value = F.col(f"`{field.name}`")
    numeric = isinstance(field.dataType, T.NumericType)
    total = F.sum(value.cast("double") * weight)
    present = F.sum(F.when(value.isNotNull(), weight))
    return [
        F.lit(field.name).alias("column"),
        F.lit(field.dataType.simpleString()).alias("dtype"),
        _count(value.isNull(), weight).alias("null_count"),
        distinct.alias("distinct_count"),
        (F.min(value).cast("string") if numeric else _absent("string")).alias("min"),
        (F.max(value).cast("string") if numeric else _absent("string")).alias("max"),
        (F.round(total / present, 2) if numeric else _absent("double")).alias("mean"),
        (_count(bad_format(field.name, "email"), weight) if email else _absent("long")).alias("invalid_email_count"),
        (_count(bad_format(field.name, "phone"), weight) if phone else _absent("long")).alias("invalid_phone_count"),
    ]


def profile_columns(
    df: DataFrame,
    email_columns: Sequence[str] = EMAIL_COLUMNS,
    phone_columns: Sequence[str] = PHONE_COLUMNS,
    approx: bool = False,
) -> DataFrame:
    """One row per column: NULLs, distinct values (NULL counts as one), numeric min, max and
    mean, and values that break the email or phone format in the columns named for it.

    ``approx=True`` replaces the exact distinct counts by sketches: one scan and no shuffle
    of values.
    """
    fields = df.schema.fields
    if approx:
        return _profile_approx(df, email_columns, phone_columns)
    branches = []
    for field in fields:
        value = F.col(f"`{field.name}`")
        folded = df.groupBy(value.alias(field.name)).agg(F.count("*").alias(_N))
        columns = _statistics(
            field, F.count("*"), F.col(_N), field.name in email_columns, field.name in phone_columns
        )
        branches.append(folded.agg(*columns))
    return reduce(DataFrame.unionAll, branches)


def _profile_approx(df: DataFrame, email_columns: Sequence[str], phone_columns: Sequence[str]) -> DataFrame:
    one = F.lit(1).cast("long")
    wide, names = [], [f.name for f in COLUMN_METRICS.fields]
    for i, field in enumerate(df.schema.fields):
        value = F.col(f"`{field.name}`")
        distinct = F.approx_count_distinct(value) + F.coalesce(
            F.max(value.isNull().cast("long")), F.lit(0).cast("long")
        )
        columns = _statistics(field, distinct, one, field.name in email_columns, field.name in phone_columns)
        wide += [column.alias(f"{name}_{i}") for name, column in zip(names, columns)]
    per_column = [
        F.struct(*[F.col(f"{name}_{i}").alias(name) for name in names]) for i in range(len(df.schema.fields))
    ]
    return df.agg(*wide).select(F.inline(F.array(*per_column)))


def profile_table(df: DataFrame, table: str, approx: bool = False) -> DataFrame:
    """One row: rows, columns and surplus rows (rows minus distinct rows).

    Exact mode groups whole rows, folding copies before the shuffle. ``approx=True`` groups
    two 64-bit fingerprints per row instead of the row, for tables too wide to shuffle.
    """
    if approx:
        # A hash skips NULLs, so every value goes with its null flag.
        cells = [x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
        key = [F.xxhash64(*cells).alias("_h1"), F.xxhash64(F.lit(1), *cells).alias("_h2")]
    else:
        key = [F.col(f"`{c}`") for c in df.columns]
    folded = df.groupBy(*key).agg(F.count("*").alias(_N))
    zero = F.lit(0).cast("long")
    return folded.agg(
        F.lit(table).alias("table"),
        F.coalesce(F.sum(_N), zero).alias("row_count"),
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        F.coalesce(F.sum(F.col(_N) - 1), zero).alias("duplicate_count"),
    )


def profile_wide_table(df: DataFrame, table: str, fingerprint_bits: int = 64) -> DataFrame:
    """The row of ``profile_table``, exact, for tables too wide to shuffle whole.

    Two hashes of every row are shuffled instead of the row. A fingerprint that one row has stands for a distinct row;
    rows are compared whole only where fingerprints meet. A bitmap of those fingerprints keeps the other rows out of
    the second shuffle. ``fingerprint_bits`` below 64 shortens the hashes, for tests of rows whose fingerprints collide.
    """
    cells = [x for c in df.columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    shift = 64 - fingerprint_bits
    marks = {f"_h{i}": F.shiftrightunsigned(F.xxhash64(F.lit(i), *cells), shift) for i in (1, 2)}
    marked = df.withColumns(marks)
    # Read three times: once for the counts, twice for what is repeated.
    stored = shared_dir(df.sparkSession, "fingerprints")
    marked.groupBy(*marks).agg(F.count("*").alias(_N)).write.parquet(stored)
    folded = df.sparkSession.read.parquet(stored)
    bits = bits_for(df.count())  # over stored tables from the files' footers
    repeated = folded.where(F.col(_N) > 1).select(*marks)
    maybe = flag_maybe(marked, "_h1", key_bits(repeated, "_h1", bits), bits, "_maybe").where("_maybe").drop("_maybe")
    candidates = maybe.join(repeated, list(marks), "left_semi")
    whole = candidates.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count("*").alias(_N)).agg(F.count("*"))
    zero = F.lit(0).cast("long")
    counts = folded.agg(F.coalesce(F.sum(_N), zero).alias("row_count"), F.count_if(F.col(_N) == 1).alias("single"))
    return counts.select(
        F.lit(table).alias("table"),
        "row_count",
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        (F.col("row_count") - F.col("single") - whole.scalar()).alias("duplicate_count"),
    )


def row_metrics(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per named frame; over stored Parquet tables it reads only file footers."""
    counts = [df.agg(F.lit(name).alias("name"), F.count("*").alias("rows")) for name, df in frames.items()]
    return reduce(DataFrame.unionAll, counts)


def profile(df: DataFrame, table: str, approx: bool = False, **formats: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Table metrics and column metrics of one table, both labelled with its name."""
    columns = profile_columns(df, approx=approx, **formats)
    return profile_table(df, table, approx), columns.select(F.lit(table).alias("table"), "*")
