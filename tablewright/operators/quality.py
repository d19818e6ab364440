"""Data-quality checks as rows (check, column, failed_count, passed), their score, and routing.

All checks that look at one row at a time share one aggregate, so they cost one scan of the
columns they name and a shuffle of one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tablewright.functions.bitmaps import bits_for, flag_maybe, key_bits
from tablewright.functions.formats import bad_date, bad_format, bad_number, out_of_range
from tablewright.model import CRITICAL_COLUMNS, DATE_FORMAT, NUMERIC_RANGES, QualityRules
from tablewright.operators.schema import cast_failures

CHECK_SCHEMA = "check string, column string, failed_count long, passed boolean"
RowCheck = tuple[str, str, Column]  # check name, column, condition under which a row fails


def _row(check: str, column: str, failed: Column, passed: Column) -> Column:
    names = (("check", F.lit(check)), ("column", F.lit(column)), ("failed_count", failed), ("passed", passed))
    return F.struct(*[value.alias(name) for name, value in names])


def _one_pass(wide: DataFrame, checks: Sequence[RowCheck], rules: QualityRules) -> DataFrame:
    """Row checks and surplus rows per key from one read of ``wide``: counts are folded per key on the map
    side, then summed."""
    failing = [F.count_if(condition).alias(f"failed_{i}") for i, (_, _, condition) in enumerate(checks)]
    per_key = wide.groupBy(rules.duplicate_key).agg(F.count("*").alias("rows"), *failing)
    zero = F.lit(0).cast("long")
    surplus = F.sum(F.when(F.col(rules.duplicate_key).isNotNull(), F.col("rows") - 1))
    sums = [F.coalesce(F.sum(f"failed_{i}"), zero).alias(f"failed_{i}") for i in range(len(checks))]
    counts = per_key.agg(*sums, F.coalesce(surplus, zero).alias("surplus"))
    rows = [
        _row(check, column, F.col(f"failed_{i}"), F.col(f"failed_{i}") == 0)
        for i, (check, column, _) in enumerate(checks)
    ]
    passed = F.lit(not rules.enforce_duplicates) | (F.col("surplus") == 0)
    rows.append(_row("duplicate_check", rules.duplicate_key, F.col("surplus"), passed))
    return counts.select(F.inline(F.array(*rows)))


def check_rows(df: DataFrame, checks: Sequence[RowCheck]) -> DataFrame:
    """Count the rows that fail each check, in one pass over ``df``."""
    counts = df.agg(*[F.count_if(condition).alias(f"failed_{i}") for i, (_, _, condition) in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(check).alias("check"),
            F.lit(column).alias("column"),
            F.col(f"failed_{i}").alias("failed_count"),
            (F.col(f"failed_{i}") == 0).alias("passed"),
        )
        for i, (check, column, _) in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def _null_checks(columns: Sequence[str], where: Column) -> list[RowCheck]:
    return [("null_check", c, where & F.col(c).isNull()) for c in columns]


def _format_checks(columns: Sequence[str], kind: str) -> list[RowCheck]:
    return [(f"{kind}_format", c, bad_format(c, kind)) for c in columns]


def _range_checks(ranges: Mapping[str, tuple[float, float]]) -> list[RowCheck]:
    return [("numeric_range", c, out_of_range(c, low, high)) for c, (low, high) in ranges.items()]


def check_nulls(df: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS, key: str = "order_id") -> DataFrame:
    """NULLs in critical columns, among the rows that have an order."""
    return check_rows(df, _null_checks(columns, F.col(key).isNotNull()))


def check_format(df: DataFrame, column: str, kind: str) -> DataFrame:
    """Values that are present but not a valid ``email`` or ``phone``. Run it before masking:
    a masked value never passes."""
    return check_rows(df, _format_checks([column], kind))


def check_range(df: DataFrame, ranges: Mapping[str, tuple[float, float]] = NUMERIC_RANGES) -> DataFrame:
    """Values outside their inclusive range."""
    return check_rows(df, _range_checks(ranges))


def check_dates(df: DataFrame, columns: Sequence[str], date_format: str = DATE_FORMAT) -> DataFrame:
    """Values that are present but no date. Run it on raw text, before ``standardize``."""
    return check_rows(df, [("date_format", c, bad_date(c, date_format)) for c in columns])


def check_duplicates(df: DataFrame, key: str = "order_id", enforce: bool = False) -> DataFrame:
    """Surplus rows per key. Repair removes them, so by default the check reports and passes.

    Rows are counted per key on the map side, so a hot key travels as one row per map task.
    """
    per_key = df.groupBy(key).agg(F.count("*").alias("rows"))
    counts = per_key.agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).cast("long").alias("failed_count"))
    return counts.select(
        F.lit("duplicate_check").alias("check"),
        F.lit(key).alias("column"),
        "failed_count",
        (F.lit(not enforce) | (F.col("failed_count") == 0)).alias("passed"),
    )


def orphan_counts(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` per key value that ``parent`` does not have; NULL keys are orphans.

    The child is folded to one row per key before the join, so hot keys weigh nothing.
    """
    per_key = child.groupBy(key).agg(F.count("*").alias("rows"))
    return per_key.join(parent.select(key).distinct(), key, "left_anti")


def orphan_counts_sifted(child: DataFrame, parent: DataFrame, key: str, bits: int | None = None) -> DataFrame:
    """``orphan_counts`` with the keys that are surely missing folded into one NULL key before the shuffle.

    A bitmap over the parent's hashed keys tells them: rows of ``child`` that it rules out need neither shuffle nor join,
    and only the rest meets the parent. The bitmap is broadcast; its size follows the parent's rows up to a fixed bound.
    """
    bits = bits or bits_for(parent.count())
    marked = flag_maybe(child.select(key), key, key_bits(parent.select(key), key, bits), bits, "_maybe")
    return orphan_counts(marked.select(F.when(F.col("_maybe"), F.col(key)).alias(key)), parent, key)


def check_referential(
    child: DataFrame, parent: DataFrame, key: str = "customer_id", sifted: bool = False
) -> DataFrame:
    """Rows of ``child`` whose key is missing from ``parent``. ``sifted`` suits children with many orphans."""
    counts = (orphan_counts_sifted if sifted else orphan_counts)(child, parent, key).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("failed_count")
    )
    return counts.select(
        F.lit("referential_integrity").alias("check"),
        F.lit(key).alias("column"),
        "failed_count",
        (F.col("failed_count") == 0).alias("passed"),
    )


def wide_row_checks(wide: DataFrame, rules: QualityRules = QualityRules(), own_parent: bool = True) -> list[RowCheck]:
    """The checks of the wide row that look at one row at a time."""
    present = set(wide.columns)
    has_order = F.col(rules.duplicate_key).isNotNull()
    checks = _null_checks([c for c in rules.critical_columns if c in present], has_order)
    checks += _format_checks([c for c in rules.email_columns if c in present], "email")
    checks += _format_checks([c for c in rules.phone_columns if c in present], "phone")
    checks += _range_checks({c: r for c, r in rules.ranges.items() if c in present})
    if own_parent:
        checks.append(("referential_integrity", "customer_id", has_order & F.col("customer_id").isNull()))
    return checks


def source_row_checks(df: DataFrame, rules: QualityRules = QualityRules()) -> list[RowCheck]:
    """The checks of a raw table that look at one row at a time."""
    types = dict(df.dtypes)
    checks = _format_checks([c for c in rules.email_columns if c in types], "email")
    checks += _format_checks([c for c in rules.phone_columns if c in types], "phone")
    checks += [("date_format", c, bad_date(c)) for c in rules.date_columns if types.get(c) == "string"]
    checks += [("number_format", c, bad_number(c)) for c in rules.ranges if types.get(c) == "string"]
    return checks


def dq_checks(
    wide: DataFrame,
    rules: QualityRules = QualityRules(),
    child: DataFrame | None = None,
    parent: DataFrame | None = None,
) -> DataFrame:
    """Every check that applies to the wide row: one row per check.

    Columns that ``wide`` lacks are skipped. With ``child`` and ``parent`` (say orders and
    customers) the referential check compares those; the wide row starts from customers, so an
    order of an unknown customer never gets into it. Without them the check compares the wide
    row with its own customers, under which only a NULL customer can fail, so it needs no join.
    """
    result = _one_pass(wide, wide_row_checks(wide, rules, own_parent=parent is None), rules)
    if parent is not None:
        result = result.unionByName(check_referential(wide if child is None else child, parent))
    return result


def source_checks(tables: Mapping[str, DataFrame], rules: QualityRules = QualityRules()) -> DataFrame:
    """What only the raw tables can show, one row per check: formats before masking, dates and numbers that will not
    parse, orders of unknown customers. Tables and columns that are absent are skipped.

    One pass over the columns named per table; orders are folded to their customers before the anti join.
    """
    results = []
    for df in tables.values():
        checks = source_row_checks(df, rules)
        if checks:
            results.append(check_rows(df, checks))
    if {"orders", "customer"} <= set(tables):
        results.append(check_referential(tables["orders"], tables["customer"]))
    if not results:
        return next(iter(tables.values())).sparkSession.createDataFrame([], CHECK_SCHEMA)
    return reduce(DataFrame.unionByName, results)


def check_casts(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row: values of ``df`` that are present and would be lost when cast to ``schema``. Columns that
    ``df`` lacks are skipped."""
    failures = cast_failures(df, T.StructType([f for f in schema.fields if f.name in df.columns]))
    lost = F.coalesce(F.sum("failed_count"), F.lit(0)).cast("long")
    return failures.agg(lost.alias("n")).select(F.inline(F.array(_row("schema_cast", "wide", F.col("n"), F.col("n") == 0))))


def dq_score(checks: DataFrame, pass_threshold: float = QualityRules().pass_threshold) -> DataFrame:
    """One row: checks, passed checks, percentage and PASS or FAIL. No checks score 0. Of checks with a column ``scored``
    only those it marks count."""
    if "scored" in checks.columns:
        checks = checks.where("scored")
    counts = checks.agg(
        F.count("*").alias("total_checks"),
        F.count_if("passed").alias("passed_checks"),
    )
    share = F.round(F.try_divide(F.col("passed_checks"), F.col("total_checks")) * 100, 2)
    scored = counts.withColumn("dq_score_pct", F.coalesce(share, F.lit(0.0)))
    return scored.withColumns(
        {
            "dq_status": F.when(F.col("dq_score_pct") >= pass_threshold, "PASS").otherwise("FAIL"),
            "pass_threshold": F.lit(float(pass_threshold)),
        }
    )


def failed_details(checks: DataFrame) -> DataFrame:
    """The checks that failed, with their counts."""
    return checks.where(~F.col("passed")).select("check", "column", "failed_count")


def route_by_status(df: DataFrame, score: DataFrame) -> DataFrame:
    """Tag every row with the status of the run, read as a scalar subquery: no collect and no join."""
    return df.withColumn("dq_status", score.select("dq_status").scalar())
