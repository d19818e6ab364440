"""Profiles and checks merged from parts, against the whole."""

import pytest
from pyspark.sql import functions as F

from tablewright.operators.profile import profile_columns
from tablewright.operators.quality import check_duplicates, check_referential, check_rows, source_row_checks
from tablewright.operators.states import (
    column_states,
    merge_columns,
    merged_checks,
    merged_duplicates,
    merged_orphans,
    merged_profile,
    store_checks,
    store_keys,
    store_landing,
    store_profile,
)
from tablewright.plans.raw_tables import raw_table
from tests.conftest import SMALL


@pytest.fixture
def people(spark):
    big = 1 << 53
    return spark.range(4000).select(
        (F.col("id") % 1500).cast("int").alias("i"),
        F.when(F.col("id") % 9 > 0, F.col("id") + big).alias("l"),
        (F.col("id") / 7).alias("d"),
        (F.col("id") / 8).cast("decimal(12,3)").alias("m"),
        F.when(F.col("id") % 5 > 0, F.concat(F.col("id"), F.lit("@x.com"))).otherwise("bad").alias("email"),
        F.lit(None).cast("string").alias("phone"),
        F.expr("date_add('2024-01-01', int(id % 400))").alias("day"),
        F.lit(None).cast("double").alias("nothing"),
    )


def by_column(df):
    return {r["column"]: r.asDict() for r in df.collect()}


def test_merged_profiles_equal_the_whole(spark, tmp_path, people):
    base = str(tmp_path)
    for part in range(4):
        store_profile(people.where(F.col("i") % 4 == part), base, f"2024010{part}_000000")
    store_profile(people.where("i % 4 = 2"), base, "20240102_000000")  # landed again: counts once
    store_profile(people.limit(0), base, "20240109_000000")
    got, want = by_column(merged_profile(spark, base)), by_column(profile_columns(people))
    assert got["l"].pop("mean") == pytest.approx(want["l"].pop("mean"))  # beyond what a double tells apart
    for name, row in want.items():
        exact = got[name].pop("distinct_count")
        assert abs(exact - row["distinct_count"]) <= 0.03 * row.pop("distinct_count") + 0.5
        assert got[name] == row


def test_a_profile_of_nothing(people):
    got = by_column(merge_columns(column_states(people.limit(0))))
    assert got["l"]["distinct_count"] == 0 and got["l"]["mean"] is None and got["l"]["min"] is None


def test_merged_checks_equal_the_whole(spark, tmp_path):
    base = str(tmp_path)
    tables = {n: raw_table(spark, SMALL, n) for n in ("customer", "orders")}
    checks = {n: source_row_checks(df) for n, df in tables.items()}
    parts = {n: [df.where(F.pmod(F.xxhash64(*df.columns), F.lit(3)) == i) for i in range(3)] for n, df in tables.items()}
    for i in (0, 1, 2, 1):
        store_landing({n: parts[n][i] for n in tables}, checks, base, f"2024010{i}_000000")
    for name, df in tables.items():
        assert sorted(merged_checks(spark, f"{base}/{name}").collect()) == sorted(check_rows(df, checks[name]).collect())
    assert merged_orphans(spark, base, "orders", "customer", "customer_id").collect() == check_referential(tables["orders"], tables["customer"]).collect()


def test_copies_in_different_parts_are_found(spark, tmp_path):
    base = str(tmp_path)
    rows = spark.createDataFrame([(k,) for k in (1, 1, 2, 3, 3, 3, None, None)], "k long")
    for i in range(2):
        store_keys(rows.where(F.coalesce("k", F.lit(0)) != i), "k", base, "rows", f"{i}")
    store_checks(rows, [("null_check", "k", F.col("k").isNull())], base, "0")
    both = rows.where("k <> 0 OR k IS NULL").unionByName(rows.where("k <> 1 OR k IS NULL")).where("k IS NOT NULL")
    got = merged_duplicates(spark, base, "rows", "k", enforce=True)
    assert got.collect() == check_duplicates(both, "k", enforce=True).collect()
    assert merged_checks(spark, base).first()["failed_count"] == 2
