"""The latest rows of stored tables: tasks that read input do not sort it, and keys with many rows are spread all the same."""

import pytest
from pyspark.sql import functions as F

from tablewright.operators.dedup import dedup_latest, dedup_latest_stored
from tablewright.operators.integrate import integrate
from tablewright.operators.repair import repair
from tablewright.plans.chain import ChainConfig, deduplicate
from tests.test_latest_payment import frames


@pytest.fixture
def rows(spark, tmp_path):
    """2000 rows of key 7 and 500 without a key, beside keys of three rows; ties, and rows that come twice."""
    n = F.col("id")
    key = F.when(n < 2000, 7).when(n < 2500, None).otherwise(1000 + n % 500)
    table = spark.range(4000).select(
        key.cast("long").alias("k"), (n % 2).alias("part"), F.when(n % 5 > 0, n % 11).alias("day"), (n % 900).cast("string").alias("note")
    )
    table.write.parquet(f"{tmp_path}/rows")
    return spark.read.parquet(f"{tmp_path}/rows")


def _limited(plan):
    """What the sorts below group limits before a shuffle read, but for parts that adaptive execution found empty."""
    lines = plan.splitlines()
    below = [lines[i + 2] for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line]
    return [line for line in below if "EmptyRelation" not in line]


def _sorted(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("keys", ["k", ["k", "part"]])
@pytest.mark.parametrize("most", [0, 100, 1_000_000])
def test_rows_are_those_of_dedup_latest(rows, keys, most):
    got = dedup_latest_stored(rows, keys, "day", most=most)
    assert got.columns == rows.columns
    assert _sorted(got) == _sorted(dedup_latest(rows, keys, "day")) and got.count() > 500


def test_tables_of_nothing_but_keys_and_with_maps(spark):
    keys = spark.range(30).select((F.col("id") % 4).alias("k"))
    for most in (0, 100):
        assert _sorted(dedup_latest_stored(keys, "k", "k", most=most)) == [(0,), (1,), (2,), (3,)]
        maps = keys.select("k", F.create_map(F.lit("a"), "k").alias("m"))
        assert dedup_latest_stored(maps, "k", "k", most=most).count() == 4


def test_input_is_not_sorted_before_the_shuffle(rows, executed):
    assert _limited(executed(dedup_latest(rows, "k", "day")))
    plan = executed(dedup_latest_stored(rows, "k", "day"))
    assert not _limited(plan) and plan.count("EmptyRelation Project") == 1  # no key is crowded: that part reads nothing


def test_rows_of_crowded_keys_are_limited_before_they_meet(rows, executed):
    plan = executed(dedup_latest_stored(rows, "k", "day", most=100))
    assert "LeftSemi" in plan and len(_limited(plan)) == 1


def test_chain_does_not_sort_the_input_of_narrow_tables(spark, executed):
    latest = deduplicate(frames(spark), ChainConfig().tables)
    for name in ("orders", "payments"):
        assert not _limited(executed(latest[name]))


def test_orders_have_one_row_before_repair(spark):
    """The address of a customer is chosen as repair chooses it: the greatest, with missing texts as UNKNOWN."""
    tables = frames(spark)
    kind = "address_id long, customer_id long, street_address string, city string, state string, zip_code string"
    homes = [(1, 1, "b", None, "s", "1"), (2, 1, "b", "T", "s", "2"), (3, 1, "b", "V", "s", "0"), (4, 2, None, "c", "s", None),
             (5, 2, "Z", "c", "s", "9"), (6, 3, None, None, None, None), (7, 3, "UNKNOWN", None, "A", "1"), (8, 4, "x", "c", None, "z"),
             (9, 4, "x", "c", "UNKNOWN", "zz"), (10, None, "x", "y", "z", "0"), (11, None, "x", "y", "z", "1"), (12, 77, "x", "y", "z", "1")]
    tables["address"] = spark.createDataFrame(homes, kind)
    latest = integrate(**tables, latest_payment=True)
    assert latest.where("order_id IS NOT NULL").groupBy("order_id").count().where("count > 1").isEmpty()
    want = _sorted(repair(integrate(**tables)))
    assert _sorted(repair(latest, one_row=True)) == want and len(want) > 15
    assert {"V", "T"} & {r["customer_city"] for r in repair(latest, one_row=True).collect()} == {"V"}
