import pytest
from pyspark.sql import functions as F

from tablewright.model import QualityRules, wide_schema
from tablewright.operators.quality import (
    check_dates,
    check_duplicates,
    check_format,
    check_nulls,
    check_range,
    check_referential,
    dq_checks,
    dq_score,
    failed_details,
    route_by_status,
)
from tablewright.operators.repair import repair
from tablewright.operators.schema import cast_failures, enforce_schema, require_columns


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def wide(spark, *rows):
    """Wide rows from dicts; absent columns are NULL."""
    schema = wide_schema()
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in rows], schema)


def test_range_bounds_are_valid(spark):
    df = spark.createDataFrame([(0.0,), (1000000.0,), (-0.01,), (1000000.01,), (None,)], "x double")
    assert one(check_range(df, {"x": (0, 1000000)}))["failed_count"] == 2


def test_formats_pass_null(spark):
    df = spark.createDataFrame(
        [(None, None), ("a.b-c_d@x-y.org", "+1 (555) 123-45"), ("a@b", "123456"), ("an**@x.com", "12*4567")],
        "email string, phone string",
    )
    assert one(check_format(df, "email", "email"))["failed_count"] == 2
    assert one(check_format(df, "phone", "phone"))["failed_count"] == 2
    with pytest.raises(ValueError, match="unknown format"):
        check_format(df, "email", "zip")


def test_nulls_count_only_rows_with_an_order(spark):
    df = spark.createDataFrame([(None, None), (1, None), (2, "x")], "order_id int, order_status string")
    counts = {r["column"]: r["failed_count"] for r in check_nulls(df, ["order_id", "order_status"]).collect()}
    assert counts == {"order_id": 0, "order_status": 1}


def test_duplicates_report_or_fail(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (None,), (None,)], "order_id int")
    assert tuple(one(check_duplicates(df)))[2:] == (3, True)
    assert tuple(one(check_duplicates(df, enforce=True)))[2:] == (3, False)
    assert tuple(one(check_duplicates(df.limit(0), enforce=True)))[2:] == (0, True)


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "customer_id int")
    parent = spark.createDataFrame([(2,), (2,), (None,)], "customer_id int")
    assert one(check_referential(child, parent))["failed_count"] == 3


def test_dates(spark):
    df = spark.createDataFrame([("2024-01-31",), ("2024-02-30",), ("x",), (None,)], "d string")
    assert one(check_dates(df, ["d"]))["failed_count"] == 2


@pytest.mark.parametrize("passed, total, score, status", [(8, 8, 100.0, "PASS"), (7, 8, 87.5, "FAIL"), (0, 0, 0.0, "FAIL"), (9, 10, 90.0, "PASS"), (2, 3, 66.67, "FAIL")])
def test_score(spark, passed, total, score, status):
    checks = spark.range(total).selectExpr(f"id < {passed} AS passed")
    assert tuple(one(dq_score(checks)))[:4] == (total, passed, score, status)


def test_eight_checks_on_the_wide_row(spark):
    good = {"order_id": 1, "customer_id": 1, "order_amount": 5.0, "order_status": "new", "amount": None}
    df = wide(spark, good, {"customer_id": 2}).withColumn(
        "order_date", F.when(F.col("order_id").isNotNull(), F.to_date(F.lit("2024-01-01")))
    )
    checks = dq_checks(df)
    assert checks.count() == 8
    assert one(dq_score(checks))["dq_status"] == "PASS"
    bad = df.withColumn("order_amount", F.lit(-1.0))
    assert one(dq_score(dq_checks(bad)))["dq_score_pct"] == 87.5
    assert [tuple(r) for r in failed_details(dq_checks(bad)).collect()] == [("numeric_range", "order_amount", 2)]
    # columns that are absent are skipped, and formats are checked where the names match
    fewer = df.drop("amount", "order_status").withColumn("email", F.lit("no"))
    names = [(r["check"], r["column"]) for r in dq_checks(fewer).collect()]
    assert len(names) == 7 and ("email_format", "email") in names
    with_parent = dq_checks(df, child=df, parent=df.where("customer_id = 2"))
    assert with_parent.where("check = 'referential_integrity'").first()["failed_count"] == 1
    assert not dq_checks(df.union(df), QualityRules(enforce_duplicates=True)).where("check = 'duplicate_check'").first()["passed"]


def test_route_tags_without_join(spark, executed):
    df = spark.range(3)
    score = dq_score(spark.range(8).selectExpr("id < 7 AS passed"))
    routed = route_by_status(df, score)
    assert [r["dq_status"] for r in routed.collect()] == ["FAIL"] * 3
    assert "Join" not in executed(routed)


def test_repair(spark):
    rows = [
        {"order_id": 1, "payment_id": 5, "amount": 1.0, "total_amount": None},
        {"order_id": 1, "payment_id": 6, "amount": 2.5},
        {"order_id": 2, "order_amount": 3.004, "customer_city": "Rome"},
        {"customer_id": 9},
    ]
    df = wide(spark, *rows)
    dated = df.withColumn("payment_date", F.when(F.col("payment_id") == 5, F.to_date(F.lit("2024-01-01"))))
    fixed = {r["order_id"]: r for r in repair(dated).collect()}
    assert set(fixed) == {1, 2}
    assert (fixed[1]["payment_id"], fixed[1]["order_amount"], fixed[1]["total_amount"]) == (5, 0.0, 1.0)
    assert (fixed[2]["total_amount"], fixed[2]["customer_city"], fixed[2]["customer_email"]) == (3.0, "Rome", "UNKNOWN")
    assert fixed[2]["payment_id"] is None and fixed[2]["order_date"] is None


def test_schema(spark):
    df = spark.createDataFrame([("1", "x", "2024-01-01"), ("z", None, "nope")], "order_id string, note string, order_date string")
    schema = "order_id bigint, order_date date"
    target = spark.createDataFrame([], schema).schema
    got = [tuple(map(str, r)) for r in enforce_schema(df, target, ["order_id"]).collect()]
    assert got == [("1", "2024-01-01"), ("None", "None")]
    assert {r["column"]: r["failed_count"] for r in cast_failures(df, target).collect()} == {"order_id": 1, "order_date": 1}
    with pytest.raises(ValueError, match="missing required columns: \\['payment_id'\\]"):
        require_columns(df, ["order_id", "payment_id"])
    with pytest.raises(ValueError, match="missing required columns"):
        enforce_schema(df)


def test_all_checks_read_the_wide_row_once(spark, tmp_path):
    wide(spark).write.parquet(f"{tmp_path}/wide")
    checks = dq_checks(spark.read.parquet(f"{tmp_path}/wide"))
    assert checks._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
