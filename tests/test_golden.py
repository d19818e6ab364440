"""Counts written down in FIXTURES.md before any implementation, on its own raw tables."""

import pytest
from pyspark.sql import functions as F

from tablewright.operators.dedup import dedup_latest
from tablewright.operators.profile import profile_columns, row_metrics
from tablewright.operators.quality import check_referential, dq_checks, dq_score
from tablewright.operators.repair import repair
from tablewright.operators.slices import split_slices
from tablewright.plans.chain import curate
from tablewright.plans.raw_tables import source
from tablewright.sinks.runs import write_run
from tablewright.sources.runs import read_run
from tests.conftest import GOLDEN

RAW = {
    "raw_customer": """
        SELECT c_custkey AS customer_id, lower(c_mktsegment) AS first_name, split_part(c_name,'#',2) AS last_name,
          CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 50 = 1 THEN 'bad.address'
               WHEN c_custkey % 50 = 2 THEN 'ab@example.com'
               ELSE lower(c_mktsegment) || '.' || CAST(c_custkey AS STRING) || '@example.com' END AS email,
          CASE WHEN c_custkey % 41 = 0 THEN 'n/a' ELSE '+1 ' || lpad(CAST(c_custkey AS STRING),10,'0') END AS phone
        FROM customer WHERE c_custkey % 40 <> 39
        UNION ALL SELECT c_custkey, lower(c_mktsegment), 'dup', NULL, NULL FROM customer WHERE c_custkey % 20 = 0""",
    "raw_address": """
        SELECT c_custkey AS address_id, c_custkey AS customer_id,
          CAST(c_custkey AS STRING) || ' ' || lower(c_mktsegment) || ' st' AS street_address,
          n_name AS city, r_name AS state, lpad(CAST(c_nationkey AS STRING),5,'0') AS zip_code
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE c_custkey % 15 <> 0
        UNION ALL SELECT c_custkey + 10000000, c_custkey, 'unit 2', 'SECOND', NULL, NULL FROM customer WHERE c_custkey % 10 = 3""",
    "raw_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
          CASE WHEN o_orderkey % 211 = 0 THEN 'not-a-date' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS order_date,
          CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 101 = 0 THEN -1.0
               WHEN o_orderkey % 103 = 0 THEN 2000000.0 ELSE o_totalprice END AS order_amount,
          CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE ' ' || o_orderstatus || ' ' END AS order_status
        FROM orders WHERE o_custkey % 25 <> 4""",
    "raw_payments": """
        SELECT l_orderkey * 10 + l_linenumber AS payment_id, l_orderkey AS order_id,
          CASE WHEN l_partkey % 71 = 0 THEN NULL ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS payment_date,
          l_extendedprice AS amount, ' ' || l_returnflag || ' ' AS payment_method
        FROM lineitem""",
    "clean_orders": """
        SELECT * FROM raw_orders WHERE order_date <> 'not-a-date' AND order_status IS NOT NULL
          AND (order_amount IS NULL OR order_amount BETWEEN 0 AND 1000000)""",
}


@pytest.fixture(scope="module")
def raw(spark):
    """The raw tables as views of a session of their own."""
    session = spark.newSession()
    for table in ("customer", "nation", "region", "orders", "lineitem"):
        source(session, GOLDEN, table).createOrReplaceTempView(table)
    frames = {}
    for name, text in RAW.items():
        frames[name] = session.sql(text)
        frames[name].createOrReplaceTempView(name)
    return frames


def columns(df):
    return {r["column"]: r for r in profile_columns(df).collect()}


def test_raw_tables(raw):
    names = ("customer", "address", "orders", "payments")
    rows = {r["name"]: r["rows"] for r in row_metrics({n: raw[f"raw_{n}"] for n in names}).collect()}
    assert rows == {"customer": 1538, "address": 1550, "orders": 14369, "payments": 60000}
    assert 1538 - dedup_latest(raw["raw_customer"], "customer_id", "customer_id").count() == 75
    assert 60000 - dedup_latest(raw["raw_payments"], "payment_id", "payment_date").count() == 14168
    customer, orders = columns(raw["raw_customer"]), columns(raw["raw_orders"])
    assert (customer["email"]["invalid_email_count"], customer["phone"]["invalid_phone_count"]) == (29, 37)
    assert customer["email"]["null_count"] == 115
    assert (orders["order_amount"]["null_count"], orders["order_status"]["null_count"]) == (147, 163)
    assert columns(raw["raw_payments"])["payment_date"]["null_count"] == 863
    assert check_referential(raw["raw_orders"], raw["raw_customer"]).first()["failed_count"] == 262


@pytest.mark.parametrize(
    "orders, wide_rows, with_order, failing, score, status, repaired",
    [
        ("raw_orders", 48188, 48136, (234, 528, 942, 0), 62.5, "FAIL", 14107),
        ("clean_orders", 46492, 46440, (0, 0, 0, 0), 100.0, "PASS", 13603),
    ],
)
def test_chain(spark, raw, tmp_path, orders, wide_rows, with_order, failing, score, status, repaired):
    tables = {n: raw[f"raw_{n}"] for n in ("customer", "address", "payments")}
    write_run(curate({**tables, "orders": raw[orders]}), str(tmp_path), "1")
    wide = read_run(spark, str(tmp_path), "1")
    assert (wide.count(), wide.where(F.col("order_id").isNotNull()).count()) == (wide_rows, with_order)
    checks = dq_checks(wide)
    failed = {(r["check"], r["column"]): r["failed_count"] for r in checks.collect()}
    assert len(failed) == 8
    got = [failed["null_check", c] for c in ("order_date", "order_status")]
    got += [failed["numeric_range", c] for c in ("order_amount", "amount")]
    assert tuple(got) == failing
    assert tuple(dq_score(checks).select("dq_score_pct", "dq_status").first()) == (score, status)
    fixed = repair(wide)
    assert fixed.count() == repaired
    slices = split_slices(fixed)
    assert (slices["orders"].count(), slices["customer"].count()) == (repaired, 1411)
