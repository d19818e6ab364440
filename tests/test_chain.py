import json

import pytest

from tablewright.plans.chain import (
    ChainConfig,
    curate,
    integrate_stage,
    latest_of,
    mask_stage,
    publish_stage,
    quality_stage,
    run_chain,
    run_log,
)
from tablewright.sources.runs import read_layer


#: Spark jobs of the chain below with counts of stored files; now it takes 84, give or take what adaptive execution splits off.
JOBS = 102


@pytest.fixture
def tables(spark):
    return {
        "customer": spark.createDataFrame(
            [(1, "Ann", "Smith", "ann@x.com", "+1 5551234"), (1, "Ann", "Smith", None, None), (2, "Bo", "Lee", "bo@x.com", "n/a")],
            "customer_id int, first_name string, last_name string, email string, phone string",
        ),
        "address": spark.createDataFrame(
            [(1, 1, "1 main st", "Rome", "IT", "00100")],
            "address_id int, customer_id int, street_address string, city string, state string, zip_code string",
        ),
        "orders": spark.createDataFrame(
            [(10, 1, "2024-01-01", 5.0, " New "), (11, 2, "2024-01-02", None, "done"), (12, 99, "2024-01-02", 1.0, "lost")],
            "order_id int, customer_id int, order_date string, order_amount double, order_status string",
        ),
        "payments": spark.createDataFrame(
            [(100, 10, "2024-01-03", 2.0, "Card"), (101, 10, "2024-01-04", 3.0, "Cash"), (101, 10, "2024-01-02", 9.0, "old")],
            "payment_id int, order_id int, payment_date string, amount double, payment_method string",
        ),
    }


def log(df):
    return {(r["stage"], r["table"]): (r["rows_in"], r["rows_out"], r["status"]) for r in df.collect()}


def test_passing_run_is_published(spark, tables, tmp_path):
    config = ChainConfig(database="chain_pass", buckets=2, keep_dedup_layer=True, salt="s")
    got = log(run_chain(spark, tables, str(tmp_path), "20240101_000000", config))
    assert got["mask", "customer"] == (3, 2, "DONE")
    assert got["integrate", "wide"] == (2 + 1 + 3 + 2, 3, "DONE")
    assert got["quality", "wide"] == (3, 2, "PASS")
    assert {t: got["publish", t][1] for t in ("customer", "address", "orders", "payments")} == {
        "customer": 2, "address": 2, "orders": 2, "payments": 1,
    }
    orders = {r["order_id"]: r for r in spark.table("chain_pass.orders").collect()}
    assert (orders[10]["total_amount"], orders[10]["order_status"], orders[11]["total_amount"]) == (8.0, "new", 0.0)
    assert spark.table("chain_pass.payments").first()["payment_id"] == 101
    address = {r["customer_id"]: r["customer_city"] for r in spark.table("chain_pass.address").collect()}
    assert address == {1: "Rome", 2: "UNKNOWN"}
    customers = {r["customer_id"]: r for r in spark.table("chain_pass.customer").collect()}
    assert customers[2]["customer_email"] == "**@x.com" and len(customers[2]["email_hashed"]) == 64
    report = json.loads(spark.read.text(f"{tmp_path}/logs/profiling/run_ts=20240101_000000").first()[0])
    assert report["tables"]["customer"]["columns"]["phone"]["invalid_phone_count"] == 1
    quality = json.loads(spark.read.text(f"{tmp_path}/logs/dq/run_ts=20240101_000000").first()[0])
    assert (quality["total_rows"], quality["dq_score_pct"], quality["failed_checks"]) == (3, 100.0, [])
    again = log(run_chain(spark, tables, str(tmp_path), "20240102_000000", config))
    assert again == got  # a second run leaves one copy of every published row
    assert read_layer(spark, f"{tmp_path}/runs").select("run_ts").distinct().count() == 2


def test_failing_run_is_kept_apart(spark, tables, tmp_path):
    config = ChainConfig(database="chain_fail", buckets=2, profile=False)
    run_chain(spark, tables, str(tmp_path), "20240101_000000", config)
    before = spark.table("chain_fail.orders").count()
    tables["orders"] = tables["orders"].selectExpr("order_id", "customer_id", "order_date", "-1D AS order_amount", "order_status")
    got = log(run_chain(spark, tables, str(tmp_path), "20240102_000000", config))
    assert got["quality", "wide"] == (3, 2, "FAIL")
    assert got["publish", "orders"] == (2, 0, "SKIPPED")
    assert spark.table("chain_fail.orders").count() == before  # the gate left the published rows alone
    rejected = spark.read.parquet(f"{tmp_path}/routed/run_ts=20240102_000000/dq_status=FAIL")
    assert rejected.count() == 2


def test_the_gate_runs_every_check(spark, tables, tmp_path):
    tables["orders"] = tables["orders"].selectExpr(
        "order_id", "customer_id", "order_date", "if(order_id = 11, '12,50', string(order_amount)) AS order_amount", "order_status"
    )
    config = ChainConfig(database="chain_checks", buckets=2, profile=False, all_checks=True)
    got = log(run_chain(spark, tables, str(tmp_path), "1", config))
    checks = {(r["check"], r["column"]): r["failed_count"] for r in spark.read.parquet(f"{tmp_path}/logs/dq_checks/run_ts=1").collect()}
    found = {k: n for k, n in checks.items() if n}
    assert found == {("phone_format", "phone"): 1, ("referential_integrity", "customer_id"): 1, ("number_format", "order_amount"): 1, ("duplicate_check", "order_id"): 1}
    assert checks["email_format", "email"] == checks["date_format", "order_date"] == checks["schema_cast", "wide"] == 0
    assert got["quality", "wide"][2] == "FAIL"


def test_stages_by_themselves(spark, tables, tmp_path):
    base, config = str(tmp_path), ChainConfig(database="chain_stages", buckets=2)
    mask_stage(spark, tables, base, "1_a", config)
    with pytest.raises(ValueError, match="'integrate' has not run"):
        quality_stage(spark, base, "1_c", config=config)
    integrate_stage(spark, base, "1_b", config=config)
    assert quality_stage(spark, base, "1_c", config=config) == "PASS"
    tables["orders"] = tables["orders"].selectExpr("order_id", "customer_id", "order_date", "-1D AS order_amount", "order_status")
    mask_stage(spark, tables, base, "2_a", config)
    integrate_stage(spark, base, "2_b", config=config)
    assert quality_stage(spark, base, "2_c", config=config) == "FAIL"
    assert quality_stage(spark, base, "3_c", "1_b", config) == "PASS"  # an earlier run, by name
    publish_stage(spark, base, "2_d", "2_c", config)
    publish_stage(spark, base, "3_d", config=config)  # the latest checked run
    with pytest.raises(ValueError, match="has not been checked"):
        publish_stage(spark, base, "4_d", "9_c", config)
    log = {(r["run_ts"], r["table"]): (r["input_run_ts"], r["status"]) for r in run_log(spark, base).collect()}
    assert log["2_b", "wide"] == ("2_a", "DONE") and log["3_c", "wide"] == ("1_b", "PASS")
    assert log["2_d", "orders"] == ("2_c", "SKIPPED") and log["3_d", "orders"] == ("3_c", "DONE")
    assert latest_of(spark, base, "publish") == "3_d"


def test_jobs_of_a_passing_chain(spark, tables, tmp_path):
    """Rows are counted while they are written: no job counts them afterwards."""
    for name, df in tables.items():
        df.write.parquet(f"{tmp_path}/raw/{name}")
    stored = {n: spark.read.parquet(f"{tmp_path}/raw/{n}") for n in tables}
    config = ChainConfig(database="chain_jobs", buckets=2, profile=False)
    spark.sparkContext.setJobGroup("chain_jobs", "a passing chain")
    got = log(run_chain(spark, stored, f"{tmp_path}/out", "1", config))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("chain_jobs"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got["publish", "orders"] == (2, 2, "DONE")
    assert jobs < JOBS - 10


def test_missing_table_is_named(spark, tables, tmp_path):
    del tables["address"]
    with pytest.raises(ValueError, match="missing tables: \\['address'\\]"):
        curate(tables)
    with pytest.raises(ValueError, match="missing tables"):
        run_chain(spark, tables, str(tmp_path))


def test_no_python_and_no_cross_join_in_the_plan(tables):
    plan = curate(tables)._jdf.queryExecution().executedPlan().toString()
    assert "PythonEval" not in plan and "EvalPython" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
