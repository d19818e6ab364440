"""Work that reads no result of other work runs beside it."""

import threading

import pytest

from tablewright.model import SLICES
from tablewright.operators.integrate import integrate
from tablewright.operators.quality import check_casts
from tablewright.operators.repair import repair
from tablewright.operators.schema import cast_failures, enforce_schema
from tablewright.operators.slices import split_slices
from tablewright.plans import chain
from tablewright.session import together
from tablewright.sinks import catalog
from tests.test_latest_payment import frames


def meets(function, barrier):
    def run(*args, **kwargs):
        barrier.wait()
        return function(*args, **kwargs)

    return run


def test_results_keep_their_order_and_errors_wait_for_the_others(spark):
    both, ended = threading.Barrier(2, timeout=60), threading.Event()
    assert together(spark, [lambda: both.wait() and "a" or "a", lambda: both.wait() and "b" or "b"]) == ["a", "b"]
    assert together(spark, []) == [] and together(spark, [lambda: 1]) == [1]

    def fail():
        raise ValueError("first")

    def last():
        spark.range(10).count()
        ended.set()

    with pytest.raises(ValueError, match="first"):
        together(spark, [fail, last])
    assert ended.is_set()


def test_job_groups_reach_the_threads(spark):
    spark.sparkContext.setJobGroup("together", "two counts")
    together(spark, [spark.range(10).count, spark.range(20).count])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("together")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) >= 2


def test_slices_are_loaded_side_by_side(spark, tmp_path, monkeypatch):
    stored = str(tmp_path / "rows")
    repair(integrate(**frames(spark))).write.parquet(stored)
    slices = split_slices(enforce_schema(spark.read.parquet(stored)))
    monkeypatch.setattr(catalog, "create_table", meets(catalog.create_table, threading.Barrier(4, timeout=60)))
    got = catalog.publish(spark, slices, "side_by_side", str(tmp_path / "tables"), mode="replace")
    assert {r["table"]: r["row_count"] for r in got.collect()} == {n: df.count() for n, df in slices.items()}
    assert len(SLICES) == 4


def test_tables_are_masked_side_by_side_with_the_profile(spark, tmp_path, monkeypatch):
    met = threading.Barrier(5, timeout=60)
    monkeypatch.setattr(chain, "write_report", meets(chain.write_report, met))
    monkeypatch.setattr(chain, "write_counted", meets(chain.write_counted, met))
    monkeypatch.setattr(chain, "integrate_stage", lambda *_: None)
    monkeypatch.setattr(chain, "quality_stage", lambda *_: None)
    monkeypatch.setattr(chain, "publish_stage", lambda *_: None)
    tables = {n: df.drop("email_hashed") for n, df in frames(spark).items()}
    log = chain.run_chain(spark, tables, str(tmp_path), "1").collect()
    assert {r["table"]: r["rows_in"] for r in log} == {n: df.count() for n, df in tables.items()}


def test_casts_to_the_type_a_column_has_read_nothing(spark, tmp_path):
    spark.range(5).selectExpr("id AS a", "cast(id AS string) AS b", "'x' AS c").write.parquet(f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    plan = cast_failures(stored, stored.schema)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    target = spark.createDataFrame([], "a long, b long, c int").schema
    assert {r["column"]: r["failed_count"] for r in cast_failures(stored, target).collect()} == {"a": 0, "b": 0, "c": 5}
    assert check_casts(stored, target).first()["failed_count"] == 5
