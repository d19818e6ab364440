"""Tables, runs, reports, slices and published tables."""

import datetime
import json
from dataclasses import replace

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tablewright.model import SLICES, TABLES, SliceSpec
from tablewright.operators.slices import cut_slice, split_slices
from tablewright.session import shared_dir, subfolders
from tablewright.sinks.catalog import create_table, publish, read_published, verify_counts
from tablewright.sinks.reports import write_report
from tablewright.sinks.runs import write_counted, write_run
from tablewright.sources.relational import list_tables, read_jdbc_tables
from tablewright.sources.runs import (
    dq_report_for,
    finished_runs,
    last_run,
    latest_run,
    new_run_ts,
    read_last,
    read_latest,
    read_layer,
    read_report,
    read_run,
)
from tablewright.sources.tables import read_table, read_tables
from tests.test_quality import wide


def test_shared_dir_follows_the_session(spark):
    setting = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    base = setting or spark.conf.get("spark.sql.warehouse.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(base.rstrip("/")) and first != second


def test_missing_tables(spark, tmp_path):
    base = str(tmp_path)
    spark.range(3).write.parquet(f"{base}/customer")
    assert list(read_tables(spark, base, TABLES)) == ["customer"]
    assert read_table(spark, f"{base}/nope", on_missing="skip") is None
    with pytest.raises(AnalysisException):
        read_table(spark, f"{base}/nope")
    with pytest.raises(ValueError):
        read_table(spark, base, on_missing="ignore")


def test_date_folders_are_read(spark, tmp_path):
    base = str(tmp_path / "raw")
    spark.range(2).write.parquet(f"{base}/2024/01/02")
    spark.range(3).write.mode("append").parquet(base)
    assert read_table(spark, base, recursive=True).count() == 5
    assert read_table(spark, base, schema=spark.range(1).schema, recursive=True).count() == 5
    assert read_table(spark, base).count() == 3


def test_runs(spark, tmp_path):
    base = str(tmp_path / "layer")
    write_run(spark.range(3), base, "20240101_000000")
    write_run(spark.range(4), base, "20240102_000000", compression="gzip")
    write_run(spark.range(5), base, "20240102_000000")
    assert [read_run(spark, base, r).count() for r in ("20240101_000000", "20240102_000000")] == [3, 5]
    layer = read_layer(spark, base)
    assert latest_run(layer).first()[0] == "20240102_000000"
    assert read_latest(layer).count() == 5
    assert dq_report_for(layer, "20240101_000000").count() == 3
    assert dq_report_for(layer, "20990101_000000").count() == 5
    assert new_run_ts(datetime.datetime(2024, 1, 2, 3, 4, 5)) == "20240102_030405"


def test_latest_run_prunes_folders(spark, tmp_path):
    base = str(tmp_path / "layer")
    for day in (1, 2):
        write_run(spark.range(3), base, f"2024010{day}_000000")
    latest = read_latest(read_layer(spark, base))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_ts" in plan


def test_last_run_opens_no_older_file_and_no_unfinished_run(spark, tmp_path):
    base = str(tmp_path / "layer")
    with pytest.raises(ValueError, match="no finished run"):
        last_run(spark, base)
    for day in (1, 2):
        write_run(spark.range(day), base, f"2024010{day}_000000")
    spark.range(9).write.parquet(f"{base}/run_ts=20240103_000000/_temporary/0")
    assert finished_runs(spark, base) == ["20240101_000000", "20240102_000000"]
    assert all("run_ts=20240102_000000" in f for f in read_last(spark, base).inputFiles())
    assert sorted((r["id"], r["run_ts"]) for r in read_last(spark, base).collect()) == [(0, "20240102_000000"), (1, "20240102_000000")]
    assert read_report(spark, base, "20240101_000000").count() == 1
    assert read_report(spark, base, "20990101_000000").count() == 2


def test_report_is_one_json_document(spark, tmp_path):
    path = write_report(spark.sql("SELECT 'x' job, map('t', struct(1 AS row_count)) tables"), str(tmp_path), "1")
    (text,) = [r[0] for r in spark.read.text(path).collect()]
    assert json.loads(text) == {"job": "x", "tables": {"t": {"row_count": 1}}}


def rows(spark):
    base = {"customer_first_name": "a", "order_date": datetime.date(2024, 1, 1), "order_amount": 1.0}
    return wide(
        spark,
        {**base, "order_id": 1, "customer_id": 1, "payment_id": 7, "payment_date": datetime.date(2024, 2, 1)},
        {**base, "order_id": 2, "customer_id": 1, "payment_id": None, "customer_first_name": "b"},
        {**base, "order_id": 3, "customer_id": 2, "payment_id": None, "order_date": datetime.date(2024, 1, 2)},
    )


def test_slices(spark):
    slices = split_slices(rows(spark))
    assert {n: df.count() for n, df in slices.items()} == {"customer": 2, "address": 2, "orders": 3, "payments": 1}
    assert slices["customer"].where("customer_id = 1").first()["customer_first_name"] == "b"
    assert split_slices(rows(spark), compat=True)["payments"].count() == 2
    all_payments = rows(spark).union(rows(spark).withColumn("payment_id", F.lit(9).cast("long")))
    assert split_slices(rows(spark), payments=all_payments)["payments"].count() == 2
    spec = SliceSpec("o", "order_id", ("order_id", "customer_id"))
    assert cut_slice(rows(spark), spec).columns == ["order_id", "customer_id"]


def test_publish_modes(spark, tmp_path):
    slices = split_slices(rows(spark))
    counts = {"customer": 2, "address": 2, "orders": 3, "payments": 1}

    def load(mode, slices=slices, name="modes"):
        return {r["table"]: r["row_count"] for r in publish(spark, slices, name, str(tmp_path / name), mode=mode, buckets=2).collect()}

    assert load("upsert") == counts
    assert load("upsert") == counts  # publishing twice leaves one copy
    assert load("append") == {t: 2 * n for t, n in counts.items()}
    assert load("replace") == counts
    moved = {**slices, "orders": slices["orders"].where("order_id <> 3")}
    assert load("upsert", moved)["orders"] == 3  # the partition of 2024-01-02 is left alone
    assert load("replace", moved)["orders"] == 2
    assert {r["table"] for r in verify_counts(spark, "modes", ["orders"]).collect()} == {"orders"}
    with pytest.raises(ValueError):
        load("merge")
    with pytest.raises(ValueError, match="no date partitions"):
        load("partitions")


def test_an_incremental_slice_deletes_nothing(spark, tmp_path):
    spec = [SLICES[0]]
    full = spark.range(10).select(F.col("id").alias("customer_id"), *[F.lit("old").alias(c) for c in SLICES[0].columns[1:]])
    part = full.where("customer_id >= 8").union(full.selectExpr("customer_id + 100", *SLICES[0].columns[1:]).limit(1))
    part = part.withColumn("customer_first_name", F.lit("new"))
    for rows_now in (full, part):
        publish(spark, {"customer": rows_now}, "keyed", str(tmp_path / "keyed"), spec)
    stored = spark.table("keyed.customer").select("customer_id", "customer_first_name").collect()
    assert len(stored) == 11 and sum(r["customer_first_name"] == "new" for r in stored) == 3


def test_layout_of_published_tables(spark, tmp_path):
    slices = split_slices(rows(spark))
    publish(spark, slices, "layout", str(tmp_path / "layout"), buckets=2)
    described = {t: {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED layout.{t}").collect()} for t in slices}
    assert described["customer"]["Num Buckets"] == "2"
    assert "# Partition Information" in described["orders"]
    days = {r["partition"] for r in spark.sql("SHOW PARTITIONS layout.orders").collect()}
    assert days == {"order_date_month=2024-01"}
    values = sorted(map(str, read_published(spark, "layout", SLICES[2]).collect()))
    assert values == sorted(map(str, slices["orders"].collect()))


def test_bucketed_tables_join_without_shuffle(spark, conf, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false")
    publish(spark, split_slices(rows(spark)), "colocated", str(tmp_path / "colocated"), buckets=2)
    joined = spark.table("colocated.customer").join(spark.table("colocated.address"), "customer_id")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()


def test_create_table_is_repeatable(spark, tmp_path):
    for _ in range(2):
        assert create_table(spark, rows(spark).select(*SLICES[2].columns), SLICES[2], "again", str(tmp_path)) == "again.orders"


ORDERS = SLICES[2]


def orders(spark, *rows):
    """(order_id, date) as a slice of orders."""
    df = spark.createDataFrame([(i, day and datetime.date.fromisoformat(day)) for i, day in rows], "order_id long, order_date date")
    rest = {c: F.lit(1).cast("double" if "amount" in c else "long" if c == "customer_id" else "string") for c in ORDERS.columns if c not in df.columns}
    return {"orders": df.withColumns(rest).select(*ORDERS.columns)}


def stored(spark, database, spec=ORDERS):
    return sorted(((r["order_id"], str(r["order_date"])) for r in read_published(spark, database, spec).collect()), key=str)


@pytest.mark.parametrize("grain", ["day", "month", "year"])
def test_an_upsert_by_key_of_dates(spark, tmp_path, grain):
    spec = replace(ORDERS, grain=grain)
    base, name = str(tmp_path / "w"), f"dated_{grain}"

    def load(*rows, mode="upsert"):
        got = publish(spark, orders(spark, *rows), name, base, [spec], mode)
        return got.first()["row_count"]

    ten = [(i, "2024-01-05") for i in range(10)]
    assert load(*ten) == 10
    assert load((10, "2024-01-05")) == 11  # one new order of a date deletes none of it
    assert load((10, "2024-01-05")) == 11
    assert load((3, "2024-03-01"), (4, None), (11, None)) == 12  # moved to another month, to no date, new without one
    assert load((3, "2024-01-05"), (4, "2025-01-05")) == 12  # and back
    want = sorted([(i, "2025-01-05" if i == 4 else "2024-01-05") for i in range(11)] + [(11, "None")], key=str)
    assert stored(spark, name, spec) == want
    labels = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}.orders").collect()}
    assert not any("2024-03" in x for x in labels) or grain == "year"  # an emptied partition is dropped
    assert load((20, "2024-01-05"), (21, "2024-01-06"), mode="partitions") == 4  # the date is replaced, no other
    assert load((30, "2024-07-01"), (31, "2024-01-05"), mode="append") == 6
    assert load((30, "2024-07-01"), (31, "2024-02-05")) == 6
    assert load((40, "2024-01-05"), mode="replace") == 1
    assert stored(spark, name, spec) == [(40, "2024-01-05")]
    assert load((40, "2024-01-05"), mode="replace") == 1
    copies = [p for v in subfolders(spark, f"{base}/orders") for p in subfolders(spark, f"{base}/orders/{v}")]
    assert len(copies) == 2 and len(set(copies)) == 1  # the partition in use and its last version; nothing of those dropped


def test_spans_of_published_dates(spark, tmp_path):
    rows = [(i, f"2024-{1 + i % 12:02d}-{1 + i % 28:02d}") for i in range(336)] + [(999, None)]
    publish(spark, orders(spark, *rows), "spans", str(tmp_path / "w"), [ORDERS], "replace")
    since, until = datetime.date(2024, 3, 10), datetime.date(2024, 5, 9)
    span = read_published(spark, "spans", ORDERS, since, until)
    assert {r["order_id"] for r in span.collect()} == {i for i, d in rows if d and "2024-03-10" <= d <= "2024-05-09"}
    scanned = {f.split("order_date_month=")[1].split("/")[0] for f in span.inputFiles()}
    assert scanned == {"2024-03", "2024-04", "2024-05"}
    assert {r["order_id"] for r in read_published(spark, "spans", ORDERS).collect()} == {i for i, _ in rows}


@pytest.mark.parametrize("mode", ["upsert", "replace"])
def test_a_write_that_fails_keeps_the_table(spark, tmp_path, mode):
    base = str(tmp_path / "w")
    customer = SLICES[0]

    def people(n, broken):
        bad = F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost"))).otherwise(F.lit("new"))
        return spark.range(n).select(F.col("id").alias("customer_id"), *[(bad if broken else F.lit("old")).cast("string").alias(c) for c in customer.columns[1:]])

    def dated(n, broken):
        rows = orders(spark, *[(i, f"2024-0{1 + i % 3}-05") for i in range(n)])["orders"]
        bad = F.when(F.col("order_id") == n - 1, F.raise_error(F.lit("lost"))).otherwise(F.lit("new")).cast("string")
        return rows.withColumn("order_status", bad) if broken else rows

    for name, spec, make in (("customer", customer, people), ("orders", ORDERS, dated)):
        database = f"failing_{mode}_{name}"
        publish(spark, {name: make(6, False)}, database, f"{base}/{database}", [spec], mode, buckets=2)
        with pytest.raises(Exception, match="lost"):
            publish(spark, {name: make(9, True)}, database, f"{base}/{database}", [spec], mode)
        assert spark.table(f"{database}.{name}").count() == 6
        assert [v for v in subfolders(spark, f"{base}/{database}/{name}") if v.startswith("v=")] == ["v=000001"]
        assert [t.name for t in spark.catalog.listTables(database)] == [name]
        # A driver that is lost leaves a version half written; the next load clears it away.
        spark.range(1).write.parquet(f"{base}/{database}/{name}/v=000007/_temporary/0")
        publish(spark, {name: make(9, False)}, database, f"{base}/{database}", [spec], mode)
        assert spark.table(f"{database}.{name}").count() == 9
        left = [v for v in subfolders(spark, f"{base}/{database}/{name}") if v.startswith("v=")]
        assert left == ["v=000001", "v=000008"] and "_incoming" not in subfolders(spark, f"{base}/{database}/{name}")


def test_a_driver_lost_between_two_partitions(spark, tmp_path, monkeypatch):
    """A key moves from one month to another, and the driver is lost before the second is pointed to."""
    base = str(tmp_path / "w")
    publish(spark, orders(spark, *[(i, "2024-01-05") for i in range(5)], *[(i, "2024-02-05") for i in range(5, 9)]), "torn", base, [ORDERS])
    moved = orders(spark, (1, "2024-02-07"))
    sql, seen = type(spark).sql, []

    def lost(self, text, *args, **more):
        if "SET LOCATION" in text:
            seen.append(text)
            if len(seen) == 2:
                raise RuntimeError("lost")
        return sql(self, text, *args, **more)

    monkeypatch.setattr(type(spark), "sql", lost)
    with pytest.raises(RuntimeError):
        publish(spark, moved, "torn", base, [ORDERS])
    monkeypatch.undo()
    spark.catalog.refreshTable("torn.orders")
    assert {i for i, _ in stored(spark, "torn")} >= set(range(9)) - {1}  # readable, each month old or new
    assert publish(spark, moved, "torn", base, [ORDERS]).first()["row_count"] == 9
    assert (1, "2024-02-07") in stored(spark, "torn")


def test_writes_count_their_rows(spark, tmp_path):
    base = str(tmp_path / "layer")
    assert write_counted(spark.range(7).repartition(3), base, "1") == 7
    assert write_counted(spark.range(7).where("id < 0"), base, "2") == 0
    assert write_counted(spark.createDataFrame([], "id long"), base, "3") == 0
    assert write_counted(spark.range(6).withColumn("p", F.col("id") % 2), base, "4", "p") == 6


class FakeReader:
    """Stands in for ``spark.read``: no database may run here, so this records what would be read."""

    def __init__(self, answers):
        self.answers, self.calls = answers, []

    @property
    def read(self):
        return self

    def jdbc(self, url, table, **options):
        self.calls.append((table, options))
        answer = next((v for k, v in self.answers.items() if k in table), [])
        return type("Frame", (), {"first": lambda s: answer[0] if answer else None, "collect": lambda s: answer})()


def test_jdbc_reads_by_key_ranges():
    reader = FakeReader({"min(order_id)": [(5, 905)], "min(empty_id)": [(None, None)], "information_schema": [("orders",), ("notes",)], "min(day)": [(datetime.date(2024, 1, 1), datetime.date(2024, 2, 1))]})
    assert list_tables(reader, "jdbc:x", "public", {}) == ["public.orders", "public.notes"]
    reader.calls.clear()
    frames = read_jdbc_tables(reader, "jdbc:x", {"orders": "order_id", "notes": None, "empty": "empty_id", "days": "day"}, 8, {"user": "u"})
    assert list(frames) == ["orders", "notes", "empty", "days"]
    whole = [c for c in reader.calls if not c[0].startswith("(")]
    ranges = {"user": "u", "partitionColumn": "order_id", "lowerBound": "5", "upperBound": "905", "numPartitions": "8"}
    assert whole[0] == ("orders", {"properties": ranges})
    assert whole[1:3] == [("notes", {"properties": {"user": "u"}}), ("empty", {"properties": {"user": "u"}})]
    assert whole[3][1]["properties"]["lowerBound"] == "2024-01-01"


def test_jdbc_reads_as_many_ranges_as_a_table_needs():
    reader = FakeReader({"min(order_id)": [(5, 905, 7_000_000)]})
    read_jdbc_tables(reader, "jdbc:x", {"orders": "order_id"})
    assert "count(*)" in reader.calls[0][0] and reader.calls[1][1]["properties"]["numPartitions"] == "4"


def test_a_hot_date_is_written_by_several_tasks(spark, conf, tmp_path):
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="50k", spark__sql__shuffle__partitions="8")
    hot = F.when(F.col("order_id") % 3 == 0, F.lit("2024-01-01")).otherwise(F.expr("date_add('2024-02-01', int(order_id % 9))"))
    orders = spark.range(0, 30000, 1, 8).select(
        F.col("id").alias("order_id"), F.col("id").alias("customer_id"), F.lit(1.0).alias("order_amount"),
        F.sha2(F.col("id").cast("string"), 256).alias("order_status"), F.lit(1.0).alias("total_amount"),
    ).withColumn("order_date", hot.cast("date"))
    slices = {"orders": orders.select(*SLICES[2].columns)}
    assert publish(spark, slices, "hot", str(tmp_path / "hot"), [SLICES[2]]).first()["row_count"] == 30000
    written = spark.table("hot.orders").select("order_date_month", F.input_file_name().alias("file")).distinct()
    files = {r["order_date_month"]: r["count"] for r in written.groupBy("order_date_month").count().collect()}
    assert files["2024-01"] > 1 and len(files) == 2
