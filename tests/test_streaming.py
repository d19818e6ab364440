import datetime
import os

import pytest
from pyspark.sql import functions as F

from tablewright.operators.dedup import dedup_latest
from tablewright.operators.integrate import standardize_payments
from tablewright.operators.mask import mask_pii
from tablewright.streaming.landing import (
    finish_load,
    land_changes,
    land_evolving,
    read_changes,
    read_landed,
    read_loads,
    recorded_schema,
)
from tablewright.streaming.latest import compact, read_current, stream_latest

SCHEMA = "k int, t int, op string, v string"


@pytest.fixture
def changes(spark, tmp_path):
    """Three files; rows arrive out of order and one key is deleted."""
    files = [
        [(1, 5, "I", "new"), (2, 1, "I", "a")],
        [(1, 3, "U", "late"), (2, 2, "D", None), (3, 1, "I", "x")],
        [(3, 2, "U", "y"), (None, 1, "I", "n")],
    ]
    for rows in files:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "source"))
    schema = spark.createDataFrame([], SCHEMA).schema
    return lambda: read_changes(spark, str(tmp_path / "source"), schema, files_per_batch=1)


def rows(df):
    return sorted(map(str, df.collect()))


def test_stream_equals_batch(spark, changes, tmp_path):
    path = str(tmp_path / "latest")
    stream_latest(changes(), path, str(tmp_path / "cp"), "k", "t", once=True).awaitTermination()
    batch = dedup_latest(spark.read.parquet(str(tmp_path / "source")), "k", "t")
    assert rows(read_current(spark, path, "k", "t")) == rows(batch)
    live = read_current(spark, path, "k", "t", op_column="op")
    assert rows(live) == rows(batch.where("op <> 'D'"))
    assert compact(spark, path, "k", "t") == compact(spark, path, "k", "t")
    assert rows(read_current(spark, path, "k", "t", op_column="op")) == rows(live)
    spark.createDataFrame([(3, 9, "D", None), (4, 1, "I", "z")], SCHEMA).write.mode("append").parquet(str(tmp_path / "source"))
    stream_latest(changes(), path, str(tmp_path / "cp"), "k", "t", once=True).awaitTermination()
    after = dedup_latest(spark.read.parquet(str(tmp_path / "source")), "k", "t").where("op <> 'D'")
    assert rows(read_current(spark, path, "k", "t", op_column="op")) == rows(after)
    assert {r["k"] for r in after.collect()} == {1, 4, None}


def numbered(spark, path, many=40, version=0, only=None):
    """A change file with one row for each of ``many`` keys, or of those in ``only``."""
    keys = spark.range(many).select(F.col("id").cast("int").alias("k"))
    keys = keys if only is None else keys.where(F.col("k").isin(only))
    keys.selectExpr("k", f"{version} AS t", "'U' AS op", f"'v{version}' AS v").coalesce(1).write.mode("append").parquet(path)


def inside(path, *parts):
    folder = os.path.join(path, *parts)
    return sorted(n for n in os.listdir(folder) if not n.startswith((".", "_"))) if os.path.isdir(folder) else []


def test_compaction_rewrites_the_buckets_that_changed(spark, tmp_path):
    source, path = str(tmp_path / "source"), str(tmp_path / "latest")
    schema = spark.createDataFrame([], SCHEMA).schema

    def land(**more):
        numbered(spark, source, **more)
        changes = read_changes(spark, source, schema, files_per_batch=1)
        stream_latest(changes, path, str(tmp_path / "cp"), "k", "t", once=True, buckets=8).awaitTermination()

    land()
    assert compact(spark, path, "k", "t") == 0
    assert len(inside(path, "folded", "upto=0")) == 8
    versions = {}
    for number in range(1, 6):
        land(version=number, only=[1])
        assert compact(spark, path, "k", "t") == number
        (bucket,) = inside(path, f"folded/upto={number}")  # one key has changed: one bucket is written
        versions[number] = bucket
        want = {k: f"v{number}" if k == 1 else "v0" for k in range(40)}
        assert {r["k"]: r["v"] for r in read_current(spark, path, "k", "t").collect()} == want
        # The last two versions of the bucket are there, and the seven others where they were first written.
        assert inside(path, "folded") == sorted({"upto=0", f"upto={number - 1}", f"upto={number}"})
        assert len(inside(path, "folded", "upto=0")) == (8 if number == 1 else 7)
        assert inside(path, "batches") == [f"batch_id={number}"]
        assert inside(path, "committed") == [str(number)]
        assert inside(path, "compactions") == sorted([str(number - 1), str(number)])
    assert compact(spark, path, "k", "t") == 5
    land(version=9, only=[2, 3])
    assert {r["v"] for r in read_current(spark, path, "k", "t").where("k IN (2, 3)").collect()} == {"v9"}


def test_a_compaction_cut_short_is_made_anew(spark, tmp_path):
    source, path = str(tmp_path / "source"), str(tmp_path / "latest")
    schema = spark.createDataFrame([], SCHEMA).schema
    for version in (0, 1):
        numbered(spark, source, version=version)
        changes = read_changes(spark, source, schema, files_per_batch=1)
        stream_latest(changes, path, str(tmp_path / "cp"), "k", "t", once=True, buckets=4).awaitTermination()
        if not version:
            compact(spark, path, "k", "t")
    want = rows(read_current(spark, path, "k", "t"))
    # Written but not listed: readers and the next compaction do not see it.
    spark.createDataFrame([(1, 99, "U", "torn")], SCHEMA).withColumn("key_bucket", F.lit(0)).write.partitionBy("key_bucket").parquet(f"{path}/folded/upto=1")
    spark.range(1).write.parquet(f"{path}/compactions/1/_temporary/0")
    assert rows(read_current(spark, path, "k", "t")) == want
    assert compact(spark, path, "k", "t") == 1
    assert rows(read_current(spark, path, "k", "t")) == want


def test_an_unfinished_compaction_is_not_read(spark, changes, tmp_path):
    path = str(tmp_path / "latest")
    stream_latest(changes(), path, str(tmp_path / "cp"), "k", "t", once=True).awaitTermination()
    want = rows(read_current(spark, path, "k", "t"))
    spark.createDataFrame([], SCHEMA).write.parquet(f"{path}/folded/upto=2")  # cut short: not listed
    assert rows(read_current(spark, path, "k", "t")) == want
    compact(spark, path, "k", "t")
    assert rows(read_current(spark, path, "k", "t")) == want


def test_a_batch_being_written_is_neither_read_nor_folded(spark, changes, tmp_path):
    path = str(tmp_path / "latest")
    stream_latest(changes(), path, str(tmp_path / "cp"), "k", "t", once=True).awaitTermination()
    want = rows(read_current(spark, path, "k", "t"))
    spark.read.parquet(f"{path}/batches/batch_id=0").write.parquet(f"{path}/batches/batch_id=7")
    assert compact(spark, path, "k", "t") < 7
    assert rows(read_current(spark, path, "k", "t")) == want


def test_before_the_first_batch(spark, tmp_path):
    (tmp_path / "none").mkdir()
    empty = spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "none"))
    path = str(tmp_path / "latest")
    stream_latest(empty, path, str(tmp_path / "cp"), "k", "t", once=True).awaitTermination()
    assert compact(spark, path, "k", "t") == -1
    assert read_current(spark, path, "k", "t").count() == 0


def test_landing_restarts_and_reloads(spark, changes, tmp_path):
    base, cp = str(tmp_path / "landed"), str(tmp_path / "cp")
    for _ in range(2):
        land_changes(changes(), base, cp, "1", once=True).awaitTermination()
    assert read_landed(spark, base, "1").count() == 7
    land_changes(changes(), base, cp, "2", once=True).awaitTermination()
    landed = read_landed(spark, base, "2")
    assert landed.count() == 7
    assert {r[0] for r in landed.select("landing_date").distinct().collect()} == {datetime.datetime.now(datetime.timezone.utc).date()}
    assert all(f.endswith(".gz.parquet") for f in landed.inputFiles())


def test_columns_that_come_while_a_load_runs(spark, tmp_path):
    source, base, cp = str(tmp_path / "source"), str(tmp_path / "landed"), str(tmp_path / "cp")

    def land(rows, schema, load_ts="1", folder=source):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        land_evolving(spark, folder, base, cp, load_ts, once=True).awaitTermination()

    land([(1, "a")], "k int, v string")
    assert read_landed(spark, base, "1").drop("landing_date").columns == ["k", "v"]
    land([(2, "b", 0.5)], "k int, v string, w double")
    land([(3, 1.5)], "k int, w double")
    landed = read_landed(spark, base, "1").drop("landing_date")
    assert sorted(map(tuple, landed.collect())) == [(1, "a", None), (2, "b", 0.5), (3, None, 1.5)]
    assert recorded_schema(spark, base, "1").names == ["k", "v", "w"]
    versions = inside(base, "_schemas", "load_ts=1")
    assert versions == ["000001", "000002"]  # recorded when it changes, not at every start
    with pytest.raises(ValueError, match="no finished load"):
        read_loads(spark, base)
    land([(4, True)], "k int, x boolean", "2", str(tmp_path / "other"))
    for load_ts in ("1", "2"):
        finish_load(spark, base, load_ts)
    union = read_loads(spark, base).drop("landing_date")
    assert union.columns == ["k", "v", "w", "load_ts", "x"] and union.count() == 4
    assert union.where("x").select("k", "load_ts").first() == (4, "2")
    with pytest.raises(ValueError, match="changed their type"):
        land([("5",)], "k string", "1", str(tmp_path / "text"))


def test_masks_and_standardizing_on_a_stream(spark, tmp_path):
    source = str(tmp_path / "p")
    payments = spark.createDataFrame(
        [(1, "2024-01-01", "1.5", " Card "), (2, "bad", "x", None)],
        "payment_id int, payment_date string, amount string, payment_method string",
    )
    payments.write.parquet(source)
    stream = read_changes(spark, source, payments.schema)
    both = mask_pii(standardize_payments(stream), ["payment_method"], hash_columns=[])
    land_changes(both, str(tmp_path / "out"), str(tmp_path / "cp"), "1", once=True).awaitTermination()
    want = mask_pii(standardize_payments(payments), ["payment_method"], hash_columns=[])
    assert rows(read_landed(spark, str(tmp_path / "out"), "1").drop("landing_date")) == rows(want)
