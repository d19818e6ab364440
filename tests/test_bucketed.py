"""Joins of bucketed tables, sifted orphans, exact duplicates of wide rows."""

import pytest
from pyspark.sql import functions as F

from tablewright.functions.bitmaps import bits_for, flag_maybe, key_bits
from tablewright.operators.bucketed import all_rows, hot_keys, integrate_stored, join_stored, store_bucketed, store_masked
from tablewright.operators.integrate import integrate
from tablewright.operators.profile import profile_table, profile_wide_table
from tablewright.operators.quality import orphan_counts, orphan_counts_sifted
from tablewright.plans.raw_tables import raw_tables
from tests.conftest import SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture
def shuffled(spark):
    """Bytes that a frame's shuffles write."""

    def run(df):
        df.write.format("noop").mode("overwrite").save()
        store = spark._jsparkSession.sharedState().statusStore()
        last = max((store.executionsList().apply(i) for i in range(store.executionsList().size())), key=lambda e: e.executionId())
        metrics = store.executionMetrics(last.executionId())
        total = 0
        for i in range(last.metrics().size()):
            metric = last.metrics().apply(i)
            if metric.name() == "shuffle records written" and metrics.contains(metric.accumulatorId()):
                total += int(metrics.apply(metric.accumulatorId()).split("\n")[-1].split(" ")[0].replace(",", ""))
        return total

    return run


@pytest.fixture
def tables(spark):
    left = spark.range(200).select(F.when(F.col("id") % 9 > 0, F.col("id") % 50).alias("k"), F.col("id").alias("a"))
    right = spark.range(300).select(F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id") % 40).cast("long").alias("k"), F.col("id").alias("b"))
    return left, right


def test_bucketed_joins_shuffle_nothing(spark, conf, tmp_path, tables):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    left, right = tables
    hot = hot_keys([left, right], "k", 50)
    assert [r["k"] for r in hot.collect()] == [7]
    stored = [store_bucketed(df, "k", hot, "bucketed_test", n, str(tmp_path / n), 4) for n, df in (("l", left), ("r", right))]
    joined = join_stored(*stored, "k")
    plan = plan_of(joined.rest)
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert {r["k"] for r in joined.aside.collect()} == {7, None}
    assert rows(all_rows(joined)) == rows(left.join(right, "k", "left"))
    again = store_bucketed(right, "k", hot, "bucketed_test", "r", str(tmp_path / "r"), 4)
    assert rows(all_rows(again)) == rows(right)


def test_what_is_aside_is_spread(spark, tmp_path, tables):
    _, right = tables
    stored = store_bucketed(right, "k", hot_keys([right], "k", 50), "bucketed_test", "spread", str(tmp_path / "s"), 4)
    files = {f for f in stored.aside.inputFiles() if "_aside=true" in f}
    assert len(files) > 1 and stored.aside.count() == right.where("k = 7").count()


def test_the_wide_row_of_stored_tables(spark, conf, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    base = str(tmp_path)
    for name, df in raw_tables(spark, SMALL).items():
        df.write.parquet(f"{base}/raw/{name}")
    masked = {n: spark.read.parquet(f"{base}/raw/{n}") for n in ("customer", "address", "orders", "payments")}
    masked["customer"] = masked["customer"].withColumn("email_hashed", F.lit("h")).dropDuplicates(["customer_id"])
    stored = store_masked(masked, "wide_test", f"{base}/stored", 4, 20)
    wide = integrate_stored(stored)
    assert rows(wide) == rows(integrate(**masked))
    usual = stored["customer"].rest.join(stored["address"].rest.drop("address_id"), "customer_id", "left")
    assert "Exchange" not in plan_of(usual)
    nothing = store_masked({n: df.limit(0) for n, df in masked.items()}, "empty_test", f"{base}/none", 4, 20)
    assert integrate_stored(nothing).count() == 0


def test_bits_tell_what_is_surely_missing(spark):
    keys, all_keys = spark.range(0, 5000, 5).toDF("k"), spark.range(20000).toDF("k")
    for bits in (bits_for(1000), 32_768):
        marked = flag_maybe(all_keys, "k", key_bits(keys, "k", bits), bits, "maybe")
        assert marked.where("k % 5 = 0 AND k < 5000 AND NOT maybe").count() == 0
        assert marked.where("maybe").count() < 2500 and marked.count() == 20000
    assert flag_maybe(all_keys, "k", key_bits(keys.limit(0), "k", 32_768), 32_768, "maybe").where("maybe").count() == 0
    with pytest.raises(ValueError):
        flag_maybe(all_keys, "k", keys, 1 << 40, "maybe")


def test_sifted_orphans(spark, conf, shuffled):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    child = spark.range(0, 40000, 1, 4).select(F.when(F.col("id") % 100 > 0, F.col("id")).alias("k"))
    parent = spark.range(0, 500).toDF("k").union(spark.createDataFrame([(None,)], "k long"))

    def total(df):
        return df.agg(F.sum("rows")).first()[0]

    for most in (None, 32_768):  # a bitmap that is too full lets keys through, and the join tells them
        assert total(orphan_counts_sifted(child, parent, "k", most)) == total(orphan_counts(child, parent, "k"))
    assert total(orphan_counts_sifted(child, parent.limit(0), "k")) == 40000
    assert orphan_counts_sifted(child.limit(0), parent, "k").count() == 0
    assert shuffled(orphan_counts_sifted(child, parent, "k")) < 0.2 * shuffled(orphan_counts(child, parent, "k"))


@pytest.mark.parametrize("bits", [64, 6, 1])
def test_exact_duplicates_whatever_the_fingerprints(spark, bits):
    """With fingerprints of a few bits nearly all rows collide; they are compared whole."""
    df = spark.range(600).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 90).alias("a"), F.when(F.col("id") % 2 > 0, F.lit("x")).alias("b"), F.lit(None).cast("string").alias("c")
    )
    assert profile_wide_table(df, "t", bits).collect() == profile_table(df, "t").collect()
    assert profile_wide_table(df.limit(0), "t", bits).first()["duplicate_count"] == 0


def test_unique_rows_are_not_shuffled(spark, conf, shuffled):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    df = spark.range(0, 30000, 1, 4).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    df = df.union(df.limit(50))
    exact = profile_wide_table(df, "t")
    assert exact.first()["duplicate_count"] == 50
    # Fingerprints are shuffled for the counts, and for what meets; of the rows themselves next to none.
    assert shuffled(exact) < 4 * 30050
