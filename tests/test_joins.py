from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tablewright.operators.integrate import integrate, standardize
from tablewright.operators.joins import left_join

key = st.one_of(st.none(), st.integers(0, 4))


def rows(df):
    return sorted(map(str, df.collect()))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(key, st.integers(0, 2)), min_size=1, max_size=12), st.lists(st.tuples(key, st.integers(0, 2)), min_size=1, max_size=12))
def test_equals_spark_left_join(spark, left, right):
    a, b = spark.createDataFrame(left, "k int, l int"), spark.createDataFrame(right, "k int, r int")
    assert left_join(a, b, "k").columns == a.join(b, "k", "left").columns
    assert rows(left_join(a, b, "k")) == rows(a.join(b, "k", "left"))


def test_hot_key_of_the_right_side_is_split(spark, executed, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100k",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100k",
        spark__sql__shuffle__partitions="20",
    )
    people = spark.range(2000).selectExpr("id k", "uuid() name")
    orders = spark.range(0, 60000, 1, 8).selectExpr("if(id % 3 = 0, 7, id % 2000) k", "id o", "sha2(string(id), 256) note")
    joined = left_join(people, orders, "k")
    plan = executed(joined)
    assert "SortMergeJoin(skew=true)" in plan
    assert joined.count() == people.join(orders, "k", "left").count()
    assert "skew=true" not in executed(people.join(orders, "k", "left"))  # what the operator is for


def test_both_parts_share_the_shuffle_of_the_left_side(spark, executed, conf, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    for name in ("a", "b"):
        spark.range(100).selectExpr("id k", f"id {name}").write.parquet(str(tmp_path / name))
    a, b = (spark.read.parquet(str(tmp_path / n)) for n in ("a", "b"))
    plan = executed(left_join(a, b, "k"))
    assert "ReusedExchange [k" in plan


def test_no_pair_is_lost_where_customers_have_many_of_everything(spark):
    customer = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "customer_id int, first_name string")
    address = spark.createDataFrame(
        [(1, 1, "s1"), (2, 1, "s2"), (3, 9, "s3")], "address_id int, customer_id int, street_address string"
    )
    orders = spark.createDataFrame(
        [(10, 1, "2024-01-02", "5.5", " New "), (11, 1, "bad", "x", None), (12, 8, "2024-01-02", "1", "x")],
        "order_id int, customer_id int, order_date string, order_amount string, order_status string",
    )
    payments = spark.createDataFrame(
        [(1, 10, "2024-02-30", 1.0, " Card"), (2, 10, None, 2.005, "cash"), (3, None, None, 9.0, "x")],
        "payment_id int, order_id int, payment_date string, amount double, payment_method string",
    )
    wide = integrate(customer, address, orders, payments, drop_columns=["nope"])
    assert wide.columns[:2] == ["order_id", "customer_id"] and "address_id" not in wide.columns
    got = sorted(
        map(str, wide.select("customer_id", "customer_street", "order_id", "payment_id", "total_amount").collect())
    )
    plain = customer.join(address.drop("address_id"), "customer_id", "left").join(orders, "customer_id", "left")
    plain = plain.join(payments, "order_id", "left").withColumnRenamed("street_address", "customer_street")
    total = F.round(F.col("order_amount").try_cast("double") + F.col("amount"), 2).alias("total_amount")
    want = plain.select("customer_id", "customer_street", "order_id", "payment_id", total)
    assert got == sorted(map(str, want.collect()))
    first = wide.where("payment_id = 1").first()
    assert (str(first["order_date"]), first["order_status"], first["payment_date"]) == ("2024-01-02", "new", None)
    assert first["payment_method"] == "card"


def test_standardize_gives_null_for_what_does_not_parse(spark):
    df = spark.createDataFrame([("abc",), ("2024-13-01",), ("1e3",), ("2024-01-31",), (None,)], "s string")
    df = df.select("s", F.col("s").alias("d"), F.col("s").alias("n"))
    got = {r["s"]: (None if r["d"] is None else str(r["d"]), r["n"]) for r in standardize(df, ["d"], ["n"]).collect()}
    assert got == {
        "abc": (None, None), "2024-13-01": (None, None), "1e3": (None, 1000.0), "2024-01-31": ("2024-01-31", None),
        None: (None, None),
    }
