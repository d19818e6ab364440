from decimal import Decimal

from tablewright.operators.profile import profile, profile_columns, profile_table, row_metrics


def by_column(df):
    return {r["column"]: r.asDict() for r in df.collect()}


def test_columns(spark):
    df = spark.createDataFrame(
        [(1, -1.0, "a@b.com", "n/a", Decimal("1.10")), (1, 1.0, "bad", None, None), (None, None, None, "+1 5551234", None)],
        "i int, d double, email string, phone string, m decimal(12,2)",
    )
    stats = by_column(profile_columns(df))
    assert stats["i"] == {
        "column": "i", "dtype": "int", "null_count": 1, "distinct_count": 2, "min": "1", "max": "1", "mean": 1.0,
        "invalid_email_count": None, "invalid_phone_count": None,
    }
    assert stats["d"]["mean"] == 0.0  # a mean of zero is a mean
    assert (stats["email"]["distinct_count"], stats["email"]["invalid_email_count"]) == (3, 1)
    assert stats["phone"]["invalid_phone_count"] == 1
    assert (stats["m"]["min"], stats["m"]["mean"], stats["m"]["dtype"]) == ("1.10", 1.1, "decimal(12,2)")


def test_approximate_equals_exact_on_few_values(spark):
    df = spark.range(300).selectExpr("id % 7 a", "if(id % 2 = 0, null, 'x') b", "cast(id as double) c")
    exact, approx = by_column(profile_columns(df)), by_column(profile_columns(df, approx=True))
    assert exact["a"] == approx["a"] and exact["b"] == approx["b"]
    assert abs(exact["c"]["distinct_count"] - approx["c"]["distinct_count"]) < 30
    assert profile_table(df, "t").first() == profile_table(df, "t", approx=True).first()


def test_empty_and_all_null(spark):
    df = spark.createDataFrame([], "x double, email string")
    stats = by_column(profile_columns(df))
    assert (stats["x"]["min"], stats["x"]["mean"], stats["x"]["distinct_count"], stats["x"]["null_count"]) == (None, None, 0, 0)
    assert stats["email"]["invalid_email_count"] == 0
    assert profile_table(df, "t").first()["row_count"] == 0
    nulls = spark.createDataFrame([(None,), (None,)], "x double")
    assert by_column(profile_columns(nulls))["x"]["distinct_count"] == 1


def test_duplicates_and_labels(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a")], "a int, b string")
    table, columns = profile(df, "t")
    assert tuple(table.first()) == ("t", 3, 2, 1)
    assert {r["table"] for r in columns.collect()} == {"t"}
    assert {r["name"]: r["rows"] for r in row_metrics({"a": df, "b": df.limit(0)}).collect()} == {"a": 3, "b": 0}


def test_each_branch_reads_one_column(spark, executed, tmp_path):
    spark.range(50).selectExpr("id a", "id % 3 b", "'x' c").write.parquet(str(tmp_path / "t"))
    plan = executed(profile_columns(spark.read.parquet(str(tmp_path / "t"))))
    schemas = [part.split(">")[0] for part in plan.split("ReadSchema: struct<")[1:]]
    assert sorted(schemas) == ["a:bigint", "b:bigint", "c:string"]
    assert "Expand" not in plan


def test_fingerprints_see_where_a_null_stands(spark):
    df = spark.createDataFrame([("x", None), (None, "x"), ("x", None), (None, None)], "a string, b string")
    assert profile_table(df, "t", approx=True).first()["duplicate_count"] == 1
