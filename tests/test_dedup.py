from hypothesis import HealthCheck, given, settings, strategies as st

from tablewright.operators.dedup import dedup_latest, drop_duplicate_rows

SCHEMA = "k int, o int, v string"


def latest(spark, rows):
    return sorted(map(tuple, dedup_latest(spark.createDataFrame(rows, SCHEMA), "k", "o").collect()), key=str)


def test_nulls_and_ties(spark):
    rows = [(1, 1, "a"), (1, 2, "b"), (1, None, "z"), (2, None, "x"), (2, None, "y"), (None, 1, "p"), (None, 3, "q")]
    assert latest(spark, rows) == sorted([(1, 2, "b"), (2, None, "y"), (None, 3, "q")], key=str)


small = st.one_of(st.none(), st.integers(0, 3))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(small, small, st.sampled_from(["a", "b"])), min_size=1, max_size=30))
def test_one_row_per_key_and_idempotent(spark, rows):
    once = latest(spark, rows)
    assert len(once) == len({r[0] for r in rows})
    assert latest(spark, once) == once
    assert latest(spark, rows[::-1]) == once


def test_hot_key_is_cut_before_the_shuffle(spark, executed):
    df = spark.range(2000).selectExpr("if(id % 3 = 0, 0, id) k", "cast(id as int) o", "'v' v")
    plan = executed(dedup_latest(df, "k", "o"))
    before, after = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after
    assert dedup_latest(df, "k", "o").where("k = 0").first()["o"] == 1998


def test_map_columns_do_not_order(spark):
    df = spark.sql("SELECT 1 k, 1 o, map('a', 1) m UNION ALL SELECT 1, 2, map('b', 2)")
    assert dedup_latest(df, "k", "o").first()["m"] == {"b": 2}


def test_whole_rows(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    assert drop_duplicate_rows(df).count() == 2
