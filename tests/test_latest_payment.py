"""Joining only the payments that repair keeps gives the rows that repair makes of all of them."""

from tablewright.operators.integrate import integrate
from tablewright.operators.repair import repair

PEOPLE = "customer_id long, first_name string, last_name string, email string, phone string, email_hashed string"
HOMES = "address_id long, customer_id long, street_address string, city string, state string, zip_code string"
ORDERS = "order_id long, customer_id long, order_date string, order_amount double, order_status string"
PAID = "payment_id long, order_id long, payment_date string, amount double, payment_method string"


def frames(spark):
    people = [(i, f"f{i}", None if i == 2 else "l", "e", "p", "h") for i in range(1, 7)]
    homes = [(10 * i + k, i, f"s{k}" if k else None, "c", None, "z") for i in (1, 2, 3) for k in range(3)] + [(99, None, "s", "c", "s", "z")]
    orders = [(i, i % 8, "2024-01-02" if i % 3 else "no date", None if i % 5 == 0 else 1.5 * i, " A ") for i in range(1, 30)] + [(None, 1, None, 2.0, "B")]
    dates = [None, "2024-02-01", "2024-3-01", "no date", "2024-02-01", "2023-12-31"]
    paid = [(100 * o + k, o, dates[(o + k) % 6], None if k == 3 else 1.0 * k, None if k == 1 else " Card ") for o in range(1, 25) for k in range(o % 7)]
    paid += [(None, 3, "2024-02-01", 7.0, "x"), (5000, None, "2024-02-01", 8.0, "x"), (5001, 777, "2024-02-01", 8.0, "x")]
    return {
        "customer": spark.createDataFrame(people, PEOPLE),
        "address": spark.createDataFrame(homes, HOMES),
        "orders": spark.createDataFrame(orders, ORDERS),
        "payments": spark.createDataFrame(paid, PAID),
    }


def test_repair_of_the_latest_payments_equals_repair_of_all(spark):
    tables = frames(spark)
    every, latest = integrate(**tables), integrate(**tables, latest_payment=True)
    assert latest.columns == every.columns and latest.dtypes == every.dtypes
    want, got = (sorted(map(tuple, repair(df).collect()), key=str) for df in (every, latest))
    assert got == want and len(want) > 20
    assert latest.groupBy("order_id", "customer_street").count().where("order_id IS NOT NULL AND count > 1").isEmpty()
    assert not every.groupBy("order_id", "customer_street").count().where("order_id IS NOT NULL AND count > 1").isEmpty()
