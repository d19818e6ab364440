"""Standardizing the four tables and joining them into one wide row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.model import ADDRESS_NAMES, CUSTOMER_NAMES, DATE_FORMAT, UNKNOWN
from tablewright.operators.dedup import dedup_latest, dedup_latest_stored
from tablewright.operators.joins import left_join


def standardize(
    df: DataFrame,
    dates: Sequence[str] = (),
    numbers: Sequence[str] = (),
    texts: Sequence[str] = (),
    date_format: str = DATE_FORMAT,
) -> DataFrame:
    """Parse ``dates``, cast ``numbers`` to double and trim and lower-case ``texts``.

    Values that do not parse become NULL instead of failing a job that may have run for hours;
    ``check_dates`` counts them. Stateless, so it also takes streaming frames.
    """
    types = dict(df.dtypes)

    def as_date(name: str) -> Column:
        value = F.col(name)
        return F.try_to_date(value, date_format) if types[name] == "string" else value.cast("date")

    return df.withColumns(
        {
            **{c: as_date(c) for c in dates},
            **{c: F.col(c).try_cast("double") for c in numbers},
            **{c: F.trim(F.lower(F.col(c))) for c in texts},
        }
    )


def standardize_orders(orders: DataFrame, date_format: str = DATE_FORMAT) -> DataFrame:
    return standardize(orders, ["order_date"], ["order_amount"], ["order_status"], date_format)


def standardize_payments(payments: DataFrame, date_format: str = DATE_FORMAT) -> DataFrame:
    return standardize(payments, ["payment_date"], ["amount"], ["payment_method"], date_format)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by a naming convention; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(names))


def join_customer_address(customer: DataFrame, address: DataFrame) -> DataFrame:
    """Customers with their addresses; several addresses give several rows, none gives one."""
    return left_join(customer, address.drop("address_id"), "customer_id")


def join_customer_orders(customer: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with their orders; customers without orders stay."""
    return left_join(customer, orders, "customer_id")


def join_orders_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with their payments; orders without payments stay."""
    return left_join(orders, payments, "order_id")


def latest_payments(payments: DataFrame) -> DataFrame:
    """The payment of each order that ``repair`` keeps: the latest by date, then by id. Ids occur once."""
    dated = standardize(payments.withColumn("_paid", F.col("payment_date")), ["_paid"])
    return dedup_latest_stored(dated, "order_id", "_paid", ["payment_id"]).drop("_paid")


def latest_addresses(address: DataFrame) -> DataFrame:
    """The address of each customer that ``repair`` keeps for all of their orders: the greatest by its columns in the order of
    the wide row, a missing text counting as ``UNKNOWN``."""
    kinds = {c: kind for c, kind in address.dtypes if c not in ("address_id", "customer_id")}
    filled = {f"_{c}": F.coalesce(c, F.lit(UNKNOWN)) if kind == "string" else F.col(c) for c, kind in kinds.items()}
    return dedup_latest(address.withColumns(filled), "customer_id", next(iter(filled)), list(filled)).drop(*filled)


def total_amount(order_amount: Column, amount: Column) -> Column:
    return F.round(order_amount + amount, 2)


def integrate(
    customer: DataFrame,
    address: DataFrame,
    orders: DataFrame,
    payments: DataFrame,
    drop_columns: Sequence[str] = (),
    latest_payment: bool = False,
) -> DataFrame:
    """The wide row: customer, addresses, orders and payments, plus ``total_amount``.

    Equals customer ⟕ address ⟕ orders ⟕ payments from left to right, but joins orders with
    payments first: the NULL order ids of customers without orders, which would all meet in one
    task, are then never a join key, and the narrow tables are shuffled rather than the wide one.
    Columns are renamed and parsed after the joins: a projection below them would differ between
    the parts of ``left_join`` and keep those from sharing a shuffle.
    ``total_amount`` is NULL without a payment; ``repair`` fills it.

    ``latest_payment=True`` joins only the payment of each order and the address of each customer that ``repair`` keeps, for
    rows that go to it and nowhere else: the others are left out while rows are narrow. Payments then have one row an order,
    so no key is hot on the right, and where customers and orders have one row a key, so does the result.
    """
    people = join_customer_address(customer, latest_addresses(address) if latest_payment else address)
    if latest_payment:
        paid = orders.join(latest_payments(payments), "order_id", "left")
    else:
        paid = join_orders_payments(orders, payments)
    return finish_wide(left_join(people, paid, "customer_id", right_keys=orders), drop_columns)


def finish_wide(joined: DataFrame, drop_columns: Sequence[str] = ()) -> DataFrame:
    """The joined tables as the wide row: renamed, parsed, with the total."""
    wide = rename_columns(standardize_payments(standardize_orders(joined)), {**CUSTOMER_NAMES, **ADDRESS_NAMES})
    wide = wide.select(
        "order_id",
        *[c for c in wide.columns if c != "order_id"],
        total_amount(F.col("order_amount"), F.col("amount")).alias("total_amount"),
    )
    return wide.drop(*drop_columns)
