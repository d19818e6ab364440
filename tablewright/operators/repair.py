"""Basic fixes of the wide row."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewright.model import UNKNOWN
from tablewright.operators.dedup import dedup_latest
from tablewright.operators.integrate import total_amount


def fill_amount(df: DataFrame, column: str = "order_amount") -> DataFrame:
    """A missing order amount counts as 0."""
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(0.0)))


def fill_unknown(df: DataFrame) -> DataFrame:
    """NULLs of all string columns become ``UNKNOWN``."""
    texts = [name for name, kind in df.dtypes if kind == "string"]
    return df.fillna(UNKNOWN, subset=texts) if texts else df


def repair(wide: DataFrame, one_row: bool = False) -> DataFrame:
    """Fill amounts and texts, drop rows without an order, keep the latest payment per order and
    recompute the total, a missing payment counting as 0. Other NULLs stay.

    ``one_row=True`` says that orders have one row already, as ``integrate(latest_payment=True)`` makes of tables with one
    row a key: wide rows are then not sorted to find it."""
    latest = fill_unknown(fill_amount(wide)).where(F.col("order_id").isNotNull())
    if not one_row:
        ties = ["payment_id", *[c for c in wide.columns if c not in ("order_id", "payment_date", "payment_id")]]
        latest = dedup_latest(latest, "order_id", "payment_date", ties)
    return latest.withColumn(
        "total_amount", total_amount(F.col("order_amount"), F.coalesce(F.col("amount"), F.lit(0.0)))
    )
