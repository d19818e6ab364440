"""Joins of stored tables that need no shuffle: both sides are dealt into the same buckets of the key when they are
written.

Adaptive execution splits skewed shuffles, and a bucketed scan has none, so a key with a third of the rows would be one
task's work. Rows of hot keys, and rows with a NULL key, are therefore kept aside as they are stored, spread over all
tasks, and joined by ``left_join``, which adaptive execution can split on either side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tablewright.operators.integrate import finish_wide
from tablewright.operators.joins import left_join

_ASIDE, _CUSTOMER_ASIDE = "_aside", "_customer_aside"
#: Rows of one key that a task may hold.
MOST_ROWS = 1_000_000


@dataclass(frozen=True)
class Stored:
    """A stored table: ``rest`` is bucketed by the key, ``aside`` has the rows of hot and NULL keys, unbucketed."""

    rest: DataFrame
    aside: DataFrame


def hot_keys(frames: Sequence[DataFrame], key: str, most: int = MOST_ROWS) -> DataFrame:
    """Keys with more than ``most`` rows in one of the frames: at most the rows over ``most``. Counts are folded on the map
    side, so a hot key is one row a task."""
    counted = [df.groupBy(key).agg(F.count("*").alias("n")) for df in frames]
    return reduce(DataFrame.unionByName, counted).where(F.col("n") > most).select(key).distinct()


def flag_hot(df: DataFrame, key: str, hot: DataFrame, flag: str = _ASIDE) -> DataFrame:
    """``df`` with a flag on the rows whose key is hot or NULL."""
    marked = df.join(hot.select(key, F.lit(True).alias(flag)), key, "left").select(*df.columns, flag)
    return marked.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)) | F.col(key).isNull())


def _spread(df: DataFrame, key: str) -> Column:
    """The key, which deals a row to the task that writes its bucket; for rows kept aside a hash of the whole row."""
    kind = df.schema[key].dataType
    anywhere = F.pmod(F.xxhash64(*df.columns), F.lit((1 << 31) - 1)).cast(kind)
    if not isinstance(kind, (T.IntegralType, T.StringType)):
        raise ValueError(f"{key} must be an integer or a string, not {kind.simpleString()}")
    return F.when(F.col(_ASIDE), anywhere).otherwise(F.col(key))


def store_bucketed(
    df: DataFrame, key: str, hot: DataFrame, database: str, name: str, path: str, buckets: int
) -> Stored:
    """Write a table in buckets of ``key``, with the rows of ``hot`` and NULL keys aside, in one pass: a bucket is one
    file, and what is kept aside is spread over the tasks."""
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    flagged = flag_hot(df, key, hot)
    writer = flagged.repartition(buckets, _spread(flagged, key)).write.mode("overwrite").option("path", path)
    writer.partitionBy(_ASIDE).bucketBy(buckets, key).sortBy(key).saveAsTable(f"{database}.{name}")
    return read_bucketed(spark, database, name, path)


def read_bucketed(spark: SparkSession, database: str, name: str, path: str) -> Stored:
    """A stored table. What is kept aside is read by its path, as its buckets would bring hot keys together again."""
    table = spark.table(f"{database}.{name}")
    rows = spark.read.schema(table.schema).option("basePath", path).parquet(path)
    return Stored(table.where(~F.col(_ASIDE)).drop(_ASIDE), rows.where(_ASIDE).drop(_ASIDE))


def join_stored(left: Stored, right: Stored, key: str) -> Stored:
    """Left outer join USING ``key``. Both sides must have been stored with the same buckets and hot keys."""
    return Stored(left.rest.join(right.rest, key, "left"), left_join(left.aside, right.aside, key))


def all_rows(stored: Stored) -> DataFrame:
    return stored.rest.unionByName(stored.aside)


def store_masked(
    tables: Mapping[str, DataFrame], database: str, path: str, buckets: int, most: int = MOST_ROWS
) -> dict[str, Stored]:
    """Customers and addresses in buckets of the customer, orders and payments in buckets of the order. Tables are read
    twice, for their hot keys and to be stored, so they should be stored ones themselves."""
    customers = hot_keys([tables["orders"], tables["address"]], "customer_id", most)
    orders = hot_keys([tables["payments"]], "order_id", most)
    flagged = flag_hot(tables["orders"], "customer_id", customers, _CUSTOMER_ASIDE)
    put = {
        "customer": (tables["customer"], "customer_id", customers),
        "address": (tables["address"], "customer_id", customers),
        "orders": (flagged, "order_id", orders),
        "payments": (tables["payments"], "order_id", orders),
    }
    return {n: store_bucketed(df, key, hot, database, n, f"{path}/{n}", buckets) for n, (df, key, hot) in put.items()}


def integrate_stored(stored: Mapping[str, Stored], drop_columns: Sequence[str] = ()) -> DataFrame:
    """The rows of ``integrate``, from tables that ``store_masked`` has written. Two of its three joins shuffle nothing; the
    third deals orders with their payments by customer, and leaves customers where they lie."""
    address = stored["address"]
    address = Stored(address.rest.drop("address_id"), address.aside.drop("address_id"))
    people = join_stored(stored["customer"], address, "customer_id")
    paid = all_rows(join_stored(stored["orders"], stored["payments"], "order_id"))
    usual = people.rest.join(paid.where(~F.col(_CUSTOMER_ASIDE)).drop(_CUSTOMER_ASIDE), "customer_id", "left")
    keys = all_rows(stored["orders"]).where(_CUSTOMER_ASIDE)
    hot = left_join(people.aside, paid.where(_CUSTOMER_ASIDE).drop(_CUSTOMER_ASIDE), "customer_id", right_keys=keys)
    return finish_wide(usual.unionByName(hot), drop_columns)
