"""Full load of the tables of a relational schema over JDBC."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


#: Rows that one query reads, where the number of queries is not given.
ROWS_PER_QUERY = 2_000_000


def list_tables(spark: SparkSession, url: str, schema: str, properties: Mapping[str, str]) -> list[str]:
    """The base tables of a schema, from the database's own catalog, named so that ``read_jdbc_table`` finds them
    wherever the schema lies on the search path."""
    query = (
        "(SELECT table_name FROM information_schema.tables "
        f"WHERE table_schema = '{schema}' AND table_type = 'BASE TABLE') t"
    )
    return [f"{schema}.{row[0]}" for row in spark.read.jdbc(url, query, properties=dict(properties)).collect()]


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    key: str | None = None,
    partitions: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """One table, read by ``partitions`` parallel queries over ranges of its ``key``, a number, date or timestamp; by default
    one for every ``ROWS_PER_QUERY`` rows.

    The bounds only place the range limits; rows outside them, and NULL keys, still arrive.
    Without a key the table comes through one connection.
    """
    properties = dict(properties or {})
    if key is None:
        return spark.read.jdbc(url, table, properties=properties)
    size = "" if partitions else ", count(*) AS n"
    bounds_query = f"(SELECT min({key}) AS low, max({key}) AS high{size} FROM {table}) b"
    bounds = spark.read.jdbc(url, bounds_query, properties=properties).first()
    low, high, *rows = bounds if bounds is not None else (None, None)
    partitions = partitions or (rows[0] // ROWS_PER_QUERY + 1 if rows else 1)
    if low is None or low == high:
        return spark.read.jdbc(url, table, properties=properties)
    # As options the bounds may be text, which dates need; the method's own arguments are integers.
    ranges = {"partitionColumn": key, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(partitions)}
    return spark.read.jdbc(url, table, properties={**properties, **ranges})


def read_jdbc_tables(
    spark: SparkSession,
    url: str,
    keys: Mapping[str, str | None],
    partitions: int | None = None,
    properties: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """The full load: a lazy frame per table. ``keys`` maps a table to its partition column,
    or to None; its names may come from ``list_tables``."""
    return {t: read_jdbc_table(spark, url, t, key, partitions, properties) for t, key in keys.items()}
