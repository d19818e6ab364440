"""The four raw tables, derived from the test tables by SQL that Spark and DuckDB both run.

Every source row is used. Rows are damaged by value, never left out: customers without orders
and orders of unknown customers come from negated ids, second versions of customers and second
addresses from the suppliers, and repeated payment ids from the line items.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SOURCES = {
    "customer": ("customer", "supplier"),
    "address": ("customer", "supplier", "nation", "region"),
    "orders": ("orders",),
    "clean_orders": ("orders",),
    "payments": ("lineitem",),
}

RAW_SQL = {
    # NULL, malformed and short emails; malformed phones; repeated keys; unknown parents
    "customer": """
        SELECT CASE WHEN c_custkey % 40 = 39 THEN -c_custkey ELSE c_custkey END AS customer_id,
          lower(c_mktsegment) AS first_name, split_part(c_name, '#', 2) AS last_name,
          CASE WHEN c_custkey % 37 = 0 THEN NULL WHEN c_custkey % 50 = 1 THEN 'bad.address'
               WHEN c_custkey % 50 = 2 THEN 'ab@example.com'
               ELSE lower(c_mktsegment) || '.' || CAST(c_custkey AS STRING) || '@example.com' END AS email,
          CASE WHEN c_custkey % 41 = 0 THEN 'n/a'
               ELSE '+1 ' || lpad(CAST(c_custkey AS STRING), 10, '0') END AS phone
        FROM {customer}
        UNION ALL
        SELECT s_suppkey, 'supplier', 'dup', NULL, NULL FROM {supplier}""",
    # some customers with two addresses, some with none
    "address": """
        SELECT c_custkey AS address_id,
          CASE WHEN c_custkey % 15 = 0 THEN -c_custkey - 1 ELSE c_custkey END AS customer_id,
          CAST(c_custkey AS STRING) || ' ' || lower(c_mktsegment) || ' st' AS street_address,
          n_name AS city, r_name AS state, lpad(CAST(c_nationkey AS STRING), 5, '0') AS zip_code
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
        UNION ALL
        SELECT -s_suppkey, s_suppkey, 'unit 2', 'SECOND', NULL, NULL FROM {supplier}""",
    # malformed dates; NULL, negative and too large amounts; NULL statuses
    "orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
          CASE WHEN o_orderkey % 211 = 0 THEN 'not-a-date'
               ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS order_date,
          CASE WHEN o_orderkey % 97 = 0 THEN NULL WHEN o_orderkey % 101 = 0 THEN -1.0
               WHEN o_orderkey % 103 = 0 THEN 2000000.0 ELSE o_totalprice END AS order_amount,
          CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE ' ' || o_orderstatus || ' ' END AS order_status
        FROM {orders}""",
    # the same orders without damage, but for NULL amounts, which repair fills
    "clean_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
          CAST(CAST(o_orderdate AS DATE) AS STRING) AS order_date,
          CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice END AS order_amount,
          ' ' || o_orderstatus || ' ' AS order_status
        FROM {orders}""",
    # repeated payment ids, several payments per order, NULL payment dates
    "payments": """
        SELECT l_orderkey * 10 + l_linenumber AS payment_id, l_orderkey AS order_id,
          CASE WHEN l_partkey % 71 = 0 THEN NULL
               ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END AS payment_date,
          l_extendedprice AS amount, ' ' || l_returnflag || ' ' AS payment_method
        FROM {lineitem}""",
}


def source(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw table as a lazy frame."""
    return spark.sql(RAW_SQL[name], **{t: source(spark, sf_dir, t) for t in SOURCES[name]})


def raw_tables(spark: SparkSession, sf_dir: str, clean: bool = False) -> dict[str, DataFrame]:
    """The four raw tables by name; ``clean`` takes the undamaged orders."""
    names = {"customer": "customer", "address": "address", "orders": "orders", "payments": "payments"}
    if clean:
        names["orders"] = "clean_orders"
    return {name: raw_table(spark, sf_dir, key) for name, key in names.items()}
