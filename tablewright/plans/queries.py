"""The registered queries: one per operator, each over whole tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.functions.masks import email_mask, partial_mask, register_sql_functions, sha256_hex
from tablewright.model import ADDRESS_NAMES, CUSTOMER_NAMES, SLICES, TABLES, QualityRules
from tablewright.operators.bucketed import all_rows, hot_keys, integrate_stored, join_stored, store_bucketed, store_masked
from tablewright.operators.dedup import dedup_latest, drop_duplicate_rows
from tablewright.operators.integrate import (
    integrate,
    join_customer_address,
    join_customer_orders,
    join_orders_payments,
    rename_columns,
    standardize,
    standardize_orders,
    standardize_payments,
)
from tablewright.operators.mask import mask_pii
from tablewright.operators.profile import profile_columns, profile_table, profile_wide_table, row_metrics
from tablewright.operators.quality import (
    check_dates,
    check_duplicates,
    check_format,
    check_nulls,
    check_range,
    check_referential,
    dq_checks,
    dq_score,
    failed_details,
    route_by_status,
    source_row_checks,
    wide_row_checks,
)
from tablewright.operators.repair import fill_amount, fill_unknown, repair
from tablewright.operators.schema import cast_failures, enforce_schema
from tablewright.operators.slices import cut_slice, split_slices
from tablewright.operators.states import (
    merged_checks,
    merged_duplicates,
    merged_orphans,
    merged_profile,
    store_checks,
    store_keys,
    store_landing,
    store_profile,
)
from tablewright.plans.chain import ChainConfig, curate, deduplicate, mask, masked_tables, run_chain
from tablewright.plans.oracle import RUN
from tablewright.plans.raw_tables import raw_table, raw_tables, source
from tablewright.session import folders, shared_dir
from tablewright.sinks.catalog import publish, read_published
from tablewright.sinks.reports import dq_report, profile_report, write_report
from tablewright.sinks.runs import write_run
from tablewright.sources.runs import last_run, read_last, read_report, read_run
from tablewright.sources.tables import read_table, read_tables
from tablewright.streaming.landing import (
    LANDING_DATE,
    finish_load,
    land_changes,
    land_evolving,
    read_changes,
    read_landed,
    read_landed_tables,
    read_loads,
)
from tablewright.streaming.latest import compact, read_current, stream_latest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SPECS = {spec.name: spec for spec in TABLES}
SLICE = {spec.name: spec for spec in SLICES}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _wide(spark: SparkSession, sf_dir: str, clean: bool = False) -> DataFrame:
    return curate(raw_tables(spark, sf_dir, clean), store=shared_dir(spark, "masked"))


def _repaired(spark: SparkSession, sf_dir: str, clean: bool = False) -> DataFrame:
    """The repaired wide rows, where nothing else reads the wide ones."""
    tables = raw_tables(spark, sf_dir, clean)
    return repair(curate(tables, store=shared_dir(spark, "masked"), latest_payment=True), one_row=True)


def _stored_wide(spark: SparkSession, sf_dir: str, clean: bool = False, columns: set[str] | None = None) -> DataFrame:
    """The wide row, or those of its columns that are read, as a stored table, for plans that read it more than once."""
    base = shared_dir(spark, "wide")
    wide = _wide(spark, sf_dir, clean)
    write_run(wide.select([c for c in wide.columns if columns is None or c in columns]), base, RUN)
    return read_run(spark, base, RUN)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# -- latest rows and duplicates ------------------------------------------------------------


@query
def dedup_latest_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_latest(source(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], "l_shipdate")


@query
def dedup_latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_latest(source(spark, sf_dir, "orders"), "o_custkey", "o_orderdate")


@query
def dedup_latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_latest(source(spark, sf_dir, "events"), "user_id", "ts")


@query
def dedup_latest_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_latest(raw_table(spark, sf_dir, "customer"), "customer_id", "customer_id")


@query
def dedup_latest_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_latest(raw_table(spark, sf_dir, "payments"), "payment_id", "payment_date")


@query
def dedup_whole_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_duplicate_rows(source(spark, sf_dir, "documents").select("lang", "source", "text"))


@query
def dedup_row_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before and after, per raw table."""
    tables = raw_tables(spark, sf_dir)
    before = row_metrics(tables).withColumnRenamed("rows", "rows_before")
    after = row_metrics(
        {n: dedup_latest(df, SPECS[n].primary_key, SPECS[n].sort_column) for n, df in tables.items()}
    ).withColumnRenamed("rows", "rows_after")
    return before.join(after, "name").withColumn("removed", F.col("rows_before") - F.col("rows_after"))


# -- profile -------------------------------------------------------------------------------


@query
def profile_table_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _union([profile_table(df, name) for name, df in raw_tables(spark, sf_dir).items()])


def _column_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _union(
        [
            profile_columns(df).select(F.lit(name).alias("table"), "*")
            for name, df in raw_tables(spark, sf_dir).items()
        ]
    )


@query
def profile_column_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = _column_metrics(spark, sf_dir)
    return metrics.withColumns({c: F.col(c).cast("double") for c in ("min", "max")})


@query
def profile_lineitem_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = profile_columns(source(spark, sf_dir, "lineitem"))
    return metrics.select(
        "column", "null_count", "distinct_count", F.col("min").cast("double"), F.col("max").cast("double"), "mean"
    )


@query
def profile_documents_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts are compared where their fingerprints meet; the others are not shuffled."""
    return profile_wide_table(source(spark, sf_dir, "documents").select("lang", "source", "text"), "documents")


@query
def profile_merged_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of a table that was landed year by year, merged from what each year has stored. Distinct counts are
    estimates, which pytest compares, and left out here."""
    base = shared_dir(spark, "profiles")
    lines = source(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    years = sorted(r[0] for r in lines.select("year").distinct().collect())  # as many rows as years
    for year in years:
        store_profile(lines.where(F.col("year") == year).drop("year"), base, f"{year}1231_000000")
    merged = merged_profile(spark, base)
    return merged.select("column", "null_count", F.col("min").cast("double"), F.col("max").cast("double"), "mean")


@query
def profile_report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile written as a nested JSON report and read back."""
    base = shared_dir(spark, "profile")
    tables = raw_tables(spark, sf_dir)
    table_metrics = _union([profile_table(df, name) for name, df in tables.items()])
    report = profile_report(table_metrics, _column_metrics(spark, sf_dir), RUN)
    write_report(report, base, RUN)
    stored = spark.read.schema(report.schema).json(f"{base}/run_ts={RUN}")
    rows = stored.select(F.explode("tables").alias("table", "metrics"))
    columns = rows.select("table", "metrics.row_count", F.explode("metrics.columns").alias("column", "stats"))
    return columns.select("table", "row_count", "column", "stats.null_count", "stats.distinct_count")


# -- formats and masks ---------------------------------------------------------------------


@query
def check_format_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_format(raw_table(spark, sf_dir, "customer"), "email", "email")


@query
def check_format_phone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_format(raw_table(spark, sf_dir, "customer"), "phone", "phone")


@query
def mask_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = raw_table(spark, sf_dir, "customer")
    masked = [partial_mask(c).alias(f"{c}_masked") for c in ("first_name", "last_name", "phone")]
    return customers.select("customer_id", "last_name", *masked)


@query
def mask_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts, from a single word to twenty thousand, in four languages."""
    return source(spark, sf_dir, "documents").select("doc_id", partial_mask("text").alias("masked"))


@query
def mask_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_table(spark, sf_dir, "customer").select("customer_id", "last_name", email_mask("email").alias("masked"))


@query
def hash_sha256(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "documents").select("doc_id", sha256_hex("text").alias("hashed"))


@query
def mask_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_pii(raw_table(spark, sf_dir, "customer"), SPECS["customer"].pii_columns)


@query
def mask_customer_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_pii(raw_table(spark, sf_dir, "customer"), SPECS["customer"].pii_columns, compat=True)


@query
def mask_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_pii(raw_table(spark, sf_dir, "address"), SPECS["address"].pii_columns)


@query
def mask_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mask_pii(raw_table(spark, sf_dir, "payments"), SPECS["payments"].pii_columns)


@query
def mask_sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_sql_functions(spark)
    return spark.sql(
        "SELECT customer_id, last_name, partial_mask(phone) AS phone, mask_email(email) AS email, "
        "sha256_hash(email) AS email_hashed FROM {raw}",
        raw=raw_table(spark, sf_dir, "customer"),
    )


# -- standardizing and joining -------------------------------------------------------------


@query
def standardize_raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize_orders(raw_table(spark, sf_dir, "orders"))


@query
def standardize_raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardize_payments(raw_table(spark, sf_dir, "payments"))


@query
def standardize_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps to dates, numbers to double, texts trimmed and lower-cased."""
    events = source(spark, sf_dir, "events").select("event_id", "ts", "value", "event_type")
    return standardize(events, ["ts"], ["value"], ["event_type"])


@query
def rename_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_columns(raw_table(spark, sf_dir, "customer"), CUSTOMER_NAMES)


@query
def rename_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rename_columns(raw_table(spark, sf_dir, "address"), ADDRESS_NAMES)


@query
def join_customers_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_customer_address(raw_table(spark, sf_dir, "customer"), raw_table(spark, sf_dir, "address"))


@query
def join_customers_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_customer_orders(raw_table(spark, sf_dir, "customer"), raw_table(spark, sf_dir, "orders"))


@query
def join_orders_with_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_orders_payments(raw_table(spark, sf_dir, "orders"), raw_table(spark, sf_dir, "payments"))


@query
def integrate_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide(spark, sf_dir)


@query
def integrate_drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured columns are dropped; unknown names are ignored."""
    return curate(raw_tables(spark, sf_dir), ChainConfig(drop_columns=("customer_phone", "no_such_column")), shared_dir(spark, "masked"))


#: Hot enough to be kept aside at the scales of the test tables.
HOT = 5


def _joined_stored(spark: SparkSession, sf_dir: str, left: str, right: str, key: str) -> DataFrame:
    base = shared_dir(spark, "bucketed")
    frames = [raw_table(spark, sf_dir, name) for name in (left, right)]
    frames[1] = frames[1].drop("address_id")
    hot = hot_keys(frames, key, HOT)
    names = [f"{n}_{base[-8:]}" for n in (left, right)]
    stored = [store_bucketed(df, key, hot, "bucketed", n, f"{base}/{n}", 8) for df, n in zip(frames, names)]
    return all_rows(join_stored(*stored, key))


@query
def join_stored_customers_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined_stored(spark, sf_dir, "customer", "address", "customer_id")


@query
def join_stored_customers_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined_stored(spark, sf_dir, "customer", "orders", "customer_id")


@query
def join_stored_orders_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _joined_stored(spark, sf_dir, "orders", "payments", "order_id")


@query
def integrate_stored_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide row from masked tables that lie in buckets of their join keys."""
    base = shared_dir(spark, "bucketed")
    masked = mask(deduplicate(raw_tables(spark, sf_dir), TABLES))
    for name, df in masked.items():
        df.write.parquet(f"{base}/masked/{name}")
    masked = read_tables(spark, f"{base}/masked")
    return integrate_stored(store_masked(masked, f"wide_{base[-8:]}", f"{base}/stored", 8, HOT))


# -- quality -------------------------------------------------------------------------------


@query
def check_null_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_nulls(_wide(spark, sf_dir))


@query
def check_duplicate_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _wide(spark, sf_dir)
    return check_duplicates(wide.where(F.col("order_id").isNotNull()), "order_id")


@query
def check_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_range(_wide(spark, sf_dir))


@query
def check_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_referential(raw_table(spark, sf_dir, "orders"), raw_table(spark, sf_dir, "customer"))


@query
def check_orphans_sifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items against the suppliers' keys as if they were orders: nearly all are orphans, which a bitmap tells."""
    lines = source(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("customer_id"))
    suppliers = source(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("customer_id"))
    return check_referential(lines, suppliers, sifted=True)


@query
def dq_checks_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of the chain, from what three landings have stored: each sees a third of the rows of every table, and none
    sees the rows of another again."""
    base = shared_dir(spark, "states")
    tables = raw_tables(spark, sf_dir)
    rules = QualityRules()
    read = {*rules.critical_columns, *rules.email_columns, *rules.phone_columns, *rules.ranges, rules.duplicate_key, "customer_id"}
    wide = _stored_wide(spark, sf_dir, columns=read)
    keys = {"customer": "customer_id", "address": "address_id", "orders": "order_id", "payments": "order_id"}
    for part in range(3):
        third = {n: df.where(F.pmod(F.hash(keys[n]), F.lit(3)) == part) for n, df in tables.items()}
        store_landing(third, {n: source_row_checks(df) for n, df in third.items()}, base, f"2024010{part + 1}_000000")
        rows = wide.where(F.pmod(F.hash("customer_id"), F.lit(3)) == part)
        store_checks(rows, wide_row_checks(rows, own_parent=False), f"{base}/wide", f"2024010{part + 1}_000000")
        store_keys(rows, "order_id", f"{base}/wide", "orders", f"2024010{part + 1}_000000")
    names = [n for n in tables if source_row_checks(tables[n])] + ["wide"]
    merged = [merged_checks(spark, f"{base}/{n}") for n in names]
    merged.append(merged_duplicates(spark, f"{base}/wide", "orders", "order_id"))
    merged.append(merged_orphans(spark, base, "orders", "customer", "customer_id"))
    return _union(merged)


@query
def check_raw_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return check_dates(raw_table(spark, sf_dir, "orders"), ["order_date"]).unionByName(
        check_dates(raw_table(spark, sf_dir, "payments"), ["payment_date"])
    )


@query
def dq_checks_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq_checks(_wide(spark, sf_dir))


@query
def dq_checks_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq_checks(_wide(spark, sf_dir, clean=True))


@query
def dq_checks_against_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = raw_tables(spark, sf_dir)
    return dq_checks(curate(tables, store=shared_dir(spark, "masked")), child=tables["orders"], parent=tables["customer"])


@query
def dq_score_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq_score(dq_checks(_wide(spark, sf_dir)))


@query
def dq_score_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq_score(dq_checks(_wide(spark, sf_dir, clean=True)))


@query
def dq_failed_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failed_details(dq_checks(_wide(spark, sf_dir)))


@query
def repair_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repaired(spark, sf_dir)


@query
def fill_unknown_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_unknown(raw_table(spark, sf_dir, "customer"))


@query
def fill_missing_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_amount(raw_table(spark, sf_dir, "orders"))


def _routed(spark: SparkSession, sf_dir: str, clean: bool) -> DataFrame:
    """Repaired rows stored under the status of their run, and read back."""
    masked = masked_tables(raw_tables(spark, sf_dir, clean), store=shared_dir(spark, "masked"))
    base = shared_dir(spark, "routed")
    repaired = repair(integrate(**masked, latest_payment=True), one_row=True)
    write_run(route_by_status(repaired, dq_score(dq_checks(integrate(**masked)))), base, RUN, "dq_status")
    return read_run(spark, base, RUN)


@query
def route_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir, clean=True).where(F.col("dq_status") == "PASS")


@query
def route_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir, clean=False).where(F.col("dq_status") == "FAIL")


@query
def dq_report_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality report written as nested JSON and read back, one row per failed check."""
    base = shared_dir(spark, "dq")
    wide = _stored_wide(spark, sf_dir)
    checks = dq_checks(wide)
    report = dq_report(checks, dq_score(checks), wide, RUN)
    write_report(report, base, RUN)
    stored = spark.read.schema(report.schema).json(f"{base}/run_ts={RUN}")
    return stored.select(
        "total_rows", "total_checks", "passed_checks", "dq_score_pct", "dq_status", F.inline("failed_checks")
    )


# -- schema, slices, publishing ------------------------------------------------------------


@query
def enforce_schema_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enforce_schema(_wide(spark, sf_dir))


@query
def count_cast_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw date text has not been standardized, so malformed dates fail their cast."""
    orders = raw_table(spark, sf_dir, "orders")
    schema = standardize_orders(orders).schema
    return cast_failures(orders, schema)


def _slice(name: str, compat: bool = False) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        repaired = enforce_schema(_repaired(spark, sf_dir, clean=True))
        return cut_slice(repaired, SLICE[name], compat)

    return run


for _name in SLICE:
    QUERIES[f"slice_{_name}"] = _slice(_name)
QUERIES["slice_payments_compat"] = _slice("payments", compat=True)


@query
def slice_all_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payments slice cut from every payment instead of the one that repair keeps per order."""
    wide = _wide(spark, sf_dir, clean=True)
    return split_slices(repair(wide), payments=wide)["payments"]


def _published(spark: SparkSession, sf_dir: str, times: int, mode: str, names: list[str]) -> DataFrame:
    base = shared_dir(spark, "published")
    write_run(_repaired(spark, sf_dir, clean=True), base, RUN)
    slices = split_slices(enforce_schema(read_run(spark, base, RUN)))
    specs = [SLICE[n] for n in names]
    database = "published_" + base[-8:]
    for _ in range(times):
        counts = publish(spark, slices, database, f"{base}/tables", specs, mode)
    return counts


@query
def publish_verify_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _published(spark, sf_dir, 1, "upsert", list(SLICE))


@query
def publish_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publishing again leaves one copy."""
    return _published(spark, sf_dir, 2, "upsert", list(SLICE))


@query
def publish_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appending again leaves two."""
    return _published(spark, sf_dir, 2, "append", list(SLICE))


@query
def publish_upsert_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers, then a changed part of them: the table keeps the others and has one row a key."""
    base = shared_dir(spark, "upsert")
    people = source(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_first_name")
    )
    empty = {c: F.lit(None).cast("string") for c in SLICE["customer"].columns if c not in people.columns}
    people = people.withColumns(empty)
    changed = people.where("customer_id % 3 = 0").withColumn("customer_first_name", F.lit("changed"))
    added = changed.withColumn("customer_id", -F.col("customer_id"))
    database = "upsert_" + base[-8:]
    for rows in (people, changed.unionByName(added)):
        publish(spark, {"customer": rows}, database, f"{base}/tables", [SLICE["customer"]])
    return spark.table(f"{database}.customer").select("customer_id", "customer_first_name")


def _dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.when(F.col("o_orderkey") % 53 > 0, F.col("o_orderdate").cast("date")).alias("order_date"),
        F.col("o_totalprice").alias("order_amount"), F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("total_amount"),
    )


@query
def publish_upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders by date, some without one, then some changed in place, some moved to other dates and to none, and some
    new ones: every other order stays, whatever its date, and each key is there once."""
    base = shared_dir(spark, "upsert")
    orders = _dated_orders(spark, sf_dir)
    seventh = F.col("order_id") % 7 == 0
    moved = F.when(F.col("order_id") % 2 == 0, F.date_add("order_date", 40)).when(F.col("order_id") % 3 > 0, F.col("order_date"))
    changed = orders.where(seventh).withColumns({"order_status": F.lit("changed"), "order_date": moved})
    added = orders.where(F.col("order_id") % 11 == 0).withColumns({"order_id": -F.col("order_id"), "order_status": F.lit("new")})
    database = "upsert_" + base[-8:]
    for rows in (orders, changed.unionByName(added)):
        publish(spark, {"orders": rows}, database, f"{base}/tables", [SLICE["orders"]])
    return read_published(spark, database, SLICE["orders"]).select("order_id", "order_date", "order_status")


@query
def publish_dates_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, then a corrected set of those of some days: these days are replaced, the others of their months stay."""
    base = shared_dir(spark, "dates")
    orders = _dated_orders(spark, sf_dir)
    corrected = orders.where((F.dayofmonth("order_date") == 3) & (F.col("order_id") % 5 > 0)).withColumn("order_status", F.lit("late"))
    database = "dates_" + base[-8:]
    for rows, mode in ((orders, "replace"), (corrected, "partitions")):
        publish(spark, {"orders": rows}, database, f"{base}/tables", [SLICE["orders"]], mode)
    return read_published(spark, database, SLICE["orders"]).select("order_id", "order_date", "order_status")


@query
def read_published_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A span of dates of a published table: its months are pruned, its days skipped inside them."""
    base = shared_dir(spark, "quarter")
    database = "quarter_" + base[-8:]
    publish(spark, {"orders": _dated_orders(spark, sf_dir)}, database, f"{base}/tables", [SLICE["orders"]], "replace")
    return read_published(spark, database, SLICE["orders"], datetime.date(1995, 2, 10), datetime.date(1995, 5, 9))


@query
def profile_table_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surplus rows by fingerprints, over rows whose NULLs stand in shifted columns."""
    orders = source(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).alias("a"),
        F.when(F.col("o_orderkey") % 2 == 1, F.col("o_orderstatus")).alias("b"),
    )
    return profile_table(orders, "orders", approx=True)


# -- runs and layers -----------------------------------------------------------------------


def _order_years(spark: SparkSession, sf_dir: str) -> str:
    """A layer with orders as one run per year of their date, and one that is still being written."""
    base = shared_dir(spark, "years")
    orders = source(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"))
    orders.write.partitionBy("year").parquet(f"{base}/by_year")
    stored = spark.read.parquet(f"{base}/by_year")
    for (year,) in stored.select("year").distinct().collect():  # as many rows as years
        write_run(stored.where(F.col("year") == year).drop("year"), f"{base}/runs", f"{year}1231_000000")
    source(spark, sf_dir, "region").write.parquet(f"{base}/runs/run_ts=99991231_000000/_temporary/0")
    return f"{base}/runs"


@query
def latest_run_of_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(last_run(spark, _order_years(spark, sf_dir)),)], "run_ts string")


@query
def read_latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_last(spark, _order_years(spark, sf_dir))


@query
def read_run_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writing a run again replaces it."""
    base = shared_dir(spark, "replaced")
    lineitem = source(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    for _ in range(2):
        write_run(lineitem, base, RUN, compression="gzip")
    return read_run(spark, base, RUN)


@query
def dq_report_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failed checks of a run that left no report are those of the latest run."""
    base, store = shared_dir(spark, "reports"), shared_dir(spark, "masked")
    masked = masked_tables(raw_tables(spark, sf_dir), store=store)
    clean = masked_tables({"orders": raw_table(spark, sf_dir, "clean_orders")}, store=f"{store}/clean")
    write_run(dq_checks(integrate(**masked | clean)), base, "20240101_000000")
    write_run(dq_checks(integrate(**masked)), base, "20240102_000000")
    return failed_details(read_report(spark, base, "20240103_000000"))


@query
def raw_recursive_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date folders below a raw table, and files beside them, are all read."""
    base = shared_dir(spark, "raw")
    events = source(spark, sf_dir, "events").select("event_id", "event_type", "value")
    purchase = F.col("event_type") == "purchase"
    events.where(purchase).write.parquet(f"{base}/events/2024/01/02")
    events.where(~purchase).write.mode("append").parquet(f"{base}/events")
    return read_table(spark, f"{base}/events", recursive=True)


@query
def read_configured_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The configured tables that were landed; a missing one is skipped."""
    base = shared_dir(spark, "landed")
    for name, df in raw_tables(spark, sf_dir).items():
        if name != "address":
            df.write.parquet(f"{base}/{name}")
    return row_metrics(read_tables(spark, base))


# -- the chain -----------------------------------------------------------------------------


@query
def chain_published_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published orders, from raw tables in one plan."""
    return split_slices(enforce_schema(_repaired(spark, sf_dir, clean=True)))["orders"]


def _chain(spark: SparkSession, sf_dir: str, clean: bool) -> DataFrame:
    base = shared_dir(spark, "chain")
    config = ChainConfig(database="chain_" + base[-8:])
    return run_chain(spark, raw_tables(spark, sf_dir, clean), base, RUN, config).drop("run_ts")


@query
def chain_run_log_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chain(spark, sf_dir, clean=True)


@query
def chain_run_log_fail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chain(spark, sf_dir, clean=False)


def _chain_table(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """The rows of a catalog table that the whole chain has published."""
        base = shared_dir(spark, "chain")
        config = ChainConfig(database="chain_" + base[-8:], slices=[SLICE[name]], profile=False)
        run_chain(spark, raw_tables(spark, sf_dir, clean=True), base, RUN, config)
        return read_published(spark, config.database, SLICE[name])

    return run


for _name in SLICE:
    QUERIES[f"chain_tables_{_name}"] = _chain_table(_name)


@query
def chain_dq_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks that a run of the chain has stored and scored, over tables in which some amounts are no numbers."""
    base = shared_dir(spark, "checks")
    tables = raw_tables(spark, sf_dir)
    text = F.when(F.col("order_id") % 107 == 0, "12,50").otherwise(F.col("order_amount").cast("string"))
    tables["orders"] = tables["orders"].withColumn("order_amount", text)
    run_chain(spark, tables, base, RUN, ChainConfig(database="checks_" + base[-8:], profile=False, all_checks=True))
    return read_run(spark, f"{base}/logs/dq_checks", RUN).drop("scored")


@query
def chain_default_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks that a run under the default settings has stored: eight decide, the others are reported. Orders of unknown
    customers, malformed emails and phones fail, and the run publishes all the same."""
    base = shared_dir(spark, "checks")
    config = ChainConfig(database="checks_" + base[-8:], profile=False)
    run_chain(spark, raw_tables(spark, sf_dir, clean=True), base, RUN, config)
    published = spark.table(f"{config.database}.orders").agg(F.count("*")).scalar()
    return read_run(spark, f"{base}/logs/dq_checks", RUN).withColumn("published_orders", published)


# -- streams -------------------------------------------------------------------------------


def _stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    schema = source(spark, sf_dir, table).schema
    return read_changes(spark, sf_dir, schema, glob=f"{table}.parquet")


def _landed(spark: SparkSession, changes: DataFrame, date_column: str | None = None) -> DataFrame:
    base = shared_dir(spark, "landing")
    land_changes(changes, f"{base}/data", f"{base}/checkpoint", RUN, date_column, once=True).awaitTermination()
    return read_landed(spark, f"{base}/data", RUN)


@query
def land_changes_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = _landed(spark, _stream(spark, sf_dir, "events"), "ts")
    return landed.groupBy(F.col(LANDING_DATE).alias("day")).agg(F.count("*").alias("rows"))


@query
def land_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reload from scratch, and a restart that finds nothing new, land every row once."""
    base = shared_dir(spark, "reload")
    for load_ts in ("20240101_000000", "20240102_000000", "20240102_000000"):
        changes = _stream(spark, sf_dir, "events")
        land_changes(changes, f"{base}/data", f"{base}/checkpoint", load_ts, "ts", once=True).awaitTermination()
    return read_landed(spark, f"{base}/data", "20240102_000000").drop(LANDING_DATE)


@query
def landed_reload_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables landed twice, and once more without an end: readers get the second load, as the tables were."""
    base = shared_dir(spark, "landed")
    for load_ts, finished in (("20240101_000000", True), ("20240102_000000", True), ("20240103_000000", False)):
        for name in ("customer", "orders"):
            changes = _stream(spark, sf_dir, name)
            land_changes(changes, f"{base}/data/{name}", f"{base}/checkpoint/{name}", load_ts, once=True).awaitTermination()
            if finished:
                finish_load(spark, f"{base}/data/{name}", load_ts)
    tables = read_landed_tables(spark, f"{base}/data")
    return tables["customer"].select(F.lit("customer").alias("table"), F.col("c_custkey").alias("id")).unionByName(
        tables["orders"].select(F.lit("orders").alias("table"), F.col("o_orderkey").alias("id"))
    )


@query
def land_changing_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change files that gain two columns while a load runs, and a second load of the wide files alone; read as one."""
    base = shared_dir(spark, "evolving")
    events = source(spark, sf_dir, "events")
    odd = F.col("event_id") % 2 == 1
    narrow, wide = f"{base}/source", f"{base}/wide"
    for load_ts, folder in (("20240101_000000", narrow), ("20240101_000000", narrow), ("20240102_000000", wide)):
        first = load_ts == "20240101_000000" and not folders(spark, f"{base}/data/_schemas/load_ts={load_ts}", "_SUCCESS")
        rows = events.where(~odd).drop("value", "props") if first else events.where(odd)
        rows.write.mode("append").parquet(folder)
        land_evolving(spark, folder, f"{base}/data", f"{base}/checkpoint", load_ts, "ts", once=True).awaitTermination()
        finish_load(spark, f"{base}/data", load_ts)
    return read_loads(spark, f"{base}/data").drop(LANDING_DATE)


@query
def stream_latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest event per user, from a stream of several files and a compaction in between."""
    base = shared_dir(spark, "latest")
    events = source(spark, sf_dir, "events")
    events.repartition(6, "event_id").write.parquet(f"{base}/source")
    keys, sort = "user_id", "ts"
    changes = read_changes(spark, f"{base}/source", events.schema, files_per_batch=2)
    stream_latest(changes, f"{base}/rows", f"{base}/checkpoint", keys, sort, once=True, buckets=8).awaitTermination()
    compact(spark, f"{base}/rows", keys, sort)
    return read_current(spark, f"{base}/rows", keys, sort)


@query
def stream_latest_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two compactions with batches between and after them, beside a batch that is still being written: it is neither read
    nor folded."""
    base = shared_dir(spark, "compacted")
    events = source(spark, sf_dir, "events")
    keys, sort = "user_id", "ts"
    for part in range(3):
        events.where(F.col("event_id") % 3 == part).repartition(2, "event_id").write.mode("append").parquet(f"{base}/source")
        changes = read_changes(spark, f"{base}/source", events.schema, files_per_batch=1)
        stream_latest(changes, f"{base}/rows", f"{base}/checkpoint", keys, sort, once=True, buckets=8).awaitTermination()
        if part == 0:
            later = events.withColumns({"value": F.lit(-1.0), "ts": F.expr("ts + INTERVAL 1 DAY"), "key_bucket": F.lit(0)})
            later.write.partitionBy("key_bucket").parquet(f"{base}/rows/batches/batch_id=99")
        if part < 2:
            compact(spark, f"{base}/rows", keys, sort)
    return read_current(spark, f"{base}/rows", keys, sort)


@query
def stream_mask_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch mask on a stream."""
    customers = _stream(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias("last_name"))
    return _landed(spark, mask_pii(customers, ["last_name"], hash_columns=["last_name"])).drop(LANDING_DATE)


@query
def stream_standardize_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch standardization on a stream."""
    events = _stream(spark, sf_dir, "events").select("event_id", "ts", "value", "event_type")
    return _landed(spark, standardize(events, ["ts"], ["value"], ["event_type"]), "ts").drop(LANDING_DATE)
