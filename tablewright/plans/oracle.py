"""The registered queries as SQL for DuckDB, written from the definitions and not from the plans:
left joins in their stated order, one row per key by ``row_number``, checks as plain counts."""

from __future__ import annotations

from tablewright.model import EMAIL_PATTERN, PHONE_PATTERN
from tablewright.plans.raw_tables import RAW_SQL, SOURCES

RUN = "20240131_000000"
COLUMNS = {
    "customer": ["customer_id", "first_name", "last_name", "email", "phone"],
    "address": ["address_id", "customer_id", "street_address", "city", "state", "zip_code"],
    "orders": ["order_id", "customer_id", "order_date", "order_amount", "order_status"],
    "payments": ["payment_id", "order_id", "payment_date", "amount", "payment_method"],
}
DTYPES = {
    **{c: "bigint" for c in ("customer_id", "address_id", "order_id", "payment_id")},
    **{c: "double" for c in ("order_amount", "amount")},
}
KEYS = {
    "customer": ("customer_id", "customer_id"),
    "address": ("address_id", "address_id"),
    "orders": ("order_id", "order_date"),
    "payments": ("payment_id", "payment_date"),
}
WIDE = [
    "order_id", "customer_id", "customer_first_name", "customer_last_name", "customer_email", "customer_phone",
    "email_hashed", "customer_street", "customer_city", "customer_state", "customer_zip", "order_date",
    "order_amount", "order_status", "payment_id", "payment_date", "amount", "payment_method", "total_amount",
]
TEXTS = {c for c in WIDE if c.startswith("customer_") and c != "customer_id"}
TEXTS |= {"email_hashed", "order_status", "payment_method"}


def _raw(name: str) -> str:
    return RAW_SQL[name].format(**{t: t for t in SOURCES[name]})


def _latest(table: str, columns: list[str], keys: list[str], sort: str, ties: list[str] | None = None) -> str:
    ties = [c for c in columns if c not in keys] if ties is None else ties
    order = ", ".join(f"{c} DESC NULLS LAST" for c in dict.fromkeys([sort, *ties]))
    names = ", ".join(columns)
    return (
        f"SELECT {names} FROM (SELECT {names}, row_number() OVER (PARTITION BY {', '.join(keys)} "
        f"ORDER BY {order}) AS rn FROM {table}) WHERE rn = 1"
    )


def _partial(c: str) -> str:
    return (
        f"CASE WHEN length({c}) <= 4 THEN repeat('*', length({c})) "
        f"ELSE left({c}, 2) || repeat('*', length({c}) - 4) || right({c}, 2) END"
    )


def _email(c: str) -> str:
    return (
        f"CASE WHEN {c} IS NULL THEN NULL WHEN instr({c}, '@') = 0 THEN '****@****.***' "
        f"WHEN instr({c}, '@') > 3 THEN left({c}, 2) || repeat('*', instr({c}, '@') - 3) || substr({c}, instr({c}, '@')) "
        f"ELSE '**' || substr({c}, instr({c}, '@')) END"
    )


def _date(c: str) -> str:
    return f"CAST(try_strptime({c}, '%Y-%m-%d') AS DATE)"


def _masked_customer(table: str, compat: bool = False) -> str:
    hashed = _email("email") if compat else "email"
    return (
        f"SELECT customer_id, {_partial('first_name')} AS first_name, {_partial('last_name')} AS last_name, "
        f"{_email('email')} AS email, {_partial('phone')} AS phone, sha256({hashed}) AS email_hashed FROM {table}"
    )


def _masked_address(table: str) -> str:
    return (
        f"SELECT address_id, customer_id, {_partial('street_address')} AS street_address, city, state, zip_code "
        f"FROM {table}"
    )


def _standard_orders(table: str) -> str:
    return (
        f"SELECT order_id, customer_id, {_date('order_date')} AS order_date, "
        f"TRY_CAST(order_amount AS DOUBLE) AS order_amount, trim(lower(order_status)) AS order_status FROM {table}"
    )


def _standard_payments(table: str) -> str:
    return (
        f"SELECT payment_id, order_id, {_date('payment_date')} AS payment_date, "
        f"TRY_CAST(amount AS DOUBLE) AS amount, trim(lower(payment_method)) AS payment_method FROM {table}"
    )


RENAMED_CUSTOMER = (
    "SELECT customer_id, first_name AS customer_first_name, last_name AS customer_last_name, "
    "email AS customer_email, phone AS customer_phone{extra} FROM {table}"
)
RENAMED_ADDRESS = (
    "SELECT address_id, customer_id, street_address AS customer_street, city AS customer_city, "
    "state AS customer_state, zip_code AS customer_zip FROM {table}"
)

_WIDE_SQL = """
    SELECT o.order_id, c.customer_id, c.first_name AS customer_first_name, c.last_name AS customer_last_name,
      c.email AS customer_email, c.phone AS customer_phone, c.email_hashed,
      a.street_address AS customer_street, a.city AS customer_city, a.state AS customer_state,
      a.zip_code AS customer_zip, o.order_date, o.order_amount, o.order_status,
      p.payment_id, p.payment_date, p.amount, p.payment_method, round(o.order_amount + p.amount, 2) AS total_amount
    FROM masked_customer c LEFT JOIN masked_address a ON c.customer_id = a.customer_id
    LEFT JOIN std_orders o ON c.customer_id = o.customer_id LEFT JOIN std_payments p ON o.order_id = p.order_id"""

_NULL_CHECKS = " UNION ALL ".join(
    f"SELECT 'null_check' AS \"check\", '{c}' AS \"column\", count(*) AS failed_count, count(*) = 0 AS passed "
    f"FROM wide WHERE order_id IS NOT NULL AND {c} IS NULL"
    for c in ("customer_id", "order_id", "order_date", "order_status")
)
_RANGE_CHECKS = " UNION ALL ".join(
    f"SELECT 'numeric_range' AS \"check\", '{c}' AS \"column\", count(*) AS failed_count, count(*) = 0 AS passed "
    f"FROM wide WHERE {c} < 0 OR {c} > 1000000"
    for c in ("order_amount", "amount")
)
_DUPLICATE_CHECK = (
    "SELECT 'duplicate_check' AS \"check\", 'order_id' AS \"column\", "
    "count(*) - count(DISTINCT order_id) AS failed_count, true AS passed FROM wide WHERE order_id IS NOT NULL"
)


def _orphan_check(child: str, parent: str) -> str:
    return (
        "SELECT 'referential_integrity' AS \"check\", 'customer_id' AS \"column\", count(*) AS failed_count, "
        f"count(*) = 0 AS passed FROM {child} ch WHERE NOT EXISTS "
        f"(SELECT 1 FROM {parent} pa WHERE pa.customer_id = ch.customer_id)"
    )


_CHECKS = " UNION ALL ".join([_NULL_CHECKS, _RANGE_CHECKS, _DUPLICATE_CHECK])
_SCORE = """
    SELECT count(*) AS total_checks, CAST(sum(CASE WHEN passed THEN 1 ELSE 0 END) AS BIGINT) AS passed_checks,
      round(100.0 * sum(CASE WHEN passed THEN 1 ELSE 0 END) / count(*), 2) AS dq_score_pct,
      CASE WHEN round(100.0 * sum(CASE WHEN passed THEN 1 ELSE 0 END) / count(*), 2) >= 90
           THEN 'PASS' ELSE 'FAIL' END AS dq_status, CAST(90 AS DOUBLE) AS pass_threshold
    FROM checks"""


def _filled() -> str:
    columns = []
    for c in WIDE:
        if c == "order_amount":
            columns.append("coalesce(order_amount, 0.0) AS order_amount")
        elif c in TEXTS:
            columns.append(f"coalesce({c}, 'UNKNOWN') AS {c}")
        else:
            columns.append(c)
    return f"SELECT {', '.join(columns)} FROM wide WHERE order_id IS NOT NULL"


_REPAIR_TIES = ["payment_id", *[c for c in WIDE if c not in ("order_id", "payment_date", "payment_id")]]
_TOTAL = "round(order_amount + coalesce(amount, 0.0), 2) AS total_amount"
_REPAIRED = (
    f"SELECT {', '.join(WIDE[:-1])}, {_TOTAL} FROM "
    f"({_latest('filled', WIDE, ['order_id'], 'payment_date', _REPAIR_TIES)})"
)
SLICE_COLUMNS = {
    "customer": ["customer_id", "customer_first_name", "customer_last_name", "customer_email", "customer_phone",
                 "email_hashed"],
    "address": ["customer_id", "customer_street", "customer_city", "customer_state", "customer_zip"],
    "orders": ["order_id", "customer_id", "order_date", "order_amount", "order_status", "total_amount"],
    "payments": ["payment_id", "order_id", "payment_date", "amount", "payment_method"],
}


def _slice(name: str, table: str = "repaired", compat: bool = False) -> str:
    columns = SLICE_COLUMNS[name]
    key = columns[0] if name != "orders" else "order_id"
    rows = table if compat else f"(SELECT * FROM {table} WHERE {key} IS NOT NULL)"
    rest = [c for c in columns if c != key]
    return _latest(rows, columns, [key], rest[0], rest)


def _ctes(clean: bool) -> dict[str, str]:
    ctes = {f"raw_{t}": _raw(t) for t in COLUMNS}
    if clean:
        ctes["raw_orders"] = _raw("clean_orders")
    for table, (key, sort) in KEYS.items():
        ctes[f"dedup_{table}"] = _latest(f"raw_{table}", COLUMNS[table], [key], sort)
    ctes["masked_customer"] = _masked_customer("dedup_customer")
    ctes["masked_address"] = _masked_address("dedup_address")
    ctes["std_orders"] = _standard_orders("dedup_orders")
    ctes["std_payments"] = _standard_payments("dedup_payments")
    ctes["wide"] = _WIDE_SQL
    ctes["checks"] = (
        f"{_CHECKS} UNION ALL SELECT 'referential_integrity', 'customer_id', count(*), count(*) = 0 "
        "FROM wide WHERE order_id IS NOT NULL AND customer_id NOT IN "
        "(SELECT customer_id FROM wide WHERE customer_id IS NOT NULL)"
    )
    ctes["score"] = _SCORE
    ctes["filled"] = _filled()
    ctes["repaired"] = _REPAIRED
    for name in SLICE_COLUMNS:
        ctes[f"slice_{name}"] = _slice(name)
    return ctes


def _sql(final: str, clean: bool = False, **more: str) -> str:
    ctes = {**_ctes(clean), **more}
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in ctes.items()) + f"\n{final}"


def _count_columns(table: str) -> str:
    parts = []
    for c in COLUMNS[table]:
        numeric = c in DTYPES
        email = f"(SELECT count(*) FROM raw_{table} WHERE NOT regexp_matches({c}, '{EMAIL_PATTERN}'))"
        phone = f"(SELECT count(*) FROM raw_{table} WHERE NOT regexp_matches({c}, '{PHONE_PATTERN}'))"
        absent = "CAST(NULL AS {})"
        parts.append(
            f"SELECT '{table}' AS \"table\", '{c}' AS \"column\", '{DTYPES.get(c, 'string')}' AS dtype, "
            f"count(*) - count({c}) AS null_count, (SELECT count(*) FROM (SELECT DISTINCT {c} FROM raw_{table})) "
            "AS distinct_count, "
            + (
                f"CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, round(avg({c}), 2) AS mean, "
                if numeric
                else "CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max, CAST(NULL AS DOUBLE) AS mean, "
            )
            + f"{email if c == 'email' else absent.format('BIGINT')} AS invalid_email_count, "
            f"{phone if c == 'phone' else absent.format('BIGINT')} AS invalid_phone_count FROM raw_{table}"
        )
    return " UNION ALL ".join(parts)


COLUMN_METRICS = " UNION ALL ".join(_count_columns(t) for t in COLUMNS)
TABLE_METRICS = " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS row_count, CAST({len(c)} AS BIGINT) AS column_count, "
    f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw_{t})) AS duplicate_count FROM raw_{t}"
    for t, c in COLUMNS.items()
)
LINEITEM = {
    "l_orderkey": 1, "l_partkey": 1, "l_suppkey": 1, "l_linenumber": 1, "l_quantity": 1, "l_extendedprice": 1,
    "l_discount": 1, "l_tax": 1, "l_returnflag": 0, "l_linestatus": 0, "l_shipdate": 0,
}  # fmt: skip  # 1 = numeric


def _lineitem_metrics() -> str:
    parts = []
    for c, numeric in LINEITEM.items():
        stats = [f"CAST(min({c}) AS DOUBLE)", f"CAST(max({c}) AS DOUBLE)", f"round(avg({c}), 2)"]
        low, high, mean = stats if numeric else ["CAST(NULL AS DOUBLE)"] * 3
        parts.append(
            f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_count, count(DISTINCT {c}) + "
            f"CASE WHEN count(*) > count({c}) THEN 1 ELSE 0 END AS distinct_count, "
            f"{low} AS min, {high} AS max, {mean} AS mean FROM lineitem"
        )
    return " UNION ALL ".join(parts)


def _format_check(column: str, pattern: str) -> str:
    return (
        f"SELECT '{column}_format' AS \"check\", '{column}' AS \"column\", count(*) AS failed_count, "
        f"count(*) = 0 AS passed FROM raw_customer WHERE NOT regexp_matches({column}, '{pattern}')"
    )


def _date_check(table: str, column: str) -> str:
    return (
        f"SELECT 'date_format' AS \"check\", '{column}' AS \"column\", count(*) AS failed_count, "
        f"count(*) = 0 AS passed FROM raw_{table} WHERE {column} IS NOT NULL AND {_date(column)} IS NULL"
    )


def _counts(tables: dict[str, str], name: str = "table", value: str = "row_count") -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS \"{name}\", {q} AS {value}" for n, q in tables.items())


def _run_log(clean: bool) -> str:
    def count(table: str) -> str:
        return f"(SELECT count(*) FROM {table})"

    masked = " + ".join(count(f"dedup_{t}") for t in COLUMNS)
    rows = [("mask", t, count(f"raw_{t}"), count(f"dedup_{t}"), "'DONE'") for t in COLUMNS]
    rows.append(("integrate", "wide", masked, count("wide"), "'DONE'"))
    rows.append(("quality", "wide", count("wide"), count("repaired"), "(SELECT dq_status FROM score)"))
    for t in SLICE_COLUMNS:
        out = count(f"slice_{t}") if clean else "CAST(0 AS BIGINT)"
        rows.append(("publish", t, count("repaired"), out, "'DONE'" if clean else "'SKIPPED'"))
    return " UNION ALL ".join(
        f"SELECT '{stage}' AS stage, '{table}' AS \"table\", "
        f"{'CAST(NULL AS VARCHAR)' if stage == 'mask' else repr(RUN)} AS input_run_ts, "
        f"{rows_in} AS rows_in, {rows_out} AS rows_out, {status} AS status"
        for stage, table, rows_in, rows_out, status in rows
    )


def _joined(left: str, right: str, on: str, columns: str) -> str:
    return f"SELECT {columns} FROM raw_{left} l LEFT JOIN raw_{right} r ON l.{on} = r.{on}"


def _columns(alias: str, table: str, without: tuple[str, ...] = ()) -> str:
    return ", ".join(f"{alias}.{c}" for c in COLUMNS[table] if c not in without)


_EVENTS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
_STANDARD_EVENTS = (
    "SELECT event_id, CAST(ts AS DATE) AS ts, CAST(value AS DOUBLE) AS value, "
    "trim(lower(event_type)) AS event_type FROM events"
)
_DATED = (
    "(SELECT *, o_orderkey AS order_id, CASE WHEN o_orderkey % 53 > 0 THEN CAST(o_orderdate AS DATE) END AS order_date "
    "FROM orders)"
)
_YEARS = "(SELECT *, CAST(year(o_orderdate) AS VARCHAR) || '1231_000000' AS run_ts FROM orders)"
_FAILED = 'SELECT "check", "column", failed_count FROM checks WHERE NOT passed'

ORACLE: dict[str, str] = {
    "dedup_latest_lineitem": _latest("lineitem", list(LINEITEM), ["l_orderkey", "l_linenumber"], "l_shipdate"),
    "dedup_latest_orders": _latest(
        "orders",
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
        ["o_custkey"],
        "o_orderdate",
    ),
    "dedup_latest_events": _latest("events", _EVENTS, ["user_id"], "ts"),
    "dedup_latest_customer": _sql("SELECT * FROM dedup_customer"),
    "dedup_latest_payments": _sql("SELECT * FROM dedup_payments"),
    "dedup_whole_row": "SELECT DISTINCT lang, source, text FROM documents",
    "dedup_row_metrics": _sql(
        " UNION ALL ".join(
            f"SELECT '{t}' AS name, (SELECT count(*) FROM raw_{t}) AS rows_before, "
            f"(SELECT count(*) FROM dedup_{t}) AS rows_after, "
            f"(SELECT count(*) FROM raw_{t}) - (SELECT count(*) FROM dedup_{t}) AS removed"
            for t in COLUMNS
        )
    ),
    "profile_table_metrics": _sql(TABLE_METRICS),
    "profile_column_metrics": _sql(COLUMN_METRICS),
    "profile_lineitem_columns": _lineitem_metrics(),
    "profile_documents_table": (
        "SELECT 'documents' AS \"table\", count(*) AS row_count, CAST(3 AS BIGINT) AS column_count, "
        "count(*) - (SELECT count(*) FROM (SELECT DISTINCT lang, source, text FROM documents)) AS duplicate_count FROM documents"
    ),
    "profile_merged_lineitem": f'SELECT "column", null_count, min, max, mean FROM ({_lineitem_metrics()})',
    "profile_report_json": _sql(
        'SELECT t."table", t.row_count, c."column", c.null_count, c.distinct_count '
        'FROM table_metrics t JOIN column_metrics c ON t."table" = c."table"',
        table_metrics=TABLE_METRICS,
        column_metrics=COLUMN_METRICS,
    ),
    "check_format_email": _sql(_format_check("email", EMAIL_PATTERN)),
    "check_format_phone": _sql(_format_check("phone", PHONE_PATTERN)),
    "mask_partial": _sql(
        f"SELECT customer_id, last_name, {_partial('first_name')} AS first_name_masked, "
        f"{_partial('last_name')} AS last_name_masked, {_partial('phone')} AS phone_masked FROM raw_customer"
    ),
    "mask_documents": f"SELECT doc_id, {_partial('text')} AS masked FROM documents",
    "mask_email": _sql(f"SELECT customer_id, last_name, {_email('email')} AS masked FROM raw_customer"),
    "hash_sha256": "SELECT doc_id, sha256(text) AS hashed FROM documents",
    "mask_customer": _sql(_masked_customer("raw_customer")),
    "mask_customer_compat": _sql(_masked_customer("raw_customer", compat=True)),
    "mask_address": _sql(_masked_address("raw_address")),
    "mask_passthrough": _sql("SELECT * FROM raw_payments"),
    "mask_sql_functions": _sql(
        f"SELECT customer_id, last_name, {_partial('phone')} AS phone, {_email('email')} AS email, "
        "sha256(email) AS email_hashed FROM raw_customer"
    ),
    "standardize_raw_orders": _sql(_standard_orders("raw_orders")),
    "standardize_raw_payments": _sql(_standard_payments("raw_payments")),
    "standardize_timestamps": _STANDARD_EVENTS,
    "rename_customer": _sql(RENAMED_CUSTOMER.format(table="raw_customer", extra="")),
    "rename_address": _sql(RENAMED_ADDRESS.format(table="raw_address")),
    "join_customers_addresses": _sql(
        _joined(
            "customer",
            "address",
            "customer_id",
            f"{_columns('l', 'customer')}, {_columns('r', 'address', ('address_id', 'customer_id'))}",
        )
    ),
    "join_customers_orders": _sql(
        _joined(
            "customer",
            "orders",
            "customer_id",
            f"{_columns('l', 'customer')}, {_columns('r', 'orders', ('customer_id',))}",
        )
    ),
    "join_orders_with_payments": _sql(
        _joined(
            "orders", "payments", "order_id", f"{_columns('l', 'orders')}, {_columns('r', 'payments', ('order_id',))}"
        )
    ),
    "integrate_wide": _sql("SELECT * FROM wide"),
    "integrate_stored_wide": _sql("SELECT * FROM wide"),
    "integrate_drop_columns": _sql("SELECT * EXCLUDE (customer_phone) FROM wide"),
    "check_null_columns": _sql(_NULL_CHECKS),
    "check_duplicate_orders": _sql(_DUPLICATE_CHECK),
    "check_ranges": _sql(_RANGE_CHECKS),
    "check_orphans": _sql(_orphan_check("raw_orders", "raw_customer")),
    "check_orphans_sifted": (
        "SELECT 'referential_integrity' AS \"check\", 'customer_id' AS \"column\", count(*) AS failed_count, "
        "count(*) = 0 AS passed FROM lineitem WHERE l_orderkey NOT IN (SELECT s_suppkey FROM supplier)"
    ),
    "dq_checks_merged": _sql(
        " UNION ALL ".join(
            [
                _CHECKS,
                _orphan_check("raw_orders", "raw_customer"),
                _format_check("email", EMAIL_PATTERN),
                _format_check("phone", PHONE_PATTERN),
                _date_check("orders", "order_date"),
                _date_check("payments", "payment_date"),
            ]
        )
    ),
    "check_raw_dates": _sql(_date_check("orders", "order_date") + " UNION ALL " + _date_check("payments", "payment_date")),
    "dq_checks_raw": _sql("SELECT * FROM checks"),
    "dq_checks_clean": _sql("SELECT * FROM checks", clean=True),
    "dq_checks_against_parent": _sql(_CHECKS + " UNION ALL " + _orphan_check("raw_orders", "raw_customer")),
    "dq_score_raw": _sql("SELECT * FROM score"),
    "dq_score_clean": _sql("SELECT * FROM score", clean=True),
    "dq_failed_details": _sql(_FAILED),
    "repair_wide": _sql("SELECT * FROM repaired"),
    "fill_unknown_texts": _sql(
        "SELECT customer_id, "
        + ", ".join(f"coalesce({c}, 'UNKNOWN') AS {c}" for c in COLUMNS["customer"][1:])
        + " FROM raw_customer"
    ),
    "fill_missing_amount": _sql("SELECT * REPLACE (coalesce(order_amount, 0.0) AS order_amount) FROM raw_orders"),
    "route_pass": _sql(
        "SELECT repaired.*, dq_status FROM repaired, score WHERE dq_status = 'PASS'", clean=True
    ),
    "route_fail": _sql("SELECT repaired.*, dq_status FROM repaired, score WHERE dq_status = 'FAIL'"),
    "dq_report_json": _sql(
        "SELECT (SELECT count(*) FROM wide) AS total_rows, s.total_checks, s.passed_checks, s.dq_score_pct, "
        's.dq_status, f."check", f."column", f.failed_count FROM score s, failed f',
        failed=_FAILED,
    ),
    "enforce_schema_wide": _sql("SELECT * FROM wide"),
    "count_cast_failures": _sql(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", "
            + (
                f"(SELECT count(*) FROM raw_orders WHERE order_date IS NOT NULL AND {_date(c)} IS NULL)"
                if c == "order_date"
                else "CAST(0 AS BIGINT)"
            )
            + " AS failed_count"
            for c in COLUMNS["orders"]
        )
    ),
    **{f"slice_{name}": _sql(f"SELECT * FROM slice_{name}", clean=True) for name in SLICE_COLUMNS},
    "slice_payments_compat": _sql(_slice("payments", compat=True), clean=True),
    "slice_all_payments": _sql(_slice("payments", table="wide"), clean=True),
    "publish_verify_counts": _sql(
        _counts({t: f"(SELECT count(*) FROM slice_{t})" for t in SLICE_COLUMNS}), clean=True
    ),
    "publish_twice": _sql(
        _counts({t: f"(SELECT count(*) FROM slice_{t})" for t in SLICE_COLUMNS}), clean=True
    ),
    "publish_append": _sql(
        _counts({t: f"2 * (SELECT count(*) FROM slice_{t})" for t in SLICE_COLUMNS}), clean=True
    ),
    "latest_run_of_layer": f"SELECT max(run_ts) AS run_ts FROM {_YEARS}",
    "read_latest_run": (
        f"SELECT o_orderkey, o_totalprice, run_ts FROM {_YEARS} WHERE run_ts = (SELECT max(run_ts) FROM {_YEARS})"
    ),
    "read_run_replaced": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem",
    "dq_report_latest": _sql(_FAILED),
    "raw_recursive_read": "SELECT event_id, event_type, value FROM events",
    "read_configured_tables": _sql(
        _counts({t: f"(SELECT count(*) FROM raw_{t})" for t in ("customer", "orders", "payments")}, "name", "rows")
    ),
    "chain_published_orders": _sql("SELECT * FROM slice_orders", clean=True),
    "chain_run_log_pass": _sql(_run_log(clean=True), clean=True),
    "chain_run_log_fail": _sql(_run_log(clean=False)),
    **{f"chain_tables_{name}": _sql(f"SELECT * FROM slice_{name}", clean=True) for name in SLICE_COLUMNS},
    "chain_dq_checks": _sql(
        " UNION ALL ".join(
            [
                _CHECKS,
                _orphan_check("raw_orders", "raw_customer"),
                _format_check("email", EMAIL_PATTERN),
                _format_check("phone", PHONE_PATTERN),
                _date_check("orders", "order_date"),
                _date_check("payments", "payment_date"),
                "SELECT 'number_format', 'order_amount', count(*), count(*) = 0 FROM raw_orders "
                "WHERE order_amount IS NOT NULL AND TRY_CAST(order_amount AS DOUBLE) IS NULL",
                "SELECT 'schema_cast', 'wide', 0, true",
            ]
        ),
        raw_orders="SELECT * REPLACE (CASE WHEN order_id % 107 = 0 THEN '12,50' "
        f"ELSE CAST(order_amount AS VARCHAR) END AS order_amount) FROM ({_raw('orders')})",
    ),
    "chain_default_checks": _sql(
        'SELECT "check", "column", failed_count, passed, scored, (SELECT count(*) FROM slice_orders) AS published_orders '
        "FROM (SELECT *, true AS scored FROM checks UNION ALL SELECT *, false FROM ("
        + " UNION ALL ".join(
            [
                _orphan_check("raw_orders", "raw_customer"),
                _format_check("email", EMAIL_PATTERN),
                _format_check("phone", PHONE_PATTERN),
                _date_check("orders", "order_date"),
                _date_check("payments", "payment_date"),
                "SELECT 'schema_cast', 'wide', 0, true",
            ]
        )
        + "))",
        clean=True,
    ),
    "landed_reload_tables": (
        "SELECT 'customer' AS \"table\", c_custkey AS id FROM customer UNION ALL SELECT 'orders', o_orderkey FROM orders"
    ),
    "land_changes_daily": "SELECT CAST(ts AS DATE) AS day, count(*) AS rows FROM events GROUP BY 1",
    "land_reload": f"SELECT {', '.join(_EVENTS)} FROM events",
    "land_changing_schema": (
        "SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 2 = 1 THEN value END AS value, "
        "CASE WHEN event_id % 2 = 1 THEN props END AS props, '20240101_000000' AS load_ts FROM events UNION ALL "
        "SELECT event_id, ts, user_id, event_type, value, props, '20240102_000000' FROM events WHERE event_id % 2 = 1"
    ),
    "stream_latest_events": _latest("events", _EVENTS, ["user_id"], "ts"),
    "stream_latest_compacted": _latest("events", _EVENTS, ["user_id"], "ts"),
    "publish_upsert_orders": (
        f"SELECT order_id, CASE WHEN order_id % 7 <> 0 THEN order_date WHEN order_id % 2 = 0 "
        "THEN CAST(order_date + INTERVAL 40 DAY AS DATE) WHEN order_id % 3 > 0 THEN order_date END AS order_date, "
        f"CASE WHEN order_id % 7 = 0 THEN 'changed' ELSE o_orderstatus END AS order_status FROM {_DATED} "
        f"UNION ALL SELECT -order_id, order_date, 'new' FROM {_DATED} WHERE order_id % 11 = 0"
    ),
    "publish_dates_orders": (
        "SELECT order_id, order_date, CASE WHEN dayofmonth(order_date) = 3 AND order_id % 5 > 0 THEN 'late' "
        f"ELSE o_orderstatus END AS order_status FROM {_DATED} WHERE dayofmonth(order_date) IS DISTINCT FROM 3 OR order_id % 5 > 0 "
        f"OR order_date NOT IN (SELECT order_date FROM {_DATED} WHERE order_date IS NOT NULL AND order_id % 5 > 0)"
    ),
    "read_published_quarter": (
        "SELECT order_id, o_custkey AS customer_id, order_date, o_totalprice AS order_amount, o_orderstatus AS order_status, "
        f"o_totalprice AS total_amount FROM {_DATED} WHERE order_date BETWEEN DATE '1995-02-10' AND DATE '1995-05-09'"
    ),
    "publish_upsert_customers": (
        "SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 3 = 0 THEN 'changed' ELSE c_name END AS customer_first_name "
        "FROM customer UNION ALL SELECT -c_custkey, 'changed' FROM customer WHERE c_custkey % 3 = 0"
    ),
    "profile_table_approx": (
        "SELECT 'orders' AS \"table\", count(*) AS row_count, 2 AS column_count, "
        "count(*) - (SELECT count(*) FROM (SELECT DISTINCT o_orderkey % 2, o_orderstatus FROM orders)) AS duplicate_count "
        "FROM orders"
    ),
    "stream_mask_customers": (
        f"SELECT c_custkey, {_partial('c_name')} AS last_name, sha256(c_name) AS last_name_hashed FROM customer"
    ),
    "stream_standardize_events": _STANDARD_EVENTS,
}
for _joined_tables, _stored in (
    ("join_customers_addresses", "join_stored_customers_addresses"),
    ("join_customers_orders", "join_stored_customers_orders"),
    ("join_orders_with_payments", "join_stored_orders_payments"),
):
    ORACLE[_stored] = ORACLE[_joined_tables]
