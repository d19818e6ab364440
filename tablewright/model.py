"""Table specs, rules and target schemas. Driver-side values only, no data."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """One source table: its key, the column that orders versions of a row, its personal data.

    ``narrow`` rows are numbers, dates and states of a few bytes each in a compressed file, so that an input split has very
    many of them: they are not sorted a split at a time.
    """

    name: str
    primary_key: tuple[str, ...]
    sort_column: str
    pii_columns: tuple[str, ...] = ()
    narrow: bool = False


@dataclass(frozen=True)
class SliceSpec:
    """One published table cut from the wide row.

    ``partition_by`` names a date, by whose day, month or year (``grain``) the table is laid out; ``bucket_by`` suits
    ids, where a partition per value would leave one tiny file per customer.
    """

    name: str
    key: str
    columns: tuple[str, ...]
    partition_by: str | None = None
    bucket_by: str | None = None
    grain: str = "month"


# They must agree with the tables and rules being replaced.
TABLES = (
    TableSpec("customer", ("customer_id",), "customer_id", ("first_name", "last_name", "email", "phone")),
    TableSpec("address", ("address_id",), "address_id", ("street_address",)),
    TableSpec("orders", ("order_id",), "order_date", narrow=True),
    TableSpec("payments", ("payment_id",), "payment_date", narrow=True),
)
MASKING_RULES = {
    "first_name": "partial",
    "last_name": "partial",
    "email": "email",
    "phone": "partial",
    "street_address": "partial",
}
HASH_COLUMNS = ("email",)
EMAIL_PATTERN = r"^[\w\.\-]+@[\w\.\-]+\.\w{2,}$"
PHONE_PATTERN = r"^\+?[\d\s\-\(\)]{7,15}$"
EMAIL_COLUMNS = ("email",)
PHONE_COLUMNS = ("phone",)
NUMERIC_RANGES = {"order_amount": (0, 1000000), "amount": (0, 1000000)}
DATE_COLUMNS = ("order_date", "payment_date")
DATE_FORMAT = "yyyy-MM-dd"
PASS_THRESHOLD = 90.0
CRITICAL_COLUMNS = ("customer_id", "order_id", "order_date", "order_status")
REQUIRED_COLUMNS = ("customer_id", "order_id", "order_date", "order_amount", "total_amount", "payment_id")
UNKNOWN = "UNKNOWN"
CUSTOMER_NAMES = {
    "first_name": "customer_first_name",
    "last_name": "customer_last_name",
    "email": "customer_email",
    "phone": "customer_phone",
}
ADDRESS_NAMES = {
    "street_address": "customer_street",
    "city": "customer_city",
    "state": "customer_state",
    "zip_code": "customer_zip",
}
SLICES = (
    SliceSpec(
        "customer",
        "customer_id",
        ("customer_id", "customer_first_name", "customer_last_name", "customer_email", "customer_phone",
         "email_hashed"),
        bucket_by="customer_id",
    ),
    SliceSpec(
        "address",
        "customer_id",
        ("customer_id", "customer_street", "customer_city", "customer_state", "customer_zip"),
        bucket_by="customer_id",
    ),
    SliceSpec(
        "orders",
        "order_id",
        ("order_id", "customer_id", "order_date", "order_amount", "order_status", "total_amount"),
        partition_by="order_date",
    ),
    SliceSpec(
        "payments",
        "payment_id",
        ("payment_id", "order_id", "payment_date", "amount", "payment_method"),
        partition_by="payment_date",
    ),
)


def wide_schema(id_type: T.DataType | None = None) -> T.StructType:
    """The 19 columns of the wide row, fixed values like those above. Ids are bigint unless ``id_type`` says otherwise:
    32-bit ids run out long before 100 TB of rows."""
    ids = id_type or T.LongType()
    text, date, number = T.StringType(), T.DateType(), T.DoubleType()
    return T.StructType(
        [
            T.StructField("order_id", ids),
            T.StructField("customer_id", ids),
            T.StructField("customer_first_name", text),
            T.StructField("customer_last_name", text),
            T.StructField("customer_email", text),
            T.StructField("customer_phone", text),
            T.StructField("email_hashed", text),
            T.StructField("customer_street", text),
            T.StructField("customer_city", text),
            T.StructField("customer_state", text),
            T.StructField("customer_zip", text),
            T.StructField("order_date", date),
            T.StructField("order_amount", number),
            T.StructField("order_status", text),
            T.StructField("payment_id", ids),
            T.StructField("payment_date", date),
            T.StructField("amount", number),
            T.StructField("payment_method", text),
            T.StructField("total_amount", number),
        ]
    )


@dataclass(frozen=True)
class QualityRules:
    critical_columns: tuple[str, ...] = CRITICAL_COLUMNS
    ranges: dict[str, tuple[float, float]] = field(default_factory=lambda: dict(NUMERIC_RANGES))
    email_columns: tuple[str, ...] = EMAIL_COLUMNS
    phone_columns: tuple[str, ...] = PHONE_COLUMNS
    date_columns: tuple[str, ...] = DATE_COLUMNS
    duplicate_key: str = "order_id"
    enforce_duplicates: bool = False
    pass_threshold: float = PASS_THRESHOLD
