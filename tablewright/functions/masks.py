"""Masking as native column expressions, so a masked scan stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession, functions as F

# What a masked value looks like.
STAR = "*"
NOT_AN_EMAIL = "****@****.***"
SHORT_LOCAL_PART = "**"


# Each mask is one SQL text over a value ``{v}``, for columns and for SQL functions alike.
PARTIAL = (
    f"CASE WHEN char_length({{v}}) <= 4 THEN repeat('{STAR}', char_length({{v}})) "
    f"ELSE concat(left({{v}}, 2), repeat('{STAR}', char_length({{v}}) - 4), right({{v}}, 2)) END"
)
EMAIL = (
    f"CASE WHEN instr({{v}}, '@') = 0 THEN '{NOT_AN_EMAIL}' "
    f"WHEN instr({{v}}, '@') > 3 THEN concat(left({{v}}, 2), repeat('{STAR}', instr({{v}}, '@') - 3), "
    "substring({v}, instr({v}, '@'))) "
    f"WHEN instr({{v}}, '@') > 0 THEN concat('{SHORT_LOCAL_PART}', substring({{v}}, instr({{v}}, '@'))) END"
)


def _text(column: str) -> str:
    """A column's name, quoted part by part, as text."""
    quoted = column if "`" in column else ".".join(f"`{part}`" for part in column.split("."))
    return f"CAST({quoted} AS STRING)"


def partial_mask(column: str) -> Column:
    """Keep the first and last two characters; values of up to four characters become stars only."""
    return F.expr(PARTIAL.format(v=_text(column)))


def email_mask(column: str) -> Column:
    """Keep the domain and two characters of the part before the first ``@``."""
    return F.expr(EMAIL.format(v=_text(column)))


def sha256_hex(column: str, salt: str = "") -> Column:
    """Hex SHA-256 of the UTF-8 text. A salt keeps hashes from being looked up in a table."""
    text = F.col(column).cast("string")
    return F.sha2(F.concat(F.lit(salt), text) if salt else text, 256)


MASKS = {"partial": partial_mask, "email": email_mask, "hash": sha256_hex}

SQL_FUNCTIONS = {"partial_mask": PARTIAL.format(v="v"), "mask_email": EMAIL.format(v="v"), "sha256_hash": "sha2(v, 256)"}


def register_sql_functions(spark: SparkSession) -> None:
    """Make the masks callable from SQL. Spark inlines the bodies; no Python runs per row."""
    for name, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(v STRING) RETURNS STRING RETURN {body}")
