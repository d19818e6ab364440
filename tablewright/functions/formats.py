"""Predicates on text columns. NULL always counts as valid: absence is the null check's business."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tablewright.model import DATE_FORMAT, EMAIL_PATTERN, PHONE_PATTERN

PATTERNS = {"email": EMAIL_PATTERN, "phone": PHONE_PATTERN}


def bad_format(column: str, kind: str) -> Column:
    """True where a present value does not look like an ``email`` or ``phone``."""
    if kind not in PATTERNS:
        raise ValueError(f"unknown format {kind!r}; expected one of {sorted(PATTERNS)}")
    value = F.col(column)
    return value.isNotNull() & ~value.rlike(PATTERNS[kind])


def out_of_range(column: str, low: float, high: float) -> Column:
    """True where a present value lies outside ``[low, high]``."""
    value = F.col(column)
    return value.isNotNull() & ((value < low) | (value > high))


def bad_date(column: str, date_format: str = DATE_FORMAT) -> Column:
    """True where a present value does not parse as a date."""
    value = F.col(column)
    return value.isNotNull() & F.try_to_date(value, date_format).isNull()


def bad_number(column: str) -> Column:
    """True where a present value is no number."""
    value = F.col(column)
    return value.isNotNull() & value.try_cast("double").isNull()
