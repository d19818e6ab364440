"""Masking the personal data of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from tablewright.functions.masks import MASKS, sha256_hex
from tablewright.model import HASH_COLUMNS, MASKING_RULES


def mask_pii(
    df: DataFrame,
    pii_columns: Sequence[str],
    rules: Mapping[str, str] = MASKING_RULES,
    hash_columns: Sequence[str] = HASH_COLUMNS,
    salt: str = "",
    compat: bool = False,
) -> DataFrame:
    """Mask ``pii_columns`` in place and add ``{column}_hashed`` for those in ``hash_columns``.

    A column without a rule is masked partially (``email`` as an email); an unknown rule raises
    instead of passing clear text through. The hash is taken of the clear value. ``compat=True``
    masks ``email`` as an email whatever its rule and hashes the masked value, under which
    different people can share a hash. One projection, so it works on batch and streaming
    frames alike; with no personal columns it returns ``df`` itself.
    """
    if not pii_columns:
        return df
    absent = [c for c in pii_columns if c not in df.columns]
    if absent:
        raise ValueError(f"no such columns to mask: {absent}")
    columns = {}
    for name in pii_columns:
        by_name = "email" if name == "email" else "partial"
        rule = by_name if compat and name == "email" else rules.get(name, by_name)
        if rule not in MASKS:
            raise ValueError(f"unknown mask rule {rule!r} for {name!r}; expected one of {sorted(MASKS)}")
        columns[name] = MASKS[rule](name)
        if name in hash_columns:
            columns[f"{name}_hashed"] = (
                F.sha2(columns[name], 256) if compat else sha256_hex(name, salt)
            )
    return df.withColumns(columns)
