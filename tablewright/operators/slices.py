"""Cutting the repaired wide row into the published tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tablewright.model import SLICES, SliceSpec
from tablewright.operators.dedup import dedup_latest


def cut_slice(df: DataFrame, spec: SliceSpec, compat: bool = False) -> DataFrame:
    """The columns of one slice, one row per key; the greatest row by its columns survives.

    Rows without a key belong to no entity and are dropped; ``compat=True`` keeps one of them.
    """
    rows = df.select(*spec.columns)
    if not compat:
        rows = rows.where(F.col(spec.key).isNotNull())
    first = next(c for c in spec.columns if c != spec.key)
    return dedup_latest(rows, spec.key, first)


def split_slices(
    df: DataFrame,
    specs: Sequence[SliceSpec] = SLICES,
    payments: DataFrame | None = None,
    compat: bool = False,
) -> dict[str, DataFrame]:
    """All slices by name, lazily. ``df`` should be a stored table: each slice then reads only
    its own columns of it.

    Repair keeps one payment per order, so the others would be lost; ``payments`` may bring
    the full set for the payments slice.
    """
    return {
        spec.name: cut_slice(payments if spec.name == "payments" and payments is not None else df, spec, compat)
        for spec in specs
    }
