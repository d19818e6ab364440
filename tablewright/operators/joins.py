"""A left join that survives hot keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def left_join(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], right_keys: DataFrame | None = None
) -> DataFrame:
    """Left outer join USING ``on``, with the rows and columns of Spark's own.

    In a left outer join adaptive execution may split a skewed partition of the left side only,
    because each left row must learn in one place whether it matched; if a third of ``right``
    shares one key, one task gets it all. So the join is put together from three parts:
    matches from an inner join, whose skewed partitions adaptive execution may split on either
    side; left rows without a match from an anti join against the distinct right keys, which are
    folded before the shuffle; and left rows with a NULL key, which can match nothing and are
    not shuffled at all. The first two parts share one shuffle of ``left``.

    ``right_keys`` may name a cheaper frame that has the same keys as ``right``, for when
    ``right`` is itself a join.
    """
    on = [on] if isinstance(on, str) else list(on)
    keyed: Column = reduce(Column.__and__, [F.col(c).isNotNull() for c in on])
    keys = (right if right_keys is None else right_keys).select(*on).where(keyed).distinct()
    matched = left.where(keyed).join(right, on, "inner")
    unmatched = left.where(keyed).join(keys, on, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True).unionByName(
        left.where(~keyed), allowMissingColumns=True
    )
