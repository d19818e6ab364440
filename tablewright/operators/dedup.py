"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

_RANK, _BUCKET = "_version_rank", "_key_bucket"
#: Hash buckets of keys that rows are counted by, and the rows of one that a task may sort.
KEY_BUCKETS = 1 << 16
MOST_ROWS = 1_000_000


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(_orderable(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def version_order(df: DataFrame, keys: Sequence[str], sort: str, ties: Sequence[str] | None = None) -> list:
    """Newest first, NULLs last, then every other column, so that the survivor never depends on
    row arrival. Rows that tie on all of them are identical."""
    if ties is None:
        ties = [f.name for f in df.schema.fields if f.name not in keys and _orderable(f.dataType)]
    return [F.col(c).desc_nulls_last() for c in dict.fromkeys([sort, *ties])]


def dedup_latest(
    df: DataFrame, keys: str | Sequence[str], sort: str, ties: Sequence[str] | None = None
) -> DataFrame:
    """The latest row per key.

    ``row_number() = 1`` makes Catalyst place a group limit before the shuffle, so each map
    task sends at most one row per key: a key that holds a third of the table costs the
    reducer one row per map task. Rows with a NULL key form one group.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    newest_first = Window.partitionBy(*keys).orderBy(*version_order(df, keys, sort, ties))
    return df.withColumn(_RANK, F.row_number().over(newest_first)).where(F.col(_RANK) == 1).drop(_RANK)


def dedup_latest_stored(
    df: DataFrame, keys: str | Sequence[str], sort: str, ties: Sequence[str] | None = None, most: int = MOST_ROWS
) -> DataFrame:
    """``dedup_latest`` for stored tables, whose keys are cheap to read a second time.

    The group limit of ``dedup_latest`` sorts an input split whole, and how many rows a split has depends on how well its
    file compresses. Here rows are shuffled first, so tasks sort what adaptive execution gives them. Keys whose
    hash bucket has more than ``most`` rows would be one task's work: their rows alone are spread over
    all tasks, whatever their key, and take the group limit there. Without such keys that part is not run.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).alias(_BUCKET)
    counts = df.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
    crowded = F.broadcast(counts.where(F.col("n") > most).select(_BUCKET))  # at most KEY_BUCKETS numbers
    rows = df.select("*", bucket)
    values = [f.name for f in df.schema.fields if f.name not in keys and _orderable(f.dataType)]
    others = rows.join(crowded, _BUCKET, "left_anti").drop(_BUCKET).repartition(*keys)
    spread = rows.join(crowded, _BUCKET, "left_semi").drop(_BUCKET).hint("rebalance", *values)
    return dedup_latest(others, keys, sort, ties).unionByName(dedup_latest(spread, keys, sort, ties))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows without exact copies; copies are folded on the map side first."""
    return df.dropDuplicates()
