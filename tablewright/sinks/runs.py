"""Writing the runs of a layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F


def write_run(df: DataFrame, base: str, run_ts: str, *partition_by: str, compression: str = "snappy") -> str:
    """Store ``df`` as one run of the layer at ``base`` and return its folder.

    Writing the same run again replaces it and leaves other runs alone, so a job that was
    cut short can simply be repeated.
    """
    path = f"{base}/run_ts={run_ts}"
    writer = df.write.mode("overwrite").option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def write_counted(df: DataFrame, base: str, run_ts: str, *partition_by: str) -> int:
    """``write_run`` that returns the number of rows, observed while they are written: no job of its own, and no row
    twice, as Spark takes each partition of a write once."""
    observed = Observation()
    write_run(df.observe(observed, F.count(F.lit(1)).alias("rows")), base, run_ts, *partition_by)
    return observed.get.get("rows", 0)
