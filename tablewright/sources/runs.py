"""Reading the runs of a layer: ``{base}/run_ts=<yyyyMMdd_HHmmss>/``."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.session import folders

RUN_FORMAT = "%Y%m%d_%H%M%S"  # sorts as text in time order


def new_run_ts(now: datetime | None = None) -> str:
    """The name of a run, in UTC with a resolution of one second."""
    return (now or datetime.now(timezone.utc)).strftime(RUN_FORMAT)


def read_run(spark: SparkSession, base: str, run_ts: str) -> DataFrame:
    """One run. Only its own folder is listed, however many runs the layer holds."""
    return spark.read.parquet(f"{base}/run_ts={run_ts}")


def read_layer(spark: SparkSession, base: str) -> DataFrame:
    """All runs of a layer, with ``run_ts`` as a column that prunes folders."""
    rows = spark.read.parquet(base)
    return rows.withColumn("run_ts", F.col("run_ts").cast("string"))


def finished_runs(spark: SparkSession, base: str) -> list[str]:
    """The runs of a layer whose write is complete, oldest first. Only folder names are read."""
    return [name.removeprefix("run_ts=") for name in folders(spark, base, "_SUCCESS") if name.startswith("run_ts=")]


def last_run(spark: SparkSession, base: str) -> str:
    """The latest finished run of a layer."""
    runs = finished_runs(spark, base)
    if not runs:
        raise ValueError(f"no finished run at {base}")
    return runs[-1]


def read_last(spark: SparkSession, base: str) -> DataFrame:
    """The rows of the latest finished run, with ``run_ts``; no file of an older run is opened."""
    run_ts = last_run(spark, base)
    return read_run(spark, base, run_ts).withColumn("run_ts", F.lit(run_ts))


def read_report(spark: SparkSession, base: str, run_ts: str) -> DataFrame:
    """The report rows of a run, or those of the latest run if it left none."""
    runs = finished_runs(spark, base)
    return read_run(spark, base, run_ts).withColumn("run_ts", F.lit(run_ts)) if run_ts in runs else read_last(spark, base)


def latest_run(rows: DataFrame) -> DataFrame:
    """One row with the latest ``run_ts`` of a layer, a report table or the run log."""
    return rows.agg(F.max("run_ts").alias("run_ts"))


def read_latest(layer: DataFrame) -> DataFrame:
    """The rows of the latest run; the subquery prunes all other folders at run time."""
    return layer.where(F.col("run_ts") == latest_run(layer).scalar())


def dq_report_for(reports: DataFrame, run_ts: str) -> DataFrame:
    """The report rows of a run, or those of the latest run if it left none."""
    own = reports.where(F.col("run_ts") == run_ts).agg(F.max("run_ts").alias("run_ts"))
    chosen = F.coalesce(own.scalar(), latest_run(reports).scalar())
    return reports.where(F.col("run_ts") == chosen)
