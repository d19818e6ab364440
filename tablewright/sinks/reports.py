"""Nested JSON reports. Their size depends on tables, columns and checks, never on rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def profile_report(table_metrics: DataFrame, column_metrics: DataFrame, run_ts: str) -> DataFrame:
    """One row: job, run_timestamp and tables, a map from table to its metrics, in which columns
    is a map from column to its statistics."""
    stats = [c for c in column_metrics.columns if c not in ("table", "column")]
    columns = column_metrics.groupBy("table").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("column", F.struct(*stats).alias("stats"))))).alias(
            "columns"
        )
    )
    tables = table_metrics.join(columns, "table")
    metrics = F.struct(
        "table", F.lit(run_ts).alias("run_timestamp"), "row_count", "column_count", "duplicate_count", "columns"
    )
    entries = F.collect_list(F.struct("table", metrics.alias("metrics")))
    return tables.agg(F.map_from_entries(entries).alias("tables")).select(
        F.lit("profiling").alias("job"), F.lit(run_ts).alias("run_timestamp"), "tables"
    )


def dq_report(checks: DataFrame, score: DataFrame, wide: DataFrame, run_ts: str) -> DataFrame:
    """One row: the score of a run, the list of its failed checks, and those that failed without being scored."""
    detail = F.struct("check", "column", "failed_count")
    scored = F.col("scored") if "scored" in checks.columns else F.lit(True)

    def failed(condition: Column) -> Column:
        return checks.agg(F.sort_array(F.collect_list(F.when(~F.col("passed") & condition, detail)))).scalar()

    return score.select(
        F.lit("dq_check").alias("job"),
        F.lit(run_ts).alias("run_timestamp"),
        wide.agg(F.count("*")).scalar().alias("total_rows"),
        "total_checks",
        "passed_checks",
        "dq_score_pct",
        "dq_status",
        "pass_threshold",
        failed(scored).alias("failed_checks"),
        failed(~scored).alias("unscored_failures"),
    )


def write_report(report: DataFrame, base: str, run_ts: str) -> str:
    """Store a report as JSON below ``base`` and return its folder."""
    path = f"{base}/run_ts={run_ts}"
    report.coalesce(1).write.mode("overwrite").json(path)
    return path
