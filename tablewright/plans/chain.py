"""The whole chain, from raw tables to published ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tablewright.model import HASH_COLUMNS, MASKING_RULES, SLICES, TABLES, QualityRules, SliceSpec, TableSpec, wide_schema
from tablewright.operators.dedup import dedup_latest, dedup_latest_stored
from tablewright.operators.integrate import integrate
from tablewright.operators.mask import mask_pii
from tablewright.operators.profile import profile, row_metrics
from tablewright.operators.quality import check_casts, dq_checks, dq_score, route_by_status, source_checks
from tablewright.operators.repair import repair
from tablewright.operators.schema import enforce_schema
from tablewright.operators.slices import split_slices
from tablewright.session import together
from tablewright.sinks.catalog import publish
from tablewright.sinks.reports import dq_report, profile_report, write_report
from tablewright.sinks.runs import write_counted, write_run
from tablewright.sources.runs import finished_runs, new_run_ts, read_layer, read_run


@dataclass(frozen=True)
class ChainConfig:
    tables: Sequence[TableSpec] = TABLES
    slices: Sequence[SliceSpec] = SLICES
    masking_rules: Mapping[str, str] = field(default_factory=lambda: dict(MASKING_RULES))
    hash_columns: Sequence[str] = HASH_COLUMNS
    salt: str = ""
    quality: QualityRules = QualityRules()
    drop_columns: Sequence[str] = ()
    database: str = "curated"
    publish_mode: str = "replace"  # the chain publishes full snapshots
    provider: str = "parquet"
    buckets: int | None = None  # by the size of the table
    all_checks: bool = False  # True: the score counts what the raw tables show, too, not the wide row's eight checks alone
    profile: bool = True
    approx_profile: bool = False
    keep_dedup_layer: bool = False
    compat: bool = False


def deduplicate(tables: Mapping[str, DataFrame], specs: Sequence[TableSpec]) -> dict[str, DataFrame]:
    """The latest row per primary key of every table that is there."""
    return {
        s.name: (dedup_latest_stored if s.narrow else dedup_latest)(tables[s.name], s.primary_key, s.sort_column)
        for s in specs
        if s.name in tables
    }


def mask(tables: Mapping[str, DataFrame], config: ChainConfig = ChainConfig()) -> dict[str, DataFrame]:
    """Every table with its personal data masked; tables without any pass through."""
    return {
        s.name: mask_pii(
            tables[s.name], s.pii_columns, config.masking_rules, config.hash_columns, config.salt, config.compat
        )
        for s in config.tables
        if s.name in tables
    }


def masked_tables(
    tables: Mapping[str, DataFrame], config: ChainConfig = ChainConfig(), store: str | None = None
) -> dict[str, DataFrame]:
    """The latest rows of raw tables, masked; with ``store``, a folder, written there and read back."""
    masked = mask(deduplicate(tables, config.tables), config)
    if store:
        for name, table in masked.items():
            table.write.parquet(f"{store}/{name}")
            masked[name] = table.sparkSession.read.parquet(f"{store}/{name}")
    return masked


def curate(
    tables: Mapping[str, DataFrame],
    config: ChainConfig = ChainConfig(),
    store: str | None = None,
    latest_payment: bool = False,
) -> DataFrame:
    """Raw tables to the wide row; ``latest_payment`` as in ``integrate``.

    With ``store``, a folder, the masked tables are written there and joined from storage, as the stages
    do: each is computed once, and adaptive execution can split hot keys, which it cannot right above a
    deduplicating window. Without it everything is one lazy plan.
    """
    _require_tables(tables)
    masked = masked_tables(tables, config, store)
    return integrate(**masked, drop_columns=config.drop_columns, latest_payment=latest_payment)


def _require_tables(tables: Mapping[str, DataFrame]) -> None:
    """The joins need all four tables, though reading, deduplicating and masking skip missing ones."""
    missing = {"customer", "address", "orders", "payments"} - set(tables)
    if missing:
        raise ValueError(f"missing tables: {sorted(missing)}")


LOG_SCHEMA = "table string, input_run_ts string, rows_in long, rows_out long, status string"


def _log(spark: SparkSession, base: str, stage: str, run_ts: str, rows: list[tuple]) -> None:
    """Add a stage to the run log: table, input run, rows in, rows out and status."""
    write_run(spark.createDataFrame(rows, LOG_SCHEMA).coalesce(1), f"{base}/runs/stage={stage}", run_ts)


def run_log(spark: SparkSession, base: str) -> DataFrame:
    """One row per run, stage and table."""
    return read_layer(spark, f"{base}/runs")


def _logged(spark: SparkSession, base: str, stage: str, run_ts: str) -> list[Row]:
    """What a run of a stage has logged: a row per table, with the counts of its writes."""
    return read_run(spark, f"{base}/runs/stage={stage}", run_ts).collect()


def latest_of(spark: SparkSession, base: str, stage: str) -> str:
    """The latest run of a stage, from the names in the run log."""
    runs = finished_runs(spark, f"{base}/runs/stage={stage}")
    if not runs:
        raise ValueError(f"stage {stage!r} has not run yet")
    return runs[-1]


def _rows(frames: Mapping[str, DataFrame]) -> dict[str, int]:
    return {r["name"]: r["rows"] for r in row_metrics(frames).collect()}


def profile_stage(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    base: str,
    run_ts: str,
    config: ChainConfig = ChainConfig(),
) -> None:
    """Write the profile of the raw tables as a report."""
    both = [profile(df, name, config.approx_profile) for name, df in tables.items()]
    table_metrics, column_metrics = (reduce(DataFrame.unionAll, frames) for frames in zip(*both))
    write_report(profile_report(table_metrics, column_metrics, run_ts), f"{base}/logs/profiling", run_ts)


def mask_stage(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    base: str,
    run_ts: str,
    config: ChainConfig = ChainConfig(),
) -> None:
    """Deduplicate and mask the raw tables. Both share one write, so that deduplicated clear text
    is stored only with ``keep_dedup_layer``. Checks that need clear or raw text run here and are stored
    for the quality stage."""
    deduplicated = deduplicate(tables, config.tables)

    def store(name: str) -> int:
        df = deduplicated[name]
        if config.keep_dedup_layer:
            write_run(df, f"{base}/staging_dedup/{name}", run_ts)
            df = read_run(spark, f"{base}/staging_dedup/{name}", run_ts)
        return write_counted(mask({name: df}, config)[name], f"{base}/staging_masked/{name}", run_ts)

    before, _, *stored = together(
        spark,
        [
            lambda: _rows({name: tables[name] for name in deduplicated}),
            lambda: write_run(source_checks(tables, config.quality), f"{base}/logs/source_checks", run_ts),
            *[partial(store, name) for name in deduplicated],
        ],
    )
    after = dict(zip(deduplicated, stored))
    _log(spark, base, "mask", run_ts, [(n, None, before[n], after[n], "DONE") for n in deduplicated])


def integrate_stage(
    spark: SparkSession,
    base: str,
    run_ts: str,
    input_run_ts: str | None = None,
    config: ChainConfig = ChainConfig(),
) -> None:
    """Join the masked tables of a run, by default the latest, into the wide row."""
    input_run_ts = input_run_ts or latest_of(spark, base, "mask")
    masked = {s.name: read_run(spark, f"{base}/staging_masked/{s.name}", input_run_ts) for s in config.tables}
    rows = write_counted(integrate(**masked, drop_columns=config.drop_columns), f"{base}/processed", run_ts)
    rows_in = sum(r["rows_out"] for r in _logged(spark, base, "mask", input_run_ts))
    _log(spark, base, "integrate", run_ts, [("wide", input_run_ts, rows_in, rows, "DONE")])


def quality_stage(
    spark: SparkSession,
    base: str,
    run_ts: str,
    input_run_ts: str | None = None,
    config: ChainConfig = ChainConfig(),
) -> str:
    """Check, repair and route the wide rows of a run, by default the latest; returns the status.

    All checks are stored: those of the wide row, the casts to the target schema, and what the mask stage of the
    same run found in the raw tables. The eight of the wide row are ``scored`` and decide; the others are reported. With
    ``all_checks=True`` every one decides, and the raw tables' comparison of orders with customers takes the place
    of the wide row's with itself."""
    input_run_ts = input_run_ts or latest_of(spark, base, "integrate")
    wide = read_run(spark, f"{base}/processed", input_run_ts)
    (integrated,) = _logged(spark, base, "integrate", input_run_ts)
    own = dq_checks(wide, config.quality)
    if config.all_checks:
        own = own.where(F.col("check") != "referential_integrity")
    found = read_run(spark, f"{base}/logs/source_checks", integrated["input_run_ts"])
    found = found.unionByName(check_casts(wide, wide_schema())).withColumn("scored", F.lit(config.all_checks))
    write_run(own.withColumn("scored", F.lit(True)).unionByName(found), f"{base}/logs/dq_checks", run_ts)
    checks = read_run(spark, f"{base}/logs/dq_checks", run_ts)
    score = dq_score(checks, config.quality.pass_threshold)
    _, rows, status = together(
        spark,
        [
            lambda: write_report(dq_report(checks, score, wide, run_ts), f"{base}/logs/dq", run_ts),
            lambda: write_counted(route_by_status(repair(wide), score), f"{base}/routed", run_ts, "dq_status"),
            lambda: score.first()["dq_status"],
        ],
    )
    _log(spark, base, "quality", run_ts, [("wide", input_run_ts, integrated["rows_out"], rows, status)])
    return status


def publish_stage(
    spark: SparkSession,
    base: str,
    run_ts: str,
    input_run_ts: str | None = None,
    config: ChainConfig = ChainConfig(),
) -> None:
    """Publish the accepted rows of a run, by default the latest; a run that failed is skipped."""
    input_run_ts = input_run_ts or latest_of(spark, base, "quality")
    if input_run_ts not in finished_runs(spark, f"{base}/runs/stage=quality"):
        raise ValueError(f"run {input_run_ts!r} has not been checked")
    (quality,) = _logged(spark, base, "quality", input_run_ts)
    rows_in = quality["rows_out"]
    if quality["status"] != "PASS":
        skipped = [(s.name, input_run_ts, rows_in, 0, "SKIPPED") for s in config.slices]
        return _log(spark, base, "publish", run_ts, skipped)
    accepted = read_run(spark, f"{base}/routed", input_run_ts).where(F.col("dq_status") == "PASS")
    slices = split_slices(enforce_schema(accepted), config.slices, compat=config.compat)
    published = publish(
        spark, slices, config.database, f"{base}/published", config.slices,
        config.publish_mode, config.provider, config.buckets,
    )
    done = [(r["table"], input_run_ts, rows_in, r["row_count"], "DONE") for r in published.collect()]
    _log(spark, base, "publish", run_ts, done)


def run_chain(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    base: str,
    run_ts: str | None = None,
    config: ChainConfig = ChainConfig(),
) -> DataFrame:
    """All stages as one run: profile, deduplicate, mask, join, check, repair, route and, if the
    score passes, publish. Returns the log of the run.

    Stages hand over through stored layers, so a lost executor costs at most the current stage,
    no stage is computed twice, and each reads only the columns it needs of the layer before.
    What reads the same tables and not each other's results runs side by side: profile and masks, tables, slices.
    The driver receives row counts and the status. A stage may also be run by itself, on the
    output of an earlier run.
    """
    _require_tables(tables)
    run_ts = run_ts or new_run_ts()
    on_raw = (profile_stage, mask_stage) if config.profile else (mask_stage,)
    together(spark, [partial(stage, spark, tables, base, run_ts, config) for stage in on_raw])
    integrate_stage(spark, base, run_ts, run_ts, config)
    quality_stage(spark, base, run_ts, run_ts, config)
    publish_stage(spark, base, run_ts, run_ts, config)
    return run_log(spark, base).where(F.col("run_ts") == run_ts)
