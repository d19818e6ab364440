"""Publishing slices as catalog tables.

Nothing that readers use is ever overwritten. What is new is written whole to a version folder below the table's,
``v=<number>``; then the catalog is pointed to it: the table as a whole, or each date partition that changed. A write
that fails leaves the table as it was, and a driver lost between two partitions leaves both readable, each in its old or new
version; publishing again finishes the job, since all modes but ``append`` may be repeated. The version before
the last is deleted, as queries that read it had a whole load's time to end. A table has one writer at a time.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterable, Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tablewright.model import SLICES, SliceSpec
from tablewright.operators.profile import row_metrics
from tablewright.session import mark, remove, subfolders, together

#: About 256 MB of a narrow table.
ROWS_PER_BUCKET = 4_000_000
MODES = ("upsert", "partitions", "replace", "append")
GRAINS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}
#: Partition of the rows without a date.
NO_DATE = "none"
#: Partitions named in one statement.
STATEMENT = 500


def partition_column(spec: SliceSpec) -> str:
    """The column that date tables are laid out by: the day, month or year of their date, as text."""
    return f"{spec.partition_by}_{spec.grain}"


def _partition(spec: SliceSpec) -> Column:
    return F.coalesce(F.date_format(spec.partition_by, GRAINS[spec.grain]), F.lit(NO_DATE))


def _layout(spec: SliceSpec, provider: str, buckets: int) -> str:
    if spec.partition_by and provider == "iceberg":
        return f"PARTITIONED BY ({spec.grain}s({spec.partition_by}))"
    if spec.partition_by:
        return f"PARTITIONED BY ({partition_column(spec)} STRING)"
    if spec.bucket_by and provider == "iceberg":
        return f"PARTITIONED BY (bucket({buckets}, {spec.bucket_by}))"
    if spec.bucket_by:
        return f"CLUSTERED BY ({spec.bucket_by}) INTO {buckets} BUCKETS"
    return ""


def create_table(
    spark: SparkSession,
    df: DataFrame,
    spec: SliceSpec,
    database: str,
    warehouse: str,
    provider: str = "parquet",
    buckets: int = 64,
    compression: str = "snappy",
) -> str:
    """Create database and table where absent, with the columns of ``df``; returns the table's name.

    Dates become partitions by ``spec.grain``: a folder per day costs the driver a rename and the catalog an entry for each
    of some thousand days, while rows sorted by day inside a month are skipped by their files' statistics. Ids
    become hash buckets, which also let later joins on the id skip their shuffle; a partition per id would
    mean a folder per customer.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{warehouse}'")
    table = f"{database}.{spec.name}"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    codec = "write.parquet.compression-codec" if provider == "iceberg" else "parquet.compression"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {provider} {_layout(spec, provider, buckets)} "
        f"LOCATION '{warehouse}/{spec.name}' TBLPROPERTIES ('{codec}' = '{compression}')"
    )
    return table


def _described(spark: SparkSession, table: str, partition: str = "") -> dict[str, str]:
    """What the catalog knows of a table, or of one of its partitions, whose facts come before the table's."""
    rows = spark.sql(f"DESCRIBE EXTENDED {table} {partition}").collect()
    return {r["col_name"]: r["data_type"] for r in reversed(rows)}


def _named(column: str, label: str) -> str:
    return f"PARTITION ({column} = '{label}')"


def _labels(spark: SparkSession, table: str) -> set[str]:
    """The partitions of a table: as many as days, months or years."""
    return {r["partition"].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


class _Versions:
    """The version folders of a table."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.stored = [name for name in subfolders(spark, root) if name.startswith("v=")]
        number = max((int(name[2:]) for name in self.stored), default=0) + 1
        self.new = f"v={number:06d}"
        self.path = f"{root}/{self.new}"

    def clean(self, keep: Iterable[str], untouched: set[str] | None = None) -> None:
        """Delete versions of the table, or of all partitions but ``untouched`` ones, but for the new one and what ``keep``
        names; and version folders that hold nothing but what a failed write has left."""
        keep = {k.rstrip("/").split(f"{self.root.rsplit('/', 1)[-1]}/v=", 1)[-1] for k in keep}
        for version in self.stored:
            inside = f"{self.root}/{version}"
            if untouched is None:
                if version[2:] not in keep:
                    remove(self.spark, inside)
                continue
            here = {name for name in subfolders(self.spark, inside) if not name.startswith(("_", "."))}
            for name in here - untouched:
                if f"{version[2:]}/{name}" not in keep:
                    remove(self.spark, f"{inside}/{name}")
                    here.discard(name)
            if not here:
                remove(self.spark, inside)


def _counted(rows: DataFrame) -> tuple[DataFrame, Observation]:
    """Rows that are counted while they are written; no job of its own."""
    observed = Observation()
    return rows.observe(observed, F.count(F.lit(1)).alias("rows")), observed


def _count(observed: Observation) -> int:
    return observed.get.get("rows", 0)


def _replace_buckets(spark: SparkSession, rows: DataFrame, table: str, spec: SliceSpec, versions: _Versions) -> int:
    """Write a whole version of a table without dates, and point the table to it in one step. Bucketed files need a
    table to be written through: one of the same layout, which is dropped again."""
    known = _described(spark, table)
    staging = f"{table}__{versions.new[2:]}"
    spark.sql(f"DROP TABLE IF EXISTS {staging}")
    spark.sql(f"CREATE TABLE {staging} LIKE {table} LOCATION '{versions.path}'")
    try:
        if spec.bucket_by:
            rows = rows.repartition(int(known["Num Buckets"]), spec.bucket_by)
        rows, observed = _counted(rows)
        rows.write.insertInto(staging)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{versions.path}'")
    except Exception:
        remove(spark, versions.path)
        raise
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {staging}")
    spark.catalog.refreshTable(table)
    versions.clean([known["Location"]])
    return _count(observed)


def _replace_partitions(
    spark: SparkSession, rows: DataFrame, table: str, spec: SliceSpec, versions: _Versions, touched: set[str]
) -> int:
    """Write a version of the partitions of ``rows`` and point the catalog to them; those of ``touched`` that have no
    rows any more are dropped. A rebalance lets adaptive execution split a date that holds a third of the rows."""
    column = partition_column(spec)
    rows = rows.withColumn(column, _partition(spec)).hint("rebalance", column)
    rows, observed = _counted(rows.sortWithinPartitions(column, spec.partition_by, spec.key))
    try:
        rows.write.partitionBy(column).parquet(versions.path)
    except Exception:
        remove(spark, versions.path)
        raise
    written = {name.split("=", 1)[1] for name in subfolders(spark, versions.path) if name.startswith(f"{column}=")}
    known = _labels(spark, table)
    swapped = sorted(written & known)
    gone = sorted((touched - written) & known)
    before = [_described(spark, table, _named(column, label))["Location"] for label in swapped + gone]
    _add(spark, table, column, sorted(written - known), versions.path)
    for label in swapped:
        spark.sql(f"ALTER TABLE {table} {_named(column, label)} SET LOCATION '{versions.path}/{column}={label}'")
    for label in gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_named(column, label)}")
    spark.catalog.refreshTable(table)
    versions.clean(before, {f"{column}={label}" for label in known - written - touched})
    return _count(observed)


def _add(spark: SparkSession, table: str, column: str, labels: Sequence[str], path: str) -> None:
    for i in range(0, len(labels), STATEMENT):
        parts = " ".join(f"{_named(column, x)} LOCATION '{path}/{column}={x}'" for x in labels[i : i + STATEMENT])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")


def _append(spark: SparkSession, rows: DataFrame, table: str, spec: SliceSpec, versions: _Versions) -> None:
    """Add rows to the versions that are in use; new dates get a version of their own first."""
    if spec.partition_by:
        column = partition_column(spec)
        rows = rows.withColumn(column, _partition(spec))
        labels = {r[0] for r in rows.select(column).distinct().collect()}  # as many as months
        new = sorted(labels - _labels(spark, table))
        for label in new:
            mark(spark, f"{versions.path}/{column}={label}/_NEW")
        _add(spark, table, column, new, versions.path)
        rows = rows.hint("rebalance", column)
    elif spec.bucket_by:
        if not versions.stored:
            mark(spark, f"{versions.path}/_NEW")
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{versions.path}'")
        rows = rows.repartition(int(_described(spark, table)["Num Buckets"]), spec.bucket_by)
    rows.write.insertInto(table)


def _merged(spark: SparkSession, rows: DataFrame, table: str, spec: SliceSpec, column: str) -> tuple[DataFrame, set[str]]:
    """The new rows and the stored rows that stay, of the partitions that change, and the names of those: where the new
    rows belong and where rows of the same key lie now. Keys and partition alone are read to find them."""
    stored, new = spark.table(table), F.col("_new")
    values = rows.select(F.col(column).alias("_new")).distinct()
    if not spec.partition_by:
        return stored.join(values, F.col(column).eqNullSafe(new), "left_anti").select(*rows.columns).unionByName(rows), set()
    part = partition_column(spec)
    homes = stored.select(column, part).join(values, F.col(column).eqNullSafe(new), "left_semi").select(part)
    labels = homes.unionByName(rows.select(_partition(spec).alias(part))).distinct()
    touched = {r[0] for r in labels.collect()}  # as many as months
    others = stored.where(F.col(part).isin(sorted(touched))).join(values, F.col(column).eqNullSafe(new), "left_anti")
    return others.select(*rows.columns).unionByName(rows), touched


def _write_iceberg(spark: SparkSession, rows: DataFrame, table: str, mode: str, spec: SliceSpec) -> None:
    if mode == "append":
        rows.writeTo(table).append()
    elif mode == "partitions":
        rows.writeTo(table).overwritePartitions()
    elif mode == "replace":
        rows.writeTo(table).overwrite(F.lit(True))
    else:
        spark.sql(
            f"MERGE INTO {table} t USING {{rows}} r ON t.{spec.key} <=> r.{spec.key} "
            "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *",
            rows=rows,
        )


def _load(
    spark: SparkSession,
    rows: DataFrame,
    database: str,
    warehouse: str,
    spec: SliceSpec,
    mode: str,
    provider: str,
    buckets: int | None,
) -> int | None:
    """Load one slice as ``publish`` says; returns the rows written, where they are counted on the way."""
    root, table, schema = f"{warehouse}/{spec.name}", f"{database}.{spec.name}", rows.schema
    staged = None
    there = spark.catalog.tableExists(table)
    sized = spec.bucket_by and not there and not buckets
    if provider != "iceberg" and (sized or (there and mode in ("upsert", "partitions"))):
        # The new rows are read more than once: to size buckets, to find their keys, to be stored.
        staged = f"{root}/_incoming"
        rows, observed = _counted(rows)
        rows.write.mode("overwrite").parquet(staged)
        rows = spark.read.schema(schema).parquet(staged)
    parts = buckets or (_count(observed) // ROWS_PER_BUCKET + 1 if staged and sized else 64)
    create_table(spark, rows, spec, database, warehouse, provider, parts)
    if provider == "iceberg":
        _write_iceberg(spark, rows.select(*schema.names), table, mode, spec)
        return None
    columns = [c for c in spark.table(table).columns if not (spec.partition_by and c == partition_column(spec))]
    rows = rows.select(*columns)
    versions = _Versions(spark, root)
    touched: set[str] = set()
    written = None
    if mode == "append":
        _append(spark, rows, table, spec, versions)
    else:
        if mode == "replace" and spec.partition_by:
            touched = _labels(spark, table)
        elif mode != "replace" and there:
            rows, touched = _merged(spark, rows, table, spec, spec.key if mode == "upsert" else spec.partition_by)
        if spec.partition_by:
            written = _replace_partitions(spark, rows, table, spec, versions, touched)
        else:
            written = _replace_buckets(spark, rows, table, spec, versions)
    if staged:
        remove(spark, staged)
    return written


def publish(
    spark: SparkSession,
    slices: Mapping[str, DataFrame],
    database: str,
    warehouse: str,
    specs: Sequence[SliceSpec] = SLICES,
    mode: str = "upsert",
    provider: str = "parquet",
    buckets: int | None = None,
) -> DataFrame:
    """Create the tables where absent, load the slices and return row counts per table.

    ``upsert`` replaces the rows whose key occurs in the new rows, wherever they lie, and deletes nothing else, so
    publishing twice leaves one copy and a row whose date has moved stays once. Of date tables only the
    partitions that lose or gain rows are written anew. ``partitions`` replaces all rows of the dates that occur in
    the new ones, and refuses tables without dates. ``replace`` replaces tables whole, which suits full
    snapshots. ``append`` adds rows on every call. New rows have one row a key, as ``cut_slice`` gives them.
    Without ``buckets`` a new table gets one for every ``ROWS_PER_BUCKET`` of its first rows.

    Counts of replaced tables are taken while they are written, the others' by ``verify_counts``. Slices are loaded side by
    side, each into a table of its own.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    whole = [s.name for s in specs if not s.partition_by]
    if mode == "partitions" and whole:
        raise ValueError(f"{whole} have no date partitions; use mode='upsert'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{warehouse}'")
    load = [partial(_load, spark, slices[s.name], database, warehouse, s, mode, provider, buckets) for s in specs]
    written = dict(zip([s.name for s in specs], together(spark, load)))
    if mode == "replace" and provider != "iceberg" and written:
        return spark.createDataFrame(list(written.items()), "table string, row_count long")
    return verify_counts(spark, database, [s.name for s in specs])


def read_published(
    spark: SparkSession,
    database: str,
    spec: SliceSpec,
    since: datetime.date | None = None,
    until: datetime.date | None = None,
) -> DataFrame:
    """The columns of a published slice, of the dates from ``since`` to ``until``, both included: other partitions are
    pruned, and files inside skip by their dates. A bound leaves rows without a date out."""
    rows = spark.table(f"{database}.{spec.name}")
    for bound, below in ((since, False), (until, True)):
        if bound is not None:
            day, label = F.lit(bound), F.date_format(F.lit(bound), GRAINS[spec.grain])
            date, part = F.col(spec.partition_by), F.col(partition_column(spec))
            rows = rows.where((date <= day) & (part <= label) if below else (date >= day) & (part >= label))
    return rows.select(*spec.columns)


def verify_counts(spark: SparkSession, database: str, tables: Sequence[str]) -> DataFrame:
    """Rows per published table, counted from the stored files."""
    counts = row_metrics({t: spark.table(f"{database}.{t}") for t in tables})
    return counts.select(F.col("name").alias("table"), F.col("rows").alias("row_count"))
