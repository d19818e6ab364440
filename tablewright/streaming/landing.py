"""Landing a change stream as compressed, date-partitioned Parquet."""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tablewright.model import TABLES, TableSpec
from tablewright.session import folders, mark

LANDING_DATE = "landing_date"
#: Marks a load that readers may use; the name's underscore hides it from them.
LOADED = "_LOADED"
#: Folder of the schemas recorded for each load.
SCHEMAS = "_schemas"


def read_changes(
    spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Stream the Parquet files that arrive at ``path``, at most ``files_per_batch`` at a time."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def land_changes(
    changes: DataFrame,
    base: str,
    checkpoint: str,
    load_ts: str,
    date_column: str | None = None,
    seconds: int = 60,
    once: bool = False,
    compression: str = "gzip",
) -> StreamingQuery:
    """Land ``changes`` below ``{base}/load_ts=<load_ts>`` by date, flushing every ``seconds``.

    The date is that of ``date_column``, or of arrival. Restarting with the same ``load_ts``
    continues it, each row landing once. A new ``load_ts`` reloads from scratch: it has its own
    folder and checkpoint, and readers of the old load are not disturbed. ``once`` lands what
    is there and stops.
    """
    day = F.to_date(F.col(date_column)) if date_column else F.current_date()
    writer = (
        changes.withColumn(LANDING_DATE, day)
        .writeStream.format("parquet")
        .partitionBy(LANDING_DATE)
        .option("compression", compression)
        .option("checkpointLocation", f"{checkpoint}/load_ts={load_ts}")
    )
    trigger = {"availableNow": True} if once else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start(f"{base}/load_ts={load_ts}")


def read_landed(spark: SparkSession, base: str, load_ts: str) -> DataFrame:
    """The rows of one load, as committed by the stream: files of failed attempts are not read. A load whose schema has
    been recorded has all its columns, NULL in the rows landed before they came."""
    schema = recorded_schema(spark, base, load_ts)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{base}/load_ts={load_ts}")


def recorded_schema(spark: SparkSession, base: str, load_ts: str) -> T.StructType | None:
    """The newest schema that ``land_evolving`` has recorded for a load."""
    versions = folders(spark, f"{base}/{SCHEMAS}/load_ts={load_ts}", "_SUCCESS")
    if not versions:
        return None
    text = spark.read.schema("schema string").parquet(f"{base}/{SCHEMAS}/load_ts={load_ts}/{versions[-1]}").first()
    return T.StructType.fromJson(json.loads(text["schema"]))


def widened(known: T.StructType | None, found: T.StructType) -> T.StructType:
    """The columns of both, known ones first. A column that has changed its type raises: values landed so far would
    have to be rewritten."""
    if known is None:
        return found
    types = {f.name: f.dataType for f in known.fields}
    changed = [f.name for f in found.fields if types.get(f.name, f.dataType) != f.dataType]
    if changed:
        raise ValueError(f"columns {changed} have changed their type; land them as a new load")
    return T.StructType([*known.fields, *[f for f in found.fields if f.name not in types]])


def land_evolving(
    spark: SparkSession,
    source: str,
    base: str,
    checkpoint: str,
    load_ts: str,
    date_column: str | None = None,
    files_per_batch: int | None = None,
    once: bool = False,
    **options: int | str,
) -> StreamingQuery:
    """``land_changes`` for change files that gain columns: a stream keeps the schema it was started with, so it is
    started anew when one arrives, and goes on where it was.

    The schema is the union of what was recorded for the load and what the footers of the files at ``source`` show. It is
    recorded before the first row lands under it, so readers never meet a column they were not told of."""
    known = recorded_schema(spark, base, load_ts)
    schema = widened(known, spark.read.option("mergeSchema", "true").parquet(source).schema)
    if schema != known:
        path = f"{base}/{SCHEMAS}/load_ts={load_ts}"
        number = len(folders(spark, path, "_SUCCESS")) + 1
        spark.createDataFrame([(schema.json(),)], "schema string").coalesce(1).write.mode("overwrite").parquet(f"{path}/{number:06d}")
    changes = read_changes(spark, source, schema, files_per_batch=files_per_batch)
    return land_changes(changes, base, checkpoint, load_ts, date_column, once=once, **options)


def read_loads(spark: SparkSession, base: str) -> DataFrame:
    """The rows of all finished loads, each under its own schema, with ``load_ts``: columns that a load lacks are NULL."""
    loads = [name.removeprefix("load_ts=") for name in folders(spark, base, LOADED) if name.startswith("load_ts=")]
    if not loads:
        raise ValueError(f"no finished load at {base}")
    frames = [read_landed(spark, base, ts).withColumn("load_ts", F.lit(ts)) for ts in loads]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def finish_load(spark: SparkSession, base: str, load_ts: str) -> None:
    """Let readers use a load: its first pass over the source is through. Changes may go on landing in it."""
    mark(spark, f"{base}/load_ts={load_ts}/{LOADED}")


def last_load(spark: SparkSession, base: str) -> str | None:
    """The latest load that was finished, or None."""
    loads = [name for name in folders(spark, base, LOADED) if name.startswith("load_ts=")]
    return loads[-1].removeprefix("load_ts=") if loads else None


def read_landed_tables(spark: SparkSession, base: str, specs: Iterable[TableSpec] = TABLES) -> dict[str, DataFrame]:
    """The landed tables below ``base`` by name, each from its latest finished load, through the stream's commit log.

    They have the columns of their source, as the chain takes them. Tables without a finished load are absent."""
    loads = {s.name: last_load(spark, f"{base}/{s.name}") for s in specs}
    return {n: read_landed(spark, f"{base}/{n}", ts).drop(LANDING_DATE) for n, ts in loads.items() if ts}
