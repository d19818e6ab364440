"""The current row per key of a change stream.

The latest of all rows is the latest of the latest rows of each batch. So a batch is folded to one row per key and stored
under its batch number, and readers fold the stored batches. No streaming state grows with the table, a repeated batch
replaces itself, and a hot key adds one row per batch. A batch counts once its number is recorded, after its files are
complete; readers and ``compact`` use recorded batches only.

Batches and the folded table are laid out by buckets of keys, as many as the stream was first started with. ``compact``
rewrites the buckets that the batches since the last compaction have rows in, and leaves the others where they lie; what
it made counts once its list of buckets is complete. Files that the compaction before the last had in use are
deleted: readers had a whole compaction's time to finish.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tablewright.operators.dedup import dedup_latest
from tablewright.session import file_names, folders, mark, remove, subfolders

_BATCHES, _COMMITTED, _FOLDED, _DONE = "batches", "committed", "folded", "compactions"
_BUCKET = "key_bucket"


def stream_latest(
    changes: DataFrame,
    path: str,
    checkpoint: str,
    keys: str | Sequence[str],
    sort: str,
    ties: Sequence[str] | None = None,
    seconds: int = 60,
    once: bool = False,
    buckets: int = 64,
) -> StreamingQuery:
    """Fold every batch of ``changes`` to its latest rows and store it below ``path``.

    ``buckets`` holds when the table is first started: about its size over 256 MB."""
    spark = changes.sparkSession
    names = [keys] if isinstance(keys, str) else list(keys)
    # What readers find before the first batch.
    start = spark.createDataFrame([], changes.schema).withColumn(_BUCKET, F.lit(0))
    start.write.mode("ignore").parquet(f"{path}/schema")
    spark.range(buckets, buckets + 1).toDF("buckets").coalesce(1).write.mode("ignore").parquet(f"{path}/layout")
    count = spark.read.schema("buckets long").parquet(f"{path}/layout").first()["buckets"]

    def store(batch: DataFrame, batch_id: int) -> None:
        latest = _placed(dedup_latest(batch, names, sort, ties), names, count)
        latest.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{path}/{_BATCHES}/batch_id={batch_id}")
        mark(spark, f"{path}/{_COMMITTED}/{batch_id}")

    trigger = {"availableNow": True} if once else {"processingTime": f"{seconds} seconds"}
    writer = changes.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start()


def _placed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def _compactions(spark: SparkSession, path: str) -> list[int]:
    """The finished compactions that are still listed, oldest first; at most two and what a broken one has left."""
    return sorted(int(name) for name in folders(spark, f"{path}/{_DONE}", "_SUCCESS"))


def _buckets(spark: SparkSession, path: str, compaction: int | None) -> dict[int, int]:
    """Per bucket the compaction that wrote its folded rows: as many as there are buckets."""
    if compaction is None:
        return {}
    rows = spark.read.schema("bucket int, upto long").parquet(f"{path}/{_DONE}/{compaction}")
    return {r["bucket"]: r["upto"] for r in rows.collect()}


def _batches_after(spark: SparkSession, path: str, done: int) -> list[int]:
    """Recorded batches since the last compaction: as many as the stream has made since then."""
    return sorted(int(n) for n in file_names(spark, f"{path}/{_COMMITTED}") if int(n) > done)


def _read(spark: SparkSession, path: str, places: Sequence[str]) -> DataFrame:
    schema = spark.read.parquet(f"{path}/schema").drop(_BUCKET).schema
    if not places:
        return spark.createDataFrame([], schema)
    # Folders are read as they are named here: their buckets are no column.
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*places)


def _rows(spark: SparkSession, path: str, held: dict[int, int], batches: Sequence[int]) -> DataFrame:
    """Folded rows of the buckets in ``held`` and all rows of ``batches``."""
    folded = [f"{path}/{_FOLDED}/upto={upto}/{_BUCKET}={bucket}" for bucket, upto in sorted(held.items())]
    new = [f"{path}/{_BATCHES}/batch_id={b}" for b in batches]
    return _read(spark, path, folded).unionByName(_read(spark, path, new))


def read_current(
    spark: SparkSession,
    path: str,
    keys: str | Sequence[str],
    sort: str,
    ties: Sequence[str] | None = None,
    op_column: str | None = None,
    delete_op: str = "D",
) -> DataFrame:
    """The current row per key. Every change is an upsert, unless ``op_column`` names the column
    that tells deletes: a key whose latest change is a delete is then left out."""
    done = max(_compactions(spark, path), default=None)
    batches = _batches_after(spark, path, -1 if done is None else done)
    latest = dedup_latest(_rows(spark, path, _buckets(spark, path, done), batches), keys, sort, ties)
    if op_column is None:
        return latest
    return latest.where(~F.col(op_column).eqNullSafe(delete_op))


def compact(
    spark: SparkSession, path: str, keys: str | Sequence[str], sort: str, ties: Sequence[str] | None = None
) -> int:
    """Fold the recorded batches into the buckets they touch and return the number of the last, -1 before the first.

    Deletes are kept, since they still hide older rows. A compaction cut short is never read, and is made anew by the
    next one."""
    finished = _compactions(spark, path)
    done = finished[-1] if finished else None
    batches = _batches_after(spark, path, -1 if done is None else done)
    if not batches:
        return -1 if done is None else done
    upto = batches[-1]
    held = _buckets(spark, path, done)
    touched = {
        int(name.split("=", 1)[1])
        for b in batches
        for name in subfolders(spark, f"{path}/{_BATCHES}/batch_id={b}")
        if name.startswith(f"{_BUCKET}=")
    }
    names = [keys] if isinstance(keys, str) else list(keys)
    rows = _rows(spark, path, {b: n for b, n in held.items() if b in touched}, batches)
    buckets = spark.read.schema("buckets long").parquet(f"{path}/layout").first()["buckets"]
    latest = _placed(dedup_latest(rows, names, sort, ties), names, buckets)
    latest.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{path}/{_FOLDED}/upto={upto}")
    now = {**held, **{b: upto for b in touched}}
    listed = spark.createDataFrame(sorted(now.items()), "bucket int, upto long").coalesce(1)
    listed.write.mode("overwrite").parquet(f"{path}/{_DONE}/{upto}")
    _forget(spark, path, finished, held, now)
    return upto


def _forget(spark: SparkSession, path: str, finished: list[int], held: dict[int, int], now: dict[int, int]) -> None:
    """Delete what only the compaction before the last had in use: its batches, its list, and its buckets that the last
    one or this one has rewritten."""
    if not finished:
        return
    last = finished[-1]
    for name in file_names(spark, f"{path}/{_COMMITTED}"):
        if int(name) <= last:
            remove(spark, f"{path}/{_BATCHES}/batch_id={name}")
            remove(spark, f"{path}/{_COMMITTED}/{name}")
    for older in finished[:-1]:
        remove(spark, f"{path}/{_DONE}/{older}")
    used = {(b, n) for versions in (held, now) for b, n in versions.items()}
    newest = max(now.values())
    for folder in subfolders(spark, f"{path}/{_FOLDED}"):
        number, inside = int(folder.split("=", 1)[1]), f"{path}/{_FOLDED}/{folder}"
        if number > newest:
            continue
        here = [n for n in subfolders(spark, inside) if n.startswith(f"{_BUCKET}=")]
        gone = [n for n in here if (int(n.split("=", 1)[1]), number) not in used]
        for name in gone:
            remove(spark, f"{inside}/{name}")
        if len(gone) == len(here):
            remove(spark, inside)
