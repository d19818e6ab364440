"""Session settings and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession


def build_session(app: str = "tablewright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew splitting and UTC; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, or below the warehouse where that is unset: both are
    folders that all executors reach. It is deleted when the session's JVM ends."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/.tablewright"
    parent = f"{base.rstrip('/')}/{uuid.uuid4().hex}"
    files, where = _file_system(spark, parent), spark._jvm.org.apache.hadoop.fs.Path(parent)
    files.mkdirs(where)
    files.deleteOnExit(where)
    return f"{parent}/{label}-{uuid.uuid4().hex}"


def together(spark: SparkSession, calls: Sequence[Callable[[], Any]]) -> list[Any]:
    """The results of ``calls``, which do not read each other's, in their order. Each has a thread that submits its jobs, so
    that tasks of one fill the cores that the last tasks of another leave idle. All have ended when the first error is raised."""
    if len(calls) < 2:
        return [call() for call in calls]
    with ThreadPoolExecutor(len(calls)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(call)) for call in calls]
    return [one.result() for one in running]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a stored folder, if it is there."""
    _file_system(spark, path).delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)


def folders(spark: SparkSession, path: str, holding: str) -> list[str]:
    """Names of the folders right below ``path`` that have a file ``holding``, sorted; none where ``path`` is absent.

    One listing and a look into each folder; no data file is opened."""
    files, parent = _file_system(spark, path), spark._jvm.org.apache.hadoop.fs.Path(path)
    if not files.exists(parent):
        return []
    within = spark._jvm.org.apache.hadoop.fs.Path
    found = [s.getPath().getName() for s in files.listStatus(parent) if s.isDirectory()]
    return sorted(name for name in found if files.exists(within(f"{path}/{name}/{holding}")))


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``, sorted; none where it is absent. One listing."""
    files, parent = _file_system(spark, path), spark._jvm.org.apache.hadoop.fs.Path(path)
    if not files.exists(parent):
        return []
    return sorted(s.getPath().getName() for s in files.listStatus(parent) if s.isDirectory())


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files right below ``path``, but for hidden ones; none where it is absent. One listing."""
    files, parent = _file_system(spark, path), spark._jvm.org.apache.hadoop.fs.Path(path)
    if not files.exists(parent):
        return []
    names = [s.getPath().getName() for s in files.listStatus(parent) if s.isFile()]
    return sorted(n for n in names if not n.startswith((".", "_")))


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    _file_system(spark, path).create(spark._jvm.org.apache.hadoop.fs.Path(path), True).close()


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
