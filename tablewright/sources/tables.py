"""Reading tables."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

from tablewright.model import TABLES, TableSpec

log = logging.getLogger(__name__)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    recursive: bool = False,
    on_missing: str = "raise",
) -> DataFrame | None:
    """One Parquet table. Pass a schema to spare the footer read that infers it.

    ``recursive`` also finds files in plain date folders below ``path``; it gives up partition columns, so
    landed loads are for ``read_landed_tables``. A missing path raises,
    or gives None with ``on_missing="skip"``; other errors always raise.
    """
    if on_missing not in ("raise", "skip"):
        raise ValueError(f"on_missing must be 'raise' or 'skip', not {on_missing!r}")
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if schema is not None:
        reader = reader.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if on_missing == "raise" or error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("skipping missing table at %s", path)
        return None


def read_tables(
    spark: SparkSession,
    base: str,
    specs: Iterable[TableSpec] = TABLES,
    on_missing: str = "skip",
    suffix: str = "",
    recursive: bool = False,
) -> dict[str, DataFrame]:
    """The tables of ``specs`` below ``base`` by name; missing ones are absent under ``"skip"``."""
    tables = {s.name: read_table(spark, f"{base}/{s.name}{suffix}", recursive=recursive, on_missing=on_missing) for s in specs}
    return {name: df for name, df in tables.items() if df is not None}
