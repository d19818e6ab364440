"""Helpers of several operators: checkpoints, connected components."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.session import shared_dir

#: Words are runs of other characters than these six.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def kept(df: DataFrame) -> DataFrame:
    """Cut the lineage: a checkpoint below ``spark.checkpoint.dir``."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or shared_dir(spark, "checkpoints"))
    return df.checkpoint()


def buckets_for(spark: SparkSession, rows: int, rows_each: int) -> int:
    return max(rows // rows_each + 1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def salted_join(left: DataFrame, right: DataFrame, keys: list[tuple[str, str]], how: str, salts: int = 256) -> DataFrame:
    """Join a table with hot keys to one with at most one row a key: each of those rows is repeated ``salts``
    times, and the left rows of a key are dealt over the copies. Keys may be null; the right's names must differ."""
    left = left.withColumn("__salt", F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int"))
    right = right.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    on = left["__salt"] == right["__copy"]
    for a, b in keys:
        on = on & left[a].eqNullSafe(right[b])
    return left.join(right, on, how).drop("__salt", "__copy")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, of every node with an edge (``a``, ``b``).

    Alternating stars: every node's larger neighbours, then every node's smaller ones, are hung below its least
    neighbour until nothing changes. Minima are folded on the map side and joined back, so a node with
    very many edges is never gathered. Rows are at most the edges.
    """
    edges = kept(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        seen = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if seen == before or not seen[0]:
            return (
                edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
                .unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")))
                .distinct()
            )
        before = seen
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("least"))
        small = large.join(least, "a").where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges = kept(small.unionByName(least.withColumnRenamed("least", "b")).distinct())


def forest(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The least of ``n`` numbers that each is joined to by the pairs ``p``, ``q``."""
    label = np.arange(n)
    while len(p):
        low = np.minimum(label[p], label[q])
        new = label.copy()
        np.minimum.at(new, p, low)
        np.minimum.at(new, q, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def give_back() -> None:
    """Return a Python worker's freed memory to the system; workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
