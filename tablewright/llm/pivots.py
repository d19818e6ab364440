"""Near-duplicate vectors through a pivot-permutation index.

A vector is described by its nearest reference points in order. The inverted lists hold vectors by pairs
of pivots among the first ``prefix`` of that order, fitted to the sample; pairs of vectors that meet there have the pivots
they share among twice as many counted, are kept at ``shared`` or more, and are verified by their cosine
in double precision. A pair counts in the least list it shares, so nowhere twice.

The pivots are chosen from a bounded sample, the ``sample`` vectors with the smallest hashes, by farthest-first traversal: the
next pivot is the sampled vector whose greatest cosine to the pivots so far is least. So a group of near copies holds next to
no pivots however large it is, and vectors that all lie close together are still told apart. Directions are taken from the
sample's mean, which many embeddings share. Every vector is indexed, of whatever length: pivots have the most frequent length of the sample,
and other vectors are described by the components they have in common; only vectors of one length are compared.
Equal vectors are one entry with a weight. Lists longer than ``block`` are cut into blocks and compared
block against block in tasks of their own; what leaves a task is a count for each vector and a spanning
forest, never pairs. Entries are joined by numbers of their own; ids only name classes.

Defined cases: null, empty or zero vectors and vectors with null or non-finite components link with nothing; vectors of
different lengths do not link; rows with one id and vector count as links of one another; rows without an id link like any
other, and a class without any id has the name null.
"""

from __future__ import annotations

from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tablewright.llm.shared import buckets_for, components, forest, kept, salted_join

FOUND = "a long, b long, n long"
#: Numbers of pivots and prefixes to choose from, the share of neighbours to meet, the sampled vectors that it is measured
#: on, and the links among these that count.
PIVOTS, PREFIXES, ENOUGH, FITTED, FEW = (256, 64, 16, 4), (5, 6, 7, 8, 10, 12), 0.95, 1024, 50


def _usable(vector: str) -> F.Column:
    return F.expr(
        f"{vector} is not null and exists({vector}, x -> x <> 0)"
        f" and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    )


def _unit(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of length one."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _keys(nearest: np.ndarray, prefix: int, pivots: int) -> np.ndarray:
    """Pairs of pivots among the first ``prefix``, as numbers; one number for all where there is no pair."""
    if prefix < 2:
        return np.zeros((len(nearest), 1), dtype=np.int64)
    first = np.sort(nearest[:, :prefix], axis=1).astype(np.int64)
    return np.stack([first[:, i] * pivots + first[:, j] for i, j in combinations(range(prefix), 2)], axis=1)


def _centred(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Directions from ``mean``; rows that equal it have none."""
    y = x - mean
    size = np.linalg.norm(y, axis=1, keepdims=True)
    return np.where(size > 1e-9, y / np.maximum(size, 1e-9), 0.0)


def _nearest(x: np.ndarray, mean: np.ndarray, centres: np.ndarray, depth: int) -> np.ndarray:
    """The nearest pivots of each row in order, by the components that rows and pivots share."""
    both = min(x.shape[1], centres.shape[1])
    return np.argsort(-((x[:, :both] - mean[:both]) @ centres[:, :both].T), axis=1, kind="stable")[:, :depth]


def _far_apart(x: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` rows, each the one whose greatest cosine to the earlier ones is least."""
    chosen, nearest = [0], x @ x[0]
    while len(chosen) < min(most, len(x)):
        i = int(nearest.argmin())
        if nearest[i] >= 1 - 1e-9:
            break
        chosen.append(i)
        nearest = np.maximum(nearest, x @ x[i])
    return x[chosen]


def _met(one: np.ndarray, other: np.ndarray, prefix: int, shared: int) -> np.ndarray:
    """Whether rows of nearest pivots meet in a list and share enough of them."""
    in_list, all_of = ((one[:, :k, None] == other[:, None, :k]).any(axis=2).sum(axis=1) for k in (prefix, one.shape[1]))
    return (in_list >= min(2, prefix)) & (all_of >= shared)


def _fitted(units: np.ndarray, mean: np.ndarray, centres: np.ndarray, threshold: float, shared: int) -> tuple[int, int]:
    """How many pivots and which prefix to use: the first under which sampled vectors meet what lies close as often as
    ``ENOUGH``. That is both made-up neighbours at ``threshold`` to ``threshold`` + 0.02 in random directions, and the sampled
    vectors' own links. Vectors that share a main direction differ in little else and take a longer prefix; where
    nearly all are near copies, fewer pivots; with one, all vectors are compared, as are so few that a block holds them."""
    rng = np.random.default_rng(0)
    cosine = rng.uniform(threshold, min(threshold + 0.02, 1.0), len(units))[:, None]
    aside = rng.normal(size=units.shape)
    aside -= (aside * units).sum(axis=1, keepdims=True) * units
    aside /= np.maximum(np.linalg.norm(aside, axis=1, keepdims=True), 1e-12)
    made_up = cosine * units + np.sqrt(1 - cosine**2) * aside
    p, q = np.nonzero(np.triu(units @ units.T >= threshold, 1))
    some = rng.permutation(len(p))[: 4 * FITTED]
    for n in PIVOTS:
        for prefix in PREFIXES:
            depth = min(2 * prefix, n, len(centres))
            one, other = (_nearest(x, mean, centres[:n], depth) for x in (units, made_up))
            least = min(prefix, depth), min(shared, depth)
            met = _met(one, other, *least).mean()
            if len(some) >= FEW:
                met = min(met, _met(one[p[some]], one[q[some]], *least).mean())
            if met >= ENOUGH:
                return n, prefix
    return 1, 1


def _list(x, weights, keys, near, block, own, cell, threshold, shared) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of one cell of a list: links counted by weight for each vector, and the linked pairs as numbers."""
    rows = np.flatnonzero(block == cell[0])
    columns = np.flatnonzero(block == cell[1])
    counts, left, right = np.zeros(len(x), dtype=np.int64), [], []
    for a in range(0, len(rows), 256):
        part = rows[a : a + 256]
        good = near[part] @ near[columns].T >= shared
        good &= x[part] @ x[columns].T >= threshold
        if cell[0] == cell[1]:
            good &= part[:, None] < columns[None, :]
        p, q = np.nonzero(good)
        p, q = part[p], columns[q]
        earlier = np.zeros(len(p), dtype=bool)
        for i in range(keys.shape[1]):
            low = keys[p, i] < own
            for j in range(keys.shape[1]):
                earlier |= low & (keys[p, i] == keys[q, j])
        p, q = p[~earlier], q[~earlier]
        np.add.at(counts, p, weights[q])
        np.add.at(counts, q, weights[p])
        left.append(p)
        right.append(q)
    none = np.zeros(0, dtype=np.int64)
    return counts, np.concatenate([none, *left]), np.concatenate([none, *right])


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    threshold: float = 0.95,
    pivots: int | None = None,
    prefix: int | None = None,
    shared: int = 3,
    block: int = 1024,
    sample: int = 4096,
) -> DataFrame:
    """One row for each vector: its id, ``n_links``, ``component_id`` and ``kept``."""
    spark = vectors.sparkSession
    every = vectors.select(F.col(id_col).cast("long").alias("__id"), F.col(vector_col).cast("array<double>").alias("__vector"))
    every = kept(every.withColumn("__usable", _usable("__vector")))
    usable = every.where("__usable")
    entries = usable.groupBy("__vector").agg(F.min("__id").alias("__least"), F.count("*").alias("__weight"))
    entries = kept(entries.withColumn("__name", F.monotonically_increasing_id()))
    # The sample is bounded: `sample` vectors.
    drawn = entries.orderBy(F.xxhash64("__vector"), "__name").limit(sample).select("__vector").collect()
    nothing = every.select(F.col("__id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("__id").alias("component_id"))
    if not drawn:
        return nothing.withColumn("kept", F.lit(True))
    lengths = Counter(len(r[0]) for r in drawn)
    length = max(lengths, key=lambda k: (lengths[k], k))
    units = _unit(pa.array([r[0] for r in drawn if len(r[0]) == length]))
    mean = units.mean(axis=0)
    centres = _far_apart(_centred(units, mean), pivots or PIVOTS[0])
    if len(drawn) <= block and not prefix and not pivots:
        centres, prefix = centres[:1], 1  # these are all: one block holds them
    if not prefix:
        n, prefix = _fitted(units[:FITTED], mean, centres, threshold, shared)
        centres = centres[: pivots or n]
    n_pivots = len(centres)
    depth = min(2 * prefix, n_pivots)
    prefix, shared = min(prefix, depth), min(shared, depth)

    def describe(batches):
        for batch in batches:
            sizes = pc.list_value_length(batch["__vector"]).to_numpy()
            for size in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == size))
                keys = _keys(_nearest(_unit(part["__vector"]), mean, centres, depth), prefix, n_pivots)
                for k in range(keys.shape[1]):
                    columns = [pa.array(keys[:, k]), pa.array(np.full(len(keys), size, np.int32)), *part.columns]
                    yield pa.RecordBatch.from_arrays(columns, names=["list", "size", *part.schema.names])

    same = entries.select("__vector", "__name", "__weight")
    lists = same.mapInArrow(describe, "list long, size int, __vector array<double>, __name long, __weight long")
    long = kept(lists.groupBy("list", "size").count().where(F.col("count") > block).select("list", "size", F.ceil(F.col("count") / block).cast("int").alias("cut")))
    lists = lists.join(long, ["list", "size"], "left").withColumn("cut", F.coalesce("cut", F.lit(1)))
    lists = lists.withColumn("block", F.pmod(F.xxhash64("__name"), F.col("cut")).cast("int"))
    cells = F.transform(F.sequence(F.lit(0), F.col("cut") - 1), lambda k: F.struct(F.least(k, "block").alias("i"), F.greatest(k, "block").alias("j")))
    lists = lists.select("*", F.explode(cells).alias("cell")).select("*", "cell.i", "cell.j").drop("cell", "cut")
    n = buckets_for(spark, same.count() * max(1, prefix * (prefix - 1) // 2), 4 * block)

    def compare(key, table):
        order = np.lexsort(tuple(table[c].to_numpy() for c in ("j", "i", "list", "size")))
        table = table.take(pa.array(order))
        sizes = table["size"].to_numpy()
        out: list[tuple[int, int, int]] = []
        first = np.flatnonzero(np.r_[True, np.diff(sizes) != 0])
        for start, stop in zip(first, [*first[1:], len(sizes)]):
            compare_cells(table.slice(start, stop - start), out)
        a, b, c = zip(*out) if out else ((), (), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(c, pa.int64())})

    def compare_cells(table, out):
        x = _unit(table["__vector"])
        nearest = _nearest(x, mean, centres, depth)
        keys = _keys(nearest, prefix, n_pivots)
        near = np.zeros((len(x), n_pivots), dtype=np.float32)
        np.put_along_axis(near, nearest, 1, axis=1)
        which, i, j, block_of, names, weights = (
            table[c].to_numpy() for c in ("list", "i", "j", "block", "__name", "__weight")
        )
        cuts = np.flatnonzero(
            np.concatenate([[True], (np.diff(which) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0), [True]])
        )
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b - a < 2:
                continue
            s = slice(a, b)
            counts, p, q = _list(x[s], weights[s], keys[s], near[s], block_of[s], which[a], (i[a], j[a]), threshold, shared)
            label = forest(b - a, p, q)
            for k in np.flatnonzero(counts):
                out.append((int(names[a + k]), int(names[a + label[k]]), int(counts[k])))

    found = kept(lists.groupBy(F.pmod(F.xxhash64("list", "size", "i", "j"), F.lit(n))).applyInArrow(compare, FOUND))
    classes = components(found.select("a", "b"))
    counted = found.groupBy(F.col("a").alias("__name")).agg(F.sum("n").alias("__links"))
    told = entries.join(counted, "__name", "left").join(classes, F.col("__name") == F.col("node"), "left")
    told = kept(
        told.select(
            "__vector", "__least", (F.coalesce("__links", F.lit(0)) + F.col("__weight") - 1).alias("n_links"),
            F.coalesce("component", "__name").alias("component"),
        )
    )
    names = told.groupBy(F.col("component").alias("__class")).agg(F.min("__least").alias("component_id"))
    named = kept(salted_join(told, names, [("component", "__class")], "inner", 16).select("__vector", "n_links", "component_id"))
    linked = usable.join(named, "__vector").select(F.col("__id").alias(id_col), "n_links", "component_id")
    lone = every.where("not __usable")
    alone = lone.select(F.col("__id").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("__id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
