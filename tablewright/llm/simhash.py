"""SimHash fingerprints and their near-duplicate classes by a byte-position inverted index.

Two 64-bit fingerprints that differ in at most three bits share at least five of their eight bytes in place. The
index lists fingerprints by the bytes they hold at given positions; a pair that meets in a list has
its shared positional bytes tallied, is kept at five or more, and is then verified bit by bit.

Single bytes would give lists that grow with the corpus, so a list stands for three positions at once: of any five
positions out of two halves of four, three lie in one half, so the eight triples inside the halves meet every
such pair. Lists longer than ``hot`` are taken apart exactly: first into the ten sets of five positions
that hold the triple, then, where one of those is long as well, by *centres*: two values that differ in at
most three of the other 24 bits have a value within one bit of one and two bits of the other, and such a
centre has at most 325 neighbours. So neither a list nor a task grows with a group of near copies,
and only a spanning forest of every list leaves the task, never its pairs.

Defined cases: null or empty text has fingerprint zero, linked like any other; repeated rows of an id stay rows.
Classes join fingerprints, never ids: rows that share an id, or have none, meet only through their texts. A class
is named by its smallest id; a class without any id has the name null.
"""

from __future__ import annotations

from itertools import accumulate, combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm.shared import buckets_for, components, forest, give_back, kept, salted_join

SEED = 42
TRIPLES = [c for half in (range(4), range(4, 8)) for c in combinations(half, 3)]
FIVES = list(combinations(range(8), 5))
LAST_ID = (1 << 63) - 1
_BITS = np.array([[value >> bit & 1 for bit in range(8)] for value in range(256)])


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Bits set in over half of the hashes of all shingles, repeats included; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [e - 1 for e in accumulate(len(w) + 1 for w in words)]
    if len(words) > shingle:
        starts = [0, *(e + 1 for e in ends[: len(words) - shingle])]
        parts = [joined[a:b] for a, b in zip(starts, ends[shingle - 1 :])]
    else:
        parts = [joined]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, len(parts))
    places = hashes.astype("<u8").view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)
    counts = np.bincount(places.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    bits = (2 * counts > len(parts)).astype(np.uint8).ravel()
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``docs`` without its text, with ``__print``, the fingerprint as a long."""
    rest = [c for c in docs.columns if c != text_col]
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}

    def run(batches):
        for batch in batches:
            prints = [fingerprint(t, shingle) for t in batch["__text"].to_pylist()]
            columns = [batch.column(c) for c in rest] + [pa.array(prints, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*rest, "__print"])
            give_back()

    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("__text")
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in rest), "__print long"])
    return docs.select(*(F.col(f"`{c}`") for c in rest), text).mapInArrow(run, schema)


def _at(positions) -> Column:
    """The bytes of ``__print`` at some positions, the others cleared."""
    return F.col("__print").bitwiseAND(F.lit(sum(255 << 8 * p for p in positions) - (1 << 64 if 7 in positions else 0)))


def _lists(prints: DataFrame, sets: list[tuple[int, ...]]) -> DataFrame:
    """One row for each fingerprint and set of positions."""
    keys = F.array(*(F.struct(F.lit(i).alias("slot"), _at(s).alias("bytes")) for i, s in enumerate(sets)))
    return prints.select("*", F.explode(keys).alias("__key")).select("*", "__key.slot", "__key.bytes").drop("__key")


def joined(values: np.ndarray, names: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the fingerprints of one list."""
    p, q = [], []
    for a in range(0, len(values), 256):
        x = values[a : a + 256, None] ^ values[None, :]
        shared = (x.view(np.uint8).reshape(*x.shape, 8) == 0).sum(axis=2)
        left, right = np.nonzero((shared >= 8 - bits) & (np.bitwise_count(x) <= bits))
        p.append(left + a)
        q.append(right)
    label = forest(len(values), np.concatenate(p), np.concatenate(q))
    return [(int(names[i]), int(names[label[i]])) for i in np.flatnonzero(label != np.arange(len(label)))]


def _edges(rows) -> pa.Table:
    a, b = zip(*rows) if rows else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _compare(lists: DataFrame, bits: int, n: int) -> DataFrame:
    def run(key, table):
        slot, place = table["slot"].to_numpy(), table["bytes"].to_numpy()
        order = np.lexsort((place, slot))
        slot, place = slot[order], place[order]
        values, names = table["__print"].to_numpy()[order].view(np.uint64), table["__name"].to_numpy()[order]
        cuts = np.flatnonzero(np.concatenate([[True], (slot[1:] != slot[:-1]) | (place[1:] != place[:-1]), [True]]))
        out = []
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b - a > 1:
                out += joined(values[a:b], names[a:b], bits)
        return _edges(out)

    return lists.groupBy(F.pmod(F.xxhash64("slot", "bytes"), F.lit(n))).applyInArrow(run, "a long, b long")


def _hot(lists: DataFrame, hot: int) -> DataFrame:
    return kept(lists.groupBy("slot", "bytes").count().where(F.col("count") > hot).select("slot", "bytes"))


def _centres(lists: DataFrame, n: int) -> DataFrame:
    """Links within long lists of five positions, through values near both ends of a link."""

    def run(batches):
        for batch in batches:
            for value, name, slot in zip(*(batch.column(c).to_pylist() for c in ("__print", "__name", "slot"))):
                free = [8 * p + i for p in range(8) if p not in FIVES[slot] for i in range(8)]
                masks = [0, *(1 << i for i in free)]
                far = [1 << i | 1 << j for i, j in combinations(free, 2)]
                centres = np.array([m for m in masks + far], dtype=np.uint64) ^ np.uint64(value & LAST_ID | (value < 0) << 63)
                k = len(centres)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([slot] * k, pa.int32()), pa.array(centres.view(np.int64)), pa.array([name] * k, pa.int64()), pa.array([1] * len(masks) + [2] * len(far), pa.int32())],
                    names=["slot", "centre", "name", "away"],
                )

    near = lists.mapInArrow(run, "slot int, centre long, name long, away int")
    # At most 301 values lie within two bits of a centre.
    stars = near.groupBy("slot", "centre").agg(
        F.min(F.when(F.col("away") == 1, F.col("name"))).alias("a"), F.collect_set("name").alias("all")
    )
    return stars.where("a is not null and size(all) > 1").select("a", F.explode("all").alias("b")).where("a <> b")


def links(prints: DataFrame, bits: int = 3, hot: int = 2048) -> DataFrame:
    """Edges that join exactly the classes of distinct fingerprints ``__print`` (named ``__name``)."""
    if bits != 3:
        raise ValueError("the sets of positions are those for three bits")
    prints = kept(prints)
    n = buckets_for(prints.sparkSession, prints.count() * len(TRIPLES), 100_000)
    triples = _lists(prints, TRIPLES)
    hot_triples = _hot(triples, hot)
    edges = _compare(triples.join(hot_triples, ["slot", "bytes"], "left_anti"), bits, n)
    if not hot_triples.isEmpty():
        long = triples.join(hot_triples, ["slot", "bytes"]).withColumnRenamed("slot", "triple").drop("bytes")
        inside = F.array(*(F.array(*(F.lit(i) for i, f in enumerate(FIVES) if set(t) <= set(f))) for t in TRIPLES))
        long = long.select("__print", "__name", F.explode(inside[F.col("triple")]).alias("slot")).distinct()
        by_slot = F.array(*(_at(f) for f in FIVES))
        fives = kept(long.withColumn("bytes", by_slot[F.col("slot")]))
        hot_fives = _hot(fives, hot)
        edges = edges.unionByName(_compare(fives.join(hot_fives, ["slot", "bytes"], "left_anti"), bits, n))
        if not hot_fives.isEmpty():
            edges = edges.unionByName(_centres(fives.join(hot_fives, ["slot", "bytes"]), n))
    return edges


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    bits: int = 3,
    hot: int = 2048,
    class_col: str | None = None,
) -> DataFrame:
    """The columns of ``docs`` but its text, with ``fingerprint`` (hex) and ``component_id``.

    ``class_col`` names a column for the class itself, which tells classes without any id apart.
    """
    prints = kept(fingerprints(docs, text_col, shingle))
    least = kept(prints.groupBy("__print").agg(F.min(F.col(id_col).cast("long")).alias("__least")))
    found = components(links(least.select("__print", F.col("__print").alias("__name")), bits, hot))
    named = kept(least.join(found, least["__print"] == found["node"], "left").select("__print", "__least", "component"))
    linked = named.where("component is not null")
    names = linked.groupBy(F.col("component").alias("__class")).agg(F.min("__least").alias("component_id"))
    linked = salted_join(linked, names, [("component", "__class")], "inner", 32)
    alone = named.where("component is null").select("__print", F.col("__print").alias("__class"), F.col("__least").alias("component_id"))
    named = kept(linked.select("__print", "__class", "component_id").unionByName(alone))
    named = named.withColumnRenamed("__class", class_col) if class_col else named.drop("__class")
    # Both sides are dealt by the fingerprint alone, so a hot fingerprint is split.
    return (
        prints.join(named, "__print")
        .withColumn("fingerprint", F.lpad(F.lower(F.hex("__print")), 16, "0"))
        .drop("__print")
    )
