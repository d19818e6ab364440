"""Mixing sources to target weights by a low-discrepancy schedule.

Sources get shares of the words to take by weight; a target stops at ``limit`` times its source's size and the
excess is shared anew by weight. The schedule maps golden-ratio points through the cumulative targets: point s
falls to one source, and the slots of each source are ranked. A source's documents, in an order shuffled by the
hash of their ids, are cut into blocks of ``block`` words, and slot r takes block r modulo their number,
until the source's target is met, the last slot in part. Where an interval gets fewer points than its source needs
slots, exactly the missing ones follow after the last point. So targets are met to less than a word.

All of it is joins, sums and windows. Running sums and ranks go over two levels (sums of about sqrt(n) groups,
then within a group), so a hot source is never one task's. The sources themselves, one row each, are the
only table that is ordered as a whole.

Defined cases: null text and text without words has size 0 and is never taken; documents of a null source are a
source, ordered last; repeated rows are separate documents; an empty table gives an empty result; with one
source its target is 150 % of its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.llm.shared import WORD, kept, salted_join

GOLDEN = 0.6180339887498949
GRID = 4096


def size_of(text_col: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """``source``, ``source_size``, ``target`` of a table with ``source`` and ``size``.

    With the sources in the order of limit per weight, the first k are at their limit; the others split what
    is left by weight. k is the least for which nobody else is above.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    number = (F.row_number().over(by_name) - 1) % len(weights)
    sources = sources.withColumn("weight", F.array(*map(F.lit, weights))[number])
    sources = sources.withColumn("cap", limit * F.col("source_size")).withColumn("level", F.col("cap") / F.col("weight"))
    order = Window.orderBy("level", F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    rest = sources.select(
        "*",
        (F.lit(share) * F.sum("source_size").over(every)).alias("total"),
        F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("capped"),
        F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
    ).withColumn("water", (F.col("total") - F.col("capped")) / F.col("open"))
    # The first source that stays below its limit tells the level for all that follow.
    found = rest.withColumn("water", F.min(F.when(F.col("water") <= F.col("level"), F.struct("level", "source", "water"))).over(every)["water"])
    target = F.least(F.col("cap"), F.coalesce(F.col("water") * F.col("weight"), F.col("cap")))
    return found.select("source", "source_size", target.alias("target"))


def _running(df: DataFrame, by: list[str], group: str, order: list[Column], value: Column) -> DataFrame:
    """``before``: the sum of ``value`` over all earlier rows, by groups first and then within a group."""
    df = df.withColumn("__value", value)
    groups = df.groupBy(*by, group).agg(F.sum("__value").alias("__sum"))
    earlier = Window.partitionBy(*by).orderBy(group).rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("__before", F.coalesce(F.sum("__sum").over(earlier), F.lit(0))).drop("__sum")
    names = {c: f"__by_{c}" for c in [*by, group]}
    groups = groups.withColumnsRenamed(names)
    on = F.lit(True)
    for c, other in names.items():
        on = on & F.col(c).eqNullSafe(F.col(other))
    joined = df.join(groups, on).drop(*names.values())
    within = Window.partitionBy(*by, group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("__before") + F.coalesce(F.sum("__value").over(within), F.lit(0))
    return joined.withColumn("before", before.cast("long")).drop("__before", "__value")


def schedule(goals: DataFrame, block: int) -> DataFrame:
    """One row a slot: ``source``, ``slot``, ``rank`` among its source's slots, ``words`` it takes."""
    quota = goals.withColumn("words", F.round("target").cast("long")).where("words > 0")
    order = Window.orderBy(F.col("source").asc_nulls_last())
    total = F.sum("words").over(Window.partitionBy())
    ends = quota.withColumn("high", F.sum("words").over(order) / total)
    ends = ends.withColumn("low", F.coalesce(F.lag("high").over(order), F.lit(0.0)))
    ends = kept(ends.withColumn("quota", F.ceil(F.col("words") / block)))
    slots = ends.agg(F.sum("quota")).first()[0]
    if not slots:
        return ends.select("source", F.lit(0).cast("long").alias("slot"), F.lit(0).cast("long").alias("rank"), F.lit(0).cast("long").alias("take")).limit(0)
    n = int(slots * 1.02) + 64
    group = max(1, int(n**0.5))
    points = goals.sparkSession.range(n).withColumn("point", F.col("id") * F.lit(GOLDEN) - F.floor(F.col("id") * F.lit(GOLDEN)))
    points = points.withColumn("cell", F.floor(F.col("point") * GRID))
    last = F.least(F.floor(F.col("high") * GRID), F.lit(GRID - 1))
    cells = ends.select("*", F.explode(F.sequence(F.floor(F.col("low") * GRID), last)).alias("cell"))
    dealt = points.join(cells, "cell").where("point >= low and point < high")
    dealt = dealt.select("source", "words", "quota", F.col("id").alias("slot"), F.floor(F.col("id") / group).alias("part"))
    ranked = _running(dealt, ["source"], "part", [F.col("slot")], F.lit(1)).where("before < quota")
    ranked = kept(ranked.select("source", "words", "slot", "before"))
    # Points give an interval its share of slots but for a few; every source's missing ones are added.
    met = ranked.groupBy(F.col("source").alias("__source")).agg(F.count("*").alias("__met"))
    short = ends.join(met, F.col("source").eqNullSafe(F.col("__source")), "left").withColumn("__met", F.coalesce("__met", F.lit(0)))
    short = short.where("__met < quota").withColumn("lack", F.col("quota") - F.col("__met"))
    earlier = F.coalesce(F.sum("lack").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    short = short.withColumn("slot", F.lit(n) + earlier).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lack") - 1)).alias("k"))
    added = short.select("source", "words", (F.col("slot") + F.col("k")).alias("slot"), (F.col("__met") + F.col("k")).alias("before"))
    return ranked.unionByName(added).select(
        "source", "slot", F.col("before").alias("rank"), F.least(F.lit(block).cast("long"), F.col("words") - F.col("before") * block).alias("take")
    )


def _blocks(sized: DataFrame, block: int, groups: int) -> DataFrame:
    """Pieces of documents in blocks of their shuffled source: ``at`` is a piece's place in its block."""
    deal = F.xxhash64("__row")
    placed = sized.where("size > 0").withColumn("deal", deal).withColumn("part", F.pmod(F.shiftright("deal", 20), F.lit(groups)))
    placed = _running(placed, ["source"], "part", [F.col("deal"), F.col("__row")], F.col("size"))
    spans = F.sequence(F.floor(F.col("before") / block), F.floor((F.col("before") + F.col("size") - 1) / block))
    pieces = placed.select("source", "__row", "size", "before", F.explode(spans).alias("block"))
    low, high = F.greatest(F.col("before"), F.col("block") * block), F.least(F.col("before") + F.col("size"), (F.col("block") + 1) * block)
    return pieces.select(
        "source", "__row", "block", (low - F.col("block") * block).alias("at"), (low - F.col("before")).alias("first_word"), (high - low).alias("n_words")
    )


def taken_pieces(sized: DataFrame, goals: DataFrame, block: int) -> DataFrame:
    """Every piece that a slot takes: ``__row``, ``slot``, ``round``, ``first_word``, ``n_words``.

    Blocks are numbered through their source; the last is short, and a round ends with it.
    """
    n = sized.count()
    blocks = _blocks(sized, block, max(1, int(n**0.5)))
    lengths = goals.select("source", F.col("source_size").alias("__length"))
    # A round takes the words of a source once: slots are spans of words on the rounds laid end to end.
    slots = schedule(goals, block)
    slots = slots.join(lengths, slots["source"].eqNullSafe(lengths["source"])).select(slots["*"], "__length")
    start = F.col("rank") * block
    rounds = F.sequence(F.floor(start / F.col("__length")), F.floor((start + F.col("take") - 1) / F.col("__length")))
    spans = slots.select("source", "slot", "__length", start.alias("low"), (start + F.col("take")).alias("high"), F.explode(rounds).alias("round"))
    base = F.col("round") * F.col("__length")
    spans = spans.select(
        "source", "slot", "round", (F.greatest("low", base) - base).alias("low"), (F.least("high", base + F.col("__length")) - base).alias("high")
    )
    spans = spans.select("*", F.explode(F.sequence(F.floor(F.col("low") / block), F.floor((F.col("high") - 1) / block))).alias("block"))
    spans = spans.withColumn("from", F.greatest(F.col("low") - F.col("block") * block, F.lit(0)))
    spans = spans.withColumn("to", F.least(F.col("high") - F.col("block") * block, F.lit(block))).withColumnRenamed("source", "__source")
    met = blocks.join(spans.drop("low", "high"), (blocks["block"] == spans["block"]) & blocks["source"].eqNullSafe(spans["__source"]))
    low, high = F.greatest("at", "from"), F.least(F.col("at") + F.col("n_words"), F.col("to"))
    met = met.select("__row", "slot", "round", (F.col("first_word") + low - F.col("at")).alias("first_word"), (high - low).alias("n_words"))
    return met.where("n_words > 0")


def mix(
    docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", block: int = 1024, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, limit: float = 2.0
) -> DataFrame:
    """One row a document: its id, ``size``, ``source_size``, ``target`` and ``taken`` words."""
    sized = docs.select(F.col(id_col).alias("__id"), F.col(source_col).alias("source"), size_of(text_col).alias("size"))
    copies = Window.partitionBy("__id", "source", "size").orderBy(F.lit(0))
    name = F.concat_ws(":", F.coalesce(F.col("__id").cast("string"), F.lit("null")), "source", F.col("size").cast("string"))
    sized = kept(sized.withColumn("__row", F.concat_ws("#", name, F.row_number().over(copies).cast("string"))))
    goals = kept(targets(sized, weights, share, limit))
    taken = taken_pieces(sized.select("__row", "source", "size"), goals, block).groupBy("__row").agg(F.sum("n_words").alias("taken"))
    out = salted_join(sized.join(taken, "__row", "left"), goals.withColumnRenamed("source", "__source"), [("source", "__source")], "inner")
    return out.select(F.col("__id").alias(id_col), "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", block: int = 1024) -> DataFrame:
    """The rows of ``docs`` that a mix takes, once for every round; a text that a target cuts keeps the words
    taken, joined by spaces. ``slot`` is the place of a row in the schedule, ``round`` counts repeats from 0."""
    for name in {"slot", "round"} & set(docs.columns):
        raise ValueError(f"column {name} is there already")
    # Rows are known by their id and a hash of what they hold. Equal rows are numbered without their texts, which
    # are shuffled once: one row of each kind meets all that the mix takes of it.
    row = [F.col(id_col).alias("__id"), F.xxhash64(*docs.columns).alias("__hash")]
    small = docs.select(*row, F.col(source_col).alias("source"), size_of(text_col).alias("size"))
    same = Window.partitionBy("__id", "__hash").orderBy(F.lit(0))
    number = F.row_number().over(same).cast("string")
    name = F.concat_ws("#", F.coalesce(F.col("__id").cast("string"), F.lit("null")), F.col("__hash").cast("string"), number)
    sized = kept(small.withColumn("__row", name))
    goals = kept(targets(sized))
    rounds = taken_pieces(sized.select("__row", "source", "size"), goals, block).groupBy("__row", "round")
    rounds = rounds.agg(F.min("slot").alias("slot"), F.min("first_word").alias("__first"), F.sum("n_words").alias("__n"))
    rounds = rounds.join(sized.select("__row", "__hash", F.col("size").alias("__size")), "__row")
    rounds = rounds.withColumn("__key", F.regexp_replace("__row", "#[0-9]+$", "")).drop("__row", "__hash")
    key = F.concat_ws("#", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.xxhash64(*docs.columns).cast("string"))
    rows = docs.withColumn("__key", key).dropDuplicates(["__key"]).join(rounds, "__key")
    words = F.regexp_extract_all(F.col(text_col), F.lit(f"({WORD})"), F.lit(1))
    cut = F.array_join(F.slice(words, F.col("__first").cast("int") + 1, F.col("__n").cast("int")), " ")
    text = F.when(F.col("__n") < F.col("__size"), cut).otherwise(F.col(text_col))
    return rows.withColumn(text_col, text).select(*docs.columns, "slot", "round")
