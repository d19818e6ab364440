"""Conversations without quotations, in the order of replies, linked by what their messages quote.

The ``>`` marks that begin a line give its level of quotation; consecutive lines of one level are a passage, and end at an empty
line. A passage is normalised (marks off, lines joined, case folded, spaces collapsed) and hashed, so that wrapping it
anew changes nothing, and is joined to the latest earlier message of its conversation that said it: as a whole, as a
paragraph, or as a line. Where no message said a passage, its lines are looked up one by one. A message replies to the
message that most of its linked lines at the lowest level come from (the latest of equals), or else to nobody. A
reply's ``root`` and ``depth`` follow from the links by doubling them.

The latest earlier message is found in blocks of TURNS turns: inside the block, else in the last block before it that has
one. So a line that everyone says, in a conversation of very many turns, is a short row for each block and no
task's whole. Joins back to quoted lines are salted.

Defined cases: null text has no lines; a line of marks only ends a passage; messages with a null conversation are a
conversation; those with a null turn come last in it, each by itself: they quote and are never replied to; repeated rows
stay and link alike; quotations from the same or later turns stay unlinked.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.llm.shared import give_back, kept, salted_join

MARKS = re.compile(r"(?:[ \t]{0,3}>)+")
BREAK = re.compile(r"\r\n?|\n")
TURNS, LAST = 1024, (1 << 62)
RESULTS = ("n_passages", "n_linked", "n_unlinked", "reply_to", "root", "depth")
_LINES = pa.list_(pa.struct([("level", pa.int32()), ("passage", pa.binary()), ("line", pa.binary())]))


def normal(line: str) -> str:
    """A line without its marks, case and spacing."""
    return " ".join(MARKS.sub("", line, count=1).casefold().split()) if MARKS.match(line) else " ".join(line.casefold().split())


def level(line: str) -> int:
    found = MARKS.match(line)
    return found.group().count(">") if found else 0


def _key(parts: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(parts).encode())


def passages(text: str) -> list[tuple[int, list[str]]]:
    """Level and normalised lines of every run of lines of one level; empty lines end a run."""
    out: list[tuple[int, list[str]]] = []
    going = None
    for line in BREAK.split(text):
        at, words = level(line), normal(line)
        if not words:
            going = None
            continue
        if going != at:
            out.append((at, []))
            going = at
        out[-1][1].append(words)
    return out


def own_text(text: str) -> str:
    return "\n".join(x for x in BREAK.split(text) if not level(x)).strip("\n \t")


def parse(text: str) -> tuple[str, int, list[dict], list[bytes]]:
    """Own text, number of quoted passages, each quoted line with the keys of its passage and itself, and the keys of all
    that the message says: everything, each paragraph, each line."""
    runs = passages(text)
    quoted = [
        {"level": at, "passage": _key(lines), "line": _key([line])} for at, lines in runs if at for line in lines
    ]
    own = [lines for at, lines in runs if not at]
    said = {_key(lines) for lines in own} | {_key([line]) for lines in own for line in lines}
    if own:
        said.add(_key([line for lines in own for line in lines]))
    return own_text(text), sum(1 for at, _ in runs if at), quoted, sorted(said)


def _parsed(messages: DataFrame, text_col: str) -> DataFrame:
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in messages.schema.fields)

    def run(batches):
        for batch in batches:
            texts = [parse(t or "") for t in batch.column(text_col).to_pylist()]
            own, n, quoted, said = zip(*texts) if texts else ((), (), (), ())
            at = batch.schema.get_field_index(text_col)
            columns = [pa.array(own, pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            new = [pa.array(n, pa.int64()), pa.array(quoted, _LINES), pa.array(said, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays([*columns, *new], names=[*batch.schema.names, "n_passages", "__quoted", "__said"])
            give_back()

    lines = "array<struct<level: int, passage: binary, line: binary>>"
    return messages.mapInArrow(run, f"{schema}, n_passages long, __quoted {lines}, __said array<binary>")


def _latest_before(asked: DataFrame, said: DataFrame) -> DataFrame:
    """``asked`` (conversation, key, turn; distinct) with ``first``, the latest smaller turn among ``said`` of the same."""
    both = asked.select("conv", "key", "turn", F.lit(0).alias("kind")).unionByName(said.select("conv", "key", "turn", F.lit(1).alias("kind")))
    both = both.withColumn("block", F.expr(f"turn div {TURNS}"))
    inside = Window.partitionBy("conv", "key", "block").orderBy("turn", "kind").rowsBetween(Window.unboundedPreceding, -1)
    heard = F.when(F.col("kind") == 1, F.col("turn"))
    near = both.withColumn("near", F.last(heard, ignorenulls=True).over(inside))
    blocks = both.groupBy("conv", "key", "block").agg(F.max(heard).alias("most"))
    before = Window.partitionBy("conv", "key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("far", F.last("most", ignorenulls=True).over(before))
    blocks = blocks.select(F.col("conv").alias("c"), F.col("key").alias("k"), F.col("block").alias("b"), "far")
    on = F.col("conv").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")) & (F.col("block") == F.col("b"))
    met = near.where("kind = 0").join(blocks, on, "left")
    return met.select("conv", "key", "turn", F.coalesce("near", "far").alias("first"))


def _found(lines: DataFrame, answers: DataFrame, key: str, into: str) -> DataFrame:
    right = answers.select(F.col("conv").alias("__c"), F.col("key").alias("__k"), F.col("turn").alias("__t"), F.col("first").alias(into))
    return salted_join(lines, right, [("conv", "__c"), (key, "__k"), ("turn", "__t")], "left", 16).drop("__c", "__k", "__t")


def _roots(links: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``root`` and ``depth`` of every message that replies, from one link each (``root``, at first the
    turn replied to)."""
    links = kept(links.withColumn("depth", F.lit(1).cast("long")))
    while True:
        further = links.select(F.col("conv").alias("__c"), F.col("turn").alias("__t"), F.col("root").alias("next"), F.col("depth").alias("more"))
        step = salted_join(links, further, [("conv", "__c"), ("root", "__t")], "left", 16)
        step = kept(step.select("conv", "turn", F.coalesce("next", "root").alias("root"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), "next"))
        links = step.drop("next")
        if step.where("next IS NOT NULL").isEmpty():
            return links


def link_quotes(
    messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", text_col: str = "text"
) -> DataFrame:
    """``messages`` with its text freed of quotations, and ``n_passages``, ``n_linked`` (quoted lines whose origin was
    found), ``n_unlinked``, ``reply_to`` (a turn), ``root`` (the turn that the replies go back to; its own where it replies
    to nobody) and ``depth`` (replies from there)."""
    clash = sorted({*RESULTS} & set(messages.columns))
    if clash:
        raise ValueError(f"columns {clash} are there already")
    rows = kept(_parsed(messages, text_col).withColumn("__row", F.monotonically_increasing_id()))
    turn: Column = F.col(turn_col).cast("long")
    base = rows.select("__row", F.col(conv_col).alias("conv"), F.coalesce(turn, F.lit(LAST)).alias("turn"), "__quoted", "__said")
    lines = base.select("__row", "conv", "turn", F.explode("__quoted").alias("x")).select("__row", "conv", "turn", "x.*")
    asked = lines.select("conv", "turn", F.explode(F.array("passage", "line")).alias("key")).distinct()
    # Only what somebody quotes is looked up.
    wanted = asked.select(F.col("conv").alias("__c"), F.col("key").alias("__k")).distinct()
    said = base.where(F.col("turn") < LAST).select("conv", "turn", F.explode("__said").alias("key"))
    said = said.join(wanted, F.col("conv").eqNullSafe(F.col("__c")) & (F.col("key") == F.col("__k")), "left_semi").distinct()
    answers = kept(_latest_before(asked, said).where("first IS NOT NULL"))
    met = _found(_found(lines, answers, "passage", "whole"), answers, "line", "single")
    met = met.withColumn("first", F.coalesce("whole", "single"))
    sources = met.groupBy("__row", "first").agg(F.count("*").alias("n"), F.count_if(F.col("level") == 1).alias("near"))
    told = F.when(F.col("first").isNotNull(), F.col("n"))
    linked = sources.groupBy("__row").agg(
        F.coalesce(F.sum(told), F.lit(0)).alias("n_linked"),
        (F.sum("n") - F.coalesce(F.sum(told), F.lit(0))).alias("n_unlinked"),
        F.max(F.when(F.col("first").isNotNull(), F.struct("near", "n", "first")))["first"].alias("reply_to"),
    )
    own = kept(rows.drop("__quoted", "__said").join(linked, "__row", "left").fillna(0, ["n_linked", "n_unlinked"]))
    replies = own.where(F.col("reply_to").isNotNull())
    links = replies.where(turn.isNotNull()).groupBy(F.col(conv_col).alias("conv"), turn.alias("turn")).agg(F.max("reply_to").alias("root"))
    roots = _roots(links).select(F.col("conv").alias("__c"), F.col("turn").alias("__t"), "root", "depth")
    # What a message replies to has a root of its own, or is one.
    joined = salted_join(own, roots, [(conv_col, "__c"), ("reply_to", "__t")], "left", 16)
    root = F.when(F.col("reply_to").isNull(), turn).otherwise(F.coalesce("root", "reply_to"))
    depth = F.when(F.col("reply_to").isNull(), F.lit(0)).otherwise(F.coalesce("depth", F.lit(0)) + 1).cast("long")
    return joined.withColumns({"root": root, "depth": depth}).drop("__row", "__c", "__t").select(*messages.columns, *RESULTS)


def in_reply_order(linked: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Conversations in the order of replies: by root, then by turn. Sorted across tasks by ranges, so that a conversation of
    very many messages spans several."""
    return linked.orderBy(conv_col, F.col("root").asc_nulls_last(), F.col(turn_col).asc_nulls_last())
