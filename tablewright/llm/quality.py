"""A ledger of quality rules as bitmasks, and the policies that read it.

Each rule is evaluated once for each document; ``ledger`` stores the measurements and one long whose bit k is set
where rule k fails. A policy is a version and the bits it acts on, so verdicts, and what a policy would do without
one of its rules, come from bitwise operations on the ledger without touching a text again.

Only DataFrame functions. Defined cases: null text has no words; every measurement of a text without words is
0; repeated rows are judged one by one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

INDEX_BITS = 24


@dataclass(frozen=True)
class Rule:
    bit: int
    name: str
    fails: str


@dataclass(frozen=True)
class Policy:
    name: str
    version: int
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << BY_NAME[r].bit for r in self.rules)


#: Bits are never reused; a rule that changes gets a new one.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule(4, "long_words", "word_chars > 15 * n_words"),
    Rule(5, "short_words", "word_chars < 2 * n_words"),
    Rule(6, "capitals", "2 * n_capitals > word_chars"),
)
BY_NAME = {r.name: r for r in RULES}
BASE = Policy("base", 1, ("few_words", "repeated_words"))
POLICIES = {
    p.name: p for p in (BASE, Policy("clean_prose", 1, tuple(r.name for r in RULES)))
}


def _windows(words: Column) -> Column:
    """A 64-bit hash of every three words in a row."""
    at = F.sequence(F.lit(0), F.size(words) - 3)
    hashed = F.transform(at, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) >= 3, hashed).otherwise(F.array().cast("array<bigint>"))


def _same(a: Column, b: Column) -> Column:
    """Whether the leading bits of two packed longs agree."""
    return F.shiftright(a, INDEX_BITS) == F.shiftright(b, INDEX_BITS)


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines``, ``n_dup_lines``, ``n_repeat_words``,
    ``n_capitals`` (long).

    Repeated windows are found by sorting longs that hold 40 bits of a window's hash and its place. Where equal
    40 bits hide different hashes, or a text is too long for its places, pairs of whole hash and place are sorted.
    """
    keep = docs.columns
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    step = docs.select(
        *(F.col(f"`{c}`") for c in keep),
        F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda x: x != "").alias("__words"),
        (F.length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"[A-Z]")).cast("long").alias("n_capitals"),
        lines.alias("__lines"),
    )
    kept = [F.col(f"`{c}`") for c in keep] + ["word_chars", "n_symbols", "n_capitals"]
    step = step.select(
        *kept,
        F.size("__words").cast("long").alias("n_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        _windows(F.col("__words")).alias("__hashes"),
    )
    kept += ["n_words", "n_lines", "n_dup_lines"]
    top = F.lit(-(1 << INDEX_BITS)).cast("long")
    packed = F.transform("__hashes", lambda x, i: x.bitwiseAND(top).bitwiseOR(i.cast("long")))
    step = step.select(*kept, "__hashes", F.sort_array(packed).alias("__packed"))
    index = lambda x: x.bitwiseAND(F.lit((1 << INDEX_BITS) - 1).cast("long")).cast("int")
    p, h = F.col("__packed"), F.col("__hashes")

    def beside(x, i):
        return F.coalesce(_same(F.get(p, i - 1), x), F.lit(False)) | F.coalesce(_same(F.get(p, i + 1), x), F.lit(False))

    step = step.select(*kept, "__hashes", "__packed", F.filter(p, beside).alias("__met"))
    m = F.col("__met")
    hidden = F.exists(
        F.transform(m, lambda x, i: (_same(F.get(m, i + 1), x)) & (F.get(h, index(x)) != F.get(h, index(F.get(m, i + 1))))),
        lambda x: F.coalesce(x, F.lit(False)),
    )
    exact = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    step = step.select(
        *kept,
        "__met",
        F.when(hidden | (F.size("__hashes") >= 1 << INDEX_BITS), exact).alias("__exact"),
    )
    e = F.col("__exact")

    def equal(x, i):
        return F.coalesce(F.get(e, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(e, i + 1)["h"] == x["h"], F.lit(False))

    starts = F.when(e.isNull(), F.transform(m, index)).otherwise(F.transform(F.filter(e, equal), lambda x: x["i"]))
    step = step.select(*kept, F.sort_array(starts).alias("__starts"))
    s = F.col("__starts")
    covered = F.transform(s, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(s, i + 1) - x, F.lit(3))))
    return step.select(*kept, F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"))


def ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The measurements, and ``failed`` with a bit for every rule that a document fails."""
    bits = [F.when(F.expr(r.fails), F.lit(1 << r.bit).cast("long")).otherwise(F.lit(0).cast("long")) for r in RULES]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measure(docs, text_col).withColumn("failed", total)


def passes(policy: Policy) -> Column:
    """Whether a policy keeps a document of a ledger."""
    return F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def ablations(table: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of a policy: documents that fail it, that fail it alone, and that the policy keeps without it.

    Equal masks are counted first; a policy of r rules has at most 2^r of them.
    """
    masks = table.groupBy(F.col("failed").bitwiseAND(F.lit(policy.mask).cast("long")).alias("mask")).agg(F.count("*").alias("n"))
    rules = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(1 << BY_NAME[r].bit).cast("long").alias("bit")) for r in policy.rules))
    each = masks.select("mask", "n", F.explode(rules).alias("r")).select("mask", "n", "r.rule", "r.bit")
    others = F.col("mask").bitwiseAND(F.bitwise_not(F.col("bit")))
    n = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).alias
    return each.groupBy("rule").agg(
        n(F.col("mask").bitwiseAND(F.col("bit")) != 0)("failing"),
        n(F.col("mask") == F.col("bit"))("failing_alone"),
        n(others == 0)("kept_without"),
    ).withColumns({"policy": F.lit(policy.name), "version": F.lit(policy.version)})
