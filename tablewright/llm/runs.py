"""Periodic runs of words: stretches that repeat their first ``period`` words, found by recursive frequency splitting.

A run of period q has at least max(12, 2 q) words, so each of its words stands in it twice or more. A word that its segment
has only once can be in no run and splits the segment; the parts are counted anew until nothing changes, and parts of
fewer than 12 words go. What is left, in ordinary text next to nothing, is scanned by lags:

* lags below 32 compare the segments with themselves, moved by the lag;
* a run of a longer period q, 2 B <= q < 4 B, repeats at least q words, hence one whole block of B words that starts at a
  multiple of B. The blocks are looked up among all windows of B words 2 B to 4 B further on, and every hit is
  extended both ways by binary search over prefix hashes. Hits inside a run of a period of at most B / 2, which
  can only give its multiples, are left out. Whatever the hashes report is compared word by word.

The same stretch found under two lags keeps the smaller one, its smallest period.

Each slice of texts is worked on by itself: memory is bounded by the slice and the longest text, no row is shuffled, and a
lost task is simply repeated.

Defined cases: null or empty text has no words and no runs; rows stay rows, whatever their ids, repeats or further
columns; a column that bears the name of a result raises.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.llm.shared import give_back

LEAST = 12
SHORT_LAGS = 32
SLICE = 1 << 20
#: Candidates of a block size that are extended at a time.
CHUNK = 1 << 20
RESULTS = ("runs", "collapsed")


def split_rare(word: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places that survive, and the segment of each: words of a segment that stand in it once split it."""
    at = np.arange(len(word))
    values = int(word.max()) + 1 if len(word) else 1
    while len(at):
        size = np.bincount(segment)[segment]
        if size.min() < LEAST:
            at, segment = at[size >= LEAST], segment[size >= LEAST]
            if not len(at):
                break
        _, which, n = np.unique(segment * values + word[at], return_inverse=True, return_counts=True)
        often = n[which] > 1
        if often.all():
            break
        before = segment[often]
        at = at[often]
        segment = np.cumsum(np.r_[False, (np.diff(at) != 1) | (np.diff(before) != 0)])
    return at, segment


def at_lag(w: np.ndarray, lag: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all stretches that repeat at ``lag`` and are long enough."""
    edges = np.diff(np.concatenate(([0], (w[lag:] == w[:-lag]).view(np.int8), [0])))
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    enough = end - start >= max(lag, LEAST - lag)
    return start[enough], end[enough] + lag


class Prefixes:
    """Compares stretches of an array by hashes of its prefixes."""

    def __init__(self, w: np.ndarray):
        values = np.random.default_rng(7).integers(1, 1 << 63, int(w.max()) + 1, dtype=np.uint64)
        power = np.full(len(w) + 1, 0x9E3779B97F4A7C15 | 1, dtype=np.uint64)
        power[0] = 1
        self.n, self.power = len(w), np.cumprod(power)
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values[w] * self.power[:-1])))

    def windows(self, size: int) -> np.ndarray:
        """Hashes of all windows of ``size`` values."""
        return (self.sums[size:] - self.sums[:-size]) * self.power[: self.n - size + 1][::-1]

    def same(self, x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
        left, right = self.sums[x + size] - self.sums[x], self.sums[y + size] - self.sums[y]
        return left * self.power[y - x] == right

    def _longest(self, high: np.ndarray, fits) -> np.ndarray:
        low, high = np.zeros_like(high), high.copy()
        while (low < high).any():
            middle = (low + high + 1) >> 1
            good = fits(middle)
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        return low

    def after(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How far the values from ``x`` equal those from ``y``, which is greater."""
        return self._longest(self.n - y, lambda k: self.same(x, y, k))

    def before(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How far the values before ``x`` equal those before ``y``."""
        return self._longest(x.copy(), lambda k: self.same(x - k, y - k, k))


def _covered(found: list[np.ndarray], n: int, most: int) -> np.ndarray:
    """Per place the furthest end of a run that starts there or before, of a period of at most ``most``."""
    reach = np.zeros(n, dtype=np.int64)
    for start, end, period in found:
        some = period <= most
        np.maximum.at(reach, start[some], end[some])
    return np.maximum.accumulate(reach)


def _long_lags(w: np.ndarray, reach: np.ndarray, block: int) -> np.ndarray:
    """Starts, ends and periods, from 2 to 4 blocks, of the stretches of ``w``."""
    n, prefixes = len(w), Prefixes(w)
    h = prefixes.windows(block)
    order = np.argsort(h, kind="stable")
    group = np.cumsum(np.r_[False, h[order][1:] != h[order][:-1]])
    of = np.empty(len(h), dtype=np.int64)
    of[order] = group
    places = group * (n + 1) + order
    x = np.arange(0, len(h), block)
    low = np.where(reach[x] >= x + block, np.maximum(x + 2 * block, reach[x] - block + 1), x + 2 * block)
    a = np.searchsorted(places, of[x] * (n + 1) + np.minimum(low, n))
    b = np.searchsorted(places, of[x] * (n + 1) + np.minimum(x + 4 * block, n))
    many = np.maximum(b - a, 0)
    out = [np.zeros((3, 0), dtype=np.int64)]
    upto = np.cumsum(many)
    for first in range(0, int(upto[-1]), CHUNK):
        number = np.arange(first, min(first + CHUNK, int(upto[-1])))
        i = np.searchsorted(upto, number, side="right")
        one, other = x[i], order[a[i] + number - (upto[i] - many[i])]
        start, end = one - prefixes.before(one, other), other + prefixes.after(one, other)
        fits = end - start >= 2 * (other - one)
        out.append(np.unique(np.stack([start, end, other - one])[:, fits], axis=1))
    hits = np.unique(np.concatenate(out, axis=1), axis=1)
    true = np.array([(w[s : e - q] == w[s + q : e]).all() for s, e, q in hits.T], dtype=bool)
    wrong = np.unique(hits[2, ~true])
    direct = [np.stack([*at_lag(w, int(q)), np.full(len(at_lag(w, int(q))[0]), q)]) for q in wrong]
    return np.concatenate([hits[:, true], *direct], axis=1)


def find_runs(word: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Starts, ends and smallest periods of all runs, in order; ``text`` numbers the text of each word."""
    at, segment = split_rare(word, text)
    if not len(at):
        return np.zeros((3, 0), dtype=np.int64)
    # A value of its own after each segment: no stretch runs across it.
    breaks = np.flatnonzero(np.diff(segment)) + 1
    ends = np.r_[breaks, len(at)]
    values = int(word.max()) + 1
    w = np.insert(word[at], ends, values + np.arange(len(ends)))
    place = np.insert(at, ends, -1)
    segment = np.insert(segment, ends, segment[ends - 1])
    longest = np.bincount(segment)[segment] - 1
    found = []
    for lag in range(1, min(SHORT_LAGS, len(w))):
        start, end = at_lag(w, lag)
        found.append(np.stack([start, end, np.full(len(start), lag)]))
    block = SHORT_LAGS // 2
    while 4 * block <= longest.max():
        own = np.flatnonzero(longest >= 4 * block)
        inside = [np.searchsorted(own, f[:2, longest[f[0]] >= 4 * block]) for f in found]
        known = [(s, e, f[2, longest[f[0]] >= 4 * block]) for (s, e), f in zip(inside, found)]
        start, end, period = _long_lags(w[own], _covered(known, len(own), block // 2), block)
        found.append(np.stack([own[start], own[end - 1] + 1, period]))
        block *= 2
    start, end, period = np.concatenate(found, axis=1)
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.r_[True, (np.diff(start) != 0) | (np.diff(end) != 0)] if len(start) else np.zeros(0, bool)
    runs = np.stack([place[start], place[end - 1] + 1, period])[:, new]
    return runs[:, np.lexsort((runs[2], runs[0]))]


def _worked(texts: list[bytes | None]) -> tuple[list[list[dict]], list[str]]:
    """Runs of each text, and the text without their repeats."""
    words = [(t or b"").split() for t in texts]
    size = np.array([len(x) for x in words], dtype=np.int64)
    known: dict[bytes, int] = {}
    word = np.array([known.setdefault(x, len(known)) for text in words for x in text], dtype=np.int64)
    runs: list[list[dict]] = [[] for _ in words]
    if len(word):
        first = np.r_[0, np.cumsum(size)]
        start, end, period = find_runs(word, np.repeat(np.arange(len(words)), size))
        which = np.searchsorted(first, start, side="right") - 1
        for i, s, e, q in zip(which.tolist(), (start - first[which]).tolist(), (end - first[which]).tolist(), period.tolist()):
            runs[i].append({"start": s, "length": e - s, "period": q})
    kept = []
    for own, here in zip(words, runs):
        if here:
            drop = np.zeros(len(own) + 1, dtype=np.int64)
            for r in here:
                drop[r["start"] + r["period"]] += 1
                drop[r["start"] + r["length"]] -= 1
            own = [x for x, d in zip(own, np.cumsum(drop).tolist()) if not d]
        kept.append(b" ".join(own).decode())
    return runs, kept


RUNS_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``runs``, an array of start, length and period ordered by start and period, and ``collapsed``,
    the words of the text joined by spaces without those that a run repeats after its first period."""
    clash = [c for c in RESULTS if c in docs.columns]
    if clash:
        raise ValueError(f"columns {clash} are there already")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def work(batches):
        for batch in batches:
            column = batch.column(text_col).cast(pa.binary())
            sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // SLICE)) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)]):
                if a == b:
                    continue
                runs, kept = _worked(column.slice(a, b - a).to_pylist())
                part = batch.slice(a, b - a)
                new = [pa.array(runs, RUNS_TYPE), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays([*part.columns, *new], names=[*part.schema.names, *RESULTS])
            give_back()

    runs = "array<struct<start: bigint, length: bigint, period: bigint>>"
    return docs.mapInArrow(work, f"{schema}, runs {runs}, collapsed string")


def run_digests(docs: DataFrame) -> DataFrame:
    """``docs`` with the number of runs, the longest one (of equal ones the first), and digests of runs and text."""
    longest = F.expr("array_min(transform(runs, r -> struct(-r.length AS length, r.start AS start, r.period AS period)))")
    lines = F.expr(r"array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    docs = docs.withColumn("__longest", longest)
    return docs.withColumns(
        {
            "n_runs": F.size("runs").cast("long"),
            "start": F.col("__longest.start"),
            "length": -F.col("__longest.length"),
            "period": F.col("__longest.period"),
            "exponent_milli": F.expr("-1000 * __longest.length div __longest.period"),
            "runs_sha256": F.sha2(lines.cast("binary"), 256),
            "collapsed_sha256": F.sha2(F.col("collapsed").cast("binary"), 256),
        }
    ).drop("__longest")


def plant(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts of every tenth checksum of the id repeat some of their words to the end, as a known sample of runs: from
    word a on, word i becomes word a + (i - a) % p. A null id plants nothing."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    docs = docs.withColumns({"__g": F.floor(h / 10), "__words": words})
    docs = docs.withColumn("__n", F.size("__words"))
    start: Column = F.when(F.col("__n") > 0, F.col("__g") % F.col("__n"))
    docs = docs.withColumn("__a", start.cast("int"))
    docs = docs.withColumn("__p", F.expr("int(1 + (__n - __a) div (3 + __g % 8))"))
    planted = F.expr("array_join(transform(__words, (w, i) -> if(i >= __a, __words[__a + (i - __a) % __p], w)), ' ')")
    text = F.when(F.col("__n") > 0, planted).otherwise(F.col(text_col))
    return docs.withColumn(text_col, text).drop("__g", "__words", "__n", "__a", "__p")
