"""Spelling variants: words that differ by one letter, found in a trie of letter-group counts, and the form each goes to.

Every word has a vector: how many of its characters fall into each of GROUPS groups. A replaced character moves one count
up and one down at most, an inserted one moves one up. So from a word, a depth-first walk through the trie of
the vectors of all words of the same length, level by level, may spend a surplus of one and a deficit of one; among words
one character longer it may spend the surplus alone. Words at the leaves it reaches are compared by characters.

The first LEVELS levels of the trie, with the length, deal the words over tasks: a word is put under its own counts, and
asks under each of the at most 2 + 2 L + L (L - 1) / 2 beginnings that its budget reaches. A beginning with many words is cut
into blocks on either side, so no task holds more than a block of each. Pairs are found once: from the lesser to the greater
by vector, then by word, and from the shorter to the longer.

Forms follow counts: a word's form has at least RATIO times its occurrences, so chains end, and roots are found by doubling
links in stored tables.

Defined cases: null and empty texts have no words; equal rows count once each; the order of rows and their number of
partitions change nothing; words and counts alone come out, so other columns do not matter.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tablewright.llm.shared import give_back, kept

GROUPS, LEVELS = 20, 4
RATIO = 5
SLICE = 4 << 20
#: Words and asking words of a beginning that one task walks together.
BLOCK = 8_000
#: Asking words that walk the trie at a time, and pairs compared at a time.
WALKERS, PAIRS = 1024, 1 << 17
#: Characters that are worked on together, however long the words are.
CELLS = 1 << 22
#: Counts in a beginning are told apart up to this one.
MOST = 255
#: Letters by frequency have groups of their own; the rest share what is left.
LETTERS = "etaoinsrhldcumpfgybwvkxjqz"


def group_of() -> np.ndarray:
    """The letter group of each character below 256: accented letters share three groups."""
    out = np.full(256, GROUPS - 1, dtype=np.int64)
    for i, c in enumerate(LETTERS):
        out[ord(c)] = i if i < GROUPS - 5 else GROUPS - 5 + i % 2
    out[0xC0:] = GROUPS - 3 + np.arange(64) % 3
    return out


# -- words and counts ------------------------------------------------------------------------


def runs_of(least: int) -> regex.Pattern:
    """Runs of letters A-Z, a-z and U+00C0 to U+00FF of at least so many, in UTF-8 lower-cased from A to Z."""
    return regex.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % least)


def word_counts(docs: DataFrame, text_col: str = "text", id_col: str | None = None, damage: int = 0, least_length: int = 6) -> DataFrame:
    """``word`` and ``n``: runs of letters of at least ``least_length`` characters and their occurrences in all texts, folded
    in each slice before they are shuffled. With ``damage``, a run loses a character where that number
    divides the checksum of ``<id>:<run>``: a known sample of misspellings."""
    docs = docs.select(F.col(text_col).alias("text"), (F.col(id_col) if id_col else F.lit(None)).cast("string").alias("id"))

    # A run that is too short stays so without a character.
    pattern = runs_of(least_length)

    def fold(batches):
        for batch in batches:
            words: Counter = Counter()
            size = 0
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for text, name in zip(texts, batch.column("id").to_pylist()):
                found = pattern.findall((text or b"").lower())
                if damage:
                    found = _damaged(found, zlib.crc32(f"{name}:".encode()), damage)
                    for run, n in found.items():
                        words[run] += n
                else:
                    words.update(found)
                size += len(text or b"")
                if size > SLICE:
                    yield _counted(words, least_length)
                    words, size = Counter(), 0
            yield _counted(words, least_length)
            give_back()

    return docs.mapInArrow(fold, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _damaged(found: list[bytes], start: int, damage: int) -> dict[bytes, int]:
    runs = Counter(found)
    hit = [(r, runs.pop(r)) for r in list(runs) if zlib.crc32(r, start) % damage == 0]
    for run, n in hit:
        text = run.decode()
        at = zlib.crc32(run, start) % len(text)
        runs[(text[:at] + text[at + 1 :]).encode()] += n
    return runs


def _counted(words: Counter, least: int) -> pa.RecordBatch:
    long = [(w, n) for w, n in words.items() if len(w) - w.count(b"\xc3") >= least]
    names, counts = [w.decode() for w, _ in long], [n for _, n in long]
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"])


# -- the trie --------------------------------------------------------------------------------


def characters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Words as rows of code points, zero after their end, and their lengths. All are below 256."""
    packed = np.array([w.encode("latin-1") for w in words])
    width = packed.dtype.itemsize
    return np.frombuffer(packed.tobytes(), np.uint8).reshape(len(words), width), np.array([len(w) for w in words])


def vectors(codes: np.ndarray) -> np.ndarray:
    """Counts per letter group, one row a word."""
    group, (n, width) = group_of(), codes.shape
    out = np.zeros((n, GROUPS), dtype=np.int64)
    step = max(1, CELLS // width)
    for a in range(0, n, step):
        part = codes[a : a + step]
        places = np.where(part > 0, group[part], GROUPS) + (GROUPS + 1) * np.arange(len(part))[:, None]
        found = np.bincount(places.ravel(), minlength=len(part) * (GROUPS + 1))
        out[a : a + step] = found.reshape(-1, GROUPS + 1)[:, :GROUPS]
    return out


class Trie:
    """Words by successive counts: per level the nodes as sorted pairs of parent and count, with the words at the leaves."""

    def __init__(self, counts: np.ndarray):
        self.order = np.lexsort(counts.T[::-1])
        counts = counts[self.order]
        self.base = int(counts.max()) + 2 if len(counts) else 2
        self.keys = []
        node = np.zeros(len(counts), dtype=np.int64)
        for level in range(counts.shape[1]):
            keys, node = np.unique(node * self.base + counts[:, level], return_inverse=True)
            self.keys.append(keys)
        self.first = np.searchsorted(node, np.arange(int(node[-1]) + 2 if len(node) else 1))

    def walk(self, counts: np.ndarray, deficit: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (row of ``counts``, word): leaves that the rows reach by spending a surplus of one and, if allowed, a
        deficit of one. Depth first in batches of rows: each batch goes down all levels before the next begins."""
        rows, words = [], []
        for a in range(0, len(counts), WALKERS):
            who, leaf = self._down(counts[a : a + WALKERS], deficit)
            size = self.first[leaf + 1] - self.first[leaf]
            upto = np.cumsum(size)
            at = np.repeat(self.first[leaf] - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)
            rows.append(np.repeat(who + a, size))
            words.append(self.order[at])
        return np.concatenate(rows), np.concatenate(words)

    def _down(self, counts: np.ndarray, deficit: int) -> tuple[np.ndarray, np.ndarray]:
        who, node = np.arange(len(counts)), np.zeros(len(counts), dtype=np.int64)
        more, less = np.ones(len(counts), dtype=np.int64), np.full(len(counts), deficit)
        for level, keys in enumerate(self.keys):
            here = counts[who, level]
            alive = []
            for step in (0, 1, -1):
                able = np.flatnonzero((more > 0) if step > 0 else (less > 0) & (here > 0) if step < 0 else more >= 0)
                key = node[able] * self.base + here[able] + step
                fits = (here[able] + step < self.base)
                at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
                fits &= keys[at] == key
                able, at = able[fits], at[fits]
                alive.append((who[able], at, more[able] - (step > 0), less[able] - (step < 0)))
            who, node, more, less = (np.concatenate(x) for x in zip(*alive))
        return who, node


def one_apart(a: np.ndarray, size_a: np.ndarray, b: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Whether rows of code points differ by one replaced character, or by one that ``b`` has more."""
    width = max(a.shape[1], b.shape[1]) + 1
    a, b = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (a, b))
    unequal = a != b
    head = unequal.argmax(axis=1)
    rows = np.arange(len(a))
    column = np.arange(width)
    behind = column > head[:, None]
    replaced = ~(unequal & behind).any(axis=1) & (size_a == size_b) & unequal[rows, head]
    moved = (a[:, :-1] != b[:, 1:]) & (column[:-1] >= head[:, None])
    return replaced | (~moved.any(axis=1) & (size_a + 1 == size_b))


def _variants(counts: np.ndarray, deficit: bool) -> list[np.ndarray]:
    """The beginnings that rows of counts reach: unchanged, one up, one up and a later one down; a deficit alone is for levels
    below. A beginning with one down first belongs to lesser vectors, which ask themselves."""
    one = np.eye(LEVELS, dtype=np.int64)
    steps = [np.zeros(LEVELS, dtype=np.int64), *one]
    if deficit:
        steps += [one[i] - one[j] for i in range(LEVELS) for j in range(i + 1, LEVELS)]
    return [counts + s for s in steps]


def _dealt(words: DataFrame) -> DataFrame:
    """Each word under its own beginning, and asking under all that it reaches (``asks``, with the length it asks for)."""

    def work(batches):
        for batch in batches:
            names = batch.column("word").to_pylist()
            names.sort(key=len)
            start = 0
            while start < len(names):
                # Rows are as wide as their longest word: fewer of them where words are long.
                stop = start + 1
                while stop < len(names) and (stop + 1 - start) * len(names[stop]) <= CELLS:
                    stop += 1
                yield _beginnings(names[start:stop])
                start = stop

    return words.select("word").mapInArrow(work, "key long, asks boolean, word string")


def _beginnings(names: list[str]) -> pa.RecordBatch:
    codes, size = characters(names)
    head = vectors(codes)[:, :LEVELS]
    here = np.arange(len(size))
    out = [(here, size, head, np.zeros(len(size), bool))]
    for longer in (0, 1):
        for v in _variants(head, not longer):
            some = (v >= 0).all(axis=1)
            out.append((here[some], size[some] + longer, v[some], np.ones(int(some.sum()), bool)))
    row, key, counts, asks = (np.concatenate(x) for x in zip(*out))
    for level in range(LEVELS):
        key = key << 8 | np.minimum(counts[:, level], MOST)
    if counts.max() >= MOST:  # beginnings that are no longer told apart are asked once
        row, key, asks = np.unique(np.stack([row, key, asks.astype(np.int64)]), axis=1)
    words = pa.array(names, pa.string()).take(pa.array(row))
    return pa.RecordBatch.from_arrays([pa.array(key), pa.array(asks.astype(bool)), words], names=["key", "asks", "word"])


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``a`` and ``b``: pairs of distinct words that are one character apart, each pair once."""
    dealt = _dealt(words)
    blocks = dealt.groupBy("key", "asks").agg((F.floor(F.count("*") / block) + 1).cast("int").alias("n"))
    blocks = blocks.groupBy("key").agg(
        F.max(F.when(~F.col("asks"), F.col("n"))).alias("held"), F.max(F.when(F.col("asks"), F.col("n"))).alias("asking")
    )
    # A beginning that no word has, or none asks for, has no pairs.
    rows = dealt.join(blocks.where("held IS NOT NULL AND asking IS NOT NULL"), "key")
    part = F.pmod(F.xxhash64("word"), F.when(F.col("asks"), F.col("asking")).otherwise(F.col("held"))).cast("int")
    other = F.when(F.col("asks"), F.col("held")).otherwise(F.col("asking"))
    rows = rows.select("key", "asks", "word", part.alias("own"), F.explode(F.sequence(F.lit(0), other - 1)).alias("other"))
    rows = rows.select(
        "key", "asks", "word",
        F.when(F.col("asks"), F.col("other")).otherwise(F.col("own")).alias("held"),
        F.when(F.col("asks"), F.col("own")).otherwise(F.col("other")).alias("asking"),
    )
    # Without this, rows would stay where the join has dealt them, all blocks of a beginning in one task.
    rows = rows.repartition("key", "held", "asking")
    return rows.groupBy("key", "held", "asking").applyInArrow(_walked, "a string, b string")


def _walked(table: pa.Table) -> pa.Table:
    asks = table.column("asks").to_numpy()
    names = np.array(table.column("word").to_pylist(), dtype=object)
    held, asking = names[~asks], names[asks]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    if len(held) and len(asking):
        codes_b, size_b = characters(held.tolist())
        codes_a, size_a = characters(asking.tolist())
        counts_a, counts_b = vectors(codes_a), vectors(codes_b)
        trie, length = Trie(counts_b), size_b[0]
        for same in (True, False):
            some = np.flatnonzero(size_a == length - (not same))
            for c in range(0, len(some), WALKERS):
                own = some[c : c + WALKERS]
                row, b = trie.walk(counts_a[own], int(same))
                a = own[row]
                if same:
                    later = _greater(counts_b[b], counts_a[a]) | ((counts_b[b] == counts_a[a]).all(axis=1) & (held[b] > asking[a]))
                    a, b = a[later], b[later]
                step = min(PAIRS, max(1, CELLS // int(length)))
                for k in range(0, len(a), step):
                    i, j = a[k : k + step], b[k : k + step]
                    near = one_apart(codes_a[i], size_a[i], codes_b[j], size_b[j])
                    found.append((asking[i[near]], held[j[near]]))
    give_back()
    a = np.concatenate([x for x, _ in found]) if found else []
    b = np.concatenate([x for _, x in found]) if found else []
    return pa.table({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string())})


def _greater(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether rows of ``x`` come after those of ``y``."""
    unequal = x != y
    at = unequal.argmax(axis=1)
    rows = np.arange(len(x))
    return x[rows, at] > y[rows, at]


# -- forms and roots -------------------------------------------------------------------------


def variants(words: DataFrame, near: Callable[[DataFrame], DataFrame] = near_pairs) -> DataFrame:
    """``words`` (``word``, ``n``; words distinct) with ``n_near``, the number of words one character apart, ``form``, the most
    frequent of them (of equal ones the first) if it has RATIO times as many occurrences, its ``form_n``, and ``root``,
    where the forms of forms end."""
    words = kept(words.select("word", "n"))
    pairs = near(words)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    named = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("__n")), "b")
    # Of equal counts the smallest word: its characters are below 256, where byte order is theirs.
    best = named.groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("__n")).alias("less"), F.col("b").alias("form"))).alias("best")
    )
    told = words.join(best, "word", "left")
    follows = -F.col("best.less") >= RATIO * F.col("n")
    told = kept(
        told.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(follows, F.col("best.form")).alias("form"), F.when(follows, -F.col("best.less")).alias("form_n"),
        )
    )
    links = told.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = kept(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), "next"))
        links = step.select("word", "root")
        if step.where("next IS NOT NULL").isEmpty():
            break
    rooted = told.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return rooted.select("word", "form", "root", "n", "n_near", "form_n")
