"""Byte-pair encoding and decoding with a segment tree over the ranks of adjacent pairs.

A word's symbols are the leaves; each holds rank * leaves + place of the pair it begins, so the root yields
the leftmost lowest-ranked merge. A merge rewrites at most three leaves, each by one path to the root, until
no pair can merge. Words of up to 256 bytes go through one tree each, side by side in arrays; longer words
have one of their own. The vocabulary is read on the driver and broadcast (its size is that of the file), and
each distinct word of a task is encoded once, with a bounded memory of words.

Follows a tokenizer file whose model is BPE with word ends, over bytes written as visible characters, after NFC
and lower case: ids equal those of the tokenizers library without special tokens added, and decoding joins tokens
by spaces, as the file names no decoder.

Defined cases: null or empty text has no ids and decodes to the empty string; strings of special tokens in
a text become their ids; rows stay rows, whatever their ids or other columns.
"""

from __future__ import annotations

import json
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from tablewright.llm.shared import give_back

NONE = np.int64(1) << 60
SIDE_BY_SIDE = 256
SLICE = 1 << 20
#: Characters beyond these blocks may be new in some version of Unicode.
RECENT = regex.compile("[^\\u0000-\\u052f\\u2010-\\u2027\\u2030-\\u205e\\u20a0-\\u20bf]")


@lru_cache(maxsize=1)
def byte_characters() -> list[str]:
    """The visible character of every byte: printable Latin-1 stands for itself, the rest follow from 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b if b in own else next(other)) for b in range(256)]


@dataclass
class Vocabulary:
    """Symbols, merges and special tokens as arrays."""

    inner: np.ndarray
    final: np.ndarray
    pairs: np.ndarray
    rank: np.ndarray
    made: np.ndarray
    tokens: list[bytes]
    special: dict[str, int]
    pattern: str
    source: str
    memory: int = 300_000

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            source = f.read()
        file = json.loads(source)
        model, end = file["model"], file["model"]["end_of_word_suffix"]
        vocab = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in merges], dtype=np.int64)
        order = np.argsort(pairs, kind="stable")
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        tokens = {v: k for k, v in [*vocab.items(), *special.items()]}
        characters = byte_characters()
        return cls(
            np.array([vocab[c] for c in characters], dtype=np.int64),
            np.array([vocab[c + end] for c in characters], dtype=np.int64),
            pairs[order],
            order.astype(np.int64),
            made,
            [tokens.get(i, "").encode() for i in range(max(tokens) + 1)],
            special,
            file["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"],
            source,
        )

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or NONE."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.rank[at], NONE)


class Encoder:
    """Words to ids, with a bounded memory of words already seen."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.known, self.runs = vocabulary, {}, {}
        self.library = None
        self.split = regex.compile(vocabulary.pattern)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True))) + ")") if vocabulary.special else None

    def pieces(self, word: bytes) -> list[str | int]:
        """What is encoded of a run without spaces: its words and the ids of special tokens."""
        text = word.decode()
        if self.cut is None or not self.cut.search(text):
            return self._split(text)
        out: list[str | int] = []
        for part in self.cut.split(text):
            out += [self.v.special[part]] if part in self.v.special else self._split(part)
        return out

    def _split(self, text: str) -> list[str]:
        if not RECENT.search(text):
            # Lower case goes character by character, so a final capital sigma is like any other.
            return self.split.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        # Which characters are letters depends on the version of Unicode: the library's own tables decide.
        if self.library is None:
            self.library = Tokenizer.from_str(self.v.source)
            self.bytes_of = {c: b for b, c in enumerate(byte_characters())}
        pieces = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(map(self.bytes_of.__getitem__, p)).decode() for p, _ in pieces]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [t.split() for t in texts]
        new = set().union(*split) - self.runs.keys()
        if len(self.runs) + len(new) > self.v.memory:
            self.runs.clear()
            self.known.clear()
            new = set().union(*split)
        cut = {run: self.pieces(run) for run in new}
        self.learn(set().union(*cut.values()) - self.known.keys())
        known = self.known.__getitem__
        for run, pieces in cut.items():
            self.runs[run] = b"".join(map(known, pieces))
        ids = self.runs.__getitem__
        return [b"".join(map(ids, words)) for words in split]

    def learn(self, words: set) -> None:
        groups: dict[int, list[tuple[str, bytes]]] = {}
        for w in words:
            if isinstance(w, int):
                self.known[w] = np.uint32(w).astype("<u4").tobytes()
                continue
            raw = w.encode()
            groups.setdefault(max(1, (len(raw) - 1).bit_length()), []).append((w, raw))
        for level, members in groups.items():
            if 1 << level > SIDE_BY_SIDE:
                for w, raw in members:
                    self.known[w] = self.long(raw)
                continue
            for a in range(0, len(members), 1 << 14):
                part = members[a : a + (1 << 14)]
                for (w, _), ids in zip(part, self.side_by_side([raw for _, raw in part], 1 << level)):
                    self.known[w] = ids

    def side_by_side(self, words: list[bytes], leaves: int) -> list[bytes]:
        """A tree for every word, as rows of arrays with ``leaves`` leaves."""
        n, v = len(words), self.v
        size = np.array([len(w) for w in words])
        inside = np.arange(leaves) < size[:, None]
        ids = np.full((n, leaves + 1), -1, dtype=np.int64)
        ids[:, :leaves][inside] = v.inner[np.frombuffer(b"".join(words), np.uint8)]
        ends = np.array([w[-1] for w in words])
        ids[np.arange(n), size - 1] = v.final[ends]
        after = np.tile(np.arange(1, leaves + 2), (n, 1))
        after = np.where(after < size[:, None], after, leaves)
        before = np.tile(np.arange(-1, leaves), (n, 1))
        tree = np.full((n, 2 * leaves), NONE, dtype=np.int64)

        def leaf(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
            rank = v.ranks(ids[rows, at], ids[rows, after[rows, at]])
            return np.where(rank < NONE, rank * leaves + at, NONE)

        for at in range(leaves - 1):
            rows = np.flatnonzero(size > at + 1)
            tree[rows, leaves + at] = leaf(rows, np.full(len(rows), at))
        level = leaves
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        rows = np.arange(n)
        while True:
            rows = rows[tree[rows, 1] < NONE]
            if not len(rows):
                break
            best = tree[rows, 1]
            at, rank = best % leaves, best // leaves
            gone = after[rows, at]
            following = after[rows, gone]
            ids[rows, at] = v.made[rank]
            ids[rows, gone] = -1
            after[rows, at] = following
            before[rows, following] = at
            previous = before[rows, at]
            tree[rows, leaves + at] = leaf(rows, at)
            tree[rows, leaves + gone] = NONE
            some = previous >= 0
            tree[rows[some], leaves + previous[some]] = leaf(rows[some], previous[some])
            for who, place in ((rows, at), (rows, gone), (rows[some], previous[some])):
                node = (leaves + place) >> 1
                while len(node) and node[0]:
                    tree[who, node] = np.minimum(tree[who, 2 * node], tree[who, 2 * node + 1])
                    node = node >> 1
        ids = ids[:, :leaves]
        flat = ids[ids >= 0].astype("<u4").tobytes()
        ends = np.cumsum((ids >= 0).sum(axis=1) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def long(self, word: bytes) -> bytes:
        """One tree for one long word."""
        v, n = self.v, len(word)
        leaves = 1 << (n - 1).bit_length()
        ids = v.inner[np.frombuffer(word, np.uint8)]
        ids[-1] = v.final[word[-1]]
        first = v.ranks(ids[:-1], ids[1:])
        base = np.full(2 * leaves, NONE, dtype=np.int64)
        base[leaves : leaves + n - 1] = np.where(first < NONE, first * leaves + np.arange(n - 1), NONE)
        level = leaves
        while level > 1:
            base[level // 2 : level] = np.minimum(base[level : 2 * level : 2], base[level + 1 : 2 * level : 2])
            level //= 2
        tree, symbols, none = base.tolist(), ids.tolist(), int(NONE)
        after, before = list(range(1, n + 1)), list(range(-1, n))
        ranks = _ranks(v)

        def put(at: int, value: int) -> None:
            node = leaves + at
            tree[node] = value
            node >>= 1
            while node:
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    break
                tree[node] = low
                node >>= 1

        def leaf(at: int) -> int:
            right = after[at]
            rank = ranks.get(symbols[at] << 32 | symbols[right]) if right < n else None
            return none if rank is None else rank * leaves + at

        while tree[1] < none:
            rank, at = divmod(tree[1], leaves)
            gone = after[at]
            symbols[at], symbols[gone] = int(v.made[rank]), -1
            after[at] = after[gone]
            if after[at] < n:
                before[after[at]] = at
            put(gone, none)
            put(at, leaf(at))
            if before[at] >= 0:
                put(before[at], leaf(before[at]))
        return np.array([s for s in symbols if s >= 0], dtype="<u4").tobytes()


_known_ranks: dict[int, dict[int, int]] = {}


def _ranks(v: Vocabulary) -> dict[int, int]:
    """Ranks by pair, for single look-ups."""
    if id(v) not in _known_ranks:
        _known_ranks.clear()
        _known_ranks[id(v)] = dict(zip(v.pairs.tolist(), v.rank.tolist()))
    return _known_ranks[id(v)]


def _slices(sizes: list[int]):
    """Consecutive rows of about SLICE bytes in all."""
    start = total = 0
    for i, size in enumerate(sizes):
        total += size
        if total >= SLICE:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def _mapped(df: DataFrame, source: str, targets: dict[str, str], make, keep: bool = True) -> DataFrame:
    """``df`` with more columns (names and types), made from slices of another; without that one unless ``keep``."""
    for target in targets:
        if target in df.columns:
            raise ValueError(f"column {target} is there already")
    rest = [f for f in df.schema.fields if keep or f.name != source]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rest), *(f"`{t}` {kind}" for t, kind in targets.items())])

    def run(batches):
        work = make()
        for batch in batches:
            column = batch.column(source)
            column = column.cast(pa.binary()) if pa.types.is_string(column.type) else column
            for a, b in _slices(pc.binary_length(column).to_pylist()):
                out = work(column.slice(a, b - a).to_pylist())
                columns = [batch.column(f.name).slice(a, b - a) for f in rest]
                yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, out)], names=[*(f.name for f in rest), *targets])
            give_back()

    return df.mapInArrow(run, schema)


def _decoder(tokens: list[bytes]):
    def work(packed: list[bytes]) -> list[str]:
        out = []
        for ids in packed:
            numbers = np.frombuffer(ids, "<u4")
            numbers = numbers[numbers < len(tokens)]
            out.append(b" ".join(map(tokens.__getitem__, numbers.tolist())).decode())
        return out

    return work


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of its text in ``ids_col``: packed little-endian unsigned 32-bit integers."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(path))
    docs = docs.withColumn(text_col, F.coalesce(F.col(f"`{text_col}`"), F.lit("")))

    def make():
        work = Encoder(vocabulary.value).encode
        return lambda texts: [work(texts)]

    return _mapped(docs, text_col, {ids_col: "binary"}, make)


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text of packed ids: their tokens joined by spaces; unknown ids and null give nothing."""
    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary.load(path))

    def make():
        work = _decoder(vocabulary.value.tokens)
        return lambda packed: [work(packed)]

    return _mapped(df.withColumn(ids_col, F.coalesce(F.col(f"`{ids_col}`"), F.lit(b""))), ids_col, {text_col: "string"}, make)


def encode_and_decode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``docs`` without its text, with the columns of ``encode`` and of ``decode`` after it. Both are made by one Python worker: in two
    steps a task has two at once, and executors keep all of them for the stages that follow."""
    vocabulary = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(path))
    docs = docs.withColumn(text_col, F.coalesce(F.col(f"`{text_col}`"), F.lit("")))

    def make():
        to_ids, to_text = Encoder(vocabulary.value).encode, _decoder(vocabulary.value.tokens)

        def work(texts: list[bytes]) -> list[list]:
            ids = to_ids(texts)
            return [ids, to_text(ids)]

        return work

    return _mapped(docs, text_col, {ids_col: "binary", decoded_col: "string"}, make, keep=False)
