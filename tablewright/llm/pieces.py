"""SentencePiece encoding and decoding through a table of distinct chunks.

Follows a model of type BPE that adds a marker before the text, writes spaces as markers, normalises nothing
and falls back to bytes; others raise. No piece of such a model has a marker after another character (checked when it is
loaded), so merges never cross from one marked word into the next: a text is cut before every run of markers, and at line
breaks where no piece holds one. Each distinct chunk is segmented once, and the ids are joined back to the texts by
the chunks' positions, as numbers into the table.

The table belongs to a task and is bounded in bytes; beyond them it starts anew. No row is shuffled: one table for all
tasks would take shuffles of every text to join back to. Chunks of similar length are merged side by side in arrays, round
by round the leftmost pair of the highest score; chunks beyond ``SIDE_BY_SIDE`` characters use a heap each.

Defined cases: null or empty text has the end id alone and decodes to the empty string; ids outside the vocabulary
and null give no text; rows stay rows, whatever their ids, repeats or further columns; a column that bears the name of a
result raises.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece
from pyspark.sql import DataFrame

from tablewright.llm.shared import give_back

MARK = "▁"
NONE = np.int64(1) << 40
SIDE_BY_SIDE = 64
SLICE = 1 << 20
#: Chunks segmented at a time.
ROWS = 1 << 14
#: Bytes of chunks that a task's table holds.
TABLE_BYTES = 24 << 20


@dataclass
class Model:
    """Pieces and merges as arrays. Symbols are ids of pieces; characters that only larger pieces hold come after them."""

    codes: np.ndarray
    symbols: np.ndarray
    pairs: np.ndarray
    rank: np.ndarray
    made: np.ndarray
    size: int
    end: int
    byte: list[int]
    tokens: list[bytes]
    pattern: str

    @classmethod
    def load(cls, path: str) -> Model:
        library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = library.get_piece_size()
        names = [library.id_to_piece(i) for i in range(size)]
        special = [library.is_control(i) or library.is_unknown(i) or library.is_byte(i) for i in range(size)]
        pieces = {p: i for i, (p, out) in enumerate(zip(names, special)) if not out}
        if library.normalize("  ﬁ a") != f"{MARK * 3}ﬁ{MARK}a" or not library.is_byte(3):
            raise ValueError(f"{path} normalises texts or has no bytes to fall back to")
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError(f"{path} has pieces that cross a marker")
        number = dict(pieces)
        for c in sorted({c for p in pieces for c in p} - pieces.keys()):
            number[c] = size + len(number) - len(pieces)
        scores = {i: library.get_score(i) for i in pieces.values()}
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        pairs = []
        for p, i in pieces.items():
            for k in range(1, len(p)):
                a, b = number.get(p[:k]), number.get(p[k:])
                if a is not None and b is not None:
                    pairs.append((a << 32 | b, order[scores[i]], i))
        table = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 3)
        single = sorted((ord(c), i) for c, i in number.items() if len(c) == 1)
        byte = {int(names[i][3:5], 16): i for i in range(size) if library.is_byte(i)}
        tokens = [b"" if out else p.replace(MARK, " ").encode() for p, out in zip(names, special)]
        for b, i in byte.items():
            tokens[i] = bytes([b])
        breaks = "" if any("\n" in p for p in pieces if len(p) > 1) else r"\n"
        return cls(
            np.array([c for c, _ in single]), np.array([i for _, i in single]), table[:, 0], table[:, 1], table[:, 2],
            size, library.eos_id(), [byte[b] for b in range(256)], tokens,
            f"{MARK}*[^{MARK}{breaks}]+|{MARK}+" + (f"|{breaks}" if breaks else ""),
        )

    def numbers(self, codes: np.ndarray) -> np.ndarray:
        """The symbol of each character, or minus its code point less one if no piece holds it."""
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.symbols[at], -1 - codes)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, or NONE, and what it becomes."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        there = (self.pairs[at] == key) & (left >= 0) & (right >= 0)
        return np.where(there, self.rank[at], NONE), self.made[at]

    def spelled(self, symbols: list[int]) -> list[int]:
        """Ids of symbols: one that is no piece becomes its bytes."""
        out = []
        for s in symbols:
            if 0 <= s < self.size:
                out.append(s)
                continue
            code = -1 - s if s < 0 else int(self.codes[np.flatnonzero(self.symbols == s)[0]])
            out += [self.byte[b] for b in chr(code).encode()]
        return out


class Segmenter:
    """Chunks to packed ids."""

    def __init__(self, model: Model):
        self.m, self.split = model, regex.compile(model.pattern)

    def chunks(self, text: str) -> list[str]:
        return self.split.findall(MARK + text.replace(" ", MARK)) if text else []

    def segment(self, chunks: list[str]) -> list[bytes]:
        """Ids of each chunk as 32-bit integers; chunks of similar length go together."""
        out: list[bytes] = [b""] * len(chunks)
        groups: dict[int, list[int]] = {}
        for i, c in enumerate(chunks):
            groups.setdefault(max(2, (len(c) - 1).bit_length()), []).append(i)
        for level, members in groups.items():
            for a in range(0, len(members), ROWS):
                part = members[a : a + ROWS]
                texts = [chunks[i] for i in part]
                done = map(self.long, texts) if 1 << level > SIDE_BY_SIDE else self.side_by_side(texts, 1 << level)
                for i, ids in zip(part, done):
                    out[i] = ids
        return out

    def side_by_side(self, texts: list[str], width: int) -> list[bytes]:
        m, n = self.m, len(texts)
        size = np.array([len(t) for t in texts])
        inside = np.arange(width) < size[:, None]
        ids = np.full((n, width + 1), -(1 << 31), dtype=np.int64)
        ids[:, :width][inside] = m.numbers(np.frombuffer("".join(texts).encode("utf-32-le"), "<u4").astype(np.int64))
        after = np.tile(np.arange(1, width + 2), (n, 1))
        before = np.tile(np.arange(-1, width), (n, 1))
        rank = np.full((n, width + 1), NONE)
        made = np.zeros((n, width + 1), dtype=np.int64)
        rank[:, : width - 1], made[:, : width - 1] = m.look_up(ids[:, : width - 1], ids[:, 1:width])
        alive = inside
        rows = np.arange(n)
        while True:
            at = rank[rows].argmin(axis=1)  # the first of equal ranks: the leftmost
            some = rank[rows, at] < NONE
            rows, at = rows[some], at[some]
            if not len(rows):
                break
            gone = after[rows, at]
            following = after[rows, gone]
            ids[rows, at] = made[rows, at]
            alive[rows, gone] = False
            rank[rows, gone] = NONE
            after[rows, at] = following
            before[rows, following] = at
            rank[rows, at], made[rows, at] = m.look_up(ids[rows, at], ids[rows, following])
            previous = before[rows, at]
            some = previous >= 0
            r, left, right = rows[some], previous[some], at[some]
            rank[r, left], made[r, left] = m.look_up(ids[r, left], ids[r, right])
        flat, counts = ids[:, :width][alive], alive.sum(axis=1)
        strange = (flat < 0) | (flat >= m.size)
        packed, ends = flat.astype("<i4").tobytes(), np.cumsum(counts).tolist()
        out = [packed[4 * a : 4 * b] for a, b in zip([0, *ends], ends)]
        if strange.any():
            of = np.repeat(np.arange(n), counts)
            for i in np.unique(of[strange]).tolist():
                symbols = flat[ends[i - 1] if i else 0 : ends[i]].tolist()
                out[i] = np.array(m.spelled(symbols), dtype="<i4").tobytes()
        return out

    def long(self, text: str) -> bytes:
        m, n = self.m, len(text)
        symbols = m.numbers(np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64)).tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n))
        table = self._table()
        heap = []

        def offer(left: int, right: int) -> None:
            if left >= 0 and right < n:
                pair = table.get((symbols[left], symbols[right]))
                if pair:
                    heapq.heappush(heap, (pair[0], left, symbols[left], symbols[right], pair[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        gone = bytearray(n)
        while heap:
            _, at, left, right, new = heapq.heappop(heap)
            other = after[at]
            if gone[at] or other >= n or symbols[at] != left or symbols[other] != right:
                continue
            symbols[at], gone[other] = new, 1
            after[at] = after[other]
            if after[at] < n:
                before[after[at]] = at
            offer(before[at], at)
            offer(at, after[at])
        return np.array(m.spelled([s for s, g in zip(symbols, gone) if not g]), dtype="<i4").tobytes()

    def _table(self) -> dict[tuple[int, int], tuple[int, int]]:
        if not hasattr(self, "pairs"):
            m = self.m
            rows = zip(m.pairs.tolist(), m.rank.tolist(), m.made.tolist())
            self.pairs = {(p >> 32, p & 0xFFFFFFFF): (r, i) for p, r, i in rows}
        return self.pairs


class ChunkTable:
    """Distinct chunks by number, with the ids of each: packed ones end to end, and where each begins."""

    def __init__(self, model: Model):
        self.segmenter, self.end = Segmenter(model), np.array([model.end], dtype="<i4")
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.ids = np.zeros(0, dtype="<i4")
        self.first = np.zeros(1, dtype=np.int64)
        self.bytes = 0

    def encode(self, texts: list[str | None]) -> pa.ListArray:
        """Ids of each text, the end id last."""
        if self.bytes > TABLE_BYTES:
            self.clear()
        cut = [self.segmenter.chunks(t or "") for t in texts]
        number = self.number
        new: list[str] = []
        positions = np.empty(sum(map(len, cut)), dtype=np.int64)
        for i, c in enumerate(chain.from_iterable(cut)):
            k = number.get(c)
            if k is None:
                k = number[c] = len(number)
                new.append(c)
            positions[i] = k
        if new:
            packed = self.segmenter.segment(new)
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(packed), "<i4")])
            self.first = np.concatenate([self.first, self.first[-1] + np.cumsum([len(p) // 4 for p in packed])])
            self.bytes += sum(60 + 2 * len(c) for c in new)
        # Every text ends with one more position, that of the end id.
        ends = np.cumsum([len(c) for c in cut])
        positions = np.insert(positions, ends, len(number))
        ids, first = np.concatenate([self.ids, self.end]), np.append(self.first, self.first[-1] + 1)
        start, size = first[positions], np.diff(first)[positions]
        upto = np.cumsum(size)
        flat = ids[np.repeat(start - (upto - size), size) + np.arange(upto[-1])]
        offsets = np.r_[0, upto[ends + np.arange(len(ends))]]
        return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Consecutive rows that start within the same SLICE bytes."""
    cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // SLICE)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(sizes)]):
        if a < b:
            yield a, b


def _with(df: DataFrame, source: str, target: str, kind: str, sizes: Callable, make: Callable) -> DataFrame:
    """``df`` with one more column, made from slices of another by what ``make`` gives in each task."""
    if target in df.columns:
        raise ValueError(f"column {target} is there already")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def work(batches):
        done = make()
        for batch in batches:
            column = batch.column(source)
            each = pc.fill_null(sizes(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b in _slices(each):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*part.columns, done(column.slice(a, b - a))], names=[*part.schema.names, target])
            give_back()

    return df.mapInArrow(work, f"{schema}, `{target}` {kind}")


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of each text, the end id last, as an array."""
    model = docs.sparkSession.sparkContext.broadcast(Model.load(path))  # as large as the vocabulary

    def make():
        table = ChunkTable(model.value)
        return lambda column: table.encode(column.to_pylist())

    return _with(docs, text_col, ids_col, "array<int>", pc.binary_length, make)


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids_col``: the bytes of its pieces without the first marker. Bytes that are no UTF-8
    become the replacement character."""
    model = df.sparkSession.sparkContext.broadcast(Model.load(path))

    def make():
        tokens = model.value.tokens

        def done(column: pa.Array) -> pa.Array:
            out = []
            for ids in column:
                numbers = ids.values.to_numpy(zero_copy_only=False) if ids.is_valid else np.zeros(0, np.int32)
                known = numbers[(numbers >= 0) & (numbers < len(tokens))].tolist()
                text = b"".join(map(tokens.__getitem__, known))
                out.append((text[1:] if text.startswith(b" ") else text).decode(errors="replace"))
            return pa.array(out, pa.string())

        return done

    return _with(df, ids_col, text_col, "string", lambda c: pc.multiply(pc.list_value_length(c), 4), make)
