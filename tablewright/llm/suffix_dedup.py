"""Repeated byte strings removed by a depth-limited radix sort of suffixes.

Suffixes are ordered only through ``threshold`` bytes, by most-significant-digit passes. The first digit is
the gram at the suffix's anchor and deals suffixes to buckets (``windows``); within a bucket every pass
sorts the surviving groups by their next 25 bytes, compared by a 64-bit hash, and drops groups that
one document holds alone. Groups equal through the threshold are exactly the repeated windows, and every
occurrence outside the smallest document of its group is removed.

Defined cases: null or empty text has no bytes; a null id counts as the largest; rows with one id are one
document for the comparison, so neither removes the other's text; texts shorter than the threshold stay.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablewright.llm.windows import BLOCKS, PIECE, Batch, Bucket, Unit, repeated_windows, spans_hash

SCHEMA = "n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"


def _runs(value: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` tokens of a whole bucket."""
    n = max(len(value) - length + 1, 0)
    return np.concatenate(
        [np.zeros(0, np.uint64), *(spans_hash(value[a : min(n, a + PIECE) + length - 1], length) for a in range(0, n, PIECE))]
    )


def radix(bucket: Bucket, unit: Unit) -> Callable:
    """Most-significant-digit passes over a bucket; bits of windows that a smaller document has."""
    width = -(-unit.window // 2)
    ids = bucket.ids[bucket.block]
    alive, group = np.arange(len(ids)), np.zeros(len(ids), dtype=np.int64)
    repeated = np.zeros(len(ids), dtype=bool)
    least = ids
    for depth in range(0, unit.window, width):
        take = min(width, unit.window - depth)
        digit = _runs(bucket.tokens.value, take)[bucket.start[alive] + depth]
        order = np.argsort(digit, kind="stable") if not depth else np.lexsort((digit, group))
        alive, digit, group = alive[order], digit[order], group[order]
        heads = np.flatnonzero(np.concatenate([[True], (digit[1:] != digit[:-1]) | (group[1:] != group[:-1])])) if len(alive) else alive
        if not len(heads):
            break
        size = np.diff(np.append(heads, len(alive)))
        low, high = np.minimum.reduceat(ids[alive], heads), np.maximum.reduceat(ids[alive], heads)
        stay = np.repeat(low < high, size)
        alive, group = alive[stay], np.repeat(np.arange(len(heads)), size)[stay]
        least = np.repeat(low, size)[stay]
    if len(alive):
        repeated[alive] = least < ids[alive]
    ends = np.concatenate([[0], np.cumsum(bucket.per_block)])
    return lambda a, b: (np.packbits(repeated[ends[a] : ends[b]]).tobytes(), None, None, None)


def _marked(batch: Batch) -> np.ndarray:
    """Which windows of the batch's documents start in a smaller document, too."""
    batch.blocks()
    marks = np.zeros(len(batch.tokens.value), dtype=bool)
    if not len(batch.record):
        return marks
    sizes = (batch.block_last - batch.block_first + 1)[batch.head]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    bits = np.zeros(ends[-1], dtype=bool)
    for bucket, cut in batch.buckets():
        n = int(ends[cut.stop] - ends[cut.start])
        for row in batch.replies[BLOCKS].get(bucket, []):
            bits[ends[cut.start] : ends[cut.stop]] = np.unpackbits(np.frombuffer(row["a"], np.uint8), count=n).astype(bool)
    each = batch.block_last - batch.block_first + 1
    offset = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    owner, _ = batch.places(batch.head)
    own, _ = batch.places(np.arange(len(batch.record)))
    later = own > owner[batch.record]
    marks[np.repeat(batch.block_first, each) + offset] = bits[np.repeat(ends[batch.record], each) + offset] | np.repeat(later, each)
    return marks


def covered(marks: np.ndarray, window: int) -> np.ndarray:
    """Tokens inside a marked window."""
    total = np.concatenate([np.zeros(window, np.int32), np.cumsum(marks, dtype=np.int32)])
    return total[window:] > total[:-window]


def _finish(batch: Batch) -> pa.Table:
    window, tokens = batch.unit.window, batch.tokens
    gone = covered(_marked(batch), window)
    runs = gone & ~np.concatenate([[False], gone[:-1]])
    heads = tokens.bounds[:-1][np.diff(tokens.bounds) > 0]
    runs[heads] = gone[heads]
    removed, spans = (np.concatenate([np.zeros(1, np.int32), np.cumsum(x, dtype=np.int32)]) for x in (gone, runs))
    raw = tokens.data[~gone].tobytes()
    out = [(0, 0, 0, b"")] * len(batch.ids)
    for i in np.flatnonzero(batch.copy):
        text = batch.texts[i]
        whole = len(text) >= window
        out[i] = (len(text), len(text) * whole, int(whole), b"" if whole else text)
    for i, a, b in zip(batch.kept.tolist(), tokens.bounds[:-1].tolist(), tokens.bounds[1:].tolist()):
        kept = raw[a - int(removed[a]) : b - int(removed[b])]
        out[i] = (b - a, int(removed[b] - removed[a]), int(spans[b] - spans[a]), kept)
    n_bytes, n_removed, n_spans, kept = zip(*out) if out else ((), (), (), ())
    rest = batch.table.drop_columns(["__batch", "__id", "__text"])
    columns = [pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)]
    columns += [pa.array(kept, pa.binary()), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())]
    for name, column in zip(("n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"), columns):
        rest = rest.append_column(name, column)
    return rest


def remove_repeated_bytes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = 50, batch_bytes: int = 2 << 20, hot: int = 4096
) -> DataFrame:
    """The columns of ``docs`` but its text, with counts, the bytes kept and their digest.

    Columns of ``docs`` named like one of the result must be renamed by the caller first.
    """

    def unit(buckets: int) -> Unit:
        return Unit(words=False, window=threshold, gram=max(1, threshold * 12 // 25), buckets=buckets, hot=hot)

    return repeated_windows(docs, unit, radix, _finish, SCHEMA, id_col, text_col, batch_bytes)
