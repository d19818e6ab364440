"""Repeated word strings removed by relative Lempel-Ziv parsing.

Every document is parsed against all blocks that come before it in (id, place) order. The blocks are
indexed by their grams (``windows``); a lookup gives, for each place of a document, the earliest earlier
place with the same ``window`` words. The parse is greedy: a factor goes on while the reference goes on word
by word, and where it breaks the next place is looked up anew, so windows across a factor's end are
checked as well. Factors of at least ``window`` words are the duplicate spans.

Defined cases: null or empty text has no words; a null id counts as the largest; of rows with one id, places
are compared as in one document, so equal places of repeated rows don't remove each other; a
document shorter than the window stays whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablewright.llm.suffix_dedup import _runs, covered
from tablewright.llm.windows import BLOCKS, Batch, Bucket, Unit, repeated_windows

FACTORS = "array<struct<start:long,length:long,ref_id:long,ref_start:long>>"
SCHEMA = f"n_words long, n_removed long, kept string, kept_sha256 string, factors {FACTORS}"


def _steps(block: np.ndarray, place: np.ndarray, ref_id: np.ndarray, ref: np.ndarray) -> np.ndarray:
    """Where a new factor begins: another block, a gap, or a reference that doesn't go on."""
    if not len(place):
        return place
    goes_on = (block[1:] == block[:-1]) & (np.diff(place) == 1) & (ref_id[1:] == ref_id[:-1]) & (np.diff(ref) == 1)
    return np.flatnonzero(np.concatenate([[True], ~goes_on]))


def look_up(bucket: Bucket, unit: Unit) -> Callable:
    """For every window of a bucket the earliest place of the same words, if another; cut into factors."""
    block, key = bucket.block, _runs(bucket.tokens.value, unit.window)[bucket.start]
    ids = bucket.ids[block]
    offset = bucket.start - bucket.tokens.bounds[block]
    place = bucket.starts[block] + offset
    order = np.lexsort((place, ids, key))
    heads = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]])) if len(order) else order
    first = np.empty(len(order), dtype=np.int64)
    first[order] = np.repeat(order[heads], np.diff(np.append(heads, len(order)))) if len(order) else order
    ref_id, ref = ids[first], place[first]
    found = np.flatnonzero((ref_id < ids) | (ref < place))
    block, offset, ref_id, ref = block[found], offset[found], ref_id[found], ref[found]
    steps = _steps(block, offset, ref_id, ref)
    count = np.diff(np.append(steps, len(found)))
    factors = np.stack([block[steps], offset[steps], count, ref_id[steps], ref[steps]], axis=1).astype(np.int64)

    def cut(a: int, b: int) -> tuple:
        own = factors[np.searchsorted(factors[:, 0], a) : np.searchsorted(factors[:, 0], b)].copy()
        own[:, 0] -= a
        return own.tobytes(), None, None, None

    return cut


def _references(batch: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks of windows that come earlier, and the place each refers to."""
    batch.blocks()
    n = len(batch.tokens.value)
    marks, ref_id, ref = np.zeros(n, dtype=bool), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
    if not len(batch.record):
        return marks, ref_id, ref
    sizes = (batch.block_last - batch.block_first + 1)[batch.head]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    known = [np.zeros(ends[-1], dtype=bool), np.zeros(ends[-1], dtype=np.int64), np.zeros(ends[-1], dtype=np.int64)]
    for bucket, cut in batch.buckets():
        for row in batch.replies[BLOCKS].get(bucket, []):
            own = np.frombuffer(row["a"], np.int64).reshape(-1, 5)
            each = own[:, 2]
            step = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
            at = np.repeat(ends[cut.start + own[:, 0]] + own[:, 1], each) + step
            known[0][at], known[1][at], known[2][at] = True, np.repeat(own[:, 3], each), np.repeat(own[:, 4], each) + step
    each = batch.block_last - batch.block_first + 1
    offset = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    where, at = np.repeat(batch.block_first, each) + offset, np.repeat(ends[batch.record], each) + offset
    head_id, head_at = batch.places(batch.head)
    own_id, own_at = batch.places(np.arange(len(batch.record)))
    later = (own_id > head_id[batch.record]) | (own_at > head_at[batch.record])
    marks[where] = known[0][at] | np.repeat(later, each)
    own = ~known[0][at]
    ref_id[where] = np.where(own, np.repeat(head_id[batch.record], each), known[1][at])
    ref[where] = np.where(own, np.repeat(head_at[batch.record], each) + offset, known[2][at])
    return marks, ref_id, ref


def _finish(batch: Batch) -> pa.Table:
    window, tokens = batch.unit.window, batch.tokens
    marks, ref_id, ref = _references(batch)
    gone = covered(marks, window)
    places = np.flatnonzero(marks)
    doc = tokens.doc(places)
    steps = _steps(doc, places, ref_id[places], ref[places])
    count = np.diff(np.append(steps, len(places)))
    factors: dict[int, list] = {}
    for d, p, c, i, r in zip(*(x.tolist() for x in (doc[steps], places[steps], count, ref_id[places[steps]], ref[places[steps]]))):
        start = p - int(tokens.bounds[d])
        factors.setdefault(d, []).append({"start": start, "length": c + window - 1, "ref_id": i, "ref_start": r})
    raw = tokens.data.tobytes()
    removed = np.concatenate([[0], np.cumsum(gone)])
    stay = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]]).astype(np.int8)))
    bounds = tokens.bounds
    out: list[tuple] = [()] * len(batch.ids)
    for i in np.flatnonzero(batch.copy):
        words = batch.texts[i].split()
        whole = len(words) >= window
        out[i] = (len(words), len(words) * whole, b"" if whole else b" ".join(words), None)
    for d, i in enumerate(batch.kept.tolist()):
        a, b = int(bounds[d]), int(bounds[d + 1])
        lost = int(removed[b] - removed[a])
        if not lost:
            text = raw[tokens.first[a] : tokens.last[b - 1]] if b > a else b""
        else:
            cuts = stay[np.searchsorted(stay, a, "right") : np.searchsorted(stay, b)].tolist()
            edges = [a, *cuts, b]
            parts = [(x, y) for x, y in zip(edges[:-1], edges[1:]) if not gone[x]]
            text = b" ".join(raw[tokens.first[x] : tokens.last[y - 1]] for x, y in parts)
        out[i] = (b - a, lost, text, factors.get(d))
    n_words, n_removed, kept, found = zip(*out) if out else ((), (), (), ())
    rest = batch.table.drop_columns(["__batch", "__id", "__text"])
    shape = pa.list_(pa.struct([(x, pa.int64()) for x in ("start", "length", "ref_id", "ref_start")]))
    columns = (
        ("n_words", pa.array(n_words, pa.int64())),
        ("n_removed", pa.array(n_removed, pa.int64())),
        ("kept", pa.array(kept, pa.binary()).cast(pa.string())),
        ("kept_sha256", pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())),
        ("factors", pa.array([f or [] for f in found], shape)),
    )
    for name, column in columns:
        rest = rest.append_column(name, column)
    return rest


def remove_repeated_words(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 20, batch_bytes: int = 2 << 20, hot: int = 4096
) -> DataFrame:
    """The columns of ``docs`` but its text, with counts, the words kept and the factors found.

    A whole copy of a smaller document has no factors listed, as it is settled by its digest.
    Columns of ``docs`` named like one of the result must be renamed by the caller first.
    """

    def unit(buckets: int) -> Unit:
        return Unit(words=True, window=window, gram=max(1, window * 2 // 5), buckets=buckets, hot=hot, within=True)

    return repeated_windows(docs, unit, look_up, _finish, SCHEMA, id_col, text_col, batch_bytes)
