"""Which windows of texts occur in more than one place: the exchange that both exact deduplicators share.

A window is ``window`` consecutive tokens (bytes or words) of one document. Its *anchor* is the place of
its smallest-hashing gram of ``gram`` tokens, so equal windows have equal grams at equal distances, and
only about 2 in ``window - gram + 2`` places are anchors. Three passes over the documents follow:

1. every batch of documents sends its distinct anchor grams (6 bytes each, in buckets by leading bits);
   a bucket answers one byte a gram: alone, repeated, or hot. A row for each batch and bucket would make as many rows as the
   square of the batches, so grams go in two steps of about the root of their number: the batches of a group
   send to wide buckets, which merge what a group has and pass it on to their narrow ones, and answers go back the same way;
2. windows of repeated anchors are sent as blocks (all windows of one anchor, as text); equal blocks
   of a batch are sent once. Blocks of a hot gram are cut into single windows that go to buckets of their
   own, so no bucket gathers a hot gram. The bucket decides with the operator's own method;
3. the answers are laid over the documents.

Whole copies of a smaller document are settled by their digest and take no part; they are known by id and
digest, as ids may be null or repeated. Batches are groups of about ``batch_bytes`` of text, dealt by a hash
of id and text, and each pass shuffles only what it adds: the documents are shuffled once, as Spark reuses
that exchange.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tablewright.llm.shared import give_back

PIECE = 1 << 18
_BASE = 0xD1342543DE82EF95
_MASK = (1 << 64) - 1
ALONE, REPEATED, HOT = 0, 1, 2
#: Occurrences of a gram that are told apart; a gram is hot before.
MOST = 65_535
SENT = "bucket int, batch int, kind int, a binary, b binary, c binary, d binary"
REPLY = "batch int, kind int, bucket int, a binary, b binary, c binary, d binary"
#: Rows that tell a batch which of its documents are whole copies, and what pass 1 and pass 2 answered.
COPIES, GRAMS, BLOCKS = 0, 1, 2


@dataclass(frozen=True)
class Unit:
    """What a token is, how many make a window, and how many make a gram."""

    words: bool
    window: int
    gram: int
    buckets: int
    #: More blocks than this of one gram are cut into windows.
    hot: int = 4096
    #: Whether occurrences within one document count.
    within: bool = False

    @property
    def step(self) -> int:
        """Batches of a group, wide buckets, and narrow buckets of a wide one: the root of the batches."""
        return math.isqrt(max(self.buckets - 1, 0)) + 1

    def cell(self, batch: int, wide: int) -> int:
        """Where the batches of a group meet in a wide bucket."""
        return batch // self.step * self.step + wide


@dataclass
class Tokens:
    """Tokens of several documents: their bytes, their values and where each document begins."""

    data: np.ndarray
    value: np.ndarray
    bounds: np.ndarray
    #: First byte and end of each token; none where tokens are bytes.
    first: np.ndarray | None = None
    last: np.ndarray | None = None

    def begin(self, at: np.ndarray) -> np.ndarray:
        return at if self.first is None else self.first[at]

    def end(self, at: np.ndarray) -> np.ndarray:
        return at + 1 if self.last is None else self.last[at]

    def doc(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, at, side="right") - 1


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_BYTES = np.array([xxhash.xxh3_64_intdigest(bytes([i])) for i in range(256)], dtype=np.uint64)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            out.append(np.multiply.accumulate(steps))
        _powers[:] = out
    return _powers[0], _powers[1]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def spans_hash(value: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` tokens; ``value`` is at most a piece and a window long."""
    up, down = powers(max(PIECE * 2, len(value) + 1))
    total = np.zeros(len(value) + 1, dtype=np.uint64)
    np.cumsum(value * up[: len(value)], out=total[1:])
    return mixed((total[length:] - total[:-length]) * down[: len(value) - length + 1])


def smallest(x: np.ndarray, width: int) -> np.ndarray:
    """For every run of ``width`` entries, the place of its smallest (the leftmost of equals)."""
    at, span = np.arange(len(x), dtype=np.int32), 1
    while span < width:
        step = min(span, width - span)
        right = x[step:] < x[:-step]
        x, at = np.where(right, x[step:], x[:-step]), np.where(right, at[step:], at[:-step])
        span += step
    return at


def tokenise(texts: list[bytes], words: bool) -> Tokens:
    """Bytes as they are, or the words of each text joined by one space."""
    first = last = None
    if words:
        texts = [b" ".join(t.split()) for t in texts]
        counts = [t.count(b" ") + 1 if t else 0 for t in texts]
        joined = b" ".join(t for t in texts if t)
        data = np.frombuffer(joined, dtype=np.uint8)
        gaps = np.flatnonzero(data == 32)
        some = int(len(data) > 0)
        first = np.concatenate([np.zeros(some, dtype=np.int64), gaps + 1])
        last = np.concatenate([gaps, np.full(some, len(data))]).astype(np.int64)
        value = np.fromiter(map(_Hashes().__getitem__, joined.split()), np.uint64, len(first))
    else:
        counts = [len(t) for t in texts]
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        value = _BYTES[data]
    return Tokens(data, value, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64), first, last)


def anchors(tokens: Tokens, unit: Unit) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per run of windows with one anchor: first window, last window, hash of the anchor's gram."""
    n, out = len(tokens.value), []
    for a in range(0, max(n - unit.window + 1, 0), PIECE):
        b = min(n, a + PIECE + unit.window - 1)
        grams = spans_hash(tokens.value[a:b], unit.gram)
        at = smallest((grams >> np.uint64(32)).astype(np.uint32), unit.window - unit.gram + 1)
        inside = np.ones(len(at), dtype=bool)
        ends = tokens.bounds[1:]
        for end in ends[(ends > a) & (ends < b)]:
            inside[max(end - unit.window + 1 - a, 0) : end - a] = False
        starts = np.flatnonzero(inside)
        if not len(starts):
            continue
        place = at[starts]
        new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (np.diff(starts) != 1)]))
        last = starts[np.concatenate([new[1:] - 1, [len(starts) - 1]])]
        # Anchors have small hashes; mixed anew, their keys spread evenly over the buckets.
        out.append((starts[new] + a, last + a, mixed(grams[place[new]] + np.uint64(_BASE))))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out))


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int64)


def pack(keys: np.ndarray) -> bytes:
    """The six leading bytes of sorted keys, plane by plane, which compresses well."""
    planes = keys.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6]
    return np.ascontiguousarray(planes.T).tobytes()


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, dtype=np.uint8).reshape(6, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :6] = planes.T
    return out.view(">u8").ravel().astype(np.uint64)


def pieces(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """Sorted keys cut by bucket."""
    own = bucket_of(keys, buckets)
    cuts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1], [True]])) if len(own) else []
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(own[a]), slice(a, b)


class Batch:
    """The documents of one batch by id, without whole copies, and their anchors."""

    def __init__(self, table: pa.Table, replies: pa.Table | None, unit: Unit):
        ids = table["__id"].to_numpy()
        self.order = np.argsort(ids, kind="stable")
        self.table = table.take(pa.array(self.order))
        self.ids = ids[self.order]
        self.unit = unit
        self.replies = {COPIES: {}, GRAMS: {}, BLOCKS: {}}
        for row in replies.to_pylist() if replies is not None else []:
            self.replies[row["kind"]].setdefault(row["bucket"], []).append(row)
        self.texts = self.table["__text"].to_pylist()
        self.copy = self._copied()
        self.kept = np.flatnonzero(~self.copy)
        self.tokens = tokenise([self.texts[i] for i in self.kept], unit.words)
        self.first, self.last, self.key = anchors(self.tokens, unit)
        self.key &= np.uint64(0xFFFFFFFFFFFF0000)
        self.doc = self.tokens.doc(self.first) if len(self.first) else self.first

    def _copied(self) -> np.ndarray:
        """Which documents are whole copies, by id and digest; only texts of ids that have a copy are hashed."""
        out, known = np.zeros(len(self.ids), dtype=bool), {}
        for row in self.replies[COPIES].get(0, []):
            for k, i in enumerate(np.frombuffer(row["a"], np.int64).tolist()):
                known.setdefault(i, set()).add(row["b"][32 * k : 32 * k + 32])
        for k in np.flatnonzero(np.isin(self.ids, np.array(list(known), dtype=np.int64))):
            out[k] = hashlib.sha256(self.texts[k]).digest() in known[int(self.ids[k])]
        return out

    def grams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct grams, how many documents (or places) have each, and which is each anchor's."""
        keys, which = np.unique(self.key, return_inverse=True)
        if self.unit.within:
            return keys, np.bincount(which, minlength=len(keys)), which
        pairs = np.unique(which.astype(np.int64) * (len(self.ids) + 1) + self.doc) // (len(self.ids) + 1)
        return keys, np.bincount(pairs, minlength=len(keys)), which

    def blocks(self) -> None:
        """What pass 2 sends: distinct blocks in the order of their buckets, each with its first place."""
        keys, _, which = self.grams()
        codes = np.zeros(len(keys), dtype=np.uint8)
        for wide, cut in pieces(keys, self.unit.step):
            for row in self.replies[GRAMS].get(wide, []):
                codes[cut] = np.frombuffer(row["a"], np.uint8)
        code = codes[which] if len(keys) else np.zeros(0, np.uint8)
        plain = np.flatnonzero(code == REPEATED)
        first, last, key, doc = (x[plain] for x in (self.first, self.last, self.key, self.doc))
        hot = np.flatnonzero(code == HOT)
        if len(hot):
            each = self.last[hot] - self.first[hot] + 1
            starts = np.repeat(self.first[hot] - np.cumsum(each) + each, each) + np.arange(each.sum())
            hashed = self._windows(starts)
            first, last = np.concatenate([first, starts]), np.concatenate([last, starts])
            key, doc = np.concatenate([key, hashed]), np.concatenate([doc, np.repeat(self.doc[hot], each)])
        # The first of equal blocks is the one with the least id and place, also where rows share an id.
        order = np.lexsort((first - self.tokens.bounds[doc], self.ids[self.kept[doc]]))
        first, last, key, doc = first[order], last[order], key[order], doc[order]
        raw, seen, heads = self.tokens.data.tobytes(), {}, []
        a, b = self.tokens.begin(first), self.tokens.end(last + self.unit.window - 1)
        record = np.zeros(len(first), dtype=np.int64)
        for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
            text = raw[x:y]
            at = seen.get(text)
            if at is None:
                at = seen[text] = len(heads)
                heads.append(i)
            record[i] = at
        heads = np.array(heads, dtype=np.int64)
        bucket = bucket_of(key[heads], self.unit.buckets)
        order = np.argsort(bucket, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        texts = list(seen)
        self.block_first, self.block_last, self.block_doc = first, last, doc
        self.record = rank[record] if len(heads) else record
        self.head, self.bucket = heads[order], bucket[order]
        self.payload = [texts[i] for i in order]

    def _windows(self, starts: np.ndarray) -> np.ndarray:
        out = np.zeros(len(starts), dtype=np.uint64)
        value, n = self.tokens.value, self.unit.window
        for a in range(0, max(len(value) - n + 1, 0), PIECE):
            near = (starts >= a) & (starts < a + PIECE)
            if near.any():
                out[near] = spans_hash(value[a : a + PIECE + n - 1], n)[starts[near] - a]
        return out

    def places(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Document id and token number, within its document, of the first window of blocks."""
        doc = self.block_doc[blocks]
        return self.ids[self.kept[doc]], self.block_first[blocks] - self.tokens.bounds[doc]

    def buckets(self) -> Iterator[tuple[int, slice]]:
        cuts = np.flatnonzero(np.concatenate([[True], self.bucket[1:] != self.bucket[:-1], [True]])) if len(self.bucket) else []
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield int(self.bucket[a]), slice(int(a), int(b))


def _rows(rows: list[tuple], schema: str) -> pa.Table:
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int32() if x.endswith(" int") else pa.binary() for x in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.table([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=names)


def _send_grams(unit: Unit) -> Callable:
    def send(key, table, replies):
        if not table.num_rows:
            return _rows([], SENT)
        give_back()
        batch = Batch(table, replies, unit)
        keys, counts, _ = batch.grams()
        counts, own = np.minimum(counts, MOST).astype(np.uint16), key[0].as_py()
        return _rows(
            [(unit.cell(own, w), own, GRAMS, pack(keys[c]), counts[c].tobytes(), None, None) for w, c in pieces(keys, unit.step)],
            SENT,
        )

    return send


def _together(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams of several rows, which each row's are, and how often each occurs."""
    keys = np.concatenate([np.zeros(0, np.uint64), *(unpack(r["a"]) for r in rows)])
    counts = np.concatenate([np.zeros(0, np.uint16), *(np.frombuffer(r["b"], np.uint16) for r in rows)])
    distinct, which = np.unique(keys, return_inverse=True)
    return distinct, which, np.bincount(which, weights=counts, minlength=len(distinct))


def _merge_grams(unit: Unit) -> Callable:
    """A wide bucket passes on what a group of batches has."""

    def merge(key, table):
        keys, _, counts = _together(table.to_pylist())
        counts = np.minimum(counts, MOST).astype(np.uint16)
        cell = key[0].as_py()
        return _rows(
            [(b, cell, GRAMS, pack(keys[c]), counts[c].tobytes(), None, None) for b, c in pieces(keys, unit.step**2)], SENT
        )

    return merge


def _answer_grams(unit: Unit) -> Callable:
    def answer(key, table):
        rows = table.to_pylist()
        _, which, total = _together(rows)
        code = np.where(total > unit.hot, HOT, np.where(total > 1, REPEATED, ALONE)).astype(np.uint8)[which]
        out, at = [], 0
        for r in rows:
            own = code[at : at + len(r["b"]) // 2]
            at += len(own)
            if own.any():
                out.append((r["batch"], GRAMS, key[0].as_py(), own.tobytes(), None, None, None))
        return _rows(out, REPLY)

    return answer


def _relay_grams(unit: Unit) -> Callable:
    """A wide bucket lays the answers of its narrow ones over what each batch of the group has sent."""

    def relay(key, sent, replies):
        rows = sent.to_pylist()
        keys, which, _ = _together(rows)
        codes = np.zeros(len(keys), dtype=np.uint8)
        found = {r["bucket"]: r["a"] for r in replies.to_pylist()}
        for bucket, cut in pieces(keys, unit.step**2):
            if bucket in found:
                codes[cut] = np.frombuffer(found[bucket], np.uint8)
        out, at = [], 0
        for r in rows:
            own = codes[which[at : at + len(r["b"]) // 2]]
            at += len(own)
            if own.any():
                out.append((r["batch"], GRAMS, r["bucket"] % unit.step, own.tobytes(), None, None, None))
        return _rows(out, REPLY)

    return relay


def _send_blocks(unit: Unit) -> Callable:
    def send(key, table, replies):
        if not table.num_rows:
            return _rows([], SENT)
        give_back()
        batch = Batch(table, replies, unit)
        batch.blocks()
        ids, starts = batch.places(batch.head)
        out = []
        for bucket, cut in batch.buckets():
            texts = batch.payload[cut]
            lengths = np.array([len(t) for t in texts], dtype=np.int32).tobytes()
            out.append((bucket, key[0].as_py(), BLOCKS, b"".join(texts), lengths, ids[cut].tobytes(), starts[cut].tobytes()))
        return _rows(out, SENT)

    return send


@dataclass
class Bucket:
    """Blocks of all batches that met in one bucket; windows are numbered block after block."""

    tokens: Tokens
    ids: np.ndarray
    starts: np.ndarray
    start: np.ndarray
    block: np.ndarray
    per_block: np.ndarray


def _open(rows: list[dict], unit: Unit) -> Bucket:
    texts: list[bytes] = []
    for r in rows:
        ends = np.cumsum(np.frombuffer(r["b"], np.int32)).tolist()
        texts += [r["a"][x:y] for x, y in zip([0, *ends], ends)]
    tokens = tokenise(texts, unit.words)
    per_block = np.diff(tokens.bounds) - unit.window + 1
    block = np.repeat(np.arange(len(texts)), per_block)
    offset = np.arange(len(block)) - np.repeat(np.cumsum(per_block) - per_block, per_block)
    ids, starts = (np.concatenate([np.frombuffer(r[c], np.int64) for r in rows]) for c in "cd")
    return Bucket(tokens, ids, starts, tokens.bounds[block] + offset, block, per_block)


def _answer_blocks(unit: Unit, decide: Callable[[Bucket, Unit], list[tuple]]) -> Callable:
    """``decide`` gives a blob for every block and column of the answer, as arrays cut by block."""

    def answer(key, table):
        give_back()
        rows = table.to_pylist()
        bucket = _open(rows, unit)
        cut = decide(bucket, unit)
        out, at = [], 0
        for r in rows:
            n = len(r["b"]) // 4
            out.append((r["batch"], BLOCKS, key[0].as_py(), *cut(at, at + n)))
            at += n
        return _rows(out, REPLY)

    return answer


def _batched(docs: DataFrame, id_col: str, text_col: str, batch_bytes: int) -> tuple[DataFrame, int]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    # The one scalar that reaches the driver: how many batches the text makes.
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = int(total // batch_bytes) + 1
    order = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))
    rest = [F.col(c) for c in docs.columns if c != text_col]
    return docs.select(
        F.pmod(F.xxhash64(order, text), F.lit(n)).cast("int").alias("__batch"), order.alias("__id"), text.cast("binary").alias("__text"), *rest
    ), n


def _copies(parts: DataFrame) -> DataFrame:
    """Documents whose whole text a smaller id has, gathered by batch."""
    own = parts.groupBy(F.unhex(F.sha2("__text", 256)).alias("__digest"), "__batch").agg(
        F.min("__id").alias("__least"), F.collect_list("__id").alias("__ids")
    )
    # A hot text is one row a batch by now.
    least = F.min("__least").over(Window.partitionBy("__digest"))
    later = F.explode(F.expr("array_distinct(filter(__ids, x -> x > __least))")).alias("__id")
    copies = own.withColumn("__least", least).select("__batch", "__digest", later)

    def gather(key, table):
        ids, digests = table["__id"].to_numpy().tobytes(), b"".join(table["__digest"].to_pylist())
        return _rows([(key[0].as_py(), COPIES, 0, ids, digests, None, None)], REPLY)

    return copies.groupBy("__batch").applyInArrow(gather, REPLY)


def repeated_windows(
    docs: DataFrame,
    unit: Callable[[int], Unit],
    decide: Callable[[Bucket, Unit], Callable],
    finish: Callable[[Batch], pa.Table],
    schema: str,
    id_col: str,
    text_col: str,
    batch_bytes: int,
) -> DataFrame:
    """Run the three passes; ``finish`` turns a batch with its answers into rows of ``schema``."""
    parts, n = _batched(docs, id_col, text_col, batch_bytes)
    unit = unit(n)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    carried = ", ".join(f"`{c}` {kinds[c]}" for c in docs.columns if c != text_col)
    copies = _copies(parts)

    def last(key, table, replies):
        out = finish(Batch(table, replies, unit))
        give_back()
        return out

    def cogroup(replies, f, out):
        return parts.groupBy("__batch").cogroup(replies.groupBy("batch")).applyInArrow(f, out)

    sent = cogroup(copies, _send_grams(unit), SENT).groupBy("bucket")
    merged = sent.applyInArrow(_merge_grams(unit), SENT)
    answered = merged.groupBy("bucket").applyInArrow(_answer_grams(unit), REPLY)
    relayed = sent.cogroup(answered.groupBy("batch")).applyInArrow(_relay_grams(unit), REPLY)
    grams = copies.unionByName(relayed)
    sent = cogroup(grams, _send_blocks(unit), SENT)
    blocks = grams.unionByName(sent.groupBy("bucket").applyInArrow(_answer_blocks(unit, decide), REPLY))

    return cogroup(blocks, last, ", ".join(x for x in (carried, schema) if x))
