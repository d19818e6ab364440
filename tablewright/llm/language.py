"""Language identification: script ranges, then Viterbi over per-word scores with a switching penalty.

A word is a run of letters. The script of its first letter narrows the candidate languages to those that write
at least one in a hundred of their training words in it; each candidate scores the word by the log
probabilities of its hashed character 1- to 4-grams. A Viterbi pass over a document's words, in which a change
of language costs ``penalty`` nats, labels spans; the document's language is the one with most letters.

A word in a script that no training language uses has all of them for candidates.

Training takes at most ``per_language`` labelled documents of every language, those with the smallest hashes of their ids,
whole. Documents are counted by language first, and only ids whose hash lies below a share that leaves about twice as
many are shuffled and ranked. The model has ``1 << FEATURE_BITS`` features a language, for ``MOST_LANGUAGES`` at most.

Defined cases: a text that is null or has no letters is ``und`` with score 0 and no spans; without any training rows every
text is. A text that no training language's script occurs in gets a learned language with score 0. Rows that share an id
are documents of their own. Ties go to the language first by code point.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from tablewright.llm.shared import give_back, kept

FEATURE_BITS = 16
UNKNOWN = "und"
#: A model of more languages would not fit the workers: 65,536 numbers each.
MOST_LANGUAGES = 1024
#: The sample's ids are broadcast up to this many (16 MB of longs), and joined by a shuffle beyond.
MOST_BROADCAST = 1 << 21
#: First letters of ranges of code points that one script uses, and its name.
SCRIPTS = (
    (0x0000, "latin"),
    (0x0370, "greek"),
    (0x0400, "cyrillic"),
    (0x0530, "armenian"),
    (0x0590, "hebrew"),
    (0x0600, "arabic"),
    (0x0900, "devanagari"),
    (0x0980, "other indic"),
    (0x0E00, "thai"),
    (0x0E80, "other asian"),
    (0x10A0, "georgian"),
    (0x1100, "hangul"),
    (0x1200, "other"),
    (0x1E00, "latin"),
    (0x1F00, "greek"),
    (0x2000, "other"),
    (0x3040, "kana"),
    (0x3100, "other"),
    (0x3400, "han"),
    (0xA000, "other"),
    (0xAC00, "hangul"),
    (0xD7B0, "other"),
    (0xF900, "han"),
    (0xFB00, "other"),
    (0x20000, "han"),
)
_FIRST = [first for first, _ in SCRIPTS]
NAMES = sorted({name for _, name in SCRIPTS})
_NUMBER = np.array([NAMES.index(name) for _, name in SCRIPTS])
_WORD = re.compile(r"[^\W\d_]+")
_SLICE = 2 << 20


@dataclass
class Model:
    languages: list[str]
    #: Log probability of a feature by language, and whether a language writes in a script.
    weights: np.ndarray
    writes: np.ndarray
    penalty: float


def words(text: str) -> list[str]:
    """Runs of letters; what counts as a word's character without being a letter, like a fraction, separates them."""
    out: list[str] = []
    for w in _WORD.findall(text.lower()):
        out += [w] if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split()
    return out


def features(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed grams of 1 to 4 characters of every word (its ends marked), and where each word's begin."""
    joined = "".join(f" {w} " for w in batch)
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in batch], dtype=np.int64)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    left = np.repeat(bounds[1:], sizes) - np.arange(len(codes))
    hashes, keep = [], []
    h = np.zeros(len(codes), dtype=np.uint64)
    for n in range(1, 5):
        shifted = np.concatenate([codes[n - 1 :], np.zeros(n - 1, np.uint64)])
        h = (h + shifted + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        hashes.append((h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - FEATURE_BITS))
        keep.append(left >= n)
    keep = np.stack(keep, axis=1)
    found = np.stack(hashes, axis=1)[keep].astype(np.int64)
    per_word = np.add.reduceat(keep.sum(axis=1), bounds[:-1]) if len(batch) else np.zeros(0, np.int64)
    return found, np.concatenate([[0], np.cumsum(per_word)])


def script(batch: list[str]) -> np.ndarray:
    return _NUMBER[np.searchsorted(_FIRST, [ord(w[0]) for w in batch], side="right") - 1]


def held_out(id_col: str = "doc_id") -> Column:
    """Documents that nothing is learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(0)) % 4 == 2


def _chosen(ids: DataFrame, per_language: int) -> DataFrame:
    """``__id``: of each language the ``per_language`` ids with the smallest hashes. The hashes are read as fractions: below
    twice ``per_language`` over the count lie enough of them, unless ids repeat; then the share is raised."""
    counts = kept(ids.groupBy("lang").agg(F.count("*").alias("n")))
    languages = counts.count()
    if languages > MOST_LANGUAGES:
        raise ValueError(f"{languages} languages are more than {MOST_LANGUAGES}")
    share, fraction = 2 * per_language, F.pmod("dealt", F.lit(1 << 32)) / (1 << 32)
    order = Window.partitionBy("lang").orderBy(F.pmod("dealt", F.lit(1 << 32)), "dealt", "id")
    while True:
        few = ids.join(F.broadcast(counts), "lang").where(fraction < F.lit(float(share)) / F.col("n"))
        few = few.select("lang", "id", "dealt").distinct()
        ranked = kept(few.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language).select("lang", "id"))
        got = ranked.groupBy("lang").agg(F.count("*").alias("got"))
        short = counts.join(got, "lang", "left").where((F.col("n") > share) & (F.coalesce("got", F.lit(0)) < per_language))
        if short.isEmpty():
            break
        share *= 64
    chosen = ranked.select(F.col("id").alias("__id")).distinct()
    return F.broadcast(chosen) if languages * per_language <= MOST_BROADCAST else chosen


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = 400, penalty: float = 6.0
) -> Model:
    """Counts of grams and scripts by language, from a bounded sample that is not held out."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col))
    labelled = labelled.select(
        F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id"), F.xxhash64(F.col(id_col)).alias("dealt")
    )
    chosen = _chosen(labelled.select("lang", "id", "dealt"), per_language)
    sample = labelled.join(chosen, labelled["id"].eqNullSafe(chosen["__id"]), "left_semi")
    # Of rows that share an id some may be too many; a task sends ``per_language`` of a language at most.
    order = Window.partitionBy("lang").orderBy("dealt", "id", F.xxhash64("text"))
    sample = sample.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_language)

    def count(batches):
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                found = words(text)
                if not found:
                    continue
                grams, n = np.unique(features(found)[0], return_counts=True)
                kinds, k = np.unique(script(found), return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {"lang": [lang] * (len(grams) + len(kinds)), "gram": np.concatenate([grams, -1 - kinds]), "n": np.concatenate([n, k])}
                )

    counts = sample.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    # At most 65,536 features and a few scripts for each language.
    rows = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(rows["lang"].to_pylist()))
    number = {x: i for i, x in enumerate(languages)}
    who = np.array([number[x] for x in rows["lang"].to_pylist()], dtype=np.int64)
    gram, n = rows["gram"].to_numpy(), rows["n"].to_numpy()
    table = np.zeros((1 << FEATURE_BITS, len(languages)))
    table[gram[gram >= 0], who[gram >= 0]] = n[gram >= 0]
    writes = np.zeros((len(NAMES), len(languages)))
    writes[-1 - gram[gram < 0], who[gram < 0]] = n[gram < 0]
    weights = np.log(table + 0.5) - np.log(table.sum(axis=0) + 0.5 * len(table)) if languages else table
    writes = writes >= 0.01 * np.maximum(writes.sum(axis=0), 1)
    return Model(languages, weights, writes & (writes.sum(axis=0) > 0), penalty)


def scores(batch: list[str], model: Model) -> np.ndarray:
    """Of each word the log probability by language; none where the language doesn't write in its script, though another
    does."""
    found, bounds = features(batch)
    out = np.add.reduceat(model.weights[found], bounds[:-1], axis=0)
    possible = model.writes[script(batch)]
    return np.where(possible | ~possible.any(axis=1, keepdims=True), out, -1e6)


def viterbi(emitted: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """Labels of the words of several documents (one after another), all documents in step."""
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    sizes, starts = sizes[order], starts[order]
    n_langs = emitted.shape[1]
    came = np.zeros((len(emitted), n_langs), dtype=np.int8 if n_langs < 128 else np.int32)
    steps = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(steps), side="left")
    best = np.zeros((len(sizes), n_langs))
    own = np.arange(n_langs)
    for t in range(steps):
        k = active[t]
        at = starts[:k] + t
        now = best[:k]
        if t:
            top = now.argmax(axis=1)
            switch = now[np.arange(k), top][:, None] - penalty
            stay = now >= switch
            came[at] = np.where(stay, own, top[:, None])
            now = np.where(stay, now, switch)
        best[:k] = now + emitted[at]
    labels = np.zeros(len(emitted), dtype=np.int64)
    label = best.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        k = active[t]
        at = starts[:k] + t
        labels[at] = label[:k]
        label[:k] = came[at, label[:k]] if t else label[:k]
    return labels


def label(texts: list[str | None], model: Model) -> list[tuple[str, float, list[dict]]]:
    """Language, score and spans of each text."""
    split = [words(t) if t else [] for t in texts]
    sizes = np.array([len(w) for w in split], dtype=np.int64)
    numbers: dict[str, int] = {}
    which = np.array([numbers.setdefault(w, len(numbers)) for ws in split for w in ws], dtype=np.int64)
    if not len(which) or not model.languages:
        return [(UNKNOWN, 0.0, []) for _ in texts]
    distinct = list(numbers)
    table = np.concatenate([scores(distinct[a : a + 5_000], model) for a in range(0, len(distinct), 5_000)])
    known = np.concatenate([model.writes[script(distinct)].any(axis=1)])[which]
    letters = np.array([len(w) for w in distinct])[which]
    langs = viterbi(table[which], sizes, model.penalty)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    doc = np.repeat(np.arange(len(texts)), sizes)
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (langs[1:] != langs[:-1])]))
    lengths = np.diff(np.append(new, len(doc)))
    spans: list[list[dict]] = [[] for _ in texts]
    for d, start, n, lang in zip(doc[new].tolist(), (new - bounds[doc[new]]).tolist(), lengths.tolist(), langs[new].tolist()):
        spans[d].append({"first_word": start, "n_words": n, "lang": model.languages[lang]})
    cells = len(texts) * len(model.languages)
    share, any_script = (
        np.bincount(doc * len(model.languages) + langs, weights=w, minlength=cells).reshape(len(texts), -1) for w in (letters * known, letters)
    )
    total = np.bincount(doc, weights=letters, minlength=len(texts))
    out = []
    for d in range(len(texts)):
        if total[d] <= 0:
            out.append((UNKNOWN, 0.0, []))
            continue
        top = int((share[d] if share[d].any() else any_script[d]).argmax())
        out.append((model.languages[top], float(share[d, top] / total[d]), spans[d]))
    return out


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (its share of the letters) and ``spans`` in numbers of words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    taken = {"lang_pred", "score", "spans"} & set(docs.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} are there already")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    shape = pa.list_(pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("lang", pa.string())]))

    def run(batches):
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_pylist()
            start = total = 0
            for i, size in enumerate(sizes):
                total += size
                if total >= _SLICE or i == len(sizes) - 1:
                    part = batch.slice(start, i + 1 - start)
                    lang, score, spans = zip(*label(part.column(text_col).to_pylist(), shared.value))
                    columns = [*part.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(spans, shape)]
                    yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "lang_pred", "score", "spans"])
                    start, total = i + 1, 0
            give_back()

    spans = "array<struct<first_word:long,n_words:long,lang:string>>"
    return docs.mapInArrow(run, f"{schema}, lang_pred string, score double, spans {spans}")
