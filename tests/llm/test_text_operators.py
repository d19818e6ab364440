"""Periodic runs, SentencePiece and spelling variants against plain versions."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tablewright.llm import pieces, runs, spelling
from tablewright.llm.registry import QUERIES
from tests.conftest import SMALL

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- periodic runs ---------------------------------------------------------------------------


def plain_runs(words):
    """Every stretch at every lag; the same stretch keeps its smallest lag."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        equal = [a == b for a, b in zip(words, words[q:])] + [False]
        start = None
        for i, same in enumerate(equal):
            if same and start is None:
                start = i
            elif not same and start is not None:
                if i - start >= max(q, 12 - q):
                    found.setdefault((start, i + q), q)
                start = None
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_collapse(words, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repeating(rng):
    n = rng.choice([0, 11, 12, 60, 300])
    words = [str(rng.randrange(rng.choice([1, 2, 3, 40, 400]))) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        if n > 12:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 2))
            words[a:] = [words[a + i % p] for i in range(n - a)]
            words[rng.randrange(n)] = "x"
    return words


def test_runs_of_random_words(spark):
    rng = random.Random(1)
    texts = [(i, " ".join(repeating(rng))) for i in range(250)]
    rows = runs.periodic_runs(spark.createDataFrame(texts, "doc_id long, text string").repartition(5)).collect()
    for r in rows:
        words = WORD.findall(r["text"])
        want = plain_runs(words)
        assert [tuple(x) for x in r["runs"]] == sorted(want, key=lambda x: (x[0], x[2]))
        assert r["collapsed"] == plain_collapse(words, want)


def test_runs_of_extreme_texts():
    # One word, two runs of it, Fibonacci words, a square of 30,000 words: stretches that lags alone would take long for.
    a, b = "a", "ab"
    while len(b) < 30000:
        a, b = b, b + a
    texts = [["a"] * 100000, ["a"] * 9000 + ["b"] + ["a"] * 9000, list(b), [str(i % 30000) for i in range(60000)]]
    found = runs._worked([" ".join(t).encode() for t in texts])[0]
    assert found[0] == [{"start": 0, "length": 100000, "period": 1}]
    assert [tuple(r.values()) for r in found[1]] == [(0, 9000, 1), (9001, 9000, 1)]
    assert found[3] == [{"start": 0, "length": 60000, "period": 30000}]
    short = runs._worked([" ".join(b[:400]).encode()])[0][0]
    assert [tuple(r.values()) for r in short] == sorted(plain_runs(list(b[:400])), key=lambda x: (x[0], x[2]))


def test_hits_that_hashes_report_are_compared(monkeypatch):
    """With hashes that say yes to everything the runs are still those of the words."""
    rng = random.Random(4)
    words = [str(rng.randrange(3)) for _ in range(300)] + [str(i % 60) for i in range(150)]
    monkeypatch.setattr(runs.Prefixes, "windows", lambda self, size: np.zeros(self.n - size + 1, np.uint64))
    found = runs._worked([" ".join(words).encode()])[0][0]
    assert [tuple(r.values()) for r in found] == sorted(plain_runs(words), key=lambda x: (x[0], x[2]))


def test_odd_texts_have_no_runs(spark):
    rows = [(None, None), (None, None), (1, ""), (2, " \n\t"), (3, "a " * 11), (3, "a " * 12), (4, "é ü " * 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, len(r["runs"]), r["collapsed"]) for r in runs.periodic_runs(df).collect())
    eleven = " ".join(["a"] * 11)
    assert got == [(0, 0, ""), (0, 0, ""), (1, 0, ""), (2, 0, ""), (3, 0, eleven), (3, 1, "a"), (4, 1, "é ü")]
    assert runs.periodic_runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(df.withColumnRenamed("doc_id", "runs"))


def test_runs_query(spark, documents):
    for r in QUERIES["op11_periodic_runs"](spark, SMALL).collect():
        words = WORD.findall(documents[r["doc_id"]] or "")
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
        found = sorted(plain_runs(words), key=lambda x: (x[0], x[2])) if n <= 700 else None
        if found is None:
            continue
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(found), *best)
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if found else None)
        assert r["runs_sha256"] == sha("".join(f"{s},{m},{q}\n" for s, m, q in found))
        assert r["collapsed_sha256"] == sha(plain_collapse(words, found))


# -- SentencePiece ---------------------------------------------------------------------------


def test_pieces_equal_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(2)
    alphabets = ["abcde  \n\t", "éèàü ñ▁  ", "日本語かな ", "😀👍🏽 ", "\x00\x01​　\r ", "<s></s><unk><0x41> ", "0123456789 ", "аб ع "]
    texts = [None, "", " ", "\n", "a" * 5000, " " * 300, "é" * 200 + "\U0010ffff", *alphabets]
    texts += ["".join(rng.choices(rng.choice(alphabets) + rng.choice(alphabets), k=rng.randint(1, 90))) for _ in range(1500)]
    df = spark.createDataFrame([(i % 7 or None, t, "extra") for i, t in enumerate(texts)], "doc_id long, text string, decoy string")
    rows = pieces.decode(pieces.encode(df, MODEL), MODEL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = library.encode(r["text"] or "", add_eos=True)
        assert r["ids"] == want and r["decoded"] == library.decode(want) and r["decoy"] == "extra"


def test_a_chunk_table_starts_anew(monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    monkeypatch.setattr(pieces, "TABLE_BYTES", 100)
    table = pieces.ChunkTable(pieces.Model.load(MODEL))
    for text in ("one two two three", "three four one", "", "zwölf Boxkämpfer"):
        assert table.encode([text, None]).to_pylist() == [library.encode(text, add_eos=True), [2]]


def test_pieces_of_odd_rows(spark):
    df = spark.createDataFrame([(1, None), (2, [2]), (3, [99999, -1, 28705, 259])], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["decoded"] for r in pieces.decode(df, MODEL).collect()} == {1: "", 2: "", 3: "  "}
    assert pieces.encode(spark.createDataFrame([], "text string"), MODEL).count() == 0
    with pytest.raises(ValueError):
        pieces.encode(spark.createDataFrame([("a", 1)], "text string, ids long"), MODEL)


def test_pieces_query(spark, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = QUERIES["op12_sentencepiece_encoding_and_decoding"](spark, SMALL).collect()
    assert {r["doc_id"] for r in rows} == set(documents)
    for r in rows:
        ids = library.encode(documents[r["doc_id"]] or "", add_eos=True)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == sha(" ".join(map(str, ids)))
        assert r["decoded_sha256"] == sha(library.decode(ids))


# -- spelling variants -----------------------------------------------------------------------


def edits(word, letters):
    cut = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    out = {a + b[1:] for a, b in cut if b} | {a + c + b for a, b in cut for c in letters} | {a + c + b[1:] for a, b in cut if b for c in letters}
    return out - {word}


def plain_variants(counts):
    letters = {c for w in counts for c in w}
    out = {}
    for w, n in counts.items():
        near = [x for x in edits(w, letters) if x in counts]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form = best if best and counts[best] >= 5 * n else None
        out[w] = [form, None, n, len(near), counts[form] if form else None]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(x) for w, x in out.items()}


def random_words(rng, many):
    letters = "abeiortszéüñ"
    words = {"".join(rng.choice(letters[: rng.randint(2, 12)]) for _ in range(rng.randint(6, 10))) for _ in range(many)}
    for w in sorted(words)[: many // 2]:
        words.add(rng.choice(sorted(edits(w, letters))))
    return sorted(w for w in words if len(w) >= 6)


@pytest.mark.parametrize("block", [20_000, 30])
def test_near_pairs(spark, block):
    words = random_words(random.Random(3), 900)
    df = spark.createDataFrame([(w,) for w in words], "word string").repartition(3)
    got = [frozenset((r["a"], r["b"])) for r in spelling.near_pairs(df, block).collect()]
    letters = {c for w in words for c in w}
    there = set(words)
    assert len(got) == len(set(got))
    assert set(got) == {frozenset((w, x)) for w in words for x in edits(w, letters) & there}


def test_near_pairs_of_very_long_words(spark, monkeypatch):
    """Letter counts beyond what beginnings tell apart, and rows as wide as the longest word."""
    words = ["e" * n + t for n in (254, 255, 256, 257, 700) for t in ("", "t", "tt", "a", "zq")] + ["abcdef", "abcdeg"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = [frozenset((r["a"], r["b"])) for r in spelling.near_pairs(df).collect()]
    there = set(words)
    assert len(got) == len(set(got))
    assert set(got) == {frozenset((w, x)) for w in words for x in edits(w, "etazqabcdfg") & there}


def test_a_damaged_run_may_equal_another(monkeypatch):
    monkeypatch.setattr(spelling.zlib, "crc32", lambda run, start=0: 0)
    assert spelling._damaged([b"xabcdef", b"abcdef", b"abcdef"], 0, 199) == {b"abcdef": 1, b"bcdef": 2}


def test_forms_and_roots(spark):
    rng = random.Random(5)
    counts = {w: rng.choice([5, 6, 25, 30, 125, 700, 4000]) for w in random_words(rng, 700)}
    chain = {"abcdefgh" + "z" * i: 5 * 5**i for i in range(7)}  # each goes to the next
    counts |= chain | {"mmmmmma": 5, "mmmmmmb": 25, "mmmmmmc": 25}
    rows = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    got = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    want = plain_variants(counts)
    assert got == want and got["mmmmmma"][0] == "mmmmmmb" and got["abcdefgh"][1] == "abcdefgh" + "z" * 6


def test_words_of_odd_texts(spark):
    rows = [(None, "Straße straße STRASSE", 1), (1, None, 2), (1, "", 3), (2, "ÀÉÎõüñ x2 longer-word", 4), (2, "ÀÉÎõüñ x2 longer-word", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long")
    got = {r["word"]: r["n"] for r in spelling.word_counts(df).collect()}
    assert got == {"straße": 2, "strasse": 1, "ÀÉÎõüñ": 2, "longer": 2}
    assert spelling.variants(df.limit(0).selectExpr("text AS word", "n")).count() == 0


def test_spelling_query(spark, documents):
    counts = collections.Counter()
    for i, text in documents.items():
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    want = plain_variants({w: n for w, n in counts.items() if n >= 5})
    rows = QUERIES["op13_spelling_variant_grouping"](spark, SMALL).collect()
    assert {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows} == want
