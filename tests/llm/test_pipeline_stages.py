"""Each stage of the pipeline against a plain version, on its own input."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from tablewright.llm import bpe, language, simhash_texts
from tests.conftest import SMALL
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_language_stage(spark, docs):
    model = language.train(docs)
    want = []
    for r in docs.collect():
        lang, score, _ = language.label([r["text"]], model)[0]
        if lang != "und" and score >= 0.5:
            want.append((r["doc_id"], r["text"], lang, r["source"], r["n_chars"]))
    assert rows(pipeline.language_id(spark, docs, SMALL)) == sorted(want, key=str)


def test_near_dedup_stage(spark, docs):
    """One row of each class of all pairs; the classes are joined by comparing every fingerprint with every other."""
    more = spark.createDataFrame([(None, "lone text", None, None, 9), (None, "lone text", None, None, 9), (-1, None, None, None, None)], SCHEMA)
    every = docs.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long")).unionByName(more)
    texts = [(r["doc_id"], r["text"]) for r in every.collect()]
    prints = np.array([simhash_texts.fingerprint((t or "").encode(), 5) for _, t in texts]).view(np.uint64)
    linked = np.bitwise_count(prints[:, None] ^ prints[None]).sum(axis=2) <= simhash_texts.bits_for(0.8)
    label = np.arange(len(texts))
    while True:
        new = np.array([label[linked[i]].min() for i in range(len(texts))])
        if (new == label).all():
            break
        label = new
    members = {}
    for (i, t), c in zip(texts, label):
        members.setdefault(c, []).append((1 << 63 if i is None else i, hashlib.sha256((t or "").encode()).hexdigest(), i))
    want = Counter(min(m)[2] for m in members.values())
    got = Counter(r["doc_id"] for r in pipeline.simhash_near_dedup(spark, every, SMALL).collect())
    assert got == want


def test_repeated_bytes_stage(spark):
    rng = random.Random(1)
    passage = " ".join(f"pässäge{i}" for i in range(40))
    texts = {i: " ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for i in range(6)}
    texts[3] = f"� own  {texts[3]} é{passage} end �"
    texts[4] = f"ü{passage}ß {texts[4]}"
    texts[5] = passage
    texts[7] = "uncut �"
    df = spark.createDataFrame([(i, t, None, None, len(t)) for i, t in texts.items()] + [(9, None, None, None, None)], SCHEMA)
    cut = brute.repeated_bytes(list(texts.items()))
    got = {r["doc_id"]: r for r in pipeline.suffix_array_dedup(spark, df, SMALL).collect()}
    assert 5 not in got and 9 not in got  # no word is left
    for i, t in texts.items():
        if i == 5:
            continue
        if not cut[i][1]:
            assert got[i]["text"] == t
        assert got[i]["n_chars"] == len(got[i]["text"])
    assert got[4]["text"].startswith("ü") and passage not in got[4]["text"] and got[4]["text"].endswith(texts[4][-20:])
    assert got[3]["text"] == texts[3] and got[7]["text"] == "uncut �"
    # A text that is cut keeps its own replacement and private characters and loses parts of characters at the cuts.
    later = spark.createDataFrame([(1, "é" * 60, None, None, 60), (2, "� first " + "é" * 59 + "à last �", None, None, 1)], SCHEMA)
    text = {r["doc_id"]: r["text"] for r in pipeline.suffix_array_dedup(spark, later, SMALL).collect()}[2]
    assert text == "� first  last �"


def test_mixing_stage(spark, docs):
    got = pipeline.mixing(spark, docs, SMALL).collect()
    sizes, taken = Counter(), Counter()
    texts = {r["doc_id"]: r for r in docs.collect()}
    for r in texts.values():
        sizes[r["source"]] += len((r["text"] or "").split())
    for r in got:
        whole = texts[r["doc_id"]]
        assert r["source"] == whole["source"] and r["n_chars"] == len(r["text"])
        own, all_words = r["text"].split(), whole["text"].split()
        assert own == all_words[: len(own)]
        taken[r["source"]] += len(own)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, full, total = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, set(), 1.5 * sum(sizes.values())
    while True:
        each = (total - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and each * weight[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
    for s in names:
        assert abs(taken[s] - (2 * sizes[s] if s in full else each * weight[s])) <= 1


def test_encoding_stage(spark, docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in pipeline.bpe_encoding(spark, docs, SMALL).collect():
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_encoding_stage_takes_one_worker_a_task(spark, docs):
    plan = pipeline.bpe_encoding(spark, docs, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_encode_and_decode_equals_its_steps(spark, docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(None, None), (7, ""), (7, " ")], "doc_id long, text string"))
    once = bpe.encode_and_decode(rows, path)
    twice = bpe.decode(bpe.encode(rows, path).drop("text"), path)
    assert once.columns == twice.columns
    assert sorted(map(repr, once.collect())) == sorted(map(repr, twice.collect()))


def test_stages_of_nothing(spark, docs):
    none = docs.limit(0)
    for name, stage in pipeline.STAGES:
        assert stage(spark, none, SMALL).count() == 0, name
