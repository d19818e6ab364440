"""Language identification: letters, scripts, the choice of the sample, and Viterbi against a plain version."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm import language

WORDS = {"en": ["the", "and", "with", "house", "river"], "fr": ["le", "et", "avec", "maison", "rivière"]}


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(WORDS[x], k=40)), x) for i, x in enumerate(["en", "fr"] * 40)]
    return language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_only_texts_without_letters_are_unknown(model):
    none = [None, "", " \n", "½ ² Ⅷ 12", "_ __ 3.4", "!?"]
    assert [x[:2] for x in language.label(none, model)] == [("und", 0.0)] * len(none)
    some = language.label(["Привет мир", "日本", "x½y", "the²house and ½ river"], model)
    assert all(lang in WORDS for lang, _, _ in some)
    assert [score for _, score, _ in some[:2]] == [0.0, 0.0]  # learned, but nothing speaks for it
    assert some[3][:2] == ("en", 1.0)
    assert language.words("Ab½c_d ²e Ⅷ3f") == ["ab", "c", "d", "e", "f"]


def plain_viterbi(emitted, penalty):
    """Best labels of one document over all paths, kept as whole paths."""
    best = {k: (emitted[0][k], [k]) for k in range(len(emitted[0]))}
    for row in emitted[1:]:
        best = {
            k: max(((score - (penalty if path[-1] != k else 0) + row[k], path[-1] == k, path + [k]) for score, path in best.values()), key=lambda x: (x[0], x[1]))[::2]
            for k in range(len(row))
        }
    return max(best.values(), key=lambda x: x[0])


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(3)
    sizes = np.array([1, 7, 3, 0, 12, 5])
    emitted = rng.normal(scale=4, size=(sizes.sum(), 3))
    labels = language.viterbi(emitted, sizes, 6.0)
    at = 0
    for n in sizes:
        if n:
            own, path = emitted[at : at + n], labels[at : at + n]
            score = own[np.arange(n), path].sum() - 6.0 * (np.diff(path) != 0).sum()
            assert score == pytest.approx(plain_viterbi(own.tolist(), 6.0)[0])
        at += n


def test_the_sample_is_the_smallest_hashes(spark):
    docs = spark.range(30000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 50 > 0, "en").otherwise("fr").alias("lang"))
    ids = docs.select("lang", F.col("doc_id").alias("id"), F.xxhash64("doc_id").alias("dealt"))
    got = {r["__id"] for r in language._chosen(ids, 40).collect()}
    by = {}
    for r in ids.collect():
        by.setdefault(r["lang"], []).append((r["dealt"] % (1 << 32), r["dealt"], r["id"]))
    assert got == {i for rows in by.values() for _, _, i in sorted(rows)[:40]}


def test_ids_that_repeat(spark):
    """A third of all rows bear one id: they are documents of their own, and no more than asked for train."""
    rng = random.Random(2)
    rows = [(0 if i % 3 else i, " ".join(rng.choices(WORDS["en"], k=5)), "en") for i in range(900)] + [(None, "le et", "fr")] * 30
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    ids = df.select("lang", F.col("doc_id").alias("id"), F.xxhash64("doc_id").alias("dealt"))
    chosen = language._chosen(ids, 20).collect()
    assert len(chosen) == 21 and None in {r[0] for r in chosen}
    model = language.train(df, per_language=20, penalty=1.0)
    assert model.languages == ["en", "fr"]
    assert {r["lang_pred"] for r in language.identify(df.select("text"), model).collect()} == {"en", "fr"}
    assert language.train(df, per_language=20).weights.shape[1] == 2


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = language.train(docs)
    rows = language.identify(docs.where(language.held_out()), model).where("lang IS NOT NULL").select("lang", "lang_pred").collect()
    right = Counter(r["lang"] == r["lang_pred"] for r in rows if r["lang_pred"] != "und")
    assert right[True] / sum(right.values()) > 0.97
