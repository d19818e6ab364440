import base64
import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablewright.llm import bpe, language, mixing, pivots, quality, quotes, simhash, warc
from tablewright.llm.shared import components
from tablewright.llm.substring import remove_repeated_words
from tablewright.llm.suffix_dedup import remove_repeated_bytes
from tests.llm import brute

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs():
    return brute.corpus()


@pytest.fixture(scope="module")
def table(spark, docs):
    return spark.createDataFrame([(i, t, "extra") for i, t in docs], "doc_id long, text string, extra string").repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


@pytest.mark.parametrize("settings", [{}, {"batch_bytes": 4000, "hot": 3}])
def test_repeated_bytes(table, docs, settings):
    rows = remove_repeated_bytes(table, **settings).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows} == brute.repeated_bytes(docs)
    assert all(r["extra"] == "extra" and hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in rows)


@pytest.mark.parametrize("settings", [{}, {"batch_bytes": 4000, "hot": 3}])
def test_repeated_words(table, docs, settings):
    rows = remove_repeated_words(table, **settings).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows} == brute.repeated_words(docs)
    words = {i: brute.WORD.findall(t or "") for i, t in docs}
    for r in rows:
        for f in r["factors"]:
            here = words[r["doc_id"]][f["start"] : f["start"] + f["length"]]
            assert len(here) >= 20 and here == words[f["ref_id"]][f["ref_start"] : f["ref_start"] + f["length"]]


def test_repeated_rows_and_null_ids(spark):
    text = "some words that come again " * 12
    df = spark.createDataFrame([(1, text), (1, text), (None, text)], "doc_id long, text string")
    rows = {(r["doc_id"], r["n_removed"]) for r in remove_repeated_bytes(df).collect()}
    assert rows == {(1, 0), (None, len(text))}


@pytest.mark.parametrize("settings", [{}, {"batch_bytes": 300, "hot": 3}])
def test_copies_among_null_and_repeated_ids(spark, settings):
    def text(k, n=60):
        return " ".join(f"{k}w{i}" for i in range(n))

    rows = [(1, text("a")), (5, text("a")), (5, text("b")), (None, text("a")), (None, text("c")), (None, text("d") + " " + text("a"))]
    rows += [(None, text("e") + " " + text("f")), (None, text("f") + " " + text("e"))]
    # (id, text) to what is left of it; among rows of one id the earlier place stays (words), or both (bytes).
    removed = {(5, text("a")), (None, text("a"))}
    df = spark.createDataFrame([(i, t, t) for i, t in rows], "doc_id long, text string, whole string").repartition(3)
    for f, left in ((remove_repeated_bytes, {text("d") + " "}), (remove_repeated_words, {text("d")})):
        got = {(r["doc_id"], r["whole"]): bytes(r["kept"], "utf-8") if isinstance(r["kept"], str) else bytes(r["kept"]) for r in f(df, **settings).collect()}
        assert len(got) == len(rows)
        for i, t in rows:
            if t.startswith("d"):
                assert got[i, t].decode() in left
            elif (i, t) in removed:
                assert got[i, t] == b""
            elif t[0] in "ef" and f is remove_repeated_words:
                assert got[i, t].decode() == text(t[0])
            else:
                assert got[i, t].decode() == t


def test_simhash(table, docs):
    rows = simhash.near_duplicates(table).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == brute.simhash(docs)


@pytest.mark.parametrize("hot", [2048, 3])
def test_links_of_fingerprints(spark, hot):
    rng = np.random.default_rng(1)
    values = set()
    for centre in rng.integers(0, 1 << 63, 3, dtype=np.uint64):
        for _ in range(40):
            x = int(centre)
            for bit in rng.integers(0, 64, rng.integers(0, 6)):
                x ^= 1 << int(bit)
            values.add(x)
    v = np.array(sorted(values), np.uint64)
    df = spark.createDataFrame([(int(x), i) for i, x in enumerate(v.view(np.int64))], "__print long, __name long")
    got = {r["node"]: r["component"] for r in components(simhash.links(df, 3, hot)).collect()}
    want = brute.classes(np.bitwise_count(v[:, None] ^ v[None, :]) <= 3, list(range(len(v))))
    assert {i: got.get(i, i) for i in want} == want


@pytest.mark.parametrize("block", [1024, 8])
def test_vectors(spark, block):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 32))
    near = x[:100] + rng.normal(size=(100, 32)) * 0.15
    every = [*x, *near, *np.repeat(x[:2], 5, axis=0), *(x[:1] + rng.normal(size=(20, 32)) * 0.02)]
    odd = [(900, None), (901, [0.0] * 32), (902, [float("nan")] + [1.0] * 31), (903, [None] + [1.0] * 31), (904, [])]
    rows = [(i, [float(a) for a in e]) for i, e in enumerate(every)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in pivots.near_vectors(df, block=block, pivots=64).collect()}
    u = np.array([np.float32(e) for _, e in rows], dtype=np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    close = u @ u.T >= 0.95
    links = close.sum(axis=1) - 1
    found = sum(got[i]["n_links"] for i, _ in rows)
    assert all(got[i]["n_links"] <= links[i] for i, _ in rows) and found >= 0.9 * links.sum()
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i, _ in odd)


def test_components_of_a_long_chain(spark):
    edges = spark.range(1, 300).select(F.col("id").alias("a"), (F.col("id") - 1).alias("b"))
    assert components(edges).where("component <> 0").count() == 0
    assert components(edges.limit(0)).count() == 0


def test_bpe(spark, table, docs):
    library = Tokenizer.from_file(PATH)
    odd = ["It's WE'LL<|endoftext|>x <|startoftext|>", "ΑΣ Σ İ ǅ", "१२ ½ ﬁ é", "ab" * 400, "\x1c a\x85b\xa0c", "\U0001f600"]
    more = spark.createDataFrame([(1000 + i, t, "") for i, t in enumerate(odd)], table.schema)
    rows = bpe.decode(bpe.encode(table.union(more), PATH), PATH).collect()
    texts = dict(docs) | {1000 + i: t for i, t in enumerate(odd)}
    for r in rows:
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert np.frombuffer(r["ids"], "<u4").tolist() == ids
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert len(rows) == len(texts)


def test_one_tree_for_a_long_word_equals_trees_side_by_side():
    encoder = bpe.Encoder(bpe.Vocabulary.load(PATH))
    for word in (b"a", b"internationalisation", b"thethethe" * 20, bytes(range(97, 123)) * 5):
        leaves = 1 << max(1, (len(word) - 1).bit_length())
        assert encoder.long(word) == encoder.side_by_side([word], leaves)[0]


def test_quality(table, docs):
    assert "Python" not in quality.ledger(table)._jdf.queryExecution().executedPlan().toString()
    texts = dict(docs)
    rows = quality.ledger(table).collect()
    for r in rows:
        measured = r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]
        assert measured == brute.quality(texts[r["doc_id"]])
    policy = quality.POLICIES["clean_prose"]
    without = {r["rule"]: r for r in quality.ablations(quality.ledger(table), policy).collect()}
    for name in policy.rules:
        bit = 1 << quality.BY_NAME[name].bit
        assert without[name]["failing"] == sum(bool(r["failed"] & bit) for r in rows)
        assert without[name]["kept_without"] == sum(not r["failed"] & policy.mask & ~bit for r in rows)


def test_quotes(spark):
    messages = [
        (1, 0, "First  thing said.\nSecond thing."),
        (1, 1, "> first thing SAID.\nI agree."),
        (1, 2, ">> First thing said.\n> I agree.\nSo do I."),
        (1, 3, "> never said\n>\nWhat?"),
        (1, 4, None),
        (2, 0, "> I agree.\nElsewhere."),
        (None, None, "> x"),
    ]
    df = spark.createDataFrame(messages, "conv_id long, turn long, text string")
    got = {(r["conv_id"], r["turn"]): (r["text"], r["n_passages"], r["n_linked"], r["n_unlinked"], r["reply_to"]) for r in quotes.link_quotes(df).collect()}
    assert got[1, 0] == ("First  thing said.\nSecond thing.", 0, 0, 0, None)
    assert got[1, 1] == ("I agree.", 1, 1, 0, 0)
    assert got[1, 2] == ("So do I.", 2, 2, 0, 1)
    assert got[1, 3] == ("What?", 1, 0, 1, None)
    assert got[1, 4] == ("", 0, 0, 0, None)
    assert got[2, 0] == ("Elsewhere.", 1, 0, 1, None)
    assert got[None, None] == ("", 1, 0, 1, None)


def test_languages(spark):
    words = {"aa": ["the", "and", "with", "house"], "bb": ["der", "und", "mit", "haus"], "cc": ["дом", "и", "с", "это"]}
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(rng.choice(words[x], 30)), x) for i, x in enumerate(np.repeat(list(words), 12).tolist())]
    rows += [(100, None, "aa"), (101, "12 34 !", "aa"), (102, "", None), (103, "the and with house the and " * 3 + "дом и с это дом " * 3, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(df)
    got = {r["doc_id"]: r for r in language.identify(df.drop("lang"), model).collect()}
    assert all(got[i]["lang_pred"] == x for i, _, x in rows[:36])
    assert [got[i]["lang_pred"] for i in (100, 101, 102)] == ["und"] * 3 and got[100]["score"] == 0
    assert [s["lang"] for s in got[103]["spans"]] == ["aa", "cc"] and got[103]["score"] < 1


def test_mixing(spark):
    rng = np.random.default_rng(0)
    rows = [(i, "w " * int(rng.integers(0, 60)), None if k == 9 else f"s{min(k, 4)}") for i, k in enumerate(rng.integers(0, 10, 300))]
    rows += [rows[0], rows[0], (None, "a b c", "s0"), (999, None, "zz")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, block=16).collect()
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(df.repartition(5), block=16).collect()))
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight, capped, total = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, set(), 1.5 * sum(sizes.values())
    while True:
        left = total - sum(2 * sizes[s] for s in capped)
        each = left / sum(weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and each * weight[s] > 2 * sizes[s]}
        if not over:
            break
        capped |= over
    want = {s: 2 * sizes[s] if s in capped else each * weight[s] for s in names}
    ids = {(i, len((t or "").split())): s for i, t, s in rows}
    taken = dict.fromkeys(names, 0)
    for r in got:
        source = ids[r["doc_id"], r["size"]]
        assert abs(r["target"] - want[source]) < 1e-6 and r["taken"] <= 2 * r["size"]
        taken[source] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in names) and len(got) == len(rows)
    texts = mixing.mixed(df, block=16).collect()
    assert sum(len(r["text"].split()) for r in texts) == sum(taken.values())


def test_archive(spark, tmp_path):
    pages = [(3, "http://a", "héllo"), (1, "http://b", "héllo"), (2, None, None), (7, "http://c", ""), (5, "x", "one"), (None, "y", "one")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    warc.write_archive(df, f"{tmp_path}/archive")
    rows = warc.read_archive(spark, f"{tmp_path}/archive")
    got = {r["id"]: r for r in rows.collect()}
    assert {i: (r["record_type"], r["refers_to"]) for i, r in got.items()} == {
        1: ("response", None), 3: ("revisit", 1), 2: ("response", None), 7: ("revisit", 2), 5: ("response", None), None: ("revisit", 5)
    }
    for i, _, html in pages:
        payload = (html or "").encode()
        assert bytes(got[i]["payload"]) == payload and got[i]["payload_bytes"] == len(payload)
        assert got[i]["payload_digest"] == base64.b32encode(hashlib.sha1(payload).digest()).decode()
    assert spark.read.parquet(f"{tmp_path}/archive/payloads").count() == 3
    warc.write_files(rows, f"{tmp_path}/files")
    text = "".join(r["value"] for r in spark.read.text(f"{tmp_path}/files", wholetext=True).collect())
    assert len(re.findall("^WARC/1.1", text, re.M)) == len(pages) and "héllo" in text
    assert len(re.findall(r"^WARC-Date: \d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ\r$", text, re.M)) == len(pages)


def test_empty_tables(spark, nothing, tmp_path):
    texts = nothing.select("doc_id", "text")
    assert remove_repeated_bytes(texts).count() == remove_repeated_words(texts).count() == 0
    assert simhash.near_duplicates(texts).count() == 0 == quality.ledger(texts).count()
    assert bpe.decode(bpe.encode(texts, PATH), PATH).count() == 0
    assert language.identify(texts, language.train(nothing)).count() == 0
    assert mixing.mix(nothing).count() == 0 == mixing.mixed(nothing).count()
    assert pivots.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    assert quotes.link_quotes(spark.createDataFrame([], "conv_id long, turn long, text string")).count() == 0
    warc.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), f"{tmp_path}/none")
    assert warc.read_archive(spark, f"{tmp_path}/none").count() == 0
