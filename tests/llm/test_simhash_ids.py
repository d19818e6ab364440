import corpus_pipeline
from tablewright.llm.simhash import near_duplicates


def _text(k):
    return " ".join(f"{k}{i}" for i in range(400))


#: Near copies, in pairs: A and its copy, B and its copy; unrelated texts else.
A, B, C = _text("a"), _text("b"), _text("c")
ROWS = [(5, A), (7, B), (None, A.upper()), (None, B.upper()), (None, C), (None, C.upper()), (9, _text("d")), (9, _text("e")), (11, _text("e").upper())]


def _table(spark):
    rows = [(i, t, "aa", "s", len(t)) for i, t in ROWS]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)


def test_rows_without_an_id_do_not_join_classes(spark):
    df = _table(spark).selectExpr("doc_id", "text", "text as whole")
    got = {(r["doc_id"], r["whole"]): r["component_id"] for r in near_duplicates(df).collect()}
    assert got == {
        (5, A): 5, (None, A.upper()): 5, (7, B): 7, (None, B.upper()): 7, (None, C): None, (None, C.upper()): None,
        (9, _text("d")): 9, (9, _text("e")): 9, (11, _text("e").upper()): 9,
    }
    # A shared id alone links nothing: the two texts of 9 are two classes.
    classes = {r["whole"]: r["k"] for r in near_duplicates(df, class_col="k").collect()}
    assert classes[_text("d")] != classes[_text("e")] == classes[_text("e").upper()] and len(set(classes.values())) == 5


def test_the_stage_keeps_one_document_of_every_class(spark):
    kept = corpus_pipeline.simhash_near_dedup(spark, _table(spark), "").collect()
    assert sorted(r["text"].lower() for r in kept) == sorted([A, B, C, _text("d"), _text("e")])
    assert {(r["doc_id"], r["text"]) for r in kept} >= {(5, A), (7, B), (9, _text("d")), (9, _text("e"))}
