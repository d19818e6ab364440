import pytest

from tablewright.llm import mixing


@pytest.mark.parametrize(
    "words",
    [
        [2892754, 3047286, 500, 4801854, 1139410, 1576638],
        [2000000, 1, 3000000, 100, 20000, 1025, 700],
        [1024, 1024, 1024],
    ],
)
def test_every_source_gets_its_slots(spark, words):
    names = [f"s{i}" for i in range(len(words) - 1)] + [None]
    goals = spark.createDataFrame([(s, w, float(w)) for s, w in zip(names, words)], "source string, source_size long, target double")
    rows = mixing.schedule(goals, 1024).collect()
    assert len({r["slot"] for r in rows}) == len(rows)
    for s, w in zip(names, words):
        own = sorted((r["rank"], r["slot"], r["take"]) for r in rows if r["source"] == s)
        assert [r for r, _, _ in own] == list(range(-(-w // 1024)))
        assert [x for _, x, _ in own] == sorted(x for _, x, _ in own)
        assert sum(t for _, _, t in own) == w and all(0 < t <= 1024 for _, _, t in own)
