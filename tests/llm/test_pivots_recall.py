import numpy as np
import pytest

from tablewright.llm import pivots


def _group(rng, n, size, cosine):
    """``n`` vectors whose pairs have about this cosine."""
    centre = rng.normal(size=size)
    centre /= np.linalg.norm(centre)
    x = rng.normal(size=(n, size))
    x -= np.outer(x @ centre, centre)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return np.sqrt(cosine) * centre + np.sqrt(1 - cosine) * x


def _found(spark, x, **settings):
    x = np.float32(x)
    df = spark.createDataFrame([(i, e.tolist()) for i, e in enumerate(x)], "vec_id long, embedding array<float>")
    got = {r["vec_id"]: r for r in pivots.near_vectors(df.repartition(3), **settings).collect()}
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    return got, (u @ u.T >= 0.95).sum(axis=1) - 1


@pytest.mark.parametrize("cosine", [0.96, 0.98])
def test_a_group_of_a_third_of_the_rows(spark, cosine):
    rng = np.random.default_rng(3)
    x = np.concatenate([_group(rng, 500, 64, cosine), rng.normal(size=(1000, 64))])
    got, links = _found(spark, x)
    found = sum(got[i]["n_links"] for i in range(500))
    assert all(got[i]["n_links"] <= links[i] for i in got) and found >= 0.95 * links[:500].sum() > 0
    assert {got[i]["component_id"] for i in range(500)} == {0} and sum(got[i]["kept"] for i in got) == 1001


def test_few_pivots(spark):
    rng = np.random.default_rng(4)
    # One group alone leaves one pivot, and a single row or a single pivot no pair of them.
    for x, settings in ((_group(rng, 40, 64, 0.97), {}), (rng.normal(size=(1, 64)), {}), (_group(rng, 30, 64, 0.97), {"pivots": 1, "block": 8})):
        got, links = _found(spark, x, **settings)
        assert [got[i]["n_links"] for i in range(len(x))] == links.tolist()


def _unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _partners(rng, x, low, high):
    """A vector for each row, at a cosine between the bounds, in a random direction."""
    cosine = rng.uniform(low, high, len(x))[:, None]
    aside = rng.normal(size=x.shape)
    aside -= (aside * x).sum(axis=1, keepdims=True) * x
    return cosine * x + np.sqrt(1 - cosine**2) * _unit(aside)


@pytest.mark.parametrize("cone", [None, 0.85])
def test_recall_of_random_pairs(spark, cone):
    """Pairs at 0.951 to 0.97, among random vectors and among vectors whose cosines all exceed 0.8."""
    rng = np.random.default_rng(5)
    base = _unit(rng.normal(size=(900, 64)) if cone is None else _group(rng, 900, 64, cone))
    x = np.concatenate([base, _partners(rng, base, 0.951, 0.97)])
    got, links = _found(spark, x[rng.permutation(len(x))])
    found = sum(got[i]["n_links"] for i in got)
    assert all(got[i]["n_links"] <= links[i] for i in got)
    assert found >= 0.9 * links.sum() >= 0.9 * 1800


def test_every_length_is_indexed(spark):
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(2)] + [(2, [1.0, 2.0, 3.1]), (3, [1.0] * 5), (4, [3.0, -1.0, 0.0])]
    rows += [(5, [1.0, 0.1]), (6, [1.0, 0.11]), (7, [-1.0, 0.1]), (8, [1.0] * 5 + [0.0]), (9, [2.0] * 5)]
    rows += [(20 + i, [1.0, float(i), 2.0, 1.0]) for i in (100, 101, -3)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in pivots.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert [got[i] for i in range(10)] == [(2, 0)] * 3 + [(1, 3), (0, 4), (1, 5), (1, 5), (0, 7), (0, 8), (1, 3)]
    assert [got[i] for i in (120, 121, 17)] == [(1, 120), (1, 120), (0, 17)]


def test_rows_without_an_id_link_like_others(spark):
    rows = [(None, [1.0, 0.1, 0.0]), (None, [1.0, 0.1, 0.0]), (3, [1.0, 0.11, 0.0]), (None, [0.0, 1.0, 1.0]), (None, [0.0, 1.0, 1.01]), (9, None), (None, None)]
    got = [tuple(r) for r in pivots.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()]
    want = [(None, 2, 3, False), (None, 2, 3, False), (3, 2, 3, True), (None, 1, None, True), (None, 1, None, True), (9, 0, 9, True), (None, 0, None, True)]
    assert sorted(got, key=str) == sorted(want, key=str)
