import numpy as np
import pytest
from helpers import classes

from snapledger.llm import embeddings as em


def planted(seed, n=300, dim=64):
    rng = np.random.default_rng(seed)
    rows = list(rng.standard_normal((n, dim)))
    for k in range(60):
        rows.append(rows[k % 20] * rng.uniform(0.1, 9) + rng.standard_normal(dim) * rng.uniform(0, 0.4))
    rows += [rows[3], rows[3], rows[5] * 2]
    return [np.float32(r).tolist() for r in rows]


def expected(vectors, usable):
    rows = np.array([v if u else [1.0] * 64 for v, u in zip(vectors, usable)])
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    near = (rows @ rows.T >= em.THRESHOLD) & np.outer(usable, usable)
    np.fill_diagonal(near, False)
    return near


@pytest.mark.parametrize("group", [4096, 5])
def test_links_are_those_of_all_pairs(spark, monkeypatch, group):
    monkeypatch.setattr(em, "GROUP", group)
    vectors = planted(1) + [None, [], [0.0] * 64, [float("nan")] + [1.0] * 63, [None] + [1.0] * 63, [float("inf")] + [0.0] * 63, [1.0, 2.0]]
    usable = np.array([bool(v) and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vectors])
    near = expected(vectors, usable)
    found = classes(range(len(vectors)), zip(*np.nonzero(near)))
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, code string, n int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in em.near_duplicates(frame.repartition(3)).collect()}
    assert got == {i: (int(near[i].sum()), found[i], found[i] == i) for i in range(len(vectors))} and near.any()


def test_estimates_are_unbiased_and_bounds_hold():
    rng = np.random.default_rng(3)
    x = em.units(list(rng.standard_normal((400, 64))), 64)
    y = em.units(list(x + 0.05 * rng.standard_normal((400, 64))), 64)
    turn = em.rotation(64, 0)
    a, b = x @ turn.T, y @ turn.T
    sign, factor = np.where(a >= 0, 1.0, -1.0), np.abs(a).sum(1) / 8
    estimate = (sign * b).sum(1) / 8 / factor
    true = (x * y).sum(1)
    assert abs((estimate - true).mean()) < 0.01
    upper = np.diag(em.upper_bounds(sign, factor, a, np.where(b >= 0, 1.0, -1.0), np.abs(b).sum(1) / 8, b))
    assert (upper >= true).all()


def test_bands_reach_the_recall():
    bits, bands = em.band_plan(50_000, 0.9, 0.999)
    agree = (1 - np.arccos(0.9) / np.pi) ** bits
    assert 1 - (1 - agree) ** bands >= 0.999


def test_missing_ids_and_an_empty_table(spark):
    frame = spark.createDataFrame([(3, [1.0, 0.0]), (None, [1.0, 0.0]), (None, [0.0, 1.0]), (3, [1.0, 0.0])], "vec_id long, embedding array<double>")
    got = sorted(str(tuple(r)) for r in em.near_duplicates(frame).collect())
    assert got == sorted(["(3, 2, 3, True)", "(3, 2, 3, True)", "(None, 2, 3, False)", "(None, 0, None, False)"])
    assert em.near_duplicates(frame.filter("false")).collect() == []
