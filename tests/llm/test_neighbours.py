"""Neighbour search: order of the curve, recall beside brute force, ties and unusable vectors."""

import math

import numpy as np
import pytest
from pyspark.sql import Row

from geopulse.llm import neighbours
from geopulse.llm.queries import QUERIES


def _truth(ids, x, every=50, k=5):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        score = u @ u[i]
        score[i] = -9
        order = np.lexsort((ids, -score))[: min(k, len(ids) - 1)]
        out[int(ids[i])] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def test_hilbert_neighbours_on_the_curve_are_neighbours_in_space():
    for axes, bits in ((2, 4), (3, 3)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), axis=-1).reshape(-1, axes)
        place = neighbours.hilbert(grid, bits)
        assert sorted(place.tolist()) == list(range(len(grid)))
        path = grid[np.argsort(place)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").orderBy("vec_id").collect()
    truth = _truth(np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float))
    got = {}
    for r in QUERIES["op10_neighbours"](spark, f"/root/testdata/{sf}").collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(got) == set(truth) and all(sorted(v) == [1, 2, 3, 4, 5] for v in got.values())
    hits = sum(len({a for a, _ in want} & {a for a, _ in got[q].values()}) for q, want in truth.items())
    assert hits >= 0.9 * 5 * len(truth)
    for q, want in truth.items():
        for place, (a, score) in enumerate(want, 1):
            if got[q][place][0] == a:
                assert got[q][place][1] == pytest.approx(score, abs=1e-12)


def test_copies_nulls_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [Row(vec_id=i, embedding=[1.0, 2.0, -1.0], label=None) for i in range(0, 1200, 2)]
    rows += [Row(vec_id=2001 + i, embedding=rng.standard_normal(3).tolist(), label=i) for i in range(60)]
    rows += [Row(vec_id=5000, embedding=None, label=1), Row(vec_id=5050, embedding=[0.0, 0.0, 0.0], label=1),
             Row(vec_id=5100, embedding=[1.0, None, 1.0], label=1), Row(vec_id=5150, embedding=[math.nan, 1.0, 1.0], label=1),
             Row(vec_id=5200, embedding=[math.inf, 1.0, 1.0], label=1), Row(vec_id=5250, embedding=[], label=1),
             Row(vec_id=None, embedding=[1.0, 1.0, 1.0], label=1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {}
    for r in neighbours.nearest(table, block=64).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], round(r["score"], 9)))
    assert set(got) == {i for i in range(0, 1200, 50)} | {i for i in range(2050, 2061, 50)}
    assert [v for _, v, _ in sorted(got[0])] == [2, 4, 6, 8, 10] and [v for _, v, _ in sorted(got[1000])] == [0, 2, 4, 6, 8]
    assert neighbours.nearest(table.where("vec_id > 9999")).count() == 0
    few = {tuple(r)[:3] for r in neighbours.nearest(table.where("vec_id in (0, 2, 2001)")).collect()}
    assert {(q, k) for q, k, _ in few} == {(0, 1), (0, 2)}
