"""The partition tree and the neighbour search on it, on uneven data."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sumac.operators import cells
from sumac.operators.cells import CellTree
from sumac.operators.neighbours import knn

RNG = np.random.default_rng(2)
EVEN = [tuple(map(float, p)) for p in RNG.normal(0, 1, (400, 2))]
TIED = [(0.0, float(y)) for y in range(300)] + [(1e300, 0.0), (-1e300, 5.0)] + [(float(x), 0.0) for x in range(60)]
DENSE = EVEN[:100] + [(1 + 1e-9 * i, 1.0) for i in range(150)] + [(1.0, 1.0)] * 70 + [(1e9, 1e9)]


def brute(points, k):
    rows = {}
    for i, p in enumerate(points):
        near = sorted((math.hypot(p[0] - q[0], p[1] - q[1]), j) for j, q in enumerate(points))[:k]
        rows |= {(i, rank): d for rank, (d, _) in enumerate(near, 1)}
    return rows


@pytest.mark.parametrize("points, k", [(EVEN, 10), (DENSE, 5), (EVEN[:7], 10), ([], 3), ([(2.0, 2.0)] * 9, 4)])
def test_knn(spark, monkeypatch, points, k):
    monkeypatch.setattr("sumac.operators.neighbours.LEAF", 16)
    table = spark.createDataFrame([(i, *p) for i, p in enumerate(points)] + [(9999, None, 1.0)], "id long, x double, y double")
    got = {(r["id"], r["rank"]): r["distance"] for r in knn(table, "id", ["x", "y"], k).collect()}
    assert got == pytest.approx(brute(points, k), rel=1e-12, abs=1e-9)


@pytest.mark.parametrize("broadcast", [0, 100_000])
def test_tree(spark, monkeypatch, broadcast):
    monkeypatch.setattr(cells, "BROADCAST_CELLS", broadcast)
    table = spark.createDataFrame(sorted(set(TIED)), "a double, b double").withColumn("_w", F.lit(1))
    tree = CellTree(table, ["a", "b"], cap=20)
    placed = tree.points.collect()
    assert sorted((r["a"], r["b"]) for r in placed) == sorted(set(TIED))
    sizes = {}
    for r in placed:
        sizes.setdefault(r["_cell"], []).append((r["a"], r["b"]))
    assert max(map(len, sizes.values())) <= 20
    balls = spark.createDataFrame([(3.0, 3.0, 4.0), (0.0, 250.0, 10.5)], "qa double, qb double, _reach double")
    met = {(r["qa"], r["_cell"]) for r in tree.touched(balls, ["qa", "qb"]).collect()}
    for x, y, reach in [(3.0, 3.0, 4.0), (0.0, 250.0, 10.5)]:
        assert {c for c, ps in sizes.items() if any(math.hypot(a - x, b - y) <= reach for a, b in ps)} <= {c for q, c in met if q == x}
        assert len([1 for q, _ in met if q == x]) < len(sizes) / 2
