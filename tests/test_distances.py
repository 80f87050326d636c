import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sumac.operators import density, neighbours


def cloud(n=160, copies=40, seed=1):
    """Two dense blobs, scattered points and a third of the rows on one spot."""
    rng = np.random.default_rng(seed)
    xy = np.vstack(
        [
            rng.normal(0, 0.05, (n // 3, 2)),
            rng.normal(1, 0.02, (n // 3, 2)),
            rng.uniform(-1, 2, (n // 3, 2)),
            np.tile([[0.5, 0.5]], (copies, 1)),
            [[50.0, 50.0]],
        ]
    )
    return xy[rng.permutation(len(xy))]


def table(spark, xy):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(xy)], "id long, x double, y double")


def brute_dbscan(xy, eps, least):
    d = np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(2))
    near = d <= eps
    core = near.sum(1) >= least
    label = np.full(len(xy), -1)
    found = 0
    for i in range(len(xy)):
        if not core[i] or label[i] >= 0:
            continue
        todo = [i]
        label[i] = found
        while todo:
            for j in np.flatnonzero(near[todo.pop()] & core):
                if label[j] < 0:
                    label[j] = found
                    todo.append(j)
        found += 1
    for i in np.flatnonzero(~core):
        around = label[near[i] & core]
        label[i] = around.min() if len(around) else -1
    return label


@pytest.mark.parametrize("direct", [density.DIRECT_PAIRS, 0])
@pytest.mark.parametrize("eps", [0.04, 0.2])
def test_dbscan_equals_brute_force(spark, monkeypatch, direct, eps):
    monkeypatch.setattr(density, "DIRECT_PAIRS", direct)
    xy = cloud()
    got = {r["id"]: r["cluster"] for r in density.dbscan(table(spark, xy), "id", ["x", "y"], eps, 5).collect()}
    assert [got[i] for i in range(len(xy))] == list(brute_dbscan(xy, eps, 5))


def test_dbscan_ignores_row_order(spark):
    df = table(spark, cloud())
    a = density.dbscan(df, "id", ["x", "y"], 0.1, 4)
    b = density.dbscan(df.orderBy(F.desc("x")), "id", ["x", "y"], 0.1, 4)
    assert sorted(a.collect()) == sorted(b.collect())


def test_dbscan_all_noise(spark):
    df = spark.createDataFrame([(i, float(i), 0.0) for i in range(5)], "id long, x double, y double")
    assert {r["cluster"] for r in density.dbscan(df, "id", ["x", "y"], 0.1, 2).collect()} == {-1}


def test_components_on_a_long_chain(spark):
    nodes = spark.range(64)
    edges = spark.range(63).filter("id != 40").select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {r["id"]: r["root"] for r in density.components(nodes, edges).collect()}
    assert got == {i: 0 if i <= 40 else 41 for i in range(64)}


@pytest.mark.parametrize("k", [1, 5])
def test_knn_equals_brute_force(spark, k):
    xy = cloud()
    got = {}
    for r in neighbours.knn(table(spark, xy), "id", ["x", "y"], k).collect():
        got[r["id"], r["rank"]] = (r["neighbour"], r["distance"])
    for i, p in enumerate(xy):
        d = np.sqrt(((xy - p) ** 2).sum(1))
        for rank, j in enumerate(sorted(range(len(xy)), key=lambda j: (d[j], j))[:k], start=1):
            assert got[i, rank] == (j, pytest.approx(d[j]))
    assert len(got) == k * len(xy)


def test_knn_with_fewer_rows_than_k(spark):
    df = spark.createDataFrame([(1, 0.0, 0.0), (2, 3.0, 4.0)], "id long, x double, y double")
    rows = sorted(tuple(r) for r in neighbours.knn(df, "id", ["x", "y"], 5).collect())
    assert rows == [(1, 1, 1, 0.0), (1, 2, 2, 5.0), (2, 1, 2, 0.0), (2, 2, 1, 5.0)]


def test_knn_imputation_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(120):
        a = None if rng.uniform() < 0.2 else float(rng.integers(0, 6)) if i % 3 else 3.0
        b = None if rng.uniform() < 0.2 else float(rng.normal())
        rows.append((i, a, b))
    df = spark.createDataFrame(rows, "id long, a double, b double")
    got = {r["id"]: (r["a"], r["b"]) for r in neighbours.impute_knn(df, "id", ["a", "b"]).collect()}

    def fill(row, target, by):
        if row[target] is not None:
            return row[target]
        if row[by] is None:
            return float(np.mean([r[target] for r in rows if r[target] is not None]))
        donors = [r for r in rows if r[target] is not None and r[by] is not None]
        donors.sort(key=lambda r: (abs(r[by] - row[by]), r[0]))
        return float(np.mean([r[target] for r in donors[:2]]))

    for row in rows:
        assert got[row[0]] == (pytest.approx(fill(row, 1, 2)), pytest.approx(fill(row, 2, 1)))


@pytest.mark.parametrize("block", [2048, 16])
def test_silhouette_equals_brute_force(spark, block):
    xy = cloud(60, 20)
    label = np.where(np.arange(len(xy)) == 3, 9, np.arange(len(xy)) % 3)
    df = spark.createDataFrame(
        [(i, [float(v) for v in p], int(c)) for i, (p, c) in enumerate(zip(xy, label))], "id long, v array<double>, c int"
    )
    got = {r["id"]: r["silhouette"] for r in density.silhouette(df, "id", F.col("v"), "c", block).collect()}
    d = np.sqrt(((xy[:, None] - xy[None]) ** 2).sum(2))
    for i in range(len(xy)):
        own = (label == label[i]).sum()
        a = d[i, label == label[i]].sum() / max(own - 1, 1)
        b = min(d[i, label == c].mean() for c in set(label) - {label[i]})
        want = 0.0 if own == 1 or max(a, b) == 0 else (b - a) / max(a, b)
        assert got[i] == pytest.approx(want, abs=1e-12)
        assert -1 <= got[i] <= 1


def test_elbow_of_a_clear_bend(spark):
    values = [0.01 * i for i in range(90)] + [0.9 + 2.0 * (i - 89) for i in range(90, 100)]
    df = spark.createDataFrame([(i + 1, v) for i, v in enumerate(values)], "rank long, d double")
    for bucket in (100_000, 7):
        row = neighbours.elbow(df, "d", bucket_rows=bucket).first()
        assert row["knee_rank"] in (90, 91) and math.isclose(row["knee"], values[row["knee_rank"] - 1])


def test_silhouettes_of_several_clusterings_at_once(spark):
    """One pass over the distances gives each clustering's own mean (F2, F4), also for near-equal long vectors."""
    rng = np.random.default_rng(8)
    x = np.concatenate([np.full((20, 12), 3.0) + rng.normal(0, 1e-7, (20, 12)), rng.normal(0, 1, (40, 12))])
    rows = [(i, v.tolist(), i % 3, i // 20) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, v array<double>, c int, d int")
    gap = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.allclose(density._gaps(x, x), gap, rtol=1e-9, atol=1e-15)
    both = {"c": df.select("id", "v", "c"), "d": df.select("id", "v", F.col("d").alias("c"))}
    got = density.mean_silhouettes(both, F.col("v"), "c", 16)
    for name, at in (("c", 2), ("d", 3)):
        of = np.array([r[at] for r in rows])
        want = []
        for i in range(len(x)):
            a = gap[i][of == of[i]].sum() / ((of == of[i]).sum() - 1)
            b = min(gap[i][of == o].mean() for o in set(of.tolist()) - {of[i]})
            want.append((b - a) / max(a, b))
        assert got[name][0] == 3 and abs(got[name][1] - np.mean(want)) < 1e-9


def test_a_leaf_with_many_questions_is_answered_in_pieces(spark, monkeypatch):
    """Tasks hold the k nearest per question and leaf, and a bounded number of questions (F5, F6)."""
    monkeypatch.setattr(neighbours, "ASKING", 7)
    monkeypatch.setattr(neighbours, "PARTITION_ASKING", 20)
    rng = np.random.default_rng(9)
    x = np.round(rng.normal(0, 1, (60, 2)), 1)
    df = spark.createDataFrame([(f"k{i:02d}", *map(float, p)) for i, p in enumerate(x)], "id string, x double, y double")
    got = {(r["id"], r["rank"]): (r["neighbour"], r["distance"]) for r in neighbours.knn(df, "id", ["x", "y"], 4).collect()}
    assert len(got) == 240
    for i, p in enumerate(x):
        near = sorted((float(np.sqrt(((p - q) ** 2).sum())), f"k{j:02d}") for j, q in enumerate(x))[:4]
        assert [got[f"k{i:02d}", r + 1] for r in range(4)] == [(n, pytest.approx(d, abs=1e-12)) for d, n in near]
