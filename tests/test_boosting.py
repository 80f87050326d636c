"""Boosted trees against a plain reimplementation on small data, with penalties, bounds, missing values and a validation loss."""

import numpy as np
import pytest

from sumac.operators import boosting
from sumac.operators.boosting import BoostedTrees, HistogramBoosting
from sumac.session import scratch_path

RNG = np.random.default_rng(4)
N = 160
X = np.stack([RNG.integers(0, 12, N).astype(float), RNG.integers(0, 5, N).astype(float)], axis=1)
X[RNG.choice(N, 15, replace=False), 1] = np.nan
Y = np.where(X[:, 0] > 6, -2.0, 1.5) + np.nan_to_num(X[:, 1], nan=4.0) * 0.7 + RNG.normal(0, 0.3, N)


def frame(spark, y=Y, more=()):
    rows = [(float(a), None if np.isnan(b) else float(b), float(c)) for (a, b), c in zip(X, y)]
    return spark.createDataFrame([*rows, (1.0, 1.0, None), *more], "a double, b double, label double").repartition(3)


def soft(g, l1):
    return np.sign(g) * max(abs(g) - l1, 0)


def plain(x, y, trees, depth, rate, l1, l2, signs, loss="squared"):
    base = y.mean() if loss == "squared" else np.log(y.mean() / (1 - y.mean()))
    margin = np.full(len(y), base)

    def grow(rows, value, level, low, high, g, h, out):
        best = None
        for f in range(x.shape[1]):
            v = x[rows, f]
            for t in np.unique(x[~np.isnan(x[:, f]), f]):
                for missing_left in (False, True) if np.isnan(v).any() else (False,):
                    left = rows[np.where(np.isnan(v), missing_left, v <= t)]
                    right = np.setdiff1d(rows, left)
                    if not len(left) or not len(right) or min(h[left].sum(), h[right].sum()) < 1:
                        continue
                    a, b = (np.clip(-soft(g[s].sum(), l1) / (h[s].sum() + l2), low, high) for s in (left, right))
                    cost = [g[s].sum() * w + (h[s].sum() + l2) * w * w / 2 + l1 * abs(w) for s, w in ((rows, value), (left, a), (right, b))]
                    gain = cost[0] - cost[1] - cost[2]
                    if signs[f] * (b - a) >= 0 and gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best = (gain, f, left, right, a, b)
        if level == depth or best is None:
            out[rows] = value * rate
            return
        _, f, left, right, a, b = best
        middle = (a + b) / 2
        one, two = ((low, high), (low, high)) if not signs[f] else ((low, middle), (middle, high)) if signs[f] > 0 else ((middle, high), (low, middle))
        grow(left, a, level + 1, *one, g, h, out)
        grow(right, b, level + 1, *two, g, h, out)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = (margin - y, np.ones(len(y))) if loss == "squared" else (p - y, p * (1 - p))
        out = np.zeros(len(y))
        grow(np.arange(len(y)), -soft(g.sum(), l1) / (h.sum() + l2), 0, -np.inf, np.inf, g, h, out)
        margin = margin + out
    return margin if loss == "squared" else 1 / (1 + np.exp(-margin))


@pytest.mark.parametrize("l1, l2, monotone", [(0.0, 1.0, {}), (2.0, 5.0, {"b": -1}), (0.0, 0.5, {"a": 1})])
def test_against_plain(spark, l1, l2, monotone):
    model = HistogramBoosting(trees=3, depth=3, rate=0.3, l1=l1, l2=l2, monotone=monotone).fit(frame(spark), ["a", "b"], "label")
    wanted = plain(X, Y, 3, 3, 0.3, l1, l2, [monotone.get(c, 0) for c in "ab"])
    assert np.allclose(model.margins(X), wanted)
    got = sorted(r["prediction"] for r in model.transform(frame(spark)).filter("label is not null").collect())
    assert np.allclose(got, sorted(wanted))
    for column, sign in monotone.items():
        grid = np.array([(a, b) for a in range(12) for b in range(5)], float)
        up = grid + np.array([1.0, 0.0] if column == "a" else [0.0, 1.0])
        assert (sign * (model.margins(up) - model.margins(grid)) >= -1e-12).all()


def test_logistic_limits_and_storage(spark, monkeypatch):
    monkeypatch.setattr("sumac.operators.boosting.REWRITE", 2)
    y = (Y > Y.mean()).astype(float)
    train = frame(spark, y)
    model = HistogramBoosting(loss="logistic", trees=5, depth=2, rate=0.3).fit(train, ["a", "b"], "label", validation=frame(spark, 1 - y))
    assert np.allclose(1 / (1 + np.exp(-model.margins(X))), plain(X, y, 5, 2, 0.3, 0, 1, [0, 0], "logistic"))
    assert [h["train_before"] for h in model.history] == sorted((h["train_before"] for h in model.history), reverse=True)
    assert [h["validation"] for h in model.history] == sorted(h["validation"] for h in model.history)
    path = scratch_path(spark, "boosted")
    model.save(spark, path)
    again = BoostedTrees.load(spark, path)
    assert (again.margins(X) == model.margins(X)).all() and again == model
    early = HistogramBoosting(loss="logistic", trees=9, depth=1, patience=2).fit(train, ["a", "b"], "label", validation=frame(spark, 1 - y))
    assert len(early.trees) == 1 and len(early.history) == 3
    few = HistogramBoosting(trees=1, depth=3, leaves=3).fit(train, ["a", "b"], "label")
    assert sum(f >= 0 for f in few.trees[0].feature) == 2
    none = HistogramBoosting(trees=2, depth=2, least_gain=1e9).fit(train, ["a", "b"], "label")
    assert sum(none.importances().values()) == 0
    with pytest.raises(ValueError):
        HistogramBoosting(trees=1).fit(train.limit(0), ["a", "b"], "label")


def test_rows_of_whole_columns_reach_the_leaves_they_reach_one_by_one():
    """Trees are evaluated node by node over whole columns (F8, F11); large ones row by row, with the same leaves."""
    rng = np.random.default_rng(5)
    for depth, small in ((1, 64), (3, 64), (3, 2), (0, 64)):
        tree = boosting.Tree.root(depth)
        for node in range(2**depth - 1):
            if node == 0 or (tree.feature[(node - 1) // 2] >= 0 and rng.random() < 0.8):
                tree.feature[node], tree.threshold[node], tree.missing_left[node] = int(rng.integers(3)), float(rng.normal()), bool(rng.integers(2))
        tree.value = rng.normal(size=len(tree.feature)).tolist()
        x = np.where(rng.random((500, 3)) < 0.1, np.nan, rng.normal(size=(500, 3)))
        x[:, 2] = np.nan_to_num(x[:, 2])
        want = np.array(tree.value)[tree.leaf_of(x, np.array(tree.threshold), np.isnan(x))]
        before, boosting.SMALL = boosting.SMALL, small
        try:
            got = tree.chosen(list(x.T), tree.threshold, [boosting._some(np.isnan(c)) for c in x.T], tree.value)
        finally:
            boosting.SMALL = before
        assert got.shape == (500,) and (got == want).all()
