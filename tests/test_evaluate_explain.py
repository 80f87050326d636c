import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sumac.operators import evaluate, explain
from sumac.operators.selection import seeded_sample


def test_recorded_rule_numbers(spark):
    """A published confusion matrix and the rates stated with it."""
    cells = {(0, 0): 5845, (0, 1): 4260, (1, 0): 2518, (1, 1): 8504}
    df = spark.createDataFrame([(t, p, n) for (t, p), n in cells.items()], "y int, p int, n int")
    df = df.withColumn("i", F.explode(F.sequence(F.lit(1), F.col("n"))))
    row = evaluate.rule_quality(df, "y", F.col("p") == 1).first()
    stated = {"coverage": 60.42, "precision": 66.62, "accuracy": 67.92, "recall": 77.15, "specificity": 57.84}
    assert row["n_covered"] == 12764
    for name, value in stated.items():
        assert round(row[name] * 100, 2) == pytest.approx(value, abs=0.011)


def test_zero_divisions_are_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    row = evaluate.binary_metrics(df, "y", "p").first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (1.0, 0.0, 0.0, 0.0)


def test_confusion_matrix_shows_unpredicted_labels(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "b"), ("c", "a")], "t string, p string")
    rows = {r["t"]: tuple(r)[1:] for r in evaluate.confusion_matrix(df, "t", "p").collect()}
    assert rows == {"a": (0, 1, 0), "b": (0, 1, 0), "c": (1, 0, 0)}
    with pytest.raises(ValueError):
        evaluate.confusion_matrix(df, "t", "p", most=2)


def test_multiclass_brier(spark):
    df = spark.createDataFrame([(0, 0.8, 0.2), (1, 0.4, 0.6)], "y int, p0 double, p1 double")
    got = evaluate.brier_score_multi(df, "y", {0: "p0", 1: "p1"}).first()[0]
    assert got == pytest.approx((0.04 + 0.16) / 2)


def test_best_model_ties_go_to_the_first_name(spark):
    df = spark.createDataFrame([("b", 0.9), ("a", 0.9), ("c", None)], "m string, s double")
    assert evaluate.select_best(df, "m", "s").first()["m"] == "a"


def facts(spark, n=60):
    rng = np.random.default_rng(2)
    rows = [(i, *map(int, rng.integers(0, 3, 3)), int(rng.integers(0, 2))) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a int, b int, c int, y int")


def rule(x):
    return x["a"] * 0.5 + x["b"] * x["c"] * 0.25


def test_shapley_adds_up(spark):
    df = facts(spark)
    phi = explain.shapley_exact(df, ["id"], ["a", "b", "c"], rule, df)
    gaps = phi.groupBy("id").agg((F.first("base") + F.sum("phi") - F.first("prediction")).alias("gap"))
    assert gaps.filter(F.abs("gap") > 1e-9).isEmpty()
    assert phi.count() == 3 * df.count()


def test_sampled_shapley_adds_up_and_approaches_exact(spark):
    df = facts(spark)
    names = ["a", "b", "c"]
    predict = explain.as_scorer(rule, names)
    got = explain.shapley_sampled(df, "id", names, predict, df, orders=300)
    total = got.groupBy("id").agg((F.first("base") + F.sum("phi")).alias("f")).join(predict(df), "id")
    assert total.filter(F.abs(F.col("f") - F.col("prediction")) > 1e-9).isEmpty()
    exact = explain.shapley_exact(df, ["id"], names, rule, df).select("id", "feature", F.col("phi").alias("true"))
    worst = got.join(exact, ["id", "feature"]).agg(F.max(F.abs(F.col("phi") - F.col("true")))).first()[0]
    assert worst < 0.2


def test_permutations_move_one_feature_only(spark):
    df = facts(spark)
    out = explain.permutations(df, "id", ["a", "b"], 3)
    assert out.count() == df.count() * (1 + 3 * 2)
    moved = out.filter("rep = 2 and feature = 'a'")
    assert sorted(r["a"] for r in moved.collect()) == sorted(r["a"] for r in df.collect())
    assert moved.join(df.select("id", F.col("b").alias("same")), "id").filter("b != same").isEmpty()


def test_unused_feature_has_no_importance(spark):
    df = facts(spark).withColumn("y", (F.col("a") > 0).cast("int"))
    predict = explain.as_scorer(lambda x: (x["a"] > 0).cast("int"), ["a", "b"])
    got = {r["feature"]: r for r in explain.permutation_importance(df, "id", ["a", "b"], "y", predict, 5).collect()}
    assert got["b"]["importance_mean"] == 0.0 and got["a"]["importance_mean"] > 0


def test_dependence_grid_keeps_few_values(spark):
    df = facts(spark)
    assert explain.dependence_grid(df, "a") == [0.0, 1.0, 2.0]
    assert explain.dependence_grid(df, "id", points=5)[0] == pytest.approx(np.quantile(range(60), 0.05))


def test_sample_is_fixed_by_its_seed(spark):
    df = facts(spark)
    a = [r["id"] for r in seeded_sample(df, "id", 10, 1).collect()]
    assert a == [r["id"] for r in seeded_sample(df.orderBy(F.rand()), "id", 10, 1).collect()]
    assert len(a) == 10 and seeded_sample(df, "id", 1000, 1).count() == 60


@pytest.mark.parametrize("n", [1, 2, 3, 50, 7920])
def test_permutations_are_bijections_of_their_own(spark, n):
    table = spark.range(n).select(F.col("id").alias("k"), F.col("id").alias("a"), (-F.col("id")).alias("b"))
    found = explain.permutations(table, "k", ["a", "b"], 3).filter("rep > 0").collect()
    orders = {}
    for r in found:
        orders.setdefault((r["rep"], r["feature"]), {})[r["k"]] = r["a"] if r["feature"] == "a" else -r["b"]
    assert len(orders) == 6 and all(sorted(o.values()) == list(range(n)) and sorted(o) == list(range(n)) for o in orders.values())
    if n >= 50:
        rows = [tuple(o[k] for k in range(n)) for o in orders.values()]
        assert len(set(rows)) == 6
        assert len({tuple((x - y) % n for x, y in zip(rows[0], r)) for r in rows[1:]}) == 5
        assert all(sum(x == y for x, y in enumerate(r)) < n / 5 for r in rows)


@pytest.mark.parametrize("n", [1, 2, 7, 50])
def test_permuted_values_travel_packed(spark, monkeypatch, n):
    """Each permutation takes every row's value to its place, of any type and with nulls, over several ranges and blocks (F3)."""
    places = np.arange(n)
    width = math.isqrt(n - 1) + 1
    height = -(-n // width)
    moved = explain._moved(places, n, width, height, 42_000_130)
    assert sorted(moved) == places.tolist() and (explain._moved_back(moved, n, width, height, 42_000_130) == places).all()
    monkeypatch.setattr(explain, "SOURCE_ROWS", 9)
    monkeypatch.setattr(explain, "BLOCK_ROWS", 6)
    monkeypatch.setattr(explain, "BLOCK_VALUES", 6)
    rows = [(i, None if i % 5 == 4 else f"t{i}", None if i % 7 == 3 else float(i), i % 2) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, a string, b double, y int")
    got = explain.permutations(df, "id", ["a", "b"], 3, keep=["y"]).collect()
    order = [r["id"] for r in df.withColumn("t", explain.seeded_hash(F.col("id"), 42)).orderBy("t", "id").collect()]
    assert len(got) == n * 7
    for rep in range(1, 4):
        for f, name in enumerate(("a", "b")):
            to = explain._moved(places, n, width, height, 42 * 1000003 + rep * 7919 + f * 104729)
            want = {order[p]: rows[order[to[p]]][1 + f] for p in range(n)}
            part = [r for r in got if r["rep"] == rep and r["feature"] == name]
            assert {r["id"]: r[name] for r in part} == want
            assert all(r["y"] == r["id"] % 2 and r["ab"[1 - f]] == rows[r["id"]][2 - f] for r in part)
