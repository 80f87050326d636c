"""Hyper-parameter search over a seeded candidate table."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Model, Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

# The searched ranges, (low, high) per parameter; whole numbers are
# drawn where both ends are whole. Parameters Spark's boosted trees lack are left out.
REGRESSION_SPACE = {
    "learning_rate": (0.001, 0.1),
    "n_estimators": (50, 1000),
    "max_depth": (3, 10),
    "min_child_weight": (1, 5),
    "min_frequency": (0.0, 1.0),
}
CLASSIFICATION_SPACE = {
    "n_estimators": (50, 500),
    "max_depth": (2, 15),
    "learning_rate": (0.001, 0.1),
    "subsample": (0.2, 1.0),
    "colsample_bytree": (0.2, 1.0),
    "min_child_weight": (1, 10),
}

Trial = dict[str, float]


def candidates(space: Mapping[str, tuple[float, float]], n: int, seed: int = 42) -> list[Trial]:
    draw = random.Random(seed)
    return [
        {
            name: draw.randint(low, high) if isinstance(low, int) and isinstance(high, int) else draw.uniform(low, high)
            for name, (low, high) in space.items()
        }
        for _ in range(n)
    ]


def run_trials(
    train: DataFrame,
    trials: Sequence[Trial],
    build: Callable[[Trial], Pipeline],
    score: Callable[[Model], float],
    parallelism: int = 4,
) -> tuple[DataFrame, dict[int, Model]]:
    """Fit and score every candidate; (trial, value, params...) table and the models."""
    train = train.persist()

    def one(trial: Trial) -> tuple[Model, float]:
        model = build(trial).fit(train)
        return model, float(score(model))

    with ThreadPoolExecutor(parallelism) as pool:
        results = list(pool.map(one, trials))
    train.unpersist()
    names = list(trials[0])
    rows = [(i, value, *[float(t[n]) for n in names]) for i, (t, (_, value)) in enumerate(zip(trials, results))]
    schema = "trial int, value double, " + ", ".join(f"{n} double" for n in names)
    return train.sparkSession.createDataFrame(rows, schema), {i: m for i, (m, _) in enumerate(results)}


def successive_halving(
    train: DataFrame,
    trials: Sequence[Trial],
    build: Callable[[Trial], Pipeline],
    score: Callable[[Model], float],
    budget: str,
    rungs: Sequence[int],
    lower_is_better: bool = True,
    parallelism: int = 4,
) -> DataFrame:
    """Give all trials a small budget and keep the better half at each larger one.

    (trial, rung, budget, value, pruned): weak trials stop early, as a per-round
    pruning callback would stop them.
    """
    alive, rows = list(range(len(trials))), []
    for rung, amount in enumerate(rungs):
        table, _ = run_trials(train, [{**trials[i], budget: amount} for i in alive], build, score, parallelism)
        values = {alive[r["trial"]]: r["value"] for r in table.collect()}
        best = sorted(alive, key=lambda i: (values[i] if lower_is_better else -values[i], i))
        keep = set(best[: max(1, (len(best) + 1) // 2)]) if rung + 1 < len(rungs) else set(best)
        rows += [(i, rung, int(amount), values[i], i not in keep) for i in alive]
        alive = sorted(keep)
    return train.sparkSession.createDataFrame(rows, "trial int, rung int, budget int, value double, pruned boolean")


def param_importance(trials: DataFrame, params: Sequence[str], value: str = "value") -> DataFrame:
    """Which parameter explains the score: importances of a forest fitted on the trials."""
    vectors = VectorAssembler(inputCols=list(params), outputCol="features").transform(trials)
    model = RandomForestRegressor(labelCol=value, numTrees=50, seed=42).fit(vectors)
    rows = [(p, float(v)) for p, v in zip(params, model.featureImportances.toArray())]
    table = trials.sparkSession.createDataFrame(rows, "param string, importance double")
    return table.orderBy(F.desc("importance"), "param")
