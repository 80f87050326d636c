import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from sumac.operators import clustering, models, outliers, search
from sumac.operators.clustering import mixture_criteria
from sumac.operators.projection import fit_pca, pca_project
from sumac.plans import flows
from sumac.plans.catalogue import QUERIES
from sumac.session import scratch_path
from sumac.sources import files, runs
from sumac.streaming import score as streaming

FOLDER = "/root/testdata/sf0.001"


def naive_ward(xy, k):
    groups = [[i] for i in range(len(xy))]
    while len(groups) > k:
        best = None
        for i in range(len(groups)):
            for j in range(i + 1, len(groups)):
                a, b = xy[groups[i]], xy[groups[j]]
                cost = len(a) * len(b) / (len(a) + len(b)) * ((a.mean(0) - b.mean(0)) ** 2).sum()
                if best is None or cost < best[0]:
                    best = (cost, i, j)
        groups[best[1]] += groups.pop(best[2])
    return {frozenset(g) for g in groups}


@pytest.mark.parametrize("block", [7, 2048])
def test_ward_equals_exact_method(spark, monkeypatch, block):
    monkeypatch.setattr(clustering, "WARD_BLOCK", block)
    xy = np.random.default_rng(4).normal(size=(40, 2))
    rows = [(i, float(x), float(y), "s") for i, (x, y) in enumerate(xy)]
    df = spark.createDataFrame([*rows, (40, None, 1.0, "s")], "id long, x double, y double, c string")
    for k in (1, 4):
        out = {r["id"]: r["cluster"] for r in clustering.ward(df, ["x", "y"], k).collect()}
        assert {frozenset(i for i in out if out[i] == g) for g in set(out.values())} == naive_ward(xy, k)
        assert set(out.values()) == set(range(k))


def test_ward_of_ties_repeats_and_nothing(spark):
    df = spark.createDataFrame([(i, float(i // 3)) for i in range(12)], "id long, x double")
    out = {r["id"]: r["cluster"] for r in clustering.ward(df, ["x"], 2).collect()}
    assert [out[i] for i in range(12)] == [0] * 6 + [1] * 6
    assert {r["cluster"] for r in clustering.ward(df, ["x"], 9).collect()} == {0, 1, 2, 3}
    assert clustering.ward(df.limit(0), ["x"], 2).count() == 0
    assert {r["cluster"] for r in clustering.ward(df.filter("id < 3"), ["x"], 2).collect()} == {0}


def test_mixture_criteria_formulas():
    aic, bic = mixture_criteria(-100.0, 3, 2, 50)
    free = 3 * 3 + 3 * 2 + 2
    assert aic == pytest.approx(2 * free + 200) and bic == pytest.approx(free * math.log(50) + 200)


def test_components_are_orthogonal(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=200)
    df = spark.createDataFrame([(float(v), float(2 * v + e), float(e)) for v, e in zip(a, rng.normal(size=200))], "a double, b double, c double")
    _, loadings, share = fit_pca(df, ["a", "b", "c"], 2)
    m = np.array(loadings)
    assert np.allclose(m @ m.T, np.eye(2), atol=1e-9) and share[0] >= share[1]
    assert abs(pca_project(df, ["a", "b", "c"], 2).agg(F.avg("pc1")).first()[0]) < 1e-9


def test_isolation_forest_flags_the_far_points(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.normal(size=(300, 2)))] + [(900 + i, 30.0 + i, -30.0) for i in range(3)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    out = outliers.isolation_forest(df, "id", ["x", "y"], contamination=0.01, trees=40)
    flagged = {r["id"] for r in out.filter("flag = -1").collect()}
    assert flagged and flagged <= {900, 901, 902} | {r["id"] for r in out.orderBy(F.desc("score")).limit(4).collect()}
    again = outliers.isolation_forest(df.orderBy(F.desc("x")), "id", ["x", "y"], contamination=0.01, trees=40)
    assert sorted(again.select("id", "score").collect()) == sorted(out.select("id", "score").collect())


def test_monotone_regressor_never_rises(spark):
    rng = np.random.default_rng(0)
    rows = [(float(p), float(rng.integers(0, 3)), float(10 - p + rng.normal())) for p in rng.uniform(0, 5, 300)]
    df = spark.createDataFrame(rows, "price double, shop double, label double")
    base = Pipeline(stages=[*models.feature_stages(["shop"]), models.gbt_regressor(trees=2, depth=2)])
    model = models.MonotoneRegressor(base, "price", "label").fit(df)
    grid = spark.range(0, 60).select((F.col("id") / 10.0).alias("price"), F.lit(1.0).alias("shop"), F.lit(0.0).alias("label"))
    values = [r["prediction"] for r in model.transform(grid).orderBy("price").collect()]
    assert all(a >= b - 1e-12 for a, b in zip(values, values[1:])) and values[0] > values[-1]


def test_search_is_deterministic_and_in_range():
    a, b = (search.candidates(search.CLASSIFICATION_SPACE, 20, seed=7) for _ in range(2))
    assert a == b
    for trial in a:
        for name, (low, high) in search.CLASSIFICATION_SPACE.items():
            assert low <= trial[name] <= high
            assert isinstance(trial[name], int) == isinstance(low, int)


def test_halving_keeps_the_better_half(spark):
    df = spark.range(4)

    class Fixed(Pipeline):
        def __init__(self, value):
            super().__init__(stages=[])
            self.value = value

        def fit(self, _):
            return self.value

    trials = [{"v": v, "n": 0} for v in (4.0, 1.0, 3.0, 2.0)]
    out = search.successive_halving(df, trials, lambda t: Fixed(t["v"]), lambda m: m, "n", [1, 2, 4])
    last = [r["trial"] for r in out.filter("rung = 2").collect()]
    assert last == [1] and out.count() == 4 + 2 + 1


def test_saved_model_predicts_the_same(spark):
    assert QUERIES["model_save_load"](spark, FOLDER).filter("not same").isEmpty()


def test_calibrated_probabilities(spark):
    rows = QUERIES["isotonic_calibration"](spark, FOLDER).collect()
    assert rows and all(0 <= r["calibrated"] <= 1 for r in rows)


def test_stream_equals_batch(spark):
    inbox, out = scratch_path(spark, "inbox"), scratch_path(spark, "out")
    flows.write_lines(spark, FOLDER, inbox)
    model = flows.sensor_model(spark, FOLDER)
    for _ in range(2):  # a restart finds nothing new and adds nothing
        records = streaming.read_records(spark, inbox, flows.FIELDS, files_per_batch=1)
        streaming.run_scoring(records, model, out, ["event_id"], lambda s: s.filter("prediction = 0"))
    got = spark.read.parquet(f"{out}/scored").select("event_id", "prediction")
    batch = model.transform(flows.sensor_records(spark, FOLDER)).select("event_id", "prediction")
    broken = spark.read.parquet(f"{out}/errors").count()
    assert broken == 10 and got.count() == batch.count() - broken
    assert got.exceptAll(batch).isEmpty()
    alerts = spark.read.parquet(f"{out}/alerts")
    assert alerts.count() == got.filter("prediction = 0").count()


def test_run_records_in_plain_folders(spark, tmp_path):
    def put(run, kind, key, text):
        place = tmp_path / run / kind
        place.mkdir(parents=True, exist_ok=True)
        (place / key).write_text(text)

    put("r1", "params", "depth", "6")
    put("r1", "metrics", "valid_f1", "1700000000000 0.4 0\n1700000000001 0.55 1\n")
    put("r2", "params", "depth", "3")
    put("r2", "tags", "source", "a b\nc")
    records = runs.read_run_records(spark, str(tmp_path))
    assert records.count() == 4
    table = runs.runs_table(records, ["depth"], ["valid_f1"])
    assert sorted(tuple(r) for r in table.collect()) == [("r1", "6", 0.55), ("r2", "3", None)]
    assert runs.best_run(table, "valid_f1").first()["run_id"] == "r1"
    assert runs.best_run(table, "valid_f1", ascending=True).first()["run_id"] == "r1"


def test_optional_inputs(spark):
    with pytest.raises(FileNotFoundError):
        files.read_existing(spark, [scratch_path(spark, "none")])


def test_csv_missing_values(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,s\n1.5,a\nNaN,\n,b\n")
    rows = files.read_csv(spark, str(tmp_path / "a.csv"), "x double, s string").collect()
    assert [tuple(r) for r in rows] == [(1.5, "a"), (None, None), (None, "b")]


def test_csv_files_with_their_own_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n3,4\n")
    (tmp_path / "b c.csv").write_text("b,more,a\n20,x,10\n")
    (tmp_path / "d.csv").write_text("a,b\n5,6\n")
    rows = files.read_csv(spark, str(tmp_path), "a long, b long").collect()
    assert sorted(tuple(r) for r in rows) == [(1, 2), (3, 4), (5, 6), (10, 20)]
    (tmp_path / "e.csv").write_text("a\n5\n")
    with pytest.raises(ValueError):
        files.read_csv(spark, str(tmp_path), "a long, b long")


def test_json_records_multiline(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"x": 1.5, "extra": 2},\n {"s": "a"}]')
    rows = files.read_json(spark, str(tmp_path / "a.json"), "x double, s string", multiline=True).collect()
    assert [tuple(r) for r in rows] == [(1.5, None), (None, "a")]


def test_a_repeated_date_replaces_its_models(spark):
    rows = [(i, float(i % 7), "ab"[i % 2], float(i % 7 > 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, x double, c string, label double")
    few = {"tree": models.decision_tree(3), "regression": models.logistic_regression(20)}
    dated = flows.DatedModels(scratch_path(spark, "dated"), "label", ["x"], ["c"], few)
    dated.run(df.filter("id < 150"), "id", "2024-01-05")
    dated.run(df, "id", "2024-02-05")

    def known():
        return sorted(tuple(r) for r in dated.runs(spark).drop("path").collect())

    before = known()
    assert [(r[0], r[1], r[2], r[6]) for r in before] == [
        ("regression", 120, 30, "2024-01-05"), ("regression", 160, 40, "2024-02-05"),
        ("tree", 120, 30, "2024-01-05"), ("tree", 160, 40, "2024-02-05"),
    ]
    first = {r["path"] for r in dated.runs(spark).collect()}
    dated.run(df, "id", "2024-02-05")
    assert known() == before
    assert len(first & {r["path"] for r in dated.runs(spark).collect()}) == 2
    assert {r["ds"]: r["n"] for r in dated.runs(spark).filter("best").groupBy("ds").agg(F.count("*").alias("n")).collect()} == {"2024-01-05": 1, "2024-02-05": 1}
    out = dated.candidate(spark, "2024-02-05", "tree").transform(df)
    assert out.filter("prediction != label").isEmpty()
    assert dated.candidate(spark, "2024-01-05").transform(df).count() == 200
    with pytest.raises(LookupError):
        dated.candidate(spark, "2024-03-05")


def test_model_input_is_spread_over_tasks(spark, monkeypatch):
    """A table in one partition was fitted and scored by one task, whatever its rows (F1, F7, F9, F10)."""
    monkeypatch.setattr(models, "SPREAD_ROWS", 10)
    df = spark.range(100).coalesce(1).selectExpr("id AS doc_id", "CAST(id % 7 AS DOUBLE) AS a", "CAST(id % 2 AS DOUBLE) AS label")
    cores = spark.sparkContext.defaultParallelism
    assert models.spread(df).rdd.getNumPartitions() == min(10, 4 * cores)
    assert sorted(models.spread(df).collect()) == sorted(df.collect())
    monkeypatch.setattr(models, "PARTITION_ROWS", 2)
    assert models.spread(df).rdd.getNumPartitions() == max(50, min(10, 4 * cores))
    assert models.spread(df.limit(10)).rdd.getNumPartitions() == 5
    assert models.spread(df.limit(0)).count() == 0
    used = []
    monkeypatch.setattr(models, "fit_all", lambda train, candidates: used.append(train.rdd.getNumPartitions()) or {})
    flows._fitted(df.withColumn("split", F.when(F.col("doc_id") < 80, "train").otherwise("test")), "label", ["a"], [], {})
    assert used == [40]


def test_a_forest_grown_in_groups_is_one_model(spark, tmp_path, monkeypatch):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler

    from sumac.plans import flows

    forest = flows.DatedModels("unused", "label", ["a"], []).candidates["random_forest"]
    assert (type(forest), forest.trees, forest.depth) == (models.ForestInGroups, 300, 8) and forest.GROUP <= 25
    rows = [(float(k % 17), float(k % 5), float(k % 17 > 8)) for k in range(300)]
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(spark.createDataFrame(rows, "a double, b double, label double"))
    sizes, one = [], models.random_forest
    monkeypatch.setattr(models, "random_forest", lambda trees, depth: sizes.append(trees) or one(trees, depth))
    monkeypatch.setattr(models.ForestInGroups, "GROUP", 2)
    model = models.ForestInGroups(5, 3).fit(data)
    assert sizes == [2, 2, 1] and model.getNumTrees == 5 and len({t.toDebugString for t in model.trees}) > 2
    scored = model.transform(data).select("a", "b", "label", "prediction", "probability").collect()
    assert sum(r["label"] == r["prediction"] for r in scored) > 290
    models.save(PipelineModel([model]), str(tmp_path / "forest"))
    assert models.load(str(tmp_path / "forest")).transform(data).select("a", "b", "label", "prediction", "probability").collect() == scored


def test_compared_shapes_use_every_coordinate(spark, tmp_path):
    from sumac.plans import modelling

    rows = [(k, [0.5, 0.5, *[float((k * (j + 3)) % 11) if j % 2 else 0.1 for j in range(62)]], k % 3) for k in range(60)]
    rows += [(60, None, 0), (61, [0.5, 0.5, None, *[0.1] * 61], 0)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    shapes = modelling._shapes(spark, str(tmp_path))
    assert list(shapes) == ["plain", "sheared"]
    for df in shapes.values():
        assert sorted(r["vec_id"] for r in df.filter("x is null and y is null").collect()) == [60, 61]
        found = df.filter("x is not null").collect()
        assert len(found) == 60 and len({round(r["x"], 6) for r in found}) >= 11 and len({round(r["y"], 6) for r in found}) >= 11


def test_the_boosted_regression_is_not_cut_down():
    from sumac.plans import modelling

    trees = modelling._boosted_regressor().getStages()[-1]
    assert (trees.getMaxIter(), trees.getMaxDepth(), trees.getSubsamplingRate()) == (100, 6, 1.0)
