"""Model, search and calibration queries.

Classification uses the judged documents (low quality is the positive class);
regression uses the part table.
"""

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from sumac.operators import boosting, clustering, density, evaluate, explain, models, outliers, projection, search, splits
from sumac.plans.distances import EPS, MIN_SAMPLES, WIDTH, coordinates
from sumac.plans.registry import query, table
from sumac.plans.tables import rounded
from sumac.functions.scalars import linear_map
from sumac.plans.basics import SHEAR
from sumac.session import freeze, scratch_path

NUMERIC, CATEGORICAL = ["n_chars", "words"], ["lang", "source"]


def judged_documents(spark, folder):
    """(doc_id, features, label, split) for all judged documents, whole texts counted."""
    documents = table(spark, folder, "documents").select(
        "doc_id", "lang", "source", F.col("n_chars").cast("double"), F.size(F.split("text", r"\s+")).cast("double").alias("words")
    )
    labels = table(spark, folder, "labels").select("doc_id", (F.col("quality") == 0).cast("double").alias("label"))
    return freeze(splits.stratified_split(freeze(documents.join(labels, "doc_id")), "doc_id", "label", 0.3))


def _parts_of(data):
    return models.spread(data.filter("split = 'train'")), models.spread(data.filter("split = 'test'"))


def _with(model, numeric=NUMERIC, categorical=CATEGORICAL):
    return Pipeline(stages=[*models.feature_stages(numeric, categorical), model])


def _predictions(model, df):
    return models.positive_probability(model.transform(df)).select("doc_id", "label", "probability_1", "prediction")


@query("gbt_classifier")
def gbt_classifier(spark, folder):
    train, test = _parts_of(models.weighted(judged_documents(spark, folder), "label"))
    model = _with(models.gbt_classifier(trees=20, depth=4, weightCol="weight")).fit(train)
    return _predictions(model, test)


@query("array_column")
def array_column(spark, folder):
    train, test = _parts_of(judged_documents(spark, folder))
    model = _with(models.logistic_regression(100)).fit(train)
    return models.positive_probability(model.transform(test)).select("doc_id", "probability_1")


@query("model_save_load")
def model_save_load(spark, folder):
    train, test = _parts_of(judged_documents(spark, folder))
    model = _with(models.decision_tree(5)).fit(train)
    path = scratch_path(spark, "model")
    models.save(model, path)
    before = _predictions(model, test).withColumnRenamed("prediction", "before")
    after = _predictions(models.load(path), test).select("doc_id", F.col("prediction").alias("after"))
    return before.join(after, "doc_id").select("doc_id", "before", "after", (F.col("before") == F.col("after")).alias("same"))


@query("linear_svc_ovr")
def linear_svc_ovr(spark, folder):
    names, wide = coordinates(spark, folder)
    train, test = _parts_of(freeze(splits.stratified_split(wide, "vec_id", "label", 0.3)))
    train = models.weighted(train.withColumn("label", F.col("label").cast("double")), "label").persist()
    model = Pipeline(stages=[*models.feature_stages(names), models.linear_svc_ovr(rounds=100)]).fit(train)
    scored = model.transform(test.withColumn("label", F.col("label").cast("double"))).select("label", "prediction")
    return rounded(evaluate.classification_report(scored, "label", "prediction"), "precision", "recall", "f1")


@query("tree_comparison")
def tree_comparison(spark, folder):
    train, test = _parts_of(judged_documents(spark, folder))
    candidates = {
        "decision tree": _with(models.decision_tree(4)),
        "random forest": _with(models.random_forest(20, 4)),
        "boosted trees": _with(models.gbt_classifier(trees=5, depth=3)),
    }
    return models.compare_classifiers(train, test, "doc_id", "label", candidates, folds=3)


@query("rf_lr_dt_trainers")
def rf_lr_dt_trainers(spark, folder):
    train, test = _parts_of(judged_documents(spark, folder))
    trainers = {
        "decision_tree": _with(models.decision_tree(10)),
        "logistic_regression": _with(models.logistic_regression(1000)),
        "random_forest": _with(models.random_forest(300, 8)),
    }
    fitted = models.fit_all(train, trainers)
    rows = []
    for name, (model, seconds) in fitted.items():
        m = evaluate.binary_metrics(model.transform(test), "label", "prediction").first()
        rows.append((name, m["accuracy"], m["f1"], seconds))
    return spark.createDataFrame(rows, "model string, accuracy double, f1 double, seconds double")


def _regression(spark, folder):
    parts = table(spark, folder, "part").select(
        "p_partkey", "p_brand", "p_type", F.col("p_size").cast("double").alias("p_size"), F.col("p_retailprice").alias("label")
    )
    return _parts_of(freeze(splits.stratified_split(parts, "p_partkey", "p_type", 0.3)))


def _boosted_regressor():
    return _with(models.gbt_regressor(trees=100, depth=6), ["p_size"], ["p_brand", "p_type"])


@query("gbt_regressor")
def gbt_regressor(spark, folder):
    train, test = _regression(spark, folder)
    return _boosted_regressor().fit(train).transform(test).select("p_partkey", "label", "prediction")


def _demand(spark, folder):
    """All parts with a demand that falls with the price, and their split."""
    parts = table(spark, folder, "part").select(
        "p_partkey", "p_type", F.col("p_size").cast("double").alias("size"), F.substring("p_brand", 7, 2).cast("double").alias("brand"),
        F.col("p_retailprice").cast("double").alias("price"),
    )
    # Demand stands in for the target: large parts sell less when dear.
    parts = parts.withColumn("label", 2000.0 - F.col("price") + F.col("size"))
    return parts, splits.stratified_split(parts, "p_partkey", "p_type", 0.3)


def _monotone_model(train):
    return boosting.HistogramBoosting(trees=100, depth=3, rate=0.1, monotone={"price": -1}).fit(train, ["price", "size", "brand"], "label")


@query("monotone_regressor")
def monotone_regressor(spark, folder):
    train, test = _parts_of(freeze(_demand(spark, folder)[1]))
    return _monotone_model(train).transform(test).select("p_partkey", "price", "label", "prediction")


@query(
    "monotone_facts",
    "SELECT p_partkey, 100 AS trees, true AS never_rises, true AS closer_than_mean FROM part",
)
def monotone_facts(spark, folder):
    """The number of trees, whether a dearer copy of each part is never predicted higher, and whether the model beats the mean on the held-out parts."""
    parts, split = _demand(spark, folder)
    train, test = _parts_of(freeze(split))
    model = _monotone_model(train)
    mean = train.agg(F.avg("label")).first()[0]
    held = model.transform(test).agg(F.avg(F.abs(F.col("prediction") - F.col("label"))), F.avg(F.abs(F.col("label") - mean))).first()
    out = model.transform(models.spread(parts))
    out = out.withColumns({"_price": F.col("price"), "_rises": F.lit(False)})
    for more in (0.01, 1.0, 50.0, 1000.0):
        out = model.transform(out.withColumn("price", F.col("_price") + more), "_dearer")
        out = out.withColumn("_rises", F.col("_rises") | (F.col("_dearer") > F.col("prediction") + 1e-9))
    return out.select("p_partkey", F.lit(len(model.trees)).alias("trees"), (~F.col("_rises")).alias("never_rises"), F.lit(held[0] < held[1]).alias("closer_than_mean"))


@query(
    "boosted_split",
    """WITH b AS (SELECT avg(p_retailprice::DOUBLE) AS base FROM part),
    v AS (SELECT p_size AS t, sum(base - p_retailprice::DOUBLE) AS g, count(*) AS n FROM part, b GROUP BY p_size),
    c AS (SELECT t, sum(g) OVER w AS gl, sum(n) OVER w AS nl, sum(g) OVER () AS gt, sum(n) OVER () AS nt FROM v WINDOW w AS (ORDER BY t)),
    s AS (SELECT t, -gl / (nl + 1) AS l, -(gt - gl) / (nt - nl + 1) AS r, gl * gl / (nl + 1) + (gt - gl) * (gt - gl) / (nt - nl + 1) AS gain
      FROM c WHERE nl < nt ORDER BY gain DESC, t LIMIT 1)
    SELECT t::DOUBLE AS threshold, round(base + l / 2, 6) AS below, round(base + r / 2, 6) AS above FROM s, b""",
)
def boosted_split(spark, folder):
    """The one split of a single tree of depth one on the size of parts, with half the step."""
    parts = table(spark, folder, "part").select(F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").cast("double").alias("label"))
    model = boosting.HistogramBoosting(trees=1, depth=1, rate=0.5).fit(parts, ["size"], "label")
    threshold = model.trees[0].threshold[0]
    at = parts.agg(F.lit(threshold).alias("size"))
    sides = model.transform(model.transform(at, "below").withColumn("size", F.lit(threshold + 1)), "above")
    return rounded(sides.select(F.lit(threshold).alias("threshold"), "below", "above"), "below", "above")


def _trial_classifier(trial):
    model = models.gbt_classifier(
        trees=int(trial["n_estimators"]), rate=trial["learning_rate"], depth=int(trial["max_depth"]),
        share=trial["subsample"], minInstancesPerNode=int(trial["min_child_weight"]),
        featureSubsetStrategy=str(max(0.01, round(trial["colsample_bytree"], 6))),
    )
    return _with(model)


_SMALL_SPACE = {**search.CLASSIFICATION_SPACE, "n_estimators": (5, 10), "max_depth": (2, 4)}


def _trials(spark, folder, n=4):
    train, test = _parts_of(judged_documents(spark, folder))
    test = test.persist()

    def score(model):
        return evaluate.binary_metrics(model.transform(test), "label", "prediction").first()["f1"]

    trials = search.candidates(_SMALL_SPACE, n)
    return train, trials, score


@query("param_search")
def param_search(spark, folder):
    train, trials, score = _trials(spark, folder)
    return search.run_trials(train, trials, _trial_classifier, score)[0]


@query("pruned_search")
def pruned_search(spark, folder):
    train, trials, score = _trials(spark, folder)
    return search.successive_halving(
        train, trials, _trial_classifier, score, "n_estimators", [2, 4], lower_is_better=False
    )


@query("param_importance")
def param_importance(spark, folder):
    # Orders play the trials: three parameters and a score per row.
    trials = table(spark, folder, "orders").select(
        F.col("o_totalprice").alias("value"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"), "o_custkey"
    )
    return search.param_importance(trials, ["year", "month", "o_custkey"])


@query("feature_elimination")
def feature_elimination(spark, folder):
    train, test = _parts_of(judged_documents(spark, folder))
    full = _with(models.gbt_classifier(trees=5, depth=3)).fit(train)
    names = models.feature_names(full.transform(train))
    weights = full.stages[-1].featureImportances.toArray()
    found = spark.createDataFrame([(n, float(w)) for n, w in zip(names, weights)], "feature string, importance double")
    ranked = [r["base"] for r in explain.importance_rollup(found, CATEGORICAL).collect()]

    def build(keep):
        return _with(
            models.gbt_classifier(trees=5, depth=3), [c for c in NUMERIC if c in keep], [c for c in CATEGORICAL if c in keep]
        )

    return models.feature_elimination(train, test, ranked, "label", build, [1, 2, 4])


@query("isotonic_calibration")
def isotonic_calibration(spark, folder):
    train, test = _parts_of(judged_documents(spark, folder))
    steps = _with(models.gbt_classifier(trees=5, depth=3))
    calibrated = models.CalibratedClassifier(steps, "doc_id", "label").fit(train).transform(test)
    return _predictions(steps.fit(train), calibrated.drop("split")).join(calibrated.select("doc_id", "calibrated"), "doc_id")


@query("learning_curve")
def learning_curve(spark, folder):
    train, test = _parts_of(judged_documents(spark, folder))
    return models.learning_curve(train, test, "doc_id", "label", _with(models.decision_tree(4)), [0.3, 0.6, 1.0])


@query("tree_importance")
def tree_importance(spark, folder):
    train, _ = _parts_of(judged_documents(spark, folder))
    model = _with(models.gbt_classifier(trees=5, depth=3)).fit(train)
    path = scratch_path(spark, "forest")
    model.stages[-1].write().overwrite().save(path)
    return explain.tree_importance(spark, path, models.feature_names(model.transform(train)))


@query("shapley_sampled")
def shapley_sampled(spark, folder):
    train, test = _parts_of(judged_documents(spark, folder))
    model = Pipeline(
        stages=[*models.feature_stages(["n_chars", "words"], scale=False), models.decision_tree(4)]
    ).fit(train)

    def predict(df):
        scored = models.positive_probability(model.transform(df), "_p")
        return scored.drop("prediction").withColumnRenamed("_p", "prediction")

    from sumac.operators.selection import seeded_sample

    background = seeded_sample(train, "doc_id", 100, 42)
    return explain.shapley_sampled(test, "doc_id", ["n_chars", "words"], predict, background, orders=8)


# --- clustering and outliers -------------------------------------------------


@query("kmeans")
def kmeans(spark, folder):
    names, wide = coordinates(spark, folder)
    return clustering.kmeans(wide, names, 3).select("vec_id", "label", "cluster")


def _components(spark, folder):
    """Two principal components of all coordinates; a full covariance of them all would have 2,080 numbers a group."""
    names, wide = coordinates(spark, folder)
    return freeze(projection.pca_project(wide, names, 2).select("vec_id", "label", "pc1", "pc2"))


@query("gmm")
def gmm(spark, folder):
    return clustering.gaussian_mixture(_components(spark, folder), ["pc1", "pc2"], 3)


@query("gmm_information_criteria")
def gmm_information_criteria(spark, folder):
    return clustering.gmm_information_criteria(_components(spark, folder), ["pc1", "pc2"], range(3, 9))


@query("ward_two_stage")
def ward_two_stage(spark, folder):
    return clustering.ward(_components(spark, folder), ["pc1", "pc2"], 3)


def _shapes(spark, folder):
    """The vectors in the plane of their two principal components, taken from all coordinates; and the same sheared."""
    names, wide = coordinates(spark, folder)
    plain = _components(spark, folder).select("vec_id", F.col("pc1").alias("x"), F.col("pc2").alias("y"))
    # A vector that lacks a coordinate has no place in the plane, but is a row.
    lacking = wide.filter(F.greatest(*[F.col(n).isNull() | F.isnan(n) for n in names]))
    plain = plain.unionByName(lacking.select("vec_id", F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y")))
    x, y = linear_map([F.col("x"), F.col("y")], SHEAR)
    return {"plain": plain, "sheared": plain.select("vec_id", x.alias("x"), y.alias("y"))}


@query("clustering_comparison")
def clustering_comparison(spark, folder):
    pair = ["x", "y"]
    return clustering.clustering_comparison(
        _shapes(spark, folder),
        "vec_id",
        pair,
        {
            "kmeans": lambda df: clustering.kmeans(df, pair, 3),
            "mixture": lambda df: clustering.gaussian_mixture(df, pair, 3),
            "dbscan": lambda df: density.dbscan(df, "vec_id", pair, EPS, MIN_SAMPLES),
        },
    )


@query(
    "cluster_profile",
    "SELECT label, count(*) AS n, "
    + ", ".join(
        f"round_even({f}(CAST(embedding[{i + 1}] AS DOUBLE)) * 100, 0) / 100 AS e{i}_{name}"
        for i in range(WIDTH)
        for f, name in (("avg", "mean"), ("stddev_samp", "std"))
    )
    + " FROM embeddings GROUP BY label",
)
def cluster_profile(spark, folder):
    names, wide = coordinates(spark, folder)
    return clustering.cluster_profile(wide, "label", names)


@query("isolation_forest")
def isolation_forest(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey", "o_totalprice", F.dayofyear("o_orderdate").cast("double").alias("day")
    )
    return outliers.isolation_forest(orders, "o_orderkey", ["o_totalprice", "day"])
