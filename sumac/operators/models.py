"""Model builders, comparison and calibration on Spark ML."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    OneVsRest,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasLabelCol
from pyspark.ml.regression import GBTRegressor, IsotonicRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from sumac.functions.scalars import seeded_hash
from sumac.operators import evaluate
from sumac.operators.clean import ImputeMedian, ImputeMode, ScaleStandard
from sumac.operators.profile import class_weights
from sumac.session import freeze

SEED = 42
#: Rows of a partition of model input until every core has a few partitions, and rows of one at most.
SPREAD_ROWS, PARTITION_ROWS = 16_384, 131_072


def feature_stages(numeric: Sequence[str], categorical: Sequence[str] = (), scale: bool = True) -> list:
    """Median fill and scaling for numbers, mode fill and one-hot for texts, one vector.

    One-hot vectors are sparse; an unseen category becomes all zeros.
    """
    stages: list = []
    if numeric:
        stages.append(ImputeMedian(numeric))
        if scale:
            stages.append(ScaleStandard(numeric))
    if categorical:
        codes, hots = [f"{c}_code" for c in categorical], [f"{c}_hot" for c in categorical]
        stages.append(ImputeMode(categorical))
        stages.append(
            StringIndexer(
                inputCols=list(categorical), outputCols=codes, handleInvalid="keep", stringOrderType="alphabetAsc"
            )
        )
        stages.append(OneHotEncoder(inputCols=codes, outputCols=hots, dropLast=True))
    inputs = [*numeric, *[f"{c}_hot" for c in categorical]]
    return [*stages, VectorAssembler(inputCols=inputs, outputCol="features")]


def feature_names(df: DataFrame, column: str = "features") -> list[str]:
    """Names of a vector's slots from its metadata, as ``column`` or ``column_value``."""
    groups = df.schema[column].metadata["ml_attr"]["attrs"].values()
    slots = sorted((a["idx"], a["name"]) for group in groups for a in group)
    return [name.replace("_hot_", "_", 1) for _, name in slots]


def positive_probability(df: DataFrame, name: str = "probability_1") -> DataFrame:
    """Probability of class 1 as a plain number."""
    return df.withColumn(name, vector_to_array("probability")[1])


class MeanRegressor(Estimator, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Predicts the training mean; the baseline every regression is compared with."""

    def __init__(self, label: str = "label"):
        super().__init__()
        self._set(labelCol=label)

    def _fit(self, df):
        mean = df.agg(F.avg(self.getLabelCol()).cast("double")).first()[0]
        value = "CAST(NULL AS DOUBLE)" if mean is None else f"CAST({mean!r} AS DOUBLE)"
        return SQLTransformer(statement=f"SELECT *, {value} AS prediction FROM __THIS__")


def gbt_classifier(trees: int = 100, rate: float = 0.05, depth: int = 6, share: float = 0.8, **more) -> GBTClassifier:
    return GBTClassifier(maxIter=trees, stepSize=rate, maxDepth=depth, subsamplingRate=share, seed=SEED, **more)


def gbt_regressor(trees: int = 100, rate: float = 0.1, depth: int = 6, share: float = 1.0, **more) -> GBTRegressor:
    return GBTRegressor(maxIter=trees, stepSize=rate, maxDepth=depth, subsamplingRate=share, seed=SEED, **more)


def random_forest(trees: int = 300, depth: int = 10, **more) -> RandomForestClassifier:
    # Each row's node in every tree is kept, instead of being found from the root again at every level.
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, cacheNodeIds=True, **more)


class ForestInGroups(Estimator):
    """A random forest whose trees are grown ``GROUP`` at a time, as one model.

    Spark keeps, for every row, each tree's sample weight and node until a fit is done: eight bytes a tree, which a group bounds.
    Groups differ in their seed, as the trees of one fit differ in their samples and columns.
    """

    GROUP = 25

    def __init__(self, trees: int = 300, depth: int = 10):
        super().__init__()
        self.trees, self.depth = trees, depth

    def _fit(self, df):
        fits = []
        for start in range(0, self.trees, self.GROUP):
            forest = random_forest(min(self.GROUP, self.trees - start), self.depth)
            fits.append(forest.setSeed(SEED + start).fit(df))
        context = df.sparkSession.sparkContext
        ml = context._jvm.org.apache.spark.ml
        grown = [tree for fit in fits for tree in fit._java_obj.trees()]
        trees = context._gateway.new_array(ml.classification.DecisionTreeClassificationModel, len(grown))
        for k, tree in enumerate(grown):
            trees[k] = tree
        first = fits[0]._java_obj
        joined = ml.classification.RandomForestClassificationModel(first.uid(), trees, first.numFeatures(), first.numClasses())
        first.copyValues(joined, ml.param.ParamMap.empty())
        joined.set("numTrees", len(grown))
        return RandomForestClassificationModel(joined)


def logistic_regression(rounds: int = 1000, **more) -> LogisticRegression:
    return LogisticRegression(maxIter=rounds, **more)


def decision_tree(depth: int = 10, **more) -> DecisionTreeClassifier:
    return DecisionTreeClassifier(maxDepth=depth, seed=SEED, **more)


def weighted(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Adds the balanced class weight of each row's label."""
    # One row per class, as class_weights returns it; Spark broadcasts it when small.
    return df.join(class_weights(df, label).select(label, F.col("weight").alias(name)), label)


def linear_svc_ovr(rounds: int = 50, parallelism: int = 4, weight: str | None = "weight") -> OneVsRest:
    """One linear support-vector model per class against the rest."""
    one = LinearSVC(maxIter=rounds, weightCol=weight) if weight else LinearSVC(maxIter=rounds)
    more = {"weightCol": weight} if weight else {}
    return OneVsRest(classifier=one, parallelism=parallelism, **more)


def spread(df: DataFrame) -> DataFrame:
    """The rows in partitions of bounded size, as many as fitting and scoring need.

    Narrow tables come from few files, so few tasks would fit every tree, and each would cache its share of the rows with a
    number per tree and vector slot. Small tables stay as they are.
    """
    rows = df.count()
    wanted = min(-(-rows // SPREAD_ROWS), 4 * df.sparkSession.sparkContext.defaultParallelism)
    parts = max(wanted, -(-rows // PARTITION_ROWS))
    return df.repartition(parts) if parts > 1 else df


def fit_all(train: DataFrame, estimators: Mapping[str, Estimator], parallelism: int = 3) -> dict[str, tuple[Model, float]]:
    """Fit independent estimators at once; (model, seconds) by name.

    Threads only submit jobs: the fits share the cluster, the table is cached once.
    """
    train = train.persist()
    try:

        def one(estimator: Estimator) -> tuple[Model, float]:
            start = time.perf_counter()
            return estimator.fit(train), time.perf_counter() - start

        with ThreadPoolExecutor(parallelism) as pool:
            return dict(zip(estimators, pool.map(one, estimators.values())))
    finally:
        train.unpersist()


def compare_classifiers(
    train: DataFrame, test: DataFrame, key: str, label: str, estimators: Mapping[str, Estimator], folds: int = 3
) -> DataFrame:
    """Cross-validated AUC and hold-out metrics per model, best precision first."""
    spark = train.sparkSession
    fold = F.conv(F.substring(seeded_hash(F.col(key), SEED), 1, 8), 16, 10).cast("long") % folds
    train = train.withColumn("_fold", fold).persist()
    auc = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")

    def judge(name: str) -> tuple:
        estimator, scores = estimators[name], []
        for i in range(folds):
            model = estimator.fit(train.filter(F.col("_fold") != i))
            scores.append(auc.evaluate(model.transform(train.filter(F.col("_fold") == i))))
        m = evaluate.binary_metrics(estimator.fit(train).transform(test), label, "prediction").first()
        return name, sum(scores) / folds, m["accuracy"], m["precision"], m["recall"], m["f1"]

    with ThreadPoolExecutor(len(estimators)) as pool:
        rows = list(pool.map(judge, estimators))
    train.unpersist()
    table = spark.createDataFrame(rows, "model string, auc double, accuracy double, precision double, recall double, f1 double")
    return table.orderBy(F.desc("precision"), F.desc("accuracy"), "model")


def pooled(df: DataFrame, at: str, value: str) -> DataFrame:
    """Mean value and row count per distinct position: all an isotonic fit needs."""
    return df.groupBy(at).agg(F.avg(value).alias(value), F.count(F.lit(1)).cast("double").alias("weight"))


def isotonic(df: DataFrame, at: str, value: str, increasing: bool = True, output: str = "isotonic"):
    """Isotonic fit on pooled positions, so that copies of a score do not travel."""
    step = IsotonicRegression(
        featuresCol=at, labelCol=value, weightCol="weight", isotonic=increasing, predictionCol=output
    )
    return step.fit(pooled(df, at, value))


class MonotoneRegressor:
    """Regression that never rises with one column (the price).

    Boosted trees learn from the other columns; the rest of the target is fitted
    by a falling step function of the price. Their sum falls with the price for
    any fixed other columns.
    """

    def __init__(self, base: Pipeline, price: str, label: str):
        self.base, self.price, self.label = base, price, label

    def fit(self, df: DataFrame) -> MonotoneRegressor:
        self.model = self.base.fit(df)
        rest = self.model.transform(df).withColumn("_rest", F.col(self.label) - F.col("prediction"))
        # The step function takes doubles; the price is cast the same way when scoring.
        rest = rest.withColumn("_price", F.col(self.price).cast("double"))
        self.steps = isotonic(rest, "_price", "_rest", increasing=False, output="_step")
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        scored = self.model.transform(df).withColumn("_price", F.col(self.price).cast("double"))
        stepped = self.steps.transform(scored)
        return stepped.withColumn("prediction", F.col("prediction") + F.col("_step")).drop("_step", "_price")


class CalibratedClassifier:
    """Cross-fitted isotonic calibration: the mean of one calibrated model per fold."""

    def __init__(self, estimator: Pipeline, key: str, label: str, folds: int = 5):
        self.estimator, self.key, self.label, self.folds = estimator, key, label, folds

    def fit(self, df: DataFrame) -> CalibratedClassifier:
        fold = F.conv(F.substring(seeded_hash(F.col(self.key), SEED), 1, 8), 16, 10).cast("long") % self.folds
        data = df.withColumn("_fold", fold).persist()

        def one(i: int):
            model = self.estimator.fit(data.filter(F.col("_fold") != i))
            held = positive_probability(model.transform(data.filter(F.col("_fold") == i)), "_p")
            held = held.withColumn("_y", F.col(self.label).cast("double"))
            return model, isotonic(held, "_p", "_y", output="_calibrated")

        with ThreadPoolExecutor(self.folds) as pool:
            self.parts = list(pool.map(one, range(self.folds)))
        data.unpersist()
        return self

    def transform(self, df: DataFrame, output: str = "calibrated") -> DataFrame:
        out = df
        for i, (model, steps) in enumerate(self.parts):
            scored = steps.transform(positive_probability(model.transform(out), "_p"))
            out = scored.withColumn(f"_p{i}", F.col("_calibrated")).select(*out.columns, f"_p{i}")
        names = [f"_p{i}" for i in range(self.folds)]
        mean = sum((F.col(n) for n in names[1:]), F.col(names[0])) / self.folds
        return out.withColumn(output, mean).drop(*names)


def learning_curve(
    train: DataFrame, valid: DataFrame, key: str, label: str, estimator: Estimator, shares: Sequence[float]
) -> DataFrame:
    """F1 on the used training rows and on validation rows by training share (nested seeded samples)."""
    place = F.conv(F.substring(seeded_hash(F.col(key), SEED), 1, 8), 16, 10).cast("double") / float(16**8)
    rows = []
    for share in shares:
        used = train.filter(place < share)
        model = estimator.fit(used)
        scores = [
            evaluate.binary_metrics(model.transform(part), label, "prediction").first() for part in (used, valid)
        ]
        counts = ("tn", "fp", "fn", "tp")
        rows.append((float(share), sum(scores[0][c] for c in counts), scores[0]["f1"], scores[1]["f1"]))
    return train.sparkSession.createDataFrame(rows, "share double, n_train long, train_f1 double, valid_f1 double")


def feature_elimination(
    train: DataFrame,
    test: DataFrame,
    ranked: Sequence[str],
    label: str,
    build: Callable[[Sequence[str]], Estimator],
    sizes: Sequence[int],
) -> DataFrame:
    """Refit on the k most important columns for each k; best precision, accuracy, then time."""
    train, test = train.persist(), test.persist()
    rows = []
    for k in sizes:
        keep = list(ranked[:k])
        start = time.perf_counter()
        model = build(keep).fit(train)
        seconds = time.perf_counter() - start
        scored = freeze(model.transform(test).select(F.col(label).cast("int"), F.col("prediction").cast("int")))
        m = evaluate.binary_metrics(scored, label, "prediction").first()
        macro = evaluate.classification_report(scored, label, "prediction").filter("class = 'macro avg'").first()["f1"]
        rows.append((k, ",".join(keep), round(seconds, 3), m["accuracy"], m["precision"], macro))
    train.unpersist()
    test.unpersist()
    schema = "k int, kept string, train_seconds double, accuracy double, precision double, f1_macro double"
    table = train.sparkSession.createDataFrame(rows, schema)
    return table.orderBy(F.desc("precision"), F.desc("accuracy"), F.asc("train_seconds"), "k")


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
