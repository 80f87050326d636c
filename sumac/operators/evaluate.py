"""Metric and report tables over prediction columns.

Each metric is one pass with conditional counts; the counts combine map-side and
only small tables (classes, bins, thresholds) travel further.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sumac.operators.ordering import global_running


def safe_ratio(top: Column, bottom: Column) -> Column:
    """A ratio that is 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def confusion_counts(truth: Column, predicted: Column, positive: object = 1) -> dict[str, Column]:
    is_true, is_hit = truth == F.lit(positive), predicted == F.lit(positive)
    return {
        "tn": F.count_if(~is_true & ~is_hit),
        "fp": F.count_if(~is_true & is_hit),
        "fn": F.count_if(is_true & ~is_hit),
        "tp": F.count_if(is_true & is_hit),
    }


def rates() -> dict[str, Column]:
    """Accuracy, precision, recall and F1 from columns tn, fp, fn, tp."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return {
        "accuracy": safe_ratio(tp + tn, tp + tn + fp + fn),
        "precision": safe_ratio(tp, tp + fp),
        "recall": safe_ratio(tp, tp + fn),
        "f1": safe_ratio(tp * 2, tp * 2 + fp + fn),
    }


def binary_metrics(df: DataFrame, truth: str, predicted: str, by: Sequence[str] = (), positive: object = 1) -> DataFrame:
    counts = confusion_counts(F.col(truth), F.col(predicted), positive)
    return df.groupBy(*by).agg(*[e.alias(n) for n, e in counts.items()]).withColumns(rates())


def classification_report(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    """One row per class plus accuracy, macro and weighted averages."""
    pairs = df.groupBy(F.col(truth).cast("string").alias("t"), F.col(predicted).cast("string").alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )
    hit = F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)
    sides = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("t").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("called"), hit.alias("hit")),
                F.struct(F.col("p").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("called"), F.lit(0).cast("long").alias("hit")),
            )
        ).alias("s")
    ).select("s.*")
    classes = (
        sides.groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("called").alias("called"), F.sum("hit").alias("hit"))
        .select(
            "class",
            safe_ratio(F.col("hit"), F.col("called")).alias("precision"),
            safe_ratio(F.col("hit"), F.col("support")).alias("recall"),
            safe_ratio(F.col("hit") * 2, F.col("called") + F.col("support")).alias("f1"),
            "support",
            "hit",
        )
    )
    scores = ("precision", "recall", "f1")
    total = F.sum("support")
    summary = classes.agg(
        safe_ratio(F.sum("hit"), total).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in scores],
        *[safe_ratio(F.sum(F.col(c) * F.col("support")), total).alias(f"weighted_{c}") for c in scores],
        total.alias("support"),
    )
    lines = [F.struct(F.lit("accuracy").alias("class"), *[F.col("accuracy").alias(c) for c in scores], F.col("support"))]
    for kind in ("macro", "weighted"):
        lines.append(
            F.struct(F.lit(f"{kind} avg").alias("class"), *[F.col(f"{kind}_{c}").alias(c) for c in scores], F.col("support"))
        )
    averages = summary.select(F.explode(F.array(*lines)).alias("r")).select("r.*")
    return classes.drop("hit").unionByName(averages)


def confusion_matrix(df: DataFrame, truth: str, predicted: str, labels: Sequence[object] | None = None, most: int = 1000) -> DataFrame:
    """Rows are true labels, columns predicted ones, zeros shown; rows without a true label count nowhere.

    Every label is a column, so more than ``most`` of them raise; the counts by (truth, predicted) serve such tables.
    """
    counts = df.groupBy(truth, predicted).agg(F.count(F.lit(1)).alias("n"))
    if labels is None:
        seen = counts.select(F.explode(F.array(truth, predicted)).alias("v")).filter("v is not null").distinct()
        labels = sorted(r["v"] for r in seen.limit(most + 1).collect())
        if len(labels) > most:
            raise ValueError(f"more than {most} labels")
    wide = counts.groupBy(truth).agg(
        *[F.coalesce(F.sum(F.when(F.col(predicted) == F.lit(v), F.col("n"))), F.lit(0)).alias(f"pred_{v}") for v in labels]
    )
    rows = df.sparkSession.createDataFrame([(v,) for v in labels], df.select(truth).schema)
    return rows.join(wide, truth, "left").fillna(0)


def mae_table(df: DataFrame, truth: str, predictions: Mapping[str, str], baseline: str | None = None) -> DataFrame:
    """(model, mae, gain over the baseline), best first and missing last."""
    summary = df.agg(*[F.avg(F.abs(F.col(truth) - F.col(c))).alias(m) for m, c in predictions.items()])
    rows = [F.struct(F.lit(m).alias("model"), F.col(m).alias("mae")) for m in predictions]
    long = summary.select("*", F.explode(F.array(*rows)).alias("r"))
    gain = (F.col(baseline) - F.col("r.mae")) if baseline else F.lit(None).cast("double")
    return long.select("r.*", gain.alias("gain")).orderBy(F.asc_nulls_last("mae"), "model")


def brier_score(df: DataFrame, truth: str, probability: str) -> DataFrame:
    error = F.col(probability) - F.col(truth)
    return df.agg(F.avg(error * error).alias("brier"))


def brier_score_multi(df: DataFrame, truth: str, probabilities: Mapping[object, str]) -> DataFrame:
    """Mean over classes of the one-against-rest score."""
    parts = []
    for label, column in probabilities.items():
        error = F.col(column) - (F.col(truth) == F.lit(label)).cast("double")
        parts.append(F.avg(error * error))
    return df.agg((sum(parts[1:], parts[0]) / len(parts)).alias("brier"))


def calibration_curve(df: DataFrame, truth: str, probability: str, bins: int = 10) -> DataFrame:
    """Mean probability against positive share per equal-width bin; empty bins are left out.

    A probability on an edge belongs to the lower bin.
    """
    inner = [i * (1.0 / bins) for i in range(1, bins)]
    place = sum(((F.col(probability) > F.lit(e)).cast("int") for e in inner), F.lit(0))
    return df.groupBy(place.alias("bin")).agg(
        F.avg(probability).alias("mean_predicted"),
        F.avg(F.col(truth).cast("double")).alias("positive_share"),
        F.count(F.lit(1)).alias("n"),
    )


def threshold_sweep(df: DataFrame, truth: str, score: str, thresholds: Sequence[float]) -> DataFrame:
    """Metrics at each cut. Rows are counted once by how many cuts they pass."""
    cuts = sorted(thresholds)
    passed = sum(((F.col(score) >= F.lit(c)).cast("int") for c in cuts), F.lit(0))
    counts = df.groupBy(passed.alias("passed")).agg(
        F.count_if(F.col(truth) == 1).alias("pos"), F.count_if(F.col(truth) == 0).alias("neg")
    )
    # At most one row per threshold from here on.
    levels = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate([None, *cuts])], "passed int, threshold double")
    ladder = levels.join(counts, "passed", "left").fillna(0, ["pos", "neg"])
    above = Window.orderBy(F.desc("passed")).rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy(F.desc("passed")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    table = ladder.select(
        "threshold",
        F.sum("pos").over(above).alias("tp"),
        F.sum("neg").over(above).alias("fp"),
        (F.sum("pos").over(everything) - F.sum("pos").over(above)).alias("fn"),
        (F.sum("neg").over(everything) - F.sum("neg").over(above)).alias("tn"),
    )
    return table.filter(F.col("threshold").isNotNull()).withColumns(rates())


def rule_quality(df: DataFrame, truth: str, fires: Column) -> DataFrame:
    """Coverage and correctness of a rule read as a classifier."""
    data = df.withColumn("_fires", F.coalesce(fires, F.lit(False)).cast("int"))
    row = binary_metrics(data, truth, "_fires")
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    covered = F.col("tp") + F.col("fp")
    return row.select(
        safe_ratio(covered, total).alias("coverage"),
        covered.alias("n_covered"),
        "precision",
        "accuracy",
        "recall",
        safe_ratio(F.col("tn"), F.col("tn") + F.col("fp")).alias("specificity"),
        F.try_divide(F.col("tp").cast("double"), covered.cast("double")).alias("precision_covered"),
    )


def select_best(scores: DataFrame, name: str, score: str, lower_is_better: bool = False) -> DataFrame:
    """Best score; the first name wins a tie and missing scores lose."""
    order = F.asc_nulls_last(score) if lower_is_better else F.desc_nulls_last(score)
    return scores.orderBy(order, name).limit(1)


def search_history(trials: DataFrame, trial: str, value: str, lower_is_better: bool = True) -> DataFrame:
    kind = "min" if lower_is_better else "max"
    return global_running(trials.select(trial, value), [trial], {"best": (kind, value)})


def parallel_coordinates(trials: DataFrame, trial: str, params: Sequence[str], value: str) -> DataFrame:
    """One row per trial and parameter."""
    typed = trials.select(trial, value, *[F.col(p).cast("double").alias(p) for p in params])
    return typed.unpivot([trial, value], list(params), "param", "param_value")
