"""Metric queries on closed-form scores, so that SQL can recompute them."""

from pyspark.sql import functions as F

from sumac.operators import evaluate as ops
from sumac.plans.registry import query, table
from sumac.plans.tables import SCORED_SQL, rounded, scored_events

_DECIDED_SQL = f"{SCORED_SQL}, decided AS (SELECT *, CAST(score >= 0.5 AS INTEGER) AS y_pred FROM scored)"
_RATES_SQL = """(tp + tn) / (tp + tn + fp + fn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
  coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1"""
_COUNTS_SQL = """count(*) FILTER ({t} = 0 AND {p} = 0) AS tn, count(*) FILTER ({t} = 0 AND {p} = 1) AS fp,
  count(*) FILTER ({t} = 1 AND {p} = 0) AS fn, count(*) FILTER ({t} = 1 AND {p} = 1) AS tp"""


def _decided(spark, folder):
    return scored_events(spark, folder).withColumn("y_pred", (F.col("score") >= 0.5).cast("int"))


@query(
    "binary_metrics",
    f"WITH {_DECIDED_SQL}, c AS (SELECT {_COUNTS_SQL.format(t='y_true', p='y_pred')} FROM decided) SELECT *, {_RATES_SQL} FROM c",
)
def binary_metrics(spark, folder):
    return ops.binary_metrics(_decided(spark, folder), "y_true", "y_pred")


# The stand-in for a multi-class model: the type of the next-lower event id.
_CLASSES_SQL = """named AS (SELECT event_type AS t, CASE WHEN event_id % 3 = 0 THEN event_type
  WHEN event_id % 3 = 1 THEN 'view' ELSE 'error' END AS p FROM events)"""


def _named(spark, folder):
    turn = F.col("event_id") % 3
    guess = F.when(turn == 0, F.col("event_type")).when(turn == 1, F.lit("view")).otherwise("error")
    return table(spark, folder, "events").select(F.col("event_type").alias("t"), guess.alias("p"))


@query(
    "classification_report",
    f"""WITH {_CLASSES_SQL}, k AS (SELECT DISTINCT t AS c FROM named UNION SELECT DISTINCT p FROM named),
    s AS (SELECT c, (SELECT count(*) FROM named WHERE t = c) AS support, (SELECT count(*) FROM named WHERE p = c) AS called,
      (SELECT count(*) FROM named WHERE t = c AND p = c) AS hit FROM k),
    r AS (SELECT c, coalesce(hit / nullif(called, 0), 0) AS precision, coalesce(hit / nullif(support, 0), 0) AS recall,
      coalesce(2 * hit / nullif(called + support, 0), 0) AS f1, support, hit FROM s)
    SELECT c AS class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support FROM r
    UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 9), round(sum(hit) / sum(support), 9),
      round(sum(hit) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM r
    UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9), CAST(sum(support) AS BIGINT) FROM r
    UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9), round(sum(recall * support) / sum(support), 9),
      round(sum(f1 * support) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM r""",
)
def classification_report(spark, folder):
    report = ops.classification_report(_named(spark, folder), "t", "p")
    return rounded(report, "precision", "recall", "f1", digits=9)


@query(
    "confusion_matrix",
    f"""WITH {_CLASSES_SQL} SELECT t, """
    + ", ".join(
        f"count(*) FILTER (p = '{c}') AS pred_{c}" for c in ("click", "error", "purchase", "signup", "view")
    )
    + " FROM named GROUP BY t",
)
def confusion_matrix(spark, folder):
    return ops.confusion_matrix(_named(spark, folder), "t", "p")


_PRICED_SQL = """guessed AS (SELECT p_retailprice AS y, 1400.0::DOUBLE AS flat, 900.0 + p_size * 10.0::DOUBLE AS sized,
  CASE WHEN p_size < 0 THEN 0.0::DOUBLE END AS broken FROM part)"""


def _guessed(spark, folder):
    return table(spark, folder, "part").select(
        F.col("p_retailprice").alias("y"),
        F.lit(1400.0).alias("flat"),
        (F.lit(900.0) + F.col("p_size") * 10.0).alias("sized"),
        F.when(F.col("p_size") < 0, 0.0).alias("broken"),
    )


@query(
    "mae",
    f"""WITH {_PRICED_SQL}, m AS (SELECT avg(abs(y - flat)) AS flat, avg(abs(y - sized)) AS sized FROM guessed)
    SELECT 'flat' AS model, round(flat, 6) AS mae, 0.0::DOUBLE AS gain FROM m
    UNION ALL SELECT 'sized', round(sized, 6), round(flat - sized, 6) FROM m""",
)
def mae(spark, folder):
    return rounded(ops.mae_table(_guessed(spark, folder), "y", {"flat": "flat", "sized": "sized"}, "flat"), "mae", "gain")


@query(
    "leaderboard",
    f"""WITH {_PRICED_SQL} SELECT 'flat' AS model, round(avg(abs(y - flat)), 6) AS mae FROM guessed
    UNION ALL SELECT 'sized', round(avg(abs(y - sized)), 6) FROM guessed
    UNION ALL SELECT 'broken', round(avg(abs(y - broken)), 6) FROM guessed""",
)
def leaderboard(spark, folder):
    models = {m: m for m in ("flat", "sized", "broken")}
    return rounded(ops.mae_table(_guessed(spark, folder), "y", models).drop("gain"), "mae")


@query(
    "dummy_regressor",
    "SELECT p_partkey, p_retailprice, round((SELECT avg(p_retailprice) FROM part), 6) AS prediction FROM part",
)
def dummy_regressor(spark, folder):
    from sumac.operators.models import MeanRegressor

    parts = table(spark, folder, "part").select("p_partkey", "p_retailprice")
    return rounded(MeanRegressor("p_retailprice").fit(parts).transform(parts), "prediction")


@query("brier_score", f"WITH {SCORED_SQL} SELECT round(avg((score - y_true) * (score - y_true)), 9) AS brier FROM scored")
def brier_score(spark, folder):
    return rounded(ops.brier_score(scored_events(spark, folder), "y_true", "score"), "brier", digits=9)


@query(
    "calibration_curve",
    f"""WITH {SCORED_SQL} SELECT CAST({' + '.join(f'CAST(score > {i} * CAST(0.1 AS DOUBLE) AS INTEGER)' for i in range(1, 10))} AS INTEGER) AS bin,
    round(avg(score), 9) AS mean_predicted, round(avg(CAST(y_true AS DOUBLE)), 9) AS positive_share, count(*) AS n
    FROM scored GROUP BY 1""",
)
def calibration_curve(spark, folder):
    curve = ops.calibration_curve(scored_events(spark, folder), "y_true", "score")
    return rounded(curve, "mean_predicted", "positive_share", digits=9)


_CUTS = [0.3, 0.4, 0.5, 0.6, 0.7, 0.8]


@query(
    "threshold_sweep",
    f"""WITH {SCORED_SQL}, c AS (SELECT threshold, {_COUNTS_SQL.format(t='y_true', p='CAST(score >= threshold AS INTEGER)')}
    FROM scored, (SELECT unnest({_CUTS}::DOUBLE[]) AS threshold) GROUP BY threshold) SELECT *, {_RATES_SQL} FROM c""",
)
def threshold_sweep(spark, folder):
    return ops.threshold_sweep(scored_events(spark, folder), "y_true", "score", _CUTS)


@query(
    "rule_quality",
    f"""WITH {SCORED_SQL}, d AS (SELECT y_true, CAST(k > 80 OR (value > 60 AND event_type = 'purchase') AS INTEGER) AS r FROM scored),
    c AS (SELECT {_COUNTS_SQL.format(t='y_true', p='r')} FROM d)
    SELECT (tp + fp) / (tp + tn + fp + fn) AS coverage, tp + fp AS n_covered, tp / (tp + fp) AS precision,
    (tp + tn) / (tp + tn + fp + fn) AS accuracy, tp / (tp + fn) AS recall, tn / (tn + fp) AS specificity,
    tp / (tp + fp) AS precision_covered FROM c""",
)
def rule_quality(spark, folder):
    fires = (F.col("k") > 80) | ((F.col("value") > 60) & (F.col("event_type") == "purchase"))
    return ops.rule_quality(scored_events(spark, folder), "y_true", fires)


@query(
    "select_best_model",
    """SELECT o_orderpriority AS model, round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*), 4) AS score
    FROM orders GROUP BY 1 ORDER BY score DESC, model LIMIT 1""",
)
def select_best_model(spark, folder):
    from sumac.functions.scalars import money_mean

    orders = table(spark, folder, "orders")
    scores = orders.groupBy(F.col("o_orderpriority").alias("model")).agg(money_mean(F.col("o_totalprice")).alias("score"))
    return ops.select_best(rounded(scores, "score", digits=4), "model", "score")


@query(
    "search_history",
    """SELECT p_partkey, p_retailprice, max(p_retailprice) OVER (ORDER BY p_partkey ROWS UNBOUNDED PRECEDING) AS best FROM part""",
)
def search_history(spark, folder):
    return ops.search_history(table(spark, folder, "part"), "p_partkey", "p_retailprice", lower_is_better=False)


@query(
    "parallel_coordinates_table",
    """SELECT o_orderkey, o_totalprice, 'o_custkey' AS param, CAST(o_custkey AS DOUBLE) AS param_value FROM orders
    UNION ALL SELECT o_orderkey, o_totalprice, 'year', CAST(year(o_orderdate) AS DOUBLE) FROM orders""",
)
def parallel_coordinates_table(spark, folder):
    orders = table(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    return ops.parallel_coordinates(orders, "o_orderkey", ["o_custkey", "year"], "o_totalprice")
