"""Explanation queries on a closed-form rule model over event columns."""

from pyspark.sql import functions as F

from sumac.operators import explain as ops
from sumac.operators.selection import rows_at, seeded_sample
from sumac.plans.registry import query, table
from sumac.plans.tables import SCORED_SQL, rounded, scored_events

FEATURES = ["paid", "joined", "late"]
REPEATS = 30
SEED = 42

_FACTS_SQL = """facts AS (SELECT event_id, CAST(event_type = 'purchase' AS INTEGER) AS paid,
  CAST(event_type = 'signup' AS INTEGER) AS joined, CAST(k > 70 AS INTEGER) AS late,
  CAST((event_id * 37) % 101 > 40 AS INTEGER) AS label
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events))"""


def _facts(spark, folder):
    k = F.get_json_object("props", "$.k").cast("double")
    return table(spark, folder, "events").select(
        "event_id",
        (F.col("event_type") == "purchase").cast("int").alias("paid"),
        (F.col("event_type") == "signup").cast("int").alias("joined"),
        (k > 70).cast("int").alias("late"),
        ((F.col("event_id") * 37) % 101 > 40).cast("int").alias("label"),
    )


def _rule(x):
    """0/1 decision of the stand-in model."""
    return F.when((x["paid"] == 1) | ((x["joined"] == 1) & (x["late"] == 0)), 1).otherwise(0)


_RULE_SQL = "CASE WHEN {paid} = 1 OR ({joined} = 1 AND {late} = 0) THEN 1 ELSE 0 END"


def _smooth(x):
    """Score with an interaction, for contributions and dependence curves."""
    return F.lit(0.1) + x["paid"] * 0.5 + x["joined"] * x["late"] * 0.25


_SMOOTH_SQL = "(0.1::DOUBLE + {paid} * 0.5::DOUBLE + {joined} * {late} * 0.25::DOUBLE)"

_PLACE_SQL = ops.shuffled_place("a.rank", "a.n", "a.width", "a.height", f"({SEED} * 1000003 + r.rep::BIGINT * 7919 + f.f * 104729)", "//")

_PERMUTED_SQL = f"""{_FACTS_SQL}, numbered AS (SELECT *, row_number() OVER (ORDER BY md5(event_id || '-{SEED}'), event_id) - 1 AS rank,
  count(*) OVER () AS n FROM facts),
shaped AS (SELECT *, ceil(sqrt(n))::BIGINT AS width FROM numbered),
ranked AS MATERIALIZED (SELECT *, (n + width - 1) // width AS height FROM shaped),
dealt AS MATERIALIZED (SELECT a.*, r.rep, f.feature, {_PLACE_SQL} AS donor FROM ranked AS a
  CROSS JOIN (SELECT CAST(unnest(range(1, {{reps}} + 1)) AS INTEGER) AS rep) AS r
  CROSS JOIN (SELECT unnest(['paid', 'joined', 'late']) AS feature, unnest([0, 1, 2]) AS f) AS f),
permuted AS (SELECT a.rep, a.feature, a.event_id, a.label,
  CASE WHEN a.feature = 'paid' THEN b.paid ELSE a.paid END AS paid,
  CASE WHEN a.feature = 'joined' THEN b.joined ELSE a.joined END AS joined,
  CASE WHEN a.feature = 'late' THEN b.late ELSE a.late END AS late
  FROM dealt AS a JOIN ranked AS b ON b.rank = a.donor)"""


@query(
    "permutation_expand",
    f"""WITH {_PERMUTED_SQL.format(reps=2)} SELECT rep, feature, event_id, paid, joined, late FROM permuted
    UNION ALL SELECT 0, NULL, event_id, paid, joined, late FROM facts""",
)
def permutation_expand(spark, folder):
    return ops.permutations(_facts(spark, folder), "event_id", FEATURES, 2, SEED)


@query(
    "permutation_importance",
    f"""WITH {_PERMUTED_SQL.format(reps=REPEATS)},
    p AS (SELECT feature, rep, label, {_RULE_SQL.format(paid='paid', joined='joined', late='late')} AS hit FROM permuted
      UNION ALL SELECT NULL, 0, label, {_RULE_SQL.format(paid='paid', joined='joined', late='late')} FROM facts),
    s AS (SELECT feature, rep, 2 * count(*) FILTER (hit = 1 AND label = 1)
      / (count(*) FILTER (hit = 1) + count(*) FILTER (label = 1)) AS f1 FROM p GROUP BY 1, 2)
    SELECT feature, round(avg((SELECT f1 FROM s WHERE rep = 0) - f1), 9) AS importance_mean,
    round(stddev_pop((SELECT f1 FROM s WHERE rep = 0) - f1), 9) AS importance_std FROM s WHERE rep > 0 GROUP BY 1""",
)
def permutation_importance(spark, folder):
    predict = ops.as_scorer(_rule, FEATURES)
    found = ops.permutation_importance(_facts(spark, folder), "event_id", FEATURES, "label", predict, REPEATS, SEED)
    return rounded(found, "importance_mean", "importance_std", digits=9)


@query(
    "partial_dependence",
    f"""WITH {SCORED_SQL}, s AS (SELECT * FROM scored ORDER BY md5(event_id || '-{SEED}'), event_id LIMIT 1000),
    q AS (SELECT quantile_cont(value, 0.05) AS lo, quantile_cont(value, 0.95) AS hi FROM s),
    g AS (SELECT lo + (hi - lo) * i / 49 AS grid_value FROM q, (SELECT unnest(range(50)) AS i))
    SELECT round(grid_value, 6) AS grid_value, round(avg(CASE WHEN grid_value > 60 THEN 0.7 ELSE 0.2 END + k * 0.001 * (grid_value / 100)), 9) AS average,
    count(*) AS n FROM s, g GROUP BY g.grid_value""",
)
def partial_dependence(spark, folder):
    def rule(x):
        return F.when(x["value"] > 60, 0.7).otherwise(0.2) + x["k"] * 0.001 * (x["value"] / 100)

    events = scored_events(spark, folder)
    predict = ops.as_scorer(rule, ["value", "k"])
    curve = ops.partial_dependence(events, "event_id", ["value", "k"], "value", predict)
    return rounded(rounded(curve, "average", digits=9), "grid_value")


_GRID = [0.0, 10.0, 50.0, 100.0]


@query(
    "grid_cross_join",
    f"""SELECT event_id, grid AS value, user_id FROM events, (SELECT unnest({_GRID}::DOUBLE[]) AS grid)""",
)
def grid_cross_join(spark, folder):
    return ops.grid_expand(table(spark, folder, "events").select("event_id", "value", "user_id"), "value", _GRID)


_BACKGROUND_SQL = f"""bg AS (SELECT paid, joined, late, count(*) / 1000.0::DOUBLE AS w FROM
  (SELECT * FROM facts ORDER BY md5(event_id || '-{SEED}'), event_id LIMIT 1000) GROUP BY 1, 2, 3)"""


def _subset_value(known: tuple[str, ...]) -> str:
    mixed = {f: f"{'x' if f in known else 'b'}.{f}" for f in FEATURES}
    return f"sum(b.w * {_SMOOTH_SQL.format(**mixed)}) AS v{''.join(str(int(f in known)) for f in FEATURES)}"


_SUBSETS = [tuple(f for f, bit in zip(FEATURES, f"{i:03b}") if bit == "1") for i in range(8)]
_VALUES_SQL = f"""{_FACTS_SQL}, {_BACKGROUND_SQL}, combos AS (SELECT DISTINCT paid, joined, late FROM facts),
  v AS (SELECT x.paid, x.joined, x.late, {', '.join(_subset_value(s) for s in _SUBSETS)} FROM combos AS x, bg AS b GROUP BY 1, 2, 3),
  phi AS (SELECT paid, joined, late, v000 AS base, v111 AS prediction,
    (v100 - v000) / 3 + (v110 - v010) / 6 + (v101 - v001) / 6 + (v111 - v011) / 3 AS phi_paid,
    (v010 - v000) / 3 + (v110 - v100) / 6 + (v011 - v001) / 6 + (v111 - v101) / 3 AS phi_joined,
    (v001 - v000) / 3 + (v101 - v100) / 6 + (v011 - v010) / 6 + (v111 - v110) / 3 AS phi_late FROM v),
  long AS (SELECT event_id, f.feature, CASE f.feature WHEN 'paid' THEN paid WHEN 'joined' THEN joined ELSE late END::DOUBLE AS value,
    CASE f.feature WHEN 'paid' THEN phi_paid WHEN 'joined' THEN phi_joined ELSE phi_late END AS phi, base, prediction
    FROM facts JOIN phi USING (paid, joined, late) CROSS JOIN (SELECT unnest(['paid', 'joined', 'late']) AS feature) AS f)"""


def _phi(spark, folder):
    facts = _facts(spark, folder)
    background = seeded_sample(facts, "event_id", 1000, SEED)
    return ops.shapley_exact(facts, ["event_id"], FEATURES, _smooth, background)


@query(
    "shapley_local",
    f"""WITH {_VALUES_SQL} SELECT event_id, feature, value, round(phi, 9) AS phi, round(base, 9) AS base,
    round(prediction, 9) AS prediction FROM long""",
)
def shapley_local(spark, folder):
    return rounded(_phi(spark, folder), "phi", "base", "prediction", digits=9)


@query(
    "shapley_global",
    f"WITH {_VALUES_SQL} SELECT feature, round(avg(abs(phi)), 12) AS mean_abs_phi FROM long GROUP BY 1",
)
def shapley_global(spark, folder):
    return rounded(ops.shapley_global(_phi(spark, folder)), "mean_abs_phi", digits=12)


@query(
    "top_features",
    f"WITH {_VALUES_SQL} SELECT feature, round(avg(abs(phi)), 12) AS mean_abs_phi FROM long GROUP BY 1 ORDER BY avg(abs(phi)) DESC LIMIT 2",
)
def top_features(spark, folder):
    return rounded(ops.top_features(_phi(spark, folder), 2), "mean_abs_phi", digits=12)


@query(
    "shapley_scatter",
    f"""WITH {_VALUES_SQL}, top AS (SELECT feature FROM long GROUP BY 1 ORDER BY avg(abs(phi)) DESC LIMIT 2)
    SELECT event_id, feature, value, round(phi, 9) AS phi, round(prediction, 9) AS prediction FROM long SEMI JOIN top USING (feature)""",
)
def shapley_scatter(spark, folder):
    points = ops.shapley_scatter(_phi(spark, folder), 2).drop("base")
    return rounded(points, "phi", "prediction", digits=9)


@query(
    "rule_explain",
    f"""WITH {_FACTS_SQL}, r AS (SELECT event_id, label AS truth, (late = 1 OR paid = 1) AS fires,
      {_RULE_SQL.format(paid='paid', joined='joined', late='late')} AS model, row_number() OVER (ORDER BY event_id) AS position FROM facts)
    SELECT position, event_id, fires, CAST(fires AS INTEGER) AS rule_prediction, model, truth FROM r
    WHERE position IN (101, 301, 575)""",
)
def rule_explain(spark, folder):
    facts = _facts(spark, folder)
    fires = (F.col("late") == 1) | (F.col("paid") == 1)
    explained = facts.select(
        "event_id",
        fires.alias("fires"),
        fires.cast("int").alias("rule_prediction"),
        _rule({f: F.col(f) for f in FEATURES}).alias("model"),
        F.col("label").alias("truth"),
    )
    return rows_at(explained, ["event_id"], [101, 301, 575])


@query(
    "importance_rollup",
    """SELECT CASE WHEN starts_with(f, 'p_type_') THEN 'p_type' WHEN starts_with(f, 'p_brand_') THEN 'p_brand' ELSE f END AS base,
    round(sum(importance), 9) AS importance FROM (
      SELECT 'p_type_' || p_type AS f, avg(p_size) / 100 AS importance FROM part GROUP BY 1
      UNION ALL SELECT 'p_brand_' || p_brand, avg(p_size) / 100 FROM part GROUP BY 1
      UNION ALL SELECT 'p_retailprice', avg(p_size) / 100 FROM part) GROUP BY 1""",
)
def importance_rollup(spark, folder):
    parts = table(spark, folder, "part")
    share = (F.avg("p_size") / 100).alias("importance")
    named = [
        parts.groupBy(F.concat(F.lit(f"cat__{c}_"), F.col(c)).alias("feature")).agg(share) for c in ("p_type", "p_brand")
    ]
    plain = parts.agg(share).select(F.lit("num__p_retailprice").alias("feature"), "importance")
    stacked = named[0].unionByName(named[1]).unionByName(plain)
    return rounded(ops.importance_rollup(stacked, ["p_type", "p_brand"]), "importance", digits=9)
