"""Fit/transform queries: masks, imputers, scalers, encoders, splits."""

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from sumac.operators import clean, splits
from sumac.operators.categories import CategoryTable
from sumac.operators.profile import moment_distance as distance_table
from sumac.operators.projection import pca_project as project
from sumac.plans.profiling import NUMBERS
from sumac.plans.registry import query, table
from sumac.plans.tables import HOLED_EVENTS_SQL, HOLED_LINES_SQL, holed_events, holed_lines, rounded

KEYS = ["l_orderkey", "l_linenumber"]
_KEYS = ", ".join(KEYS)


def _stats(select: str) -> str:
    return "s AS (SELECT " + ", ".join(select.format(c=c) for c in NUMBERS) + " FROM holed)"


def _lines(spark, folder):
    return holed_lines(spark, folder).select(*KEYS, *NUMBERS)


def _each(expression: str) -> str:
    return ", ".join(expression.format(c=c) for c in NUMBERS)


@query(
    "iqr_mask",
    f"""WITH {HOLED_EVENTS_SQL}, s AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM holed)
    SELECT event_id, CASE WHEN value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) THEN value END AS value
    FROM holed, s""",
)
def iqr_mask(spark, folder):
    events = holed_events(spark, folder).select("event_id", "value")
    return clean.IqrMask(["value"], reach=1.5).fit(events).transform(events)


@query(
    "impute_mean",
    f"WITH {HOLED_LINES_SQL}, {_stats('avg({c}) AS {c}_m')} SELECT {_KEYS}, "
    + _each("round(coalesce({c}, {c}_m), 4) AS {c}")
    + " FROM holed, s",
)
def impute_mean(spark, folder):
    lines = _lines(spark, folder)
    return rounded(clean.ImputeMean(NUMBERS).fit(lines).transform(lines), *NUMBERS, digits=4)


@query(
    "impute_median",
    f"WITH {HOLED_LINES_SQL}, {_stats('quantile_cont({c}, 0.5) AS {c}_m')} SELECT {_KEYS}, "
    + _each("round(coalesce({c}, {c}_m), 6) AS {c}")
    + " FROM holed, s",
)
def impute_median(spark, folder):
    lines = _lines(spark, folder)
    return rounded(clean.ImputeMedian(NUMBERS).fit(lines).transform(lines), *NUMBERS)


@query(
    "impute_mode",
    f"""WITH {HOLED_EVENTS_SQL} SELECT event_id, coalesce(event_type, (SELECT event_type FROM holed
    WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, event_type LIMIT 1)) AS event_type FROM holed""",
)
def impute_mode(spark, folder):
    events = holed_events(spark, folder).select("event_id", "event_type")
    return clean.ImputeMode(["event_type"]).fit(events).transform(events)


@query(
    "fit_stats_join",
    f"WITH {HOLED_LINES_SQL}, {_stats('avg({c}) AS {c}_m')} SELECT {_KEYS}, "
    + _each("round({c} - {c}_m, 4) AS {c}")
    + " FROM holed, s",
)
def fit_stats_join(spark, folder):
    lines = _lines(spark, folder)
    # A scalar subquery: computed once, then a constant of the row projection.
    means = lines.agg(F.struct(*[F.avg(c).alias(c) for c in NUMBERS]).alias("m")).scalar()
    centred = lines.withColumn("_m", means).withColumns({c: F.col(c) - F.col(f"_m.{c}") for c in NUMBERS})
    return rounded(centred.drop("_m"), *NUMBERS, digits=4)


@query(
    "scale_minmax",
    f"WITH {HOLED_LINES_SQL}, {_stats('min({c}) AS {c}_lo, max({c}) AS {c}_hi')} SELECT {_KEYS}, "
    + _each("round(({c} - {c}_lo) / ({c}_hi - {c}_lo), 9) AS {c}")
    + " FROM holed, s",
)
def scale_minmax(spark, folder):
    lines = _lines(spark, folder)
    return rounded(clean.ScaleMinMax(NUMBERS).fit(lines).transform(lines), *NUMBERS, digits=9)


@query(
    "scale_standard",
    f"WITH {HOLED_LINES_SQL}, {_stats('avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s')} SELECT {_KEYS}, "
    + _each("round(({c} - {c}_m) / {c}_s, 4) AS {c}")
    + " FROM holed, s",
)
def scale_standard(spark, folder):
    lines = _lines(spark, folder)
    return rounded(clean.ScaleStandard(NUMBERS).fit(lines).transform(lines), *NUMBERS, digits=4)


_QUARTILES = "quantile_cont({c}, 0.25) AS {c}_a, quantile_cont({c}, 0.5) AS {c}_m, quantile_cont({c}, 0.75) AS {c}_b"


@query(
    "scale_robust",
    f"WITH {HOLED_LINES_SQL}, {_stats(_QUARTILES)} SELECT {_KEYS}, "
    + _each("round(({c} - {c}_m) / ({c}_b - {c}_a), 9) AS {c}")
    + " FROM holed, s",
)
def scale_robust(spark, folder):
    lines = _lines(spark, folder)
    return rounded(clean.ScaleRobust(NUMBERS).fit(lines).transform(lines), *NUMBERS, digits=9)


@query(
    "winsorize",
    f"""WITH {HOLED_EVENTS_SQL}, s AS (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM holed)
    SELECT event_id, round(CASE WHEN value < lo THEN lo WHEN value > hi THEN hi ELSE value END, 6) AS value FROM holed, s""",
)
def winsorize(spark, folder):
    events = holed_events(spark, folder).select("event_id", "value")
    return rounded(clean.Winsorize(["value"]).fit(events).transform(events), "value")


@query("log1p_step", "SELECT event_id, round(ln(1.0 + value), 9) AS value FROM events")
def log1p_step(spark, folder):
    events = table(spark, folder, "events").select("event_id", "value")
    return rounded(clean.Log1p(["value"]).transform(events), "value", digits=9)


@query(
    "one_hot",
    f"WITH {HOLED_EVENTS_SQL} SELECT event_id, "
    + ", ".join(
        f"CAST(coalesce(event_type = '{t}', FALSE) AS INTEGER) AS event_type_{t}"
        for t in ("click", "error", "purchase", "signup", "view")
    )
    + " FROM holed",
)
def one_hot(spark, folder):
    events = holed_events(spark, folder).select("event_id", "event_type")
    return clean.OneHot(["event_type"]).fit(events).transform(events)


@query(
    "wide_categories",
    """WITH p AS (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey),
    r AS (SELECT l_partkey, CASE WHEN n >= 0.0005 * (SELECT count(*) FROM lineitem)
      THEN row_number() OVER (PARTITION BY n >= 0.0005 * (SELECT count(*) FROM lineitem) ORDER BY l_partkey) - 1
      ELSE count_if(n >= 0.0005 * (SELECT count(*) FROM lineitem)) OVER () END AS slot FROM p)
    SELECT l_orderkey, l_linenumber, dense_rank() OVER (ORDER BY l_orderkey) - 1 AS l_orderkey_code,
      dense_rank() OVER (ORDER BY l_shipdate) - 1 AS l_shipdate_code, CAST(slot AS BIGINT) AS l_partkey_code
    FROM lineitem JOIN r USING (l_partkey)""",
)
def wide_categories(spark, folder):
    """Codes of columns with as many values as there are orders, days and parts; rare parts share one."""
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey")
    coded = CategoryTable.fit(lines, ["l_orderkey", "l_shipdate"]).encode(lines)
    coded = CategoryTable.fit(lines, ["l_partkey"], min_frequency=0.0005).encode(coded)
    return coded.select("l_orderkey", "l_linenumber", "l_orderkey_code", "l_shipdate_code", "l_partkey_code")


@query("one_hot_binary", """SELECT event_id, CAST(purchase = 'yes' AS INTEGER) AS purchase_yes
    FROM (SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'yes' ELSE 'no' END AS purchase FROM events)""")
def one_hot_binary(spark, folder):
    bought = F.when(F.col("event_type") == "purchase", "yes").otherwise("no")
    events = table(spark, folder, "events").select("event_id", bought.alias("purchase"))
    step = clean.OneHot(["purchase"], drop_binary=True, categories={"purchase": ["no", "yes"]})
    return step.fit(events).transform(events)


@query(
    "one_hot_min_frequency",
    """WITH c AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1),
    r AS (SELECT p_brand FROM c WHERE n < 0.04 * (SELECT count(*) FROM part))
    SELECT p_partkey, CASE WHEN p_brand IN (SELECT p_brand FROM r) THEN 'infrequent' ELSE p_brand END AS brand_group FROM part""",
)
def one_hot_min_frequency(spark, folder):
    parts = table(spark, folder, "part").select("p_partkey", "p_brand")
    fitted = clean.OneHot(["p_brand"], min_frequency=0.04).fit(parts)
    wide = fitted.transform(parts)
    # Read the indicator that is set back as text, to compare the whole encoding.
    names = fitted.output_names()
    group = F.coalesce(*[F.when(F.col(f"`{n}`") == 1, n.removeprefix("p_brand_")) for n in names])
    return wide.select("p_partkey", group.alias("brand_group"))


_LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]


@query(
    "ordinal_encode",
    "SELECT o_orderkey, coalesce(list_position(['1-URGENT','2-HIGH','3-MEDIUM','4-NOT SPECIFIED'], o_orderpriority), 0) - 1 AS o_orderpriority FROM orders",
)
def ordinal_encode(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return clean.OrdinalEncode(["o_orderpriority"], order=_LEVELS).fit(orders).transform(orders)


@query(
    "label_encode",
    """SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS code, c_mktsegment AS decoded
    FROM customer""",
)
def label_encode(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    fitted = clean.LabelEncode(["segment"]).fit(customers)
    coded = fitted.transform(customers).withColumn("code", F.col("segment"))
    return clean.decode(coded, fitted, "segment").withColumnRenamed("segment", "decoded")


@query(
    "column_branches",
    f"""WITH {HOLED_LINES_SQL}, s AS (SELECT quantile_cont(quantity, 0.5) AS qm, quantile_cont(price, 0.5) AS pm FROM holed),
    f AS (SELECT *, coalesce(quantity, qm) AS q, coalesce(price, pm) AS p FROM holed, s),
    m AS (SELECT avg(q) AS qa, stddev_pop(q) AS qs, avg(p) AS pa, stddev_pop(p) AS ps FROM f)
    SELECT {_KEYS}, round((q - qa) / qs, 4) AS quantity, round((p - pa) / ps, 4) AS price,
    CAST(l_returnflag = 'A' AS INTEGER) AS "l_returnflag_A", CAST(l_returnflag = 'N' AS INTEGER) AS "l_returnflag_N",
    CAST(l_returnflag = 'R' AS INTEGER) AS "l_returnflag_R" FROM f, m""",
)
def column_branches(spark, folder):
    lines = holed_lines(spark, folder)
    prepared = clean.column_branches(
        [([clean.ImputeMedian, clean.ScaleStandard], ["quantity", "price"]), ([clean.OneHot], ["l_returnflag"])],
        passthrough=KEYS,
    )
    return rounded(prepared.fit(lines).transform(lines), "quantity", "price", digits=4)


@query("step_compose")
def step_compose(spark, folder):
    lines = _lines(spark, folder)
    steps = Pipeline(stages=[clean.IqrMask(NUMBERS, reach=3.0), clean.ImputeMean(NUMBERS), clean.ScaleMinMax(NUMBERS)])
    return steps.copy().fit(lines).transform(lines)


@query("function_step", "SELECT event_id, value, round(ln(1.0 + value), 9) AS log_value FROM events")
def function_step(spark, folder):
    events = table(spark, folder, "events").select("event_id", "value")
    step = clean.FunctionStep(lambda df: df.withColumn("log_value", F.round(F.log1p("value"), 9)))
    return Pipeline(stages=[step]).fit(events).transform(events)


@query("pca_project")
def pca_project(spark, folder):
    lines = table(spark, folder, "lineitem").select(*KEYS, "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return project(lines, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], 2)


@query(
    "moment_distance",
    f"""WITH {HOLED_LINES_SQL}, m AS (SELECT avg(quantity) AS q, avg(price) AS p,
      quantile_cont(quantity, 0.5) AS q5, quantile_cont(price, 0.5) AS p5 FROM holed),
    f AS (SELECT 0 AS c, quantity AS q, price AS p FROM holed
      UNION ALL SELECT 1, coalesce(quantity, m.q), coalesce(price, m.p) FROM holed, m
      UNION ALL SELECT 2, coalesce(quantity, m.q5), coalesce(price, m.p5) FROM holed, m),
    a AS (SELECT c, avg(q) AS qa, avg(p) AS pa, stddev_samp(q) AS qs, stddev_samp(p) AS ps FROM f GROUP BY c)
    SELECT CASE x.c WHEN 1 THEN 'mean' ELSE 'median' END AS candidate,
    round(abs(x.qa - o.qa) + abs(x.pa - o.pa) + abs(x.qs - o.qs) + abs(x.ps - o.ps), 4) AS distance
    FROM a AS x, a AS o WHERE o.c = 0 AND x.c > 0""",
)
def moment_distance(spark, folder):
    lines = holed_lines(spark, folder)
    both = ["quantity", "price"]
    candidates = {
        "mean": clean.ImputeMean(both).fit(lines).transform(lines),
        "median": clean.ImputeMedian(both).fit(lines).transform(lines),
    }
    return rounded(distance_table(lines, candidates, both), "distance", digits=4)


_QUOTA_SQL = """WITH c AS (SELECT o_orderpriority AS label, count(*) AS n FROM orders GROUP BY 1),
    t AS (SELECT sum(n) AS total, sum(n) - ceil(0.3 * sum(n)) AS wanted FROM c),
    q AS (SELECT label, CAST(n AS HUGEINT) * CAST(wanted AS HUGEINT) // CAST(total AS HUGEINT) AS base,
      CAST(n AS HUGEINT) * CAST(wanted AS HUGEINT) % CAST(total AS HUGEINT) AS rest, wanted FROM c, t),
    r AS (SELECT label, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, label) <= wanted - sum(base) OVER () THEN 1 ELSE 0 END
      AS quota FROM q),
    o AS (SELECT o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_orderpriority
      ORDER BY md5(o_orderkey || '-42')) AS rank FROM orders)"""


@query(
    "stratified_split",
    _QUOTA_SQL
    + """ SELECT o_orderkey, o_orderpriority, CASE WHEN rank <= quota THEN 'train' ELSE 'test' END AS split
    FROM o JOIN r ON label = o_orderpriority""",
)
def stratified_split(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return splits.stratified_split(orders, "o_orderkey", "o_orderpriority", 0.3, 42)


@query(
    "stratified_split_many",
    _QUOTA_SQL.replace("o_orderpriority", "o_custkey")
    + """ SELECT o_orderkey, o_custkey, CASE WHEN rank <= quota THEN 'train' ELSE 'test' END AS split
    FROM o JOIN r ON label = o_custkey""",
)
def stratified_split_many(spark, folder):
    """A class per customer: thousands of classes, growing with the table."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return splits.stratified_split(orders, "o_orderkey", "o_custkey", 0.3, 42)


@query("split_rank", _QUOTA_SQL + " SELECT o_orderkey, o_orderpriority, rank FROM o")
def split_rank(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return splits.split_rank(orders, "o_orderkey", "o_orderpriority", 42)


@query(
    "chronological_split",
    """WITH o AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rank FROM orders),
    n AS (SELECT count(*) AS total, CAST(floor(0.7 * count(*)) AS BIGINT) AS train FROM orders),
    b AS (SELECT train, total - CAST(ceil(0.33 * (total - train)) AS BIGINT) AS valid FROM n)
    SELECT o_orderkey, CASE WHEN rank <= train THEN 'train' WHEN rank <= valid THEN 'valid' ELSE 'test' END AS split FROM o, b""",
)
def chronological_split(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return splits.chronological_split(orders, "o_orderdate", "o_orderkey").drop("o_orderdate")
