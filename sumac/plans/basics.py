"""Projection, scalar, sort, set and running-value queries."""

from pyspark.sql import functions as F

from sumac.functions import scalars as fn
from sumac.operators import selection as ops
from sumac.operators.ordering import global_rank, global_running
from sumac.plans.registry import query, table
from sumac.plans.tables import (
    FLAGS_SQL,
    HOLED_EVENTS_SQL,
    HOLED_LINES_SQL,
    REPEATED_EVENTS_SQL,
    SCORED_SQL,
    flagged_lines,
    holed_events,
    holed_lines,
    repeated_events,
    rounded,
    scored_events,
)

# --- projections and filters -------------------------------------------------


@query("select_by_dtype", "SELECT p_partkey, p_size, p_retailprice FROM part")
def select_by_dtype(spark, folder):
    return ops.select_by_kind(table(spark, folder, "part"), "numeric")


@query("drop_columns", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
def drop_columns(spark, folder):
    return table(spark, folder, "customer").drop("c_name", "c_nationkey", "no_such_column")


@query("select_existing", "SELECT s_acctbal, s_suppkey FROM supplier")
def select_existing(spark, folder):
    return ops.select_existing(table(spark, folder, "supplier"), ["s_acctbal", "s_rating", "s_suppkey"])


@query("restore_column_order", "SELECT s_suppkey, upper(s_name) AS s_name, s_nationkey, s_acctbal FROM supplier")
def restore_column_order(spark, folder):
    supplier = table(spark, folder, "supplier")
    changed = supplier.select(F.upper("s_name").alias("s_name"), "s_acctbal", "s_suppkey", "s_nationkey")
    return ops.in_order_of(changed, supplier.columns)


@query("split_features_target", "SELECT doc_id, toxic, quality AS label FROM labels")
def split_features_target(spark, folder):
    return ops.features_and_target(table(spark, folder, "labels"), "quality")


@query(
    "dropna_subset",
    f"""WITH {HOLED_LINES_SQL} SELECT l_orderkey, l_linenumber, quantity, price FROM holed
    WHERE quantity IS NOT NULL AND price IS NOT NULL""",
)
def dropna_subset(spark, folder):
    lines = holed_lines(spark, folder).dropna(subset=["quantity", "price"])
    return lines.select("l_orderkey", "l_linenumber", "quantity", "price")


@query(
    "filter_not_in",
    f"""WITH {HOLED_EVENTS_SQL} SELECT event_id, event_type FROM holed
    WHERE event_type IS NULL OR event_type NOT IN ('click', 'ERROR')""",
)
def filter_not_in(spark, folder):
    events = holed_events(spark, folder)
    return events.filter(fn.not_in(F.col("event_type"), ["click", "ERROR"])).select("event_id", "event_type")


@query(
    "label_from_null",
    f"WITH {HOLED_EVENTS_SQL} SELECT event_id, CAST(event_type IS NOT NULL AS DOUBLE) AS label FROM holed",
)
def label_from_null(spark, folder):
    return holed_events(spark, folder).select("event_id", fn.label_from_null(F.col("event_type")).alias("label"))


_GROUPS = {"1-URGENT": "now", "2-HIGH": "now", "3-MEDIUM": "soon", "5-LOW": "later"}


@query(
    "recode_dict",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '2-HIGH' THEN 'now'
    WHEN '3-MEDIUM' THEN 'soon' WHEN '5-LOW' THEN 'later' END AS urgency FROM orders""",
)
def recode_dict(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.select("o_orderkey", fn.recode(F.col("o_orderpriority"), _GROUPS).alias("urgency"))


# Fixed value: the shear applied to the two point coordinates.
SHEAR = [[0.6, -0.6], [-0.4, 0.8]]


@query(
    "linear_map_columns",
    """SELECT vec_id, round(CAST(embedding[1] AS DOUBLE) * 0.6 + CAST(embedding[2] AS DOUBLE) * -0.4, 9) AS x0,
    round(CAST(embedding[1] AS DOUBLE) * -0.6 + CAST(embedding[2] AS DOUBLE) * 0.8, 9) AS x1 FROM embeddings""",
)
def linear_map_columns(spark, folder):
    x = [F.col("embedding")[i].cast("double") for i in (0, 1)]
    x0, x1 = fn.linear_map(x, SHEAR)
    points = table(spark, folder, "embeddings").select("vec_id", x0.alias("x0"), x1.alias("x1"))
    return rounded(points, "x0", "x1", digits=9)


@query(
    "derive_amount",
    f"""WITH {HOLED_LINES_SQL} SELECT l_orderkey, l_linenumber, round(quantity * price, 4) AS amount FROM holed""",
)
def derive_amount(spark, folder):
    lines = holed_lines(spark, folder).withColumn("amount", F.col("quantity") * F.col("price"))
    return rounded(lines.select("l_orderkey", "l_linenumber", "amount"), "amount", digits=4)


@query(
    "rule_predicate",
    f"""WITH {FLAGS_SQL} SELECT l_orderkey, l_linenumber,
    (l_quantity > 40 OR (l_tax > 0.05 AND returned = 1)) AS fires FROM flags""",
)
def rule_predicate(spark, folder):
    fires = (F.col("l_quantity") > 40) | ((F.col("l_tax") > 0.05) & (F.col("returned") == 1))
    return flagged_lines(spark, folder).select("l_orderkey", "l_linenumber", fires.alias("fires"))


@query(
    "threshold_decision",
    f"WITH {SCORED_SQL} SELECT event_id, CASE WHEN score >= 0.6 THEN 1 ELSE 0 END AS decision FROM scored",
)
def threshold_decision(spark, folder):
    return scored_events(spark, folder).select("event_id", fn.decide(F.col("score"), 0.6).alias("decision"))


@query(
    "row_lookup",
    """SELECT position, event_id, user_id, value FROM (SELECT *, row_number() OVER (ORDER BY value DESC, event_id) AS position
    FROM events) WHERE position IN (1, 9, 150, 751)""",
)
def row_lookup(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "value")
    return ops.rows_at(events, [F.desc("value"), F.asc("event_id")], [1, 9, 150, 751])


@query("seeded_sample", "SELECT event_id, value FROM events ORDER BY md5(event_id || '-42'), event_id LIMIT 1000")
def seeded_sample(spark, folder):
    return ops.seeded_sample(table(spark, folder, "events").select("event_id", "value"), "event_id", 1000, 42)


# --- joins on keys -----------------------------------------------------------


@query(
    "concat_side_by_side",
    """SELECT l_returnflag, round(avg(l_quantity), 6) AS quantity_mean, round(stddev_samp(l_quantity), 6) AS quantity_std
    FROM lineitem GROUP BY 1""",
)
def concat_side_by_side(spark, folder):
    lines = table(spark, folder, "lineitem")
    both = lines.groupBy("l_returnflag").agg(
        F.avg("l_quantity").alias("quantity_mean"), F.stddev_samp("l_quantity").alias("quantity_std")
    )
    return rounded(both, "quantity_mean", "quantity_std")


@query(
    "attach_predictions",
    """SELECT o.o_orderkey, o.o_totalprice, p.prediction FROM orders AS o JOIN
    (SELECT l_orderkey, round(CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), 2) AS prediction
     FROM lineitem GROUP BY 1) AS p ON p.l_orderkey = o.o_orderkey""",
)
def attach_predictions(spark, folder):
    scored = (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("prediction"))
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return rounded(orders.join(scored, "o_orderkey"), "prediction", digits=2)


# --- sorts, limits, sets -----------------------------------------------------


@query(
    "sort_multi",
    """SELECT p_brand, round(avg(p_size), 6) AS mean_size, max(p_retailprice) AS top_price, count(*) AS n
    FROM part GROUP BY 1""",
)
def sort_multi(spark, folder):
    brands = (
        table(spark, folder, "part")
        .groupBy("p_brand")
        .agg(F.avg("p_size").alias("mean_size"), F.max("p_retailprice").alias("top_price"), F.count(F.lit(1)).alias("n"))
    )
    return rounded(brands, "mean_size").orderBy(F.desc("mean_size"), F.desc("top_price"), F.asc("n"), "p_brand")


@query("sort_nulls_last", f"WITH {HOLED_EVENTS_SQL} SELECT event_id, value FROM holed ORDER BY value NULLS LAST, event_id")
def sort_nulls_last(spark, folder):
    return holed_events(spark, folder).select("event_id", "value").orderBy(F.asc_nulls_last("value"), "event_id")


@query("sort_by_key_date", "SELECT user_id, event_id, value FROM events ORDER BY user_id, ts, event_id")
def sort_by_key_date(spark, folder):
    return table(spark, folder, "events").orderBy("user_id", "ts", "event_id").select("user_id", "event_id", "value")


@query("top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 30")
def top_n(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return ops.top_n(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 30)


@query("best_row", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 1")
def best_row(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return ops.best_row(customers, [F.desc("c_acctbal"), F.asc("c_custkey")])


@query(
    "union_all",
    "SELECT c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier",
)
def union_all(spark, folder):
    customers = table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal")
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_acctbal").alias("acctbal"), F.col("s_nationkey").alias("nationkey")
    )
    return customers.unionByName(suppliers)


@query(
    "distinct_rows",
    f"WITH {REPEATED_EVENTS_SQL} SELECT event_id, user_id, event_type, value, props FROM (SELECT DISTINCT * FROM repeated)",
)
def distinct_rows(spark, folder):
    return repeated_events(spark, folder).dropDuplicates().drop("ts")


# --- positions and running values --------------------------------------------


@query(
    "sorted_rank",
    "SELECT event_id, value, row_number() OVER (ORDER BY value, event_id) AS rank FROM events",
)
def sorted_rank(spark, folder):
    return global_rank(table(spark, folder, "events").select("event_id", "value"), ["value", "event_id"])


@query(
    "running_best",
    """SELECT event_id, value, min(value) OVER w AS lowest, max(value) OVER w AS highest FROM events
    WINDOW w AS (ORDER BY event_id ROWS UNBOUNDED PRECEDING)""",
)
def running_best(spark, folder):
    trials = table(spark, folder, "events").select("event_id", "value")
    return global_running(trials, ["event_id"], {"lowest": ("min", "value"), "highest": ("max", "value")})


# --- scalar functions --------------------------------------------------------


@query(
    "parse_date_coerce",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 13 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""",
)
def parse_date_coerce(spark, folder):
    text = F.when(F.col("o_orderkey") % 13 != 0, F.date_format("o_orderdate", "dd/MM/yy")).otherwise(
        F.date_format("o_orderdate", "'31/02/'yy")
    )
    orders = table(spark, folder, "orders").select("o_orderkey", text.alias("text"))
    return orders.select("o_orderkey", fn.parse_day_month_year(F.col("text")).cast("string").alias("day"))


@query(
    "date_parts",
    """SELECT o_orderkey, CAST(day(o_orderdate) AS INTEGER) AS day, CAST(month(o_orderdate) AS INTEGER) AS month,
    CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""",
)
def date_parts(spark, folder):
    from sumac.operators.encode import date_parts as parts

    return parts(table(spark, folder, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate")


@query("date_truncate", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def date_truncate(spark, folder):
    return table(spark, folder, "events").select("event_id", F.to_date("ts").cast("string").alias("day"))


@query(
    "elapsed_days",
    """SELECT event_id, CAST(floor(date_diff('microsecond', ts, TIMESTAMP '2024-02-01 00:00:00') / 86400000000.0) AS BIGINT)
    AS days FROM events""",
)
def elapsed_days(spark, folder):
    end = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return table(spark, folder, "events").select("event_id", fn.elapsed_days(F.col("ts"), end).alias("days"))


@query(
    "math_scalars",
    """SELECT event_id, abs(value - 50.0::DOUBLE) AS away, round_even(value * 10, 0) / 10 AS tenths,
    round(ln(1.0 + value), 9) AS log1p, least(greatest(value, 5.0::DOUBLE), 90.0::DOUBLE) AS clipped,
    round(sqrt((value - user_id) * (value - user_id)), 9) AS distance FROM events""",
)
def math_scalars(spark, folder):
    v, gap = F.col("value"), F.col("value") - F.col("user_id")
    numbers = table(spark, folder, "events").select(
        "event_id",
        F.abs(v - 50.0).alias("away"),
        fn.round_even(v, 1).alias("tenths"),
        F.log1p(v).alias("log1p"),
        fn.clip(v, 5.0, 90.0).alias("clipped"),
        F.sqrt(gap * gap).alias("distance"),
    )
    return rounded(numbers, "log1p", "distance", digits=9)


@query(
    "mask_to_null",
    """SELECT event_id, CASE WHEN value > 100 OR value < 1 THEN NULL ELSE value END AS value FROM events""",
)
def mask_to_null(spark, folder):
    outside = (F.col("value") > 100) | (F.col("value") < 1)
    return table(spark, folder, "events").select("event_id", fn.mask_to_null(F.col("value"), outside).alias("value"))


@query(
    "cast_types",
    """SELECT event_id, CAST(trunc(value) AS INTEGER) AS whole, CAST(user_id AS VARCHAR) AS user_text,
    TRY_CAST(event_type AS INTEGER) AS bad FROM events""",
)
def cast_types(spark, folder):
    return table(spark, folder, "events").select(
        "event_id",
        F.col("value").cast("int").alias("whole"),
        F.col("user_id").cast("string").alias("user_text"),
        F.col("event_type").try_cast("int").alias("bad"),
    )


@query(
    "fill_null",
    f"""WITH {HOLED_EVENTS_SQL} SELECT event_id, coalesce(value, 0) AS value, coalesce(event_type, 'missing') AS event_type
    FROM holed""",
)
def fill_null(spark, folder):
    events = holed_events(spark, folder).select("event_id", "value", "event_type")
    return events.fillna({"value": 0.0, "event_type": "missing"})


@query(
    "string_scalars",
    """SELECT p_partkey, p_brand AS tail, starts_with(p_name, 'hot') AS hot,
    CAST(p_size AS VARCHAR) AS size_text FROM part""",
)
def string_scalars(spark, folder):
    named = table(spark, folder, "part").withColumn("feature", F.concat_ws("__", F.lit("cat"), "p_type", "p_brand"))
    return named.select(
        "p_partkey",
        F.element_at(F.split("feature", "__"), -1).alias("tail"),
        F.startswith("p_name", F.lit("hot")).alias("hot"),
        F.col("p_size").cast("string").alias("size_text"),
    )


@query(
    "json_payload",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, CAST(NULL AS DOUBLE) AS absent FROM events""",
)
def json_payload(spark, folder):
    record = F.from_json("props", "k double, absent double").alias("r")
    return table(spark, folder, "events").select("event_id", record).select("event_id", "r.k", "r.absent")
