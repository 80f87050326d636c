"""Customer feature queries on the event table."""

from pyspark.sql import functions as F

from sumac.operators import customers as ops
from sumac.plans.registry import query, table

_GAPS_SQL = """gaps AS (SELECT *, CAST(floor(date_diff('microsecond',
  lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) / 86400000000.0) AS BIGINT) AS gap_days FROM events)"""
_LENGTH = "CAST(floor(date_diff('microsecond', min(ts), max(ts)) / 86400000000.0) AS BIGINT)"
_RECENCY = "CAST(ceil(date_diff('microsecond', max(ts), (SELECT max(ts) FROM events)) / 86400000000.0) AS BIGINT)"
_MONEY = """coalesce(round_even(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(value) * 100, 0) / 100, 0)"""
_FREQUENCY = "count(DISTINCT CAST(ts AS DATE))"
_PERIOD = "coalesce(round_even(stddev_samp(gap_days) * 10, 0) / 10, 0)"


def _features(spark, folder):
    events = table(spark, folder, "events")
    return ops.lrmfp(events, "user_id", "ts", F.col("value"))


@query(
    "lrmfp",
    f"""WITH {_GAPS_SQL} SELECT user_id, {_LENGTH} AS length_days, {_RECENCY} AS recency_days,
    {_MONEY} AS monetary, {_FREQUENCY} AS frequency, {_PERIOD} AS periodicity FROM gaps GROUP BY user_id""",
)
def lrmfp(spark, folder):
    return _features(spark, folder)


@query("lrmfp_length", f"SELECT user_id, {_LENGTH} AS length_days FROM events GROUP BY user_id")
def lrmfp_length(spark, folder):
    return _features(spark, folder).select("user_id", "length_days")


@query("lrmfp_recency", f"SELECT user_id, {_RECENCY} AS recency_days FROM events GROUP BY user_id")
def lrmfp_recency(spark, folder):
    return _features(spark, folder).select("user_id", "recency_days")


@query("lrmfp_monetary", f"SELECT user_id, {_MONEY} AS monetary FROM events GROUP BY user_id")
def lrmfp_monetary(spark, folder):
    return _features(spark, folder).select("user_id", "monetary")


@query("lrmfp_frequency", f"SELECT user_id, {_FREQUENCY} AS frequency FROM events GROUP BY user_id")
def lrmfp_frequency(spark, folder):
    return _features(spark, folder).select("user_id", "frequency")


@query("lrmfp_periodicity", f"WITH {_GAPS_SQL} SELECT user_id, {_PERIOD} AS periodicity FROM gaps GROUP BY user_id")
def lrmfp_periodicity(spark, folder):
    return _features(spark, folder).select("user_id", "periodicity")


@query("lag_days_per_key", f"WITH {_GAPS_SQL} SELECT event_id, user_id, gap_days FROM gaps")
def lag_days_per_key(spark, folder):
    gaps = ops.visit_gaps(table(spark, folder, "events"), "user_id", "ts", "event_id")
    return gaps.select("event_id", "user_id", "gap_days")


@query(
    "assemble_features",
    """SELECT o_custkey AS custkey, count(*) AS n_orders, min(o_totalprice) AS cheapest, max(o_totalprice) AS dearest,
    CAST(count(DISTINCT o_orderpriority) AS BIGINT) AS priorities FROM orders GROUP BY o_custkey""",
)
def assemble_features(spark, folder):
    orders = table(spark, folder, "orders")
    return orders.groupBy(F.col("o_custkey").alias("custkey")).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.min("o_totalprice").alias("cheapest"),
        F.max("o_totalprice").alias("dearest"),
        F.count_distinct("o_orderpriority").alias("priorities"),
    )
