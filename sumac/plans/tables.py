"""Shared inputs of the bindings, with their SQL twins.

The test tables hold no NULLs or duplicates, so cleaning operators read tables
with NULLs punched in by a fixed rule, written the same way for both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sumac.plans.registry import table

HOLED_LINES_SQL = """holed AS (SELECT l_orderkey, l_linenumber, l_returnflag,
  CASE WHEN (l_orderkey * 7 + l_linenumber) % 11 = 0 THEN NULL ELSE l_quantity END AS quantity,
  CASE WHEN (l_orderkey * 5 + l_linenumber) % 13 = 0 THEN NULL ELSE l_extendedprice END AS price,
  CASE WHEN (l_orderkey * 3 + l_linenumber) % 17 = 0 THEN NULL ELSE l_discount END AS discount
  FROM lineitem)"""


def holed_lines(spark: SparkSession, folder: str) -> DataFrame:
    def punched(column: str, factor: int, modulus: int):
        hole = (F.col("l_orderkey") * factor + F.col("l_linenumber")) % modulus == 0
        return F.when(~hole, F.col(column))

    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_returnflag",
        punched("l_quantity", 7, 11).alias("quantity"),
        punched("l_extendedprice", 5, 13).alias("price"),
        punched("l_discount", 3, 17).alias("discount"),
    )


HOLED_EVENTS_SQL = """holed AS (SELECT event_id, user_id, ts,
  CASE WHEN event_id % 7 = 3 THEN NULL ELSE value END AS value,
  CASE WHEN event_id % 5 = 1 THEN NULL ELSE event_type END AS event_type,
  CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
  CASE WHEN event_id % 9 = 4 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k_holed
  FROM events)"""


def holed_events(spark: SparkSession, folder: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("double")
    return table(spark, folder, "events").select(
        "event_id",
        "user_id",
        "ts",
        F.when(F.col("event_id") % 7 != 3, F.col("value")).alias("value"),
        F.when(F.col("event_id") % 5 != 1, F.col("event_type")).alias("event_type"),
        k.alias("k"),
        F.when(F.col("event_id") % 9 != 4, k).alias("k_holed"),
    )


REPEATED_EVENTS_SQL = """repeated AS (SELECT * FROM events
  UNION ALL SELECT * FROM events WHERE event_type = 'error')"""


def repeated_events(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return events.unionByName(events.filter(F.col("event_type") == "error"))


FLAGS_SQL = """flags AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_tax,
  CAST(l_returnflag = 'R' AS INTEGER) AS returned, CAST(l_linestatus = 'F' AS INTEGER) AS finished,
  CAST(l_discount > 0.05 AS INTEGER) AS discounted FROM lineitem)"""


def flagged_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_tax",
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
        (F.col("l_linestatus") == "F").cast("int").alias("finished"),
        (F.col("l_discount") > 0.05).cast("int").alias("discounted"),
    )


# A closed-form score per event stands in for a fitted classifier, so that
# metric tables can be recomputed by another engine.
SCORED_SQL = """scored AS (SELECT event_id, event_type, value, k,
  CAST(event_type IN ('purchase', 'signup') AS INTEGER) AS y_true,
  (CAST((event_id * 37) % 101 AS DOUBLE) + CASE WHEN event_type IN ('purchase', 'signup') THEN 40 ELSE 0 END) / 141.0 AS score
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events))"""


def scored_events(spark: SparkSession, folder: str) -> DataFrame:
    positive = F.col("event_type").isin("purchase", "signup")
    noise = ((F.col("event_id") * 37) % 101).cast("double")
    return table(spark, folder, "events").select(
        "event_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("k"),
        positive.cast("int").alias("y_true"),
        ((noise + F.when(positive, 40).otherwise(0)) / 141.0).alias("score"),
    )


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round float results last, so that addition order cannot show."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})
