"""Scan and sink queries: each writes a given table with Spark and reads it back."""

from pyspark.sql import functions as F

from sumac.plans.registry import query, table
from sumac.plans.tables import HOLED_EVENTS_SQL, holed_events
from sumac.session import scratch_path
from sumac.sources import files, runs

EVENT_FIELDS = "event_id long, user_id long, event_type string, value double"


def _plain_events(spark, folder):
    return holed_events(spark, folder).select("event_id", "user_id", "event_type", "value")


_EVENTS_SQL = f"WITH {HOLED_EVENTS_SQL} SELECT event_id, user_id, event_type, value FROM holed"


@query("scan_csv", _EVENTS_SQL)
def scan_csv(spark, folder):
    path = scratch_path(spark, "csv")
    files.write_csv(_plain_events(spark, folder), path)
    return files.read_csv(spark, path, EVENT_FIELDS)


@query("scan_parquet", "SELECT event_id, user_id, event_type, value, props FROM events")
def scan_parquet(spark, folder):
    return files.read_parquet(spark, f"{folder}/events.parquet").drop("ts")


@query(
    "scan_json_records",
    f"WITH {HOLED_EVENTS_SQL} SELECT event_id, event_type, value, CAST(NULL AS DOUBLE) AS absent FROM holed",
)
def scan_json_records(spark, folder):
    path = scratch_path(spark, "json")
    _plain_events(spark, folder).write.json(path)
    return files.read_json(spark, path, "event_id long, event_type string, value double, absent double")


@query("scan_optional_union", "SELECT event_id, user_id, event_type, value, props FROM events")
def scan_optional_union(spark, folder):
    events = table(spark, folder, "events")
    first, second = scratch_path(spark, "data_1"), scratch_path(spark, "data_2")
    middle = F.lit("2024-01-16").cast("timestamp_ntz")
    events.filter(F.col("ts") < middle).write.parquet(first)
    events.filter(F.col("ts") >= middle).write.parquet(second)
    return files.read_existing(spark, [first, second, scratch_path(spark, "never-written")]).drop("ts")


@query(
    "scan_run_records",
    """SELECT CAST(c_nationkey AS VARCHAR) AS run_id, CAST(count(*) AS VARCHAR) AS customers,
    CASE WHEN c_nationkey <> 7 THEN max(c_acctbal) END AS valid_best FROM customer GROUP BY c_nationkey""",
)
def scan_run_records(spark, folder):
    per_nation = (
        table(spark, folder, "customer")
        .groupBy(F.col("c_nationkey").cast("string").alias("run"))
        .agg(F.count(F.lit(1)).cast("string").alias("customers"), F.max("c_acctbal").alias("best"))
    )
    metric = F.concat_ws(" ", F.lit("1700000000000"), F.col("best").cast("string"), F.lit("0"))
    entries = F.array(
        F.struct(F.lit("params").alias("kind"), F.lit("customers").alias("key"), F.col("customers").alias("value")),
        F.struct(F.lit("metrics").alias("kind"), F.lit("valid_best").alias("key"), metric.alias("value")),
    )
    records = per_nation.select("run", F.explode(entries).alias("e")).select("run", "e.*")
    # One run logs no metric, as an interrupted run would.
    records = records.filter((F.col("run") != "7") | (F.col("kind") == "params"))
    path = scratch_path(spark, "runs")
    runs.write_run_records(records, path)
    return runs.runs_table(runs.read_run_records(spark, path), ["customers"], ["valid_best"])


@query("sink_csv", "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def sink_csv(spark, folder):
    path = scratch_path(spark, "sink")
    files.write_csv(table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path)
    return files.read_csv(spark, path, "o_orderkey long, o_orderstatus string, o_totalprice double")


@query("sink_ds_partitioned", "SELECT event_id, value, strftime(ts, '%Y-%m-%d') AS ds FROM events")
def sink_ds_partitioned(spark, folder):
    path = scratch_path(spark, "dated")
    dated = table(spark, folder, "events").select("event_id", "value", F.to_date("ts").alias("ds"))
    files.write_by_date(dated, path)
    files.write_by_date(dated.filter(F.col("ds") == "2024-01-03"), path)
    return spark.read.parquet(path).withColumn("ds", F.col("ds").cast("string"))


@query(
    "records_to_table",
    """SELECT event_type AS model, CAST(count(*) AS BIGINT) AS n, max(value) AS top, CAST(NULL AS VARCHAR) AS note
    FROM events GROUP BY 1""",
)
def records_to_table(spark, folder):
    # One record per event type: a report whose size does not follow the data.
    rows = table(spark, folder, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("top"))
    records = [{"model": r["event_type"], "n": r["n"], "top": r["top"]} for r in rows.collect()]
    return files.records_to_table(spark, records, "model string, n long, top double, note string")
