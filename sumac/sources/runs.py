"""Run records: one small file per parameter, metric and tag of every run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# <run>/<kind>/<key>, either as plain folders or as Spark partition folders.
_PLACE = r"(?:run=)?([^/=]+)/(?:kind=)?(params|metrics|tags)/(?:key=)?([^/]+?)(?:/part-[^/]*)?$"


def write_run_records(records: DataFrame, path: str) -> None:
    """``records`` has (run, kind, key, value); one folder per entry."""
    records.select("run", "kind", "key", F.col("value").cast("string")).write.mode("append").partitionBy(
        "run", "kind", "key"
    ).text(path)


def read_run_records(spark: SparkSession, path: str) -> DataFrame:
    """(run_id, kind, key, value) of all runs; a metric file holds ``millis value step``."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    place = F.col("_metadata.file_path")
    parts = files.select(
        F.regexp_extract(place, _PLACE, 1).alias("run_id"),
        F.regexp_extract(place, _PLACE, 2).alias("kind"),
        F.regexp_extract(place, _PLACE, 3).alias("key"),
        F.trim(F.regexp_replace("value", r"[\r\n]+", " ")).alias("text"),
    ).filter(F.col("kind") != "")
    # A metric logged several times keeps one line per step; the last one counts.
    last = F.split(F.trim(F.regexp_extract("text", r"(\S+ +\S+ +\S+) *$", 1)), " +")
    value = F.when(F.col("kind") == "metrics", F.try_element_at(last, F.lit(2))).otherwise(F.col("text"))
    return parts.select("run_id", "kind", "key", value.alias("value"))


def runs_table(records: DataFrame, params: list[str], metrics: list[str]) -> DataFrame:
    """One row per run, NULL for what a run did not log; metrics as numbers."""
    keys = [f"{kind}.{key}" for kind, keys in (("params", params), ("metrics", metrics)) for key in keys]
    wide = (
        records.withColumn("name", F.concat_ws(".", "kind", "key"))
        .groupBy("run_id")
        .pivot("name", keys)
        .agg(F.first("value", ignorenulls=True))
    )
    return wide.select(
        "run_id",
        *[F.col(f"`params.{k}`").alias(k) for k in params],
        *[F.col(f"`metrics.{k}`").try_cast("double").alias(k) for k in metrics],
    )


def best_run(runs: DataFrame, metric: str, ascending: bool = False) -> DataFrame:
    """The run with the best metric; runs without it come last."""
    order = F.asc_nulls_last(metric) if ascending else F.desc_nulls_last(metric)
    return runs.orderBy(order, "run_id").limit(1)
