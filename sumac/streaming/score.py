"""Scoring arriving JSON records with a saved model, exactly once per batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sumac.sources.files import nan_free, write_by_date

CORRUPT = "_corrupt"


def read_records(spark: SparkSession, path: str, schema: T.StructType | str, files_per_batch: int = 100) -> DataFrame:
    """A stream of JSON lines. A line that does not parse keeps its text in ``_corrupt``."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return (
        spark.readStream.schema(full)
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )


def run_scoring(
    records: DataFrame,
    model: PipelineModel,
    output: str,
    keep: Sequence[str],
    alert: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Score what has arrived into ``output``/{scored,errors,alerts} and stop.

    Fields missing from a record are NULL and are filled by the model's own
    imputer. Each micro-batch replaces its own partition, so a batch repeated
    after a failure leaves no copies.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        named = batch.withColumn("batch", F.lit(batch_id))
        good = nan_free(named.filter(F.col(CORRUPT).isNull()).drop(CORRUPT))
        scored = model.transform(good).select(*keep, "prediction", "batch")
        write_by_date(scored, f"{output}/scored", "batch")
        write_by_date(named.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT, "batch"), f"{output}/errors", "batch")
        if alert is not None:
            write_by_date(alert(scored), f"{output}/alerts", "batch")
        batch.unpersist()

    query = (
        records.writeStream.foreachBatch(handle)
        .option("checkpointLocation", f"{output}/progress")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
