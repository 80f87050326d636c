"""Positions and running values over a whole table in one global order.

A window without PARTITION BY would pull the table into one task. Here the rows
are range-partitioned and sorted, the layout is frozen as a written table, and only
one number per partition passes through the driver to shift each partition's
local result. The order columns must end in a unique key: then even one hot
value is spread over several partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sumac.session import freeze

PART, POS = "_part", "_pos"


def _columns(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def sorted_layout(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Rows with their range partition and 0-based position inside it."""
    order = _columns(order)
    marked = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    # Spark builds the id as (partition index << 33) + row index.
    return (
        freeze(marked)
        .withColumn(PART, F.shiftright("_mid", 33))
        .withColumn(POS, F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_mid")
    )


def _offsets(layout: DataFrame, aggregate: Column, combine, start) -> DataFrame:
    """Per partition: the combined value of all earlier partitions."""
    # One row per shuffle partition, so the driver holds a few thousand at most.
    rows = layout.groupBy(PART).agg(aggregate.alias("v")).collect()
    carried, out = start, []
    for row in sorted(rows, key=lambda r: r[PART]):
        out.append((row[PART], carried))
        carried = row["v"] if carried is None else carried if row["v"] is None else combine(carried, row["v"])
    schema = f"{PART} long, _carry {layout.select(aggregate.alias('v')).schema['v'].dataType.simpleString()}"
    return layout.sparkSession.createDataFrame(out, schema)


def global_rank(df: DataFrame, order: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """1-based position of every row in the global order."""
    layout = sorted_layout(df, order)
    starts = _offsets(layout, F.count(F.lit(1)), lambda a, b: a + b, 0)
    return (
        layout.join(F.broadcast(starts), PART)
        .withColumn(name, F.col("_carry") + F.col(POS) + 1)
        .drop(PART, POS, "_carry")
    )


_RUNNING = {
    "sum": (F.sum, lambda a, b: a + b, lambda run, carry: F.coalesce(run + carry, run, carry)),
    "min": (F.min, min, lambda run, carry: F.least(run, carry)),
    "max": (F.max, max, lambda run, carry: F.greatest(run, carry)),
}


def global_running(
    df: DataFrame, order: Sequence[Column | str], outputs: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Running sum, min or max up to each row; ``outputs`` maps name -> (kind, column)."""
    layout = sorted_layout(df, order)
    upto = Window.partitionBy(PART).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    out = layout
    for name, (kind, column) in outputs.items():
        function, combine, merge = _RUNNING[kind]
        carry = _offsets(layout, function(column), combine, None).withColumnRenamed("_carry", f"_c_{name}")
        out = out.join(F.broadcast(carry), PART)
        out = out.withColumn(name, merge(function(column).over(upto), F.col(f"_c_{name}"))).drop(f"_c_{name}")
    return out.drop(PART, POS)


def with_previous(df: DataFrame, order: Sequence[Column | str], columns: Sequence[str], name: str) -> DataFrame:
    """Adds a struct of the given columns of the row just before in the global order."""
    layout = sorted_layout(df, order)
    value = F.struct(*columns)
    carry = _offsets(layout, F.max_by(value, F.col(POS)), lambda _, latest: latest, None)
    before = F.lag(value).over(Window.partitionBy(PART).orderBy(POS))
    return (
        layout.withColumn(name, before)
        .join(F.broadcast(carry), PART)
        .withColumn(name, F.coalesce(name, "_carry"))
        .drop(PART, POS, "_carry")
    )
