"""Customer features: length, recency, monetary value, frequency, periodicity.

All features come from one pre-aggregation per (customer, day). It combines
map-side, so a customer holding a large share of the rows never reaches one task
as raw rows. Visits on the same day are less than a day apart and give gaps of
zero whole days, so only day-to-day gaps need a window, over at most one row per
customer and day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sumac.functions.scalars import elapsed_days, elapsed_days_up, round_even
from sumac.operators.ordering import with_previous


def _daily(df: DataFrame, customer: str, date: str, amount: Column) -> DataFrame:
    return (
        df.filter(F.col(customer).isNotNull())
        .groupBy(customer, F.to_date(date).alias("day"))
        .agg(
            F.min(date).alias("first"),
            F.max(date).alias("last"),
            F.count(date).alias("visits"),
            F.sum(amount.cast("decimal(38,12)")).alias("money"),
            F.count(amount).alias("priced"),
        )
    )


def lrmfp(df: DataFrame, customer: str, date: str, amount: Column, as_of: Column | None = None) -> DataFrame:
    """One row per customer; ``as_of`` defaults to the latest date in the table.

    ``monetary`` is a mean per row; recency counts any started day.
    """
    if as_of is None:
        as_of = df.select(F.max(date)).scalar()
    per_customer = Window.partitionBy(customer).orderBy(F.col("day").asc_nulls_last())
    gap = elapsed_days(F.lag("last").over(per_customer), F.col("first"))
    days = _daily(df, customer, date, amount).withColumn("gap", gap)
    sums = days.groupBy(customer).agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.sum("money").alias("money"),
        F.sum("priced").alias("priced"),
        F.count("day").alias("frequency"),
        (F.sum("visits") - 1).cast("double").alias("gaps"),
        F.coalesce(F.sum("gap"), F.lit(0)).cast("double").alias("gap_sum"),
        F.coalesce(F.sum(F.col("gap") * F.col("gap")), F.lit(0)).cast("double").alias("gap_squares"),
    )
    spread = F.col("gap_squares") - F.try_divide(F.col("gap_sum") * F.col("gap_sum"), F.col("gaps"))
    deviation = F.when(F.col("gaps") > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (F.col("gaps") - 1)))
    mean_money = F.try_divide(F.col("money").cast("double"), F.col("priced").cast("double"))
    return sums.select(
        customer,
        elapsed_days(F.col("first"), F.col("last")).alias("length_days"),
        elapsed_days_up(F.col("last"), as_of).alias("recency_days"),
        F.coalesce(round_even(mean_money, 2), F.lit(0.0)).alias("monetary"),
        F.col("frequency"),
        F.coalesce(round_even(deviation, 1), F.lit(0.0)).alias("periodicity"),
    )


def visit_gaps(df: DataFrame, customer: str, date: str, key: str, name: str = "gap_days") -> DataFrame:
    """Whole days since the customer's previous row, kept for every row.

    One global order over (customer, date, key) instead of a window per customer:
    a customer with most of the rows is spread over many tasks.
    """
    order = [F.asc_nulls_last(customer), F.asc_nulls_last(date), F.asc(key)]
    rows = with_previous(df, order, [customer, date], "_before")
    same = F.col(f"_before.{customer}").eqNullSafe(F.col(customer))
    gap = F.when(same, elapsed_days(F.col(f"_before.{date}"), F.col(date)))
    return rows.withColumn(name, gap).drop("_before")
