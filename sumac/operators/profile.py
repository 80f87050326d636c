"""Profiles of a table: one row per column, read in one or two passes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sumac.operators.quantiles import exact_quantiles


def columns_of(df: DataFrame, *kinds: str) -> list[str]:
    """Names of the columns of the given kinds: numeric, string, datetime."""
    types = {
        "numeric": T.NumericType,
        "string": T.StringType,
        "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType),
    }
    return [f.name for f in df.schema.fields if any(isinstance(f.dataType, types[k]) for k in kinds)]


def _one_row_per_column(summary: DataFrame, columns: Sequence[str], fields: dict[str, str]) -> DataFrame:
    """Turn a one-row aggregate ``<column>__<field>`` into one row per column."""
    rows = [
        F.struct(
            F.lit(c).alias("column"),
            *[F.col(f"`{c}__{f}`").cast(kind).alias(f) for f, kind in fields.items()],
        )
        for c in columns
    ]
    return summary.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def describe_numeric(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or columns_of(df, "numeric"))
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    aggs: list[Column] = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [
            F.count(x).alias(f"{c}__count"),
            F.avg(x).alias(f"{c}__mean"),
            F.stddev_samp(x).alias(f"{c}__std"),
            F.min(x).alias(f"{c}__min"),
            F.max(x).alias(f"{c}__max"),
        ]
        aggs += [F.lit(v).cast("double").alias(f"{c}__p{p}") for p, v in zip((25, 50, 75), quartiles[c])]
    fields = {"count": "long", **{f: "double" for f in ("mean", "std", "min", "p25", "p50", "p75", "max")}}
    return _one_row_per_column(df.agg(*aggs), columns, fields)


def _long_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for all listed columns, counted in one shuffle."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    return (
        df.select(F.explode(F.array(*pairs)).alias("r"))
        .select("r.*")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def most_frequent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, count, unique, top, freq); ties go to the smallest value."""
    counts = _long_counts(df, columns).filter(F.col("value").isNotNull())
    return counts.groupBy("column").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def describe_categorical(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    return most_frequent(df, columns or columns_of(df, "string"))


def profile_schema(df: DataFrame) -> DataFrame:
    """Position, type, non-null and row count per column."""
    aggs = [F.count(c).alias(f"{c}__non_null") for c in df.columns] + [F.count(F.lit(1)).alias("_rows")]
    summary = df.agg(*aggs)
    rows = [
        F.struct(
            F.lit(i).cast("long").alias("position"),
            F.lit(name).alias("column"),
            F.lit(kind).alias("dtype"),
            F.col(f"`{name}__non_null`").alias("non_null"),
            F.col("_rows").alias("rows"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return summary.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or df.columns)
    summary = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}__nulls") for c in columns])
    return _one_row_per_column(summary, columns, {"nulls": "long"})


def nunique(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct non-null values per column."""
    columns = list(columns or df.columns)
    # Counted as typed values: 0.0 and -0.0 are one.
    return _one_row_per_column(df.agg(*[F.count_distinct(c).alias(f"{c}__n_unique") for c in columns]), columns, {"n_unique": "long"})


def min_max_table(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    columns = list(columns or columns_of(df, "numeric"))
    aggs = [a for c in columns for a in (F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"))]
    return _one_row_per_column(df.agg(*aggs), columns, {"min": "double", "max": "double"})


def value_counts(df: DataFrame, column: str, dropna: bool = False) -> DataFrame:
    """(value, n, percent of the counted rows rounded to two digits)."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    if dropna:
        counts = counts.filter(F.col("value").isNotNull())
    total = counts.select(F.sum("n")).scalar()
    return counts.withColumn("percent", F.rint(F.col("n") / total * 100.0 * 100.0) / 100.0)


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows that equal an earlier row."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicates"))


def date_range(df: DataFrame, date: Column) -> DataFrame:
    return df.agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"))


def value_range(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Fitted (min, max) per column."""
    aggs = [a for c in columns for a in (F.min(c).cast("double").alias(f"{c}_0"), F.max(c).cast("double").alias(f"{c}_1"))]
    row = df.agg(*aggs).first()
    return {c: (row[f"{c}_0"], row[f"{c}_1"]) for c in columns}


def histogram(df: DataFrame, columns: Sequence[str], bins: int) -> DataFrame:
    """Equal-width counts per column, empty bins included, maximum in the last bin."""
    ranges = value_range(df, columns)
    edges, cells = [], []
    for c in columns:
        low, high = ranges[c]
        if low is None:
            continue
        if low == high:
            low, high = low - 0.5, high + 0.5
        width = high - low
        place = F.floor((F.col(c) - F.lit(low)) / F.lit(width) * bins)
        cells.append(
            F.struct(
                F.lit(c).alias("column"),
                F.when(F.col(c).isNotNull(), F.least(place, F.lit(bins - 1))).cast("long").alias("bin"),
            )
        )
        edges.append((c, low, width))
    counts = (
        df.select(F.explode(F.array(*cells)).alias("r"))
        .select("r.*")
        .filter(F.col("bin").isNotNull())
        .groupBy("column", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Columns x bins edge rows: bounded by the request, not by the data.
    frame = df.sparkSession.createDataFrame(
        [(c, b, low + width * b / bins, low + width * (b + 1) / bins) for c, low, width in edges for b in range(bins)],
        "column string, bin long, left_edge double, right_edge double",
    )
    return frame.join(counts, ["column", "bin"], "left").fillna(0, ["n"])


def boxplot_stats(df: DataFrame, columns: Sequence[str], reach: float = 1.5) -> DataFrame:
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    aggs: list[Column] = []
    for c in columns:
        q1, q2, q3 = quartiles[c]
        if q1 is None:
            q1 = q2 = q3 = float("nan")
        low, high = q1 - reach * (q3 - q1), q3 + reach * (q3 - q1)
        x = F.col(c).cast("double")
        within = x.between(F.lit(low), F.lit(high))
        aggs += [
            F.lit(q1).alias(f"{c}__q1"),
            F.lit(q2).alias(f"{c}__median"),
            F.lit(q3).alias(f"{c}__q3"),
            F.min(F.when(within, x)).alias(f"{c}__whisker_low"),
            F.max(F.when(within, x)).alias(f"{c}__whisker_high"),
            F.count_if(~within).alias(f"{c}__outliers"),
        ]
    fields = {f: "double" for f in ("q1", "median", "q3", "whisker_low", "whisker_high")}
    return _one_row_per_column(df.agg(*aggs), columns, {**fields, "outliers": "long"})


def binary_table(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Zeros, ones and share of ones per 0/1 column; NULL counts as 0."""
    ones = [F.count_if(F.coalesce(F.col(c).cast("int"), F.lit(0)) == 1).alias(f"{c}__n_1") for c in flags]
    zeros = [F.count_if(F.coalesce(F.col(c).cast("int"), F.lit(0)) == 0).alias(f"{c}__n_0") for c in flags]
    long = _one_row_per_column(df.agg(*ones, *zeros), flags, {"n_0": "long", "n_1": "long"})
    total = F.col("n_0") + F.col("n_1")
    share = F.rint(F.try_divide(F.col("n_1").cast("double"), total.cast("double")) * 1000.0) / 1000.0
    return long.withColumns({"n_total": total, "pct_1": share}).orderBy(F.desc("pct_1"), "column")


def corr_matrix(df: DataFrame, columns: Sequence[str], upper_only: bool = False) -> DataFrame:
    """Pearson correlation in long form; each pair uses its complete rows."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    aggs = []
    for i, (a, b) in enumerate(pairs):
        aggs.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"p{i}"))
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"p{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
    if not upper_only:
        rows += [F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), F.col(f"p{i}").alias("r")) for i, (a, b) in enumerate(pairs)]
        rows += [F.struct(F.lit(c).alias("a"), F.lit(c).alias("b"), F.lit(1.0).alias("r")) for c in columns]
    return df.agg(*aggs).select(F.explode(F.array(*rows)).alias("x")).select("x.*")


def vif(df: DataFrame, columns: Sequence[str], intercept: bool = False) -> DataFrame:
    """Variance inflation per column from one Gram-matrix pass.

    Without intercept the regressions go through the origin. Only the p x p
    matrix reaches the driver, where p is the number of columns.
    """
    names = list(columns)
    data = df.select([F.col(c).cast("double").alias(c) for c in names]).dropna()
    if intercept:
        data = data.withColumn("_one", F.lit(1.0))
        names = names + ["_one"]
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    row = data.agg(*[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"g{i}_{j}") for i, j in pairs]).first()
    gram = np.zeros((len(names), len(names)))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = row[f"g{i}_{j}"]
    inverse = np.linalg.pinv(gram)
    out = []
    for i, c in enumerate(columns):
        total = gram[i, i]
        if intercept:
            total = gram[i, i] - gram[i, -1] ** 2 / gram[-1, -1]
        out.append((c, float(total * inverse[i, i])))
    return df.sparkSession.createDataFrame(out, "column string, vif double")


def moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: mean and sample deviation of each column."""
    return df.agg(
        *[F.avg(c).alias(f"{c}__mean") for c in columns], *[F.stddev_samp(c).alias(f"{c}__std") for c in columns]
    )


def moment_distance(base: DataFrame, candidates: dict[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """How far each candidate's column means and deviations lie from the base; nearest first."""
    fields = [f"{c}__{m}" for m in ("mean", "std") for c in columns]
    tables = [moments(base, columns).withColumn("_name", F.lit(None).cast("string"))]
    tables += [moments(t, columns).withColumn("_name", F.lit(n)) for n, t in candidates.items()]
    stacked = tables[0]
    for t in tables[1:]:
        stacked = stacked.unionByName(t)
    origin = {f: F.max(F.when(F.col("_name").isNull(), F.col(f))) for f in fields}
    anchors = stacked.agg(*[e.alias(f) for f, e in origin.items()]).first()
    total = sum((F.abs(F.col(f) - F.lit(anchors[f])) for f in fields), F.lit(0.0))
    return (
        stacked.filter(F.col("_name").isNotNull())
        .select(F.col("_name").alias("candidate"), total.alias("distance"))
        .orderBy("distance", "candidate")
    )


def class_ratio(df: DataFrame, label: str) -> DataFrame:
    """Negatives per positive."""
    positives = F.count_if(F.col(label) == 1).cast("double")
    negatives = F.count_if(F.col(label) == 0).cast("double")
    return df.agg(F.try_divide(negatives, positives).alias("ratio"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """n / (k * n_c) for each of the k classes."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    share = totals.select(F.col("n") / F.col("k")).scalar()
    return counts.withColumn("weight", share / F.col("n"))
