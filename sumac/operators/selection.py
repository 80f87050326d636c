"""Column and row selection, sorting, sampling and set helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sumac.functions.scalars import seeded_hash
from sumac.operators.ordering import global_rank
from sumac.operators.profile import columns_of


def select_by_kind(df: DataFrame, *kinds: str) -> DataFrame:
    return df.select(*columns_of(df, *kinds))


def select_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The wanted columns that are present, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def in_order_of(df: DataFrame, original: Sequence[str]) -> DataFrame:
    """Original columns first and in their order, new ones after them."""
    known = [c for c in original if c in df.columns]
    return df.select(*known, *[c for c in df.columns if c not in set(known)])


def features_and_target(df: DataFrame, target: str, label: str = "label") -> DataFrame:
    """Feature columns plus the target under one name, kept in one table."""
    return df.select(*[c for c in df.columns if c != target], F.col(target).alias(label))


def rows_at(df: DataFrame, order: Sequence[Column | str], positions: Sequence[int]) -> DataFrame:
    """Rows at the given 1-based positions of the global order."""
    return global_rank(df, order, "position").filter(F.col("position").isin(*positions))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """Exactly min(n, rows) rows in a portable random order (a distributed top-n)."""
    token = seeded_hash(F.col(key), seed)
    return df.withColumn("_token", token).orderBy("_token", key).limit(n).drop("_token")


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def best_row(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    return top_n(df, order, 1)
