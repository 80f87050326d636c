"""Stateless column derivations for modelling tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def date_parts(df: DataFrame, column: str, keep: bool = False) -> DataFrame:
    """Day, month and year columns; the date itself is dropped by default."""
    out = df.withColumns({"day": F.day(column), "month": F.month(column), "year": F.year(column)})
    return out if keep else out.drop(column)
