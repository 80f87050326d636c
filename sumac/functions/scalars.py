"""Column expressions used across operators. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

MICROS_PER_DAY = 86_400_000_000


def elapsed_micros(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole days elapsed (floored), not calendar boundaries crossed."""
    return F.floor(elapsed_micros(start, end) / F.lit(float(MICROS_PER_DAY))).cast("long")


def elapsed_days_up(start: Column, end: Column) -> Column:
    """Elapsed days, any started day counted."""
    return F.ceil(elapsed_micros(start, end) / F.lit(float(MICROS_PER_DAY))).cast("long")


def round_even(value: Column, digits: int) -> Column:
    """Round half to even on the scaled value."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def money_mean(value: Column) -> Column:
    """Mean of amounts, summed exactly to 12 digits so row order cannot matter."""
    total = F.sum(value.cast("decimal(38,12)")).cast("double")
    return F.try_divide(total, F.count(value).cast("double"))


def clip(value: Column, low, high) -> Column:
    """Limit to [low, high]; NULL stays NULL (greatest/least would skip it)."""
    low, high = _col(low), _col(high)
    return F.when(value < low, low).when(value > high, high).otherwise(value)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def mask_to_null(value: Column, condition: Column) -> Column:
    """NULL where ``condition`` is true, unchanged elsewhere."""
    return F.when(~F.coalesce(condition, F.lit(False)), value)


def recode(value: Column, mapping: Mapping[str, object]) -> Column:
    """Dictionary recode; values outside the mapping become NULL."""
    pairs = [F.lit(item) for entry in mapping.items() for item in entry]
    return F.try_element_at(F.create_map(*pairs), value)


def not_in(value: Column, unwanted: Sequence[object]) -> Column:
    """True unless listed; NULL counts as not listed."""
    return value.isNull() | ~value.isin(*unwanted)


def label_from_null(value: Column) -> Column:
    """1.0 where the attribute is present, else 0.0."""
    return value.isNotNull().cast("double")


def decide(score: Column, threshold: float) -> Column:
    return F.when(score >= F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def linear_map(columns: Sequence[Column], matrix: Sequence[Sequence[float]]) -> list[Column]:
    """Row vector times matrix, one output column per matrix column."""
    width = len(matrix[0])
    out = []
    for j in range(width):
        terms = [c * F.lit(float(matrix[i][j])) for i, c in enumerate(columns)]
        total = terms[0]
        for term in terms[1:]:
            total = total + term
        out.append(total)
    return out


def parse_day_month_year(text: Column, pivot: int = 69) -> Column:
    """``dd/MM/yy`` text to a date; unparseable text gives NULL.

    Two-digit years from ``pivot`` on belong to 19xx, smaller ones to 20xx.
    """
    shape = F.regexp_extract(text, r"^(\d{1,2})/(\d{1,2})/(\d{2})$", 0) != ""
    short_year = F.split_part(text, F.lit("/"), F.lit(3)).try_cast("int")
    year = F.when(short_year >= pivot, short_year + 1900).otherwise(short_year + 2000)
    iso = F.concat_ws(
        "-",
        year.cast("string"),
        F.lpad(F.split_part(text, F.lit("/"), F.lit(2)), 2, "0"),
        F.lpad(F.split_part(text, F.lit("/"), F.lit(1)), 2, "0"),
    )
    return F.when(shape, iso.try_cast("date"))


def base_name(feature: Column, prefixes: Sequence[str]) -> Column:
    """Map a one-hot feature name back to the column it came from."""
    tail = F.element_at(F.split(feature, "__"), -1)
    out = tail
    for prefix in reversed(list(prefixes)):
        out = F.when(F.startswith(tail, F.lit(prefix + "_")), F.lit(prefix)).otherwise(out)
    return out


def seeded_hash(key: Column, seed: int | str) -> Column:
    """Portable pseudo-random order: the same text hash in every engine."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"-{seed}")).cast("binary"))


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
