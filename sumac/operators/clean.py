"""Fit/transform steps on columns, as Spark ML estimators and models.

``fit`` runs one aggregation over all its columns and keeps a few numbers per
column; ``transform`` is a projection of built-in expressions with those numbers
as literals, so a chain of steps stays one stage without a shuffle. The fitted
numbers are a Param, hence saved and loaded with the pipeline.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from sumac.functions.scalars import clip
from sumac.operators.quantiles import exact_quantiles


class _Fitted(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted step: ``state`` maps each column to what ``fit`` learned."""

    state = Param(Params._dummy(), "state", "fitted values as JSON", TypeConverters.toString)

    def learned(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    def _transform(self, df: DataFrame) -> DataFrame:
        kinds = dict(df.dtypes)
        learned = self.learned()
        return df.withColumns({c: self.apply(F.col(c), learned[c], kinds[c]) for c in self.getInputCols()})

    def apply(self, x: Column, value, kind: str) -> Column:
        raise NotImplementedError


class _Step(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """An unfitted step over ``inputCols``; ``options`` holds its settings."""

    options = Param(Params._dummy(), "options", "settings as JSON", TypeConverters.toString)
    model: type[_Fitted]

    def __init__(self, columns: Sequence[str] = (), **options):
        super().__init__()
        self._set(inputCols=list(columns), options=json.dumps(options))

    def option(self, name: str):
        return json.loads(self.getOrDefault(self.options))[name]

    def learn(self, df: DataFrame, columns: list[str]) -> dict:
        raise NotImplementedError

    def _fit(self, df: DataFrame) -> _Fitted:
        columns = self.getInputCols()
        fitted = self.model()
        return fitted._set(inputCols=columns, state=json.dumps(self.learn(df, columns)))


def _moments(df: DataFrame, columns: list[str], *functions: Callable[[str], Column]) -> dict[str, list]:
    """One scan for all columns and functions; NaN is treated as missing."""
    clean = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    row = df.select([e.alias(c) for c, e in clean.items()]).agg(
        *[f(c).alias(f"{c}__{i}") for c in columns for i, f in enumerate(functions)]
    ).first()
    return {c: [row[f"{c}__{i}"] for i in range(len(functions))] for c in columns}


# --- masking and clipping ----------------------------------------------------


class BoundsMask(_Fitted):
    def apply(self, x, value, kind):
        low, high = value
        return F.when((x >= F.lit(low)) & (x <= F.lit(high)), x)


class IqrMask(_Step):
    """Values further than ``reach`` quartile ranges outside [Q1, Q3] become NULL; rows stay."""

    model = BoundsMask

    def __init__(self, columns=(), reach: float = 1.5):
        super().__init__(columns, reach=reach)

    def learn(self, df, columns):
        out = {}
        for c, (q1, q3) in exact_quantiles(df, columns, [0.25, 0.75]).items():
            margin = None if q1 is None else self.option("reach") * (q3 - q1)
            out[c] = [None, None] if q1 is None else [q1 - margin, q3 + margin]
        return out


class Clip(_Fitted):
    def apply(self, x, value, kind):
        low, high = value
        return x if low is None else clip(x, low, high)


class Winsorize(_Step):
    """Clip to two fitted percentiles."""

    model = Clip

    def __init__(self, columns=(), low: float = 0.01, high: float = 0.99):
        if not 0 <= low < high <= 1:
            raise ValueError("need 0 <= low < high <= 1")
        super().__init__(columns, low=low, high=high)

    def learn(self, df, columns):
        return exact_quantiles(df, columns, [self.option("low"), self.option("high")])


# --- imputation --------------------------------------------------------------


class Fill(_Fitted):
    def apply(self, x, value, kind):
        if kind in ("double", "float"):
            x = F.when(~F.isnan(x), x)
        target = "double" if isinstance(value, float) else kind
        return F.coalesce(x, F.lit(value).cast(target))


class ImputeMean(_Step):
    model = Fill

    def learn(self, df, columns):
        return {c: v[0] for c, v in _moments(df, columns, F.avg).items()}


class ImputeMedian(_Step):
    """Exact median."""

    model = Fill

    def learn(self, df, columns):
        return {c: v[0] for c, v in exact_quantiles(df, columns, [0.5]).items()}


class ImputeMode(_Step):
    """Most frequent value; on ties the smallest in the order of its type."""

    model = Fill

    def learn(self, df, columns):
        found = {}
        for c in columns:
            counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
            top = counts.orderBy(F.desc("_n"), c).limit(1).select(F.col(c).cast("string")).first()
            found[c] = top[0] if top else None
        return found


# --- scaling -----------------------------------------------------------------


class Affine(_Fitted):
    def apply(self, x, value, kind):
        shift, scale = value
        return (x - F.lit(shift).cast("double")) / F.lit(scale).cast("double")


def _divisor(value: float | None) -> float | None:
    return 1.0 if value == 0 else value


class ScaleMinMax(_Step):
    """To [0, 1]; NULL stays NULL, a constant column becomes 0."""

    model = Affine

    def learn(self, df, columns):
        ranges = _moments(df, columns, F.min, F.max)
        return {c: [lo, None if lo is None else _divisor(hi - lo)] for c, (lo, hi) in ranges.items()}


class ScaleStandard(_Step):
    """Zero mean and unit population deviation."""

    model = Affine

    def learn(self, df, columns):
        return {c: [m, _divisor(s)] for c, (m, s) in _moments(df, columns, F.avg, F.stddev_pop).items()}


class ScaleRobust(_Step):
    """Median to zero, quartile range to one."""

    model = Affine

    def learn(self, df, columns):
        quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
        return {c: [m, None if m is None else _divisor(q3 - q1)] for c, (q1, m, q3) in quartiles.items()}


class Log1p(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """log(1 + x)."""

    def __init__(self, columns: Sequence[str] = ()):
        super().__init__()
        self._set(inputCols=list(columns))

    def _transform(self, df):
        return df.withColumns({c: F.log1p(c) for c in self.getInputCols()})


# --- encodings ---------------------------------------------------------------


def _categories(df: DataFrame, columns: list[str]) -> dict[str, list[tuple[str, int]]]:
    """Sorted (value, count) per column. Category sets are feature lists, so they must be small."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    counts = (
        df.select(F.explode(F.array(*pairs)).alias("r"))
        .select("r.*")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    limit = 10_000
    rows = counts.limit(limit * len(columns) + 1).collect()
    out: dict[str, list[tuple[str, int]]] = {c: [] for c in columns}
    for row in rows:
        out[row["column"]].append((row["value"], row["n"]))
    wide = [c for c, found in out.items() if len(found) > limit]
    if wide or len(rows) > limit * len(columns):
        raise ValueError(f"more than {limit} categories in {wide or columns}: not a categorical column")
    numbers = {f.name for f in df.schema if isinstance(f.dataType, NumericType)}
    for c, found in out.items():
        found.sort(key=lambda r: (float(r[0]), r[0]) if c in numbers else r[0])
    return out


class Indicators(_Fitted):
    """0/1 column per kept category, named ``<column>_<value>``; unknown gives zeros."""

    def _transform(self, df):
        made = {}
        for c, groups in self.learned().items():
            for name, values in groups.items():
                hit = F.coalesce(F.col(c).cast("string").isin(values), F.lit(False))
                made[f"{c}_{name}"] = hit.cast("int")
        return df.withColumns(made).drop(*self.learned())

    def output_names(self) -> list[str]:
        return [f"{c}_{name}" for c, groups in self.learned().items() for name in groups]


class OneHot(_Step):
    """One indicator per category seen in training.

    With ``min_frequency`` categories rarer than that share of the rows collapse
    into one ``infrequent`` indicator. With ``drop_binary`` a column of exactly
    two categories keeps only its second one.
    """

    model = Indicators

    def __init__(self, columns=(), min_frequency: float = 0.0, drop_binary: bool = False, categories=None):
        super().__init__(columns, min_frequency=min_frequency, drop_binary=drop_binary, categories=categories)

    def learn(self, df, columns):
        fixed = self.option("categories")
        if fixed:
            found = {c: [(v, 1) for v in fixed[c]] for c in columns}
        else:
            found = _categories(df, columns)
        rows = df.count() if self.option("min_frequency") else 0
        out = {}
        for c, counted in found.items():
            least = self.option("min_frequency") * rows
            groups = {v: [v] for v, n in counted if n >= least}
            rare = [v for v, n in counted if n < least]
            if self.option("drop_binary") and len(groups) == 2 and not rare:
                groups.pop(next(iter(groups)))
            if rare:
                groups["infrequent"] = rare
            out[c] = groups
        return out


class Codes(_Fitted):
    """Position of the value in a list, ``-1`` when unknown."""

    def apply(self, x, value, kind):
        entries = [F.lit(item) for i, v in enumerate(value) for item in (v, i)]
        if not entries:
            return F.lit(-1)
        return F.coalesce(F.try_element_at(F.create_map(*entries), x.cast("string")), F.lit(-1))


class OrdinalEncode(_Step):
    """Codes 0..k-1 in a declared order; unknown and missing give -1."""

    model = Codes

    def __init__(self, columns=(), order: Sequence[object] = ()):
        super().__init__(columns, order=[str(v) for v in order])

    def learn(self, df, columns):
        return {c: self.option("order") for c in columns}


class LabelEncode(_Step):
    """Sorted labels to 0..k-1; ``decode`` goes back."""

    model = Codes

    def learn(self, df, columns):
        return {c: [v for v, _ in counted] for c, counted in _categories(df, columns).items()}


def decode(df: DataFrame, fitted: Codes, column: str) -> DataFrame:
    labels = F.array(*[F.lit(v) for v in fitted.learned()[column]])
    return df.withColumn(column, F.when(F.col(column) >= 0, F.try_element_at(labels, F.col(column) + 1)))


# --- composition -------------------------------------------------------------


class FunctionStep(Transformer):
    """A ``DataFrame -> DataFrame`` function as a pipeline step.

    Python functions are not saved; use ``SQLTransformer`` where that matters.
    """

    def __init__(self, function: Callable[[DataFrame], DataFrame] = lambda df: df):
        super().__init__()
        self.function = function

    def _transform(self, df):
        return self.function(df)


class DropColumns(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, columns: Sequence[str] = ()):
        super().__init__()
        self._set(inputCols=list(columns))

    def _transform(self, df):
        return df.drop(*self.getInputCols())


class KeepColumns(DropColumns):
    """Keep the listed columns, each with what a one-hot step derived from it."""

    def _transform(self, df):
        kept = []
        for c in self.getInputCols():
            kept += [c] if c in df.columns else [d for d in df.columns if d.startswith(c + "_")]
        return df.select(*dict.fromkeys(kept))


def column_branches(
    branches: Sequence[tuple[Sequence[Callable[[Sequence[str]], object]], Sequence[str]]],
    passthrough: Sequence[str] = (),
    keep_rest: bool = False,
) -> Pipeline:
    """Each branch sends its columns through its own steps.

    A step is built from the branch's column names. Columns outside all branches
    are dropped unless passed through or ``keep_rest`` is set.
    """
    stages = [make(list(columns)) for steps, columns in branches for make in steps]
    if not keep_rest:
        stages.append(KeepColumns([c for _, columns in branches for c in columns] + list(passthrough)))
    return Pipeline(stages=stages)
