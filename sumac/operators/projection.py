"""Principal components on standardised columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from sumac.operators.clean import ScaleStandard


def fit_pca(df: DataFrame, columns: Sequence[str], k: int) -> tuple[DataFrame, list[list[float]], list[float]]:
    """(scaled rows, loadings per component, explained share per component).

    Rows with a missing value are dropped. Spark's PCA does not centre, so the
    columns are standardised first; the sign makes each component's
    largest-magnitude loading positive.
    """
    complete = df.dropna(subset=list(columns))
    scaled = ScaleStandard(columns).fit(complete).transform(complete)
    vectors = VectorAssembler(inputCols=list(columns), outputCol="_x").transform(scaled)
    model = PCA(k=k, inputCol="_x", outputCol="_pc").fit(vectors)
    matrix = model.pc.toArray()
    loadings = []
    for j in range(k):
        column = matrix[:, j]
        sign = 1.0 if column[abs(column).argmax()] >= 0 else -1.0
        loadings.append([float(v) * sign for v in column])
    return scaled, loadings, [float(v) for v in model.explainedVariance]


def pca_project(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """Input rows plus ``pc1..pck``."""
    scaled, loadings, _ = fit_pca(df, columns, k)
    made = {}
    for j, weights in enumerate(loadings, start=1):
        terms = [F.col(c) * F.lit(w) for c, w in zip(columns, weights)]
        made[f"pc{j}"] = sum(terms[1:], terms[0])
    return scaled.withColumns(made)
