"""Isolation forest: small trees grown in parallel, rows scored in batches."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sumac.operators.clean import ScaleStandard
from sumac.operators.neighbours import smallest_per_group
from sumac.operators.quantiles import exact_quantiles
from sumac.session import freeze

_NODES = "tree int, node int, feature int, cut double, low int, high int, path double"


def average_path(n: float) -> float:
    """Expected search depth among n rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _samples(df: DataFrame, key: str, trees: int, rows: int, seed: int) -> DataFrame:
    """``rows`` rows per tree without replacement.

    Each row is offered to consecutive trees from a hashed one on: to so many that every tree can
    choose from about four times its rows, to all trees of a short table, to one of a long one.
    """
    offers = min(trees, max(1, -(-4 * trees * rows // max(1, df.count()))))
    first = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(trees))
    dealt = df.withColumn("_offer", F.explode(F.sequence(F.lit(0), F.lit(offers - 1))))
    dealt = dealt.withColumn("tree", ((first + F.col("_offer")) % trees).cast("int")).drop("_offer")
    dealt = dealt.withColumn("_token", F.md5(F.concat_ws("-", F.col(key).cast("string"), "tree", F.lit(seed)).cast("binary")))
    return smallest_per_group(dealt, ["tree"], ["_token", key], rows)


def isolation_forest(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    contamination: float = 0.01,
    trees: int = 100,
    sample_rows: int = 256,
    seed: int = 42,
) -> DataFrame:
    """Rows plus ``score`` (higher is stranger) and ``flag`` (-1 outlier, 1 inlier).

    Columns are standardised and rows with a missing value dropped. Trees are
    bounded by the sample, so the forest is a small broadcastable table.
    """
    names = list(columns)
    complete = df.dropna(subset=names)
    scaled = ScaleStandard(names).fit(complete).transform(complete.select(key, *[F.col(c).cast("double") for c in names]))
    sample = _samples(scaled, key, trees, sample_rows, seed).select("tree", "_token", *names)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        # The order inside the group is not given, so it is fixed before drawing.
        values = pdf.sort_values("_token")[names].to_numpy()
        draw = np.random.default_rng([seed, tree])
        limit = math.ceil(math.log2(max(len(values), 2)))
        nodes, todo = [], [(0, values, 0)]
        free = 1
        while todo:
            node, part, depth = todo.pop()
            spread = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(part) > 1 else []
            if depth >= limit or len(spread) == 0:
                nodes.append((tree, node, -1, 0.0, -1, -1, depth + average_path(len(part))))
                continue
            feature = int(draw.choice(spread))
            column = part[:, feature]
            cut = float(draw.uniform(column.min(), column.max()))
            nodes.append((tree, node, feature, cut, free, free + 1, 0.0))
            todo += [(free, part[column <= cut], depth + 1), (free + 1, part[column > cut], depth + 1)]
            free += 2
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "low", "high", "path"])

    # At most trees x (2 x sample_rows) nodes: bounded by the settings.
    grown = sample.groupBy("tree").applyInPandas(grow, _NODES).toPandas()
    if grown.empty:
        return complete.withColumns({"score": F.lit(None).cast("double"), "flag": F.lit(1)})
    used = sample.groupBy("tree").count().agg(F.max("count")).first()[0]
    forest = [
        tuple(part.sort_values("node")[c].to_numpy() for c in ("feature", "cut", "low", "high", "path"))
        for _, part in grown.groupby("tree")
    ]
    usual = max(average_path(used), 1.0)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = pdf[names].to_numpy()
            total = np.zeros(len(values))
            for feature, cut, low, high, path in forest:
                at = np.zeros(len(values), dtype=int)
                while (open_rows := np.flatnonzero(feature[at] >= 0)).size:
                    here = at[open_rows]
                    goes_low = values[open_rows, feature[here]] <= cut[here]
                    at[open_rows] = np.where(goes_low, low[here], high[here])
                total += path[at]
            yield pd.DataFrame({key: pdf[key], "score": 2.0 ** (-total / len(forest) / usual)})

    kind = df.schema[key].dataType.simpleString()
    scored = freeze(scaled.mapInPandas(score, f"{key} {kind}, score double"))
    cut = exact_quantiles(scored.select((-F.col("score")).alias("s")), ["s"], [contamination])["s"][0]
    flagged = scored.withColumn("flag", F.when(-F.col("score") < F.lit(cut), -1).otherwise(1))
    return complete.join(flagged, key)


