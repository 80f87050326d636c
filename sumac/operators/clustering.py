"""Centroid, mixture and hierarchical clustering, and their comparison."""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.clustering import GaussianMixture, KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from sumac.operators.density import components, mean_silhouettes
from sumac.operators.ordering import global_rank
from sumac.session import freeze

SEED = 42
#: Groups on each side of one comparison.
WARD_BLOCK = 2048


def _vectors(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol="_v").transform(df.dropna(subset=list(columns)))


def kmeans(df: DataFrame, columns: Sequence[str], k: int, seed: int = SEED, rounds: int = 50) -> DataFrame:
    vectors = _vectors(df, columns)
    model = KMeans(k=k, seed=seed, maxIter=rounds, featuresCol="_v", predictionCol="cluster").fit(vectors)
    return model.transform(vectors).drop("_v")


def fit_mixture(df: DataFrame, columns: Sequence[str], k: int, seed: int = SEED, rounds: int = 100):
    vectors = _vectors(df, columns)
    return GaussianMixture(k=k, seed=seed, maxIter=rounds, featuresCol="_v", predictionCol="cluster").fit(vectors), vectors


def gaussian_mixture(df: DataFrame, columns: Sequence[str], k: int, seed: int = SEED) -> DataFrame:
    model, vectors = fit_mixture(df, columns, k, seed)
    return model.transform(vectors).drop("_v", "probability")


def mixture_criteria(log_likelihood: float, k: int, d: int, n: int) -> tuple[float, float]:
    """(AIC, BIC) of a full-covariance mixture."""
    free = k * d * (d + 1) / 2 + k * d + k - 1
    return 2 * free - 2 * log_likelihood, free * math.log(n) - 2 * log_likelihood


def gmm_information_criteria(df: DataFrame, columns: Sequence[str], ks: Sequence[int] = range(3, 9)) -> DataFrame:
    """(k, log likelihood, AIC, BIC, chosen): the smallest BIC is chosen."""
    data = freeze(df.select(*columns).dropna())
    n = data.count()

    def judge(k: int) -> tuple:
        likelihood = float(fit_mixture(data, columns, k)[0].summary.logLikelihood)
        return (k, likelihood, *mixture_criteria(likelihood, k, len(columns), n))

    with ThreadPoolExecutor(4) as pool:
        rows = list(pool.map(judge, ks))
    best = min(rows, key=lambda r: (r[3], r[0]))[0]
    return df.sparkSession.createDataFrame(
        [(*r, r[0] == best) for r in rows], "k int, log_likelihood double, aic double, bic double, chosen boolean"
    )


def _nearest(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """The cheapest partner in ``b`` of every group in ``a``; of equal ones the smaller id."""
    b = b.sort_values("id")
    left, right = a["id"].to_numpy(), b["id"].to_numpy()
    x, y = (np.array(side["c"].tolist(), float).reshape(len(side), -1) for side in (a, b))
    v, w = a["w"].to_numpy(), b["w"].to_numpy()
    partner, cost = np.empty(len(a), np.int64), np.empty(len(a))
    for at in range(0, len(a), 256):
        part = slice(at, at + 256)
        # Differences, coordinate by coordinate: both sides of a pair get the same number.
        gap = np.zeros((len(left[part]), len(b)))
        for k in range(x.shape[1]):
            gap += (x[part, k, None] - y[:, k]) ** 2
        gap *= v[part, None] * w / (v[part, None] + w)
        gap[left[part, None] == right] = np.inf
        best = gap.argmin(axis=1)
        partner[part], cost[part] = right[best], gap[np.arange(len(best)), best]
    out = pd.DataFrame({"id": left, "partner": partner, "cost": cost})
    return out[np.isfinite(cost)]


def _ward_round(groups: DataFrame, n: int) -> DataFrame:
    """Merges every two groups that are each other's cheapest partner: (id, w, c, lo, hi, cost), the last three null where nothing merged."""
    blocks = math.ceil(n / WARD_BLOCK)
    tagged = groups.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    left = tagged.select("*", F.col("block").alias("i"), others.alias("j"))
    right = tagged.select("*", others.alias("i"), F.col("block").alias("j"))
    best = (
        left.groupBy("i", "j")
        .cogroup(right.groupBy("i", "j"))
        .applyInPandas(lambda a, b: _nearest(a, b), "id long, partner long, cost double")
        .groupBy("id")
        .agg(F.min(F.struct("cost", "partner")).alias("best"))
    )
    lo, hi = F.least("id", "best.partner"), F.greatest("id", "best.partner")
    # A pair is named by at most two groups, its own, and by both only if they agree.
    pairs = groups.join(best, "id").groupBy(lo.alias("lo"), hi.alias("hi")).agg(
        F.count(F.lit(1)).alias("named"), F.min("id").alias("id"), F.first("best.cost").alias("cost"), F.sum("w").alias("w"),
        F.array_sort(F.collect_list(F.struct("id", "w", "c"))).alias("both"),
    )
    met = F.col("named") == 2
    p, q = F.element_at("both", 1), F.element_at("both", -1)
    middle = F.zip_with(p["c"], q["c"], lambda x, y: (x * p["w"] + y * q["w"]) / (p["w"] + q["w"]))
    return pairs.select(
        "id", "w", F.when(met, middle).otherwise(p["c"]).alias("c"), *[F.when(met, F.col(x)).alias(x) for x in ("lo", "hi", "cost")]
    )


def ward(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """The rows with their ``cluster`` (0, 1, ..) of exactly ``k`` Ward clusters, fewer if there are fewer distinct rows.

    Ward's costs never fall as groups grow, so all pairs of groups that are each other's cheapest
    partner can merge in one round, and the tree is that of merging one pair at a time. The
    merges form a tree over the distinct rows; its k - 1 dearest are left out. Every round compares
    all groups in blocks of bounded size: memory is bounded, time grows with the square of the
    distinct rows. Equal rows are one weighted group; rows with a missing value are left out; ties go
    to the smaller position in the order of the columns. Values must be finite.
    """
    rows = df.dropna(subset=list(columns))
    weighted = rows.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("w"))
    points = freeze(global_rank(weighted, list(columns), "id"), "points")
    groups = points.select("id", "w", F.array(*[F.col(c).cast("double") for c in columns]).alias("c"))
    n, merges = points.count(), []
    while n > 1:
        done = freeze(_ward_round(groups, n), "merged")
        left = done.count()
        if left == n:
            raise ValueError("Ward clustering needs finite values")
        merges.append(done.filter("lo is not null").select(F.col("lo").alias("a"), F.col("hi").alias("b"), "cost", F.lit(len(merges)).alias("round")))
        groups, n = done.select("id", "w", "c"), left
    if not merges:
        return rows.withColumn("cluster", F.lit(0))
    tree = freeze(reduce(DataFrame.unionByName, merges), "tree")
    dear = tree.orderBy(F.desc("cost"), F.desc("round"), F.desc("a"), F.desc("b")).limit(k - 1)
    found = freeze(components(points.select("id"), tree.join(dear, ["a", "b", "round"], "left_anti")), "named")
    roots = sorted(r["root"] for r in found.select("root").distinct().collect())  # at most k
    names = F.broadcast(df.sparkSession.createDataFrame(list(zip(roots, range(len(roots)))), "root long, cluster int"))
    named = points.join(found.join(names, "root"), "id").select(*columns, "cluster")
    return rows.join(named, list(columns))


def clustering_comparison(
    datasets: Mapping[str, DataFrame],
    key: str,
    columns: Sequence[str],
    algorithms: Mapping[str, Callable[[DataFrame], DataFrame]],
) -> DataFrame:
    """(dataset, algorithm, rows, clusters, seconds, silhouette) for every combination."""
    timed, judged = [], {}
    for dataset, df in datasets.items():
        data = freeze(df.select(key, *columns))
        n, found = data.count(), {}
        for name, run in algorithms.items():
            start = time.perf_counter()
            labelled = freeze(run(data).select(key, "cluster"))
            timed.append((dataset, name, n, time.perf_counter() - start))
            found[name] = data.join(labelled, key)
        judged[dataset] = found

    # The fits are timed one by one; then a dataset's distances are taken once for all its clusterings, and the datasets share the cluster.
    with ThreadPoolExecutor(4) as pool:
        scores = dict(zip(judged, pool.map(lambda found: mean_silhouettes(found, F.array(*columns), "cluster"), judged.values())))
    out = []
    for dataset, name, n, seconds in timed:
        clusters, mean = scores[dataset][name]
        out.append((dataset, name, n, clusters, seconds, mean if clusters > 1 else None))
    schema = "dataset string, algorithm string, rows long, clusters long, seconds double, silhouette double"
    return next(iter(datasets.values())).sparkSession.createDataFrame(out, schema)


def cluster_profile(df: DataFrame, cluster: str, columns: Sequence[str]) -> DataFrame:
    """Rounded mean and deviation of each column per cluster."""
    aggs = []
    for c in columns:
        aggs.append((F.rint(F.avg(c) * 100) / 100).alias(f"{c}_mean"))
        aggs.append((F.rint(F.stddev_samp(c) * 100) / 100).alias(f"{c}_std"))
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), *aggs)
