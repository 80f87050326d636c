"""Exact nearest neighbours and neighbour-based imputation.

Copies of one location are collapsed before any pairing, and candidates come
from equi-joins on the leaves of a partition tree, so the work follows the number of distinct
locations and not the square of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from sumac.operators.cells import CellTree
from sumac.operators.ordering import global_rank, global_running
from sumac.session import freeze

#: Locations of a leaf of the partition tree.
LEAF = 256
#: Questions that one leaf answers in one task, and questions of a partition.
ASKING, PARTITION_ASKING = 65_536, 200_000


def distance(a: Sequence[Column], b: Sequence[Column]) -> Column:
    terms = [(x - y) * (x - y) for x, y in zip(a, b)]
    return F.sqrt(sum(terms[1:], terms[0]))


def smallest_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], k: int) -> DataFrame:
    """The first k rows of each group.

    Spark trims each map task to k rows per group before the shuffle, so a group
    with most of the rows costs no more than the others.
    """
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= k)


def knn(df: DataFrame, key: str, columns: Sequence[str], k: int) -> DataFrame:
    """(key, rank, neighbour, distance): k nearest rows, the row itself included.

    Copies of a location are one point of a partition tree (``cells.CellTree``) whose leaves hold few locations at any density. The k-th
    distance within its own leaf bounds a point's search (where the leaf has fewer rows, the extent of the smallest
    cell around it that has enough); candidates are the points of the leaves that this ball touches. A far point
    changes its own leaf only. Ties go to the smaller key. Rows with a missing coordinate are left out.
    """
    axes = [f"_x{i}" for i in range(len(columns))]
    points = df.dropna(subset=list(columns)).select(key, *[F.col(c).cast("double").alias(a) for c, a in zip(columns, axes)])
    weights = points.groupBy(*axes).agg(F.count(F.lit(1)).alias("_w"))
    owners = (
        smallest_per_group(points, axes, [key], k).groupBy(*axes).agg(F.sort_array(F.collect_list(key)).alias("_keys"))
    )
    tree = CellTree(freeze(weights.join(owners, axes), "located"), axes, cap=max(LEAF, 4 * k))
    query = [f"_q{a}" for a in axes]
    asking = tree.points.select(*[F.col(a).alias(q) for a, q in zip(axes, query)], "_cell")
    doubles = ", ".join(f"{q} double" for q in query)

    def own(table: pa.Table) -> pa.Table:
        """Each location with its k-th distance in its leaf, null if the leaf has fewer rows."""
        x, copies = _matrix(table, axes), pc.list_value_length(table.column("_keys")).to_numpy()
        near = np.full(len(x), np.nan)
        if copies.sum() >= k:
            for start in range(0, len(x), 256):
                gap = _gaps(x[start : start + 256], x)
                order = np.argsort(gap, axis=1)
                last = (copies[order].cumsum(axis=1) >= k).argmax(axis=1)
                near[start : start + 256] = gap[np.arange(len(gap)), order[np.arange(len(gap)), last]]
        return pa.table([*[table.column(a) for a in axes], pa.array(near, from_pandas=True)], names=[*query, "_reach"])

    near = tree.points.select("_cell", *axes, "_keys").groupBy("_cell").applyInArrow(own, f"{doubles}, _reach double")
    enough = freeze(near.filter("_reach is not null"), "reach")
    wide = tree.roomy(asking.join(enough, query, "left_anti"), query, k)
    met = freeze(tree.touched(enough.unionByName(wide), query), "met")
    best = _answers(met, tree.points.select("_cell", *axes, "_keys"), axes, query, k)
    best = best.groupBy(*query).agg(F.slice(F.array_sort(F.flatten(F.collect_list("_best"))), 1, k).alias("_best"))
    same = [points[a] == best[q] for a, q in zip(axes, query)]
    listed = points.join(best, same).select(key, F.posexplode("_best").alias("rank", "_one"))
    return listed.select(key, (F.col("rank") + 1).alias("rank"), F.col("_one.neighbour").alias("neighbour"), F.col("_one.distance").alias("distance"))


def _matrix(table: pa.Table, columns: Sequence[str]) -> np.ndarray:
    return np.stack([table.column(c).to_numpy() for c in columns], axis=1)


def _gaps(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    gap = np.zeros((len(x), len(y)))
    for j in range(x.shape[1]):
        part = x[:, j, None] - y[:, j]
        gap += part * part
    return np.sqrt(gap)


def _answers(met: DataFrame, points: DataFrame, axes: Sequence[str], query: Sequence[str], k: int) -> DataFrame:
    """(query, _best): per question and leaf the k nearest (distance, neighbour) within ``_reach``.

    A leaf is compared with its questions as matrices, so that a task holds its k nearest and not every pair. A leaf that
    many ask is copied for pieces of them, and partitions have a number of questions, whatever the table.
    """
    pieces = met.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / ASKING).alias("_pieces"))
    parts = max(met.sparkSession.sparkContext.defaultParallelism, -(-met.count() // PARTITION_ASKING))
    asked = met.join(pieces, "_cell").withColumn("_piece", F.pmod(F.xxhash64(*query), "_pieces")).drop("_pieces")
    leaves = points.join(pieces, "_cell").withColumn("_piece", F.explode(F.expr("sequence(0L, _pieces - 1)"))).drop("_pieces")
    kind = points.schema["_keys"].dataType.elementType

    def nearest(a: pa.Table, b: pa.Table) -> pa.Table:
        keys = b.column("_keys").combine_chunks()
        at, names = np.repeat(np.arange(len(keys)), pc.list_value_length(keys).to_numpy()), keys.flatten()
        order = pc.sort_indices(names).to_numpy()
        at, names = at[order], names.take(pa.array(order))
        x, y, reach = _matrix(a, query), _matrix(b, axes), a.column("_reach").to_numpy()
        taken, gaps, counts = [], [], []
        for start in range(0, len(x), 256):
            gap = _gaps(x[start : start + 256], y)[:, at]
            # Candidates stand in the order of their keys, which ties keep.
            first = np.argsort(gap, axis=1, kind="stable")[:, :k]
            gap = np.take_along_axis(gap, first, axis=1)
            inside = gap <= reach[start : start + 256, None] * (1 + 1e-12)
            taken.append(first[inside])
            gaps.append(gap[inside])
            counts.append(inside.sum(axis=1))
        taken, gaps, counts = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (taken, gaps, counts))
        both = pa.StructArray.from_arrays([pa.array(gaps, pa.float64()), names.take(pa.array(taken))], names=["distance", "neighbour"])
        listed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], counts.cumsum()]), pa.int32()), both)
        return pa.table([*[a.column(q) for q in query], listed], names=[*query, "_best"]).filter(pa.array(counts > 0))

    shape = ", ".join(f"{q} double" for q in query) + f", _best array<struct<distance: double, neighbour: {kind.simpleString()}>>"
    split = asked.repartition(parts, "_cell", "_piece").groupBy("_cell", "_piece")
    return split.cogroup(leaves.groupBy("_cell", "_piece")).applyInArrow(nearest, shape)


def kth_distances(df: DataFrame, key: str, columns: Sequence[str], k: int = 10) -> DataFrame:
    """Distance to the k-th listed neighbour (the row itself is the first), with its global rank."""
    last = knn(df, key, columns, k).filter(F.col("rank") == k).select(key, "distance")
    return global_rank(last, ["distance", key])


def elbow(ranked: DataFrame, value: str, sensitivity: float = 1.0, bucket_rows: int = 100_000) -> DataFrame:
    """Knee of an increasing convex curve given by (rank, value), by the Kneedle method.

    Read from the far end: with both axes scaled to [0, 1] the knee is the first
    local maximum of (height - position) after which the curve falls by more
    than ``sensitivity`` steps before the next maximum. Neighbouring ranks meet
    in overlapping rank buckets, so no task sees the whole curve.
    """
    ends = ranked.agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    n, low, high = ends["n"], ends["lo"], ends["hi"]
    if n < 3 or low == high:
        return ranked.select(F.col("rank").alias("knee_rank"), F.col(value).alias("knee")).limit(0)
    pos = F.lit(n) - F.col("rank")
    height = (F.lit(high) - F.col(value)) / F.lit(high - low)
    curve = ranked.select(
        "rank", F.col(value).alias("_value"), pos.alias("_pos"), (height - pos / F.lit(float(n - 1))).alias("_diff")
    )
    home = F.floor(F.col("_pos") / F.lit(bucket_rows))
    copies = curve.withColumn("_home", home).withColumn(
        "_bucket",
        F.explode(F.array_distinct(F.array(*[F.floor((F.col("_pos") + s) / F.lit(bucket_rows)) for s in (-1, 0, 1)]))),
    )
    around = Window.partitionBy("_bucket").orderBy("_pos")
    before = F.coalesce(F.lag("_diff").over(around), F.col("_diff"))
    after = F.coalesce(F.lead("_diff").over(around), F.col("_diff"))
    shaped = (
        copies.withColumns({"_before": before, "_after": after, "_last": F.lead("_diff").over(around).isNull()})
        .filter(F.col("_bucket") == F.col("_home"))
        .withColumns(
            {
                "_top": F.when(
                    (F.col("_diff") >= F.col("_before")) & (F.col("_diff") >= F.col("_after")),
                    F.struct("_pos", "_diff", "rank", "_value"),
                ),
                "_dip": F.when((F.col("_diff") <= F.col("_before")) & (F.col("_diff") <= F.col("_after")), F.col("_pos")),
            }
        )
        .select("_pos", "_after", "_top", "_dip")
    )
    followed = global_running(shaped, ["_pos"], {"_peak": ("max", "_top"), "_low": ("max", "_dip")})
    threshold = F.when(F.col("_low") >= F.col("_peak._pos"), F.lit(0.0)).otherwise(
        F.col("_peak._diff") - F.lit(sensitivity / (n - 1))
    )
    falls = followed.filter(F.col("_peak").isNotNull() & (F.col("_pos") < n - 1) & (F.col("_after") < threshold))
    first = falls.orderBy("_pos").limit(1)
    return first.select(F.col("_peak.rank").alias("knee_rank"), F.col("_peak._value").alias("knee"))


def nearest_donors(df: DataFrame, key: str, target: str, by: str, k: int = 2) -> DataFrame:
    """Donors for rows whose ``target`` is missing and ``by`` present.

    One row per (row, rank): the k rows with both cells present that are nearest
    in ``by``; ties go to the smaller key. The distance covers two coordinates of
    which one is shared, hence the factor sqrt(2).

    Distinct donor and receiver values are put in one global order. Running donor
    counts tell each receiver its place among the donors, and the k donor values
    on either side reach it by an equi-join on that place.
    """
    have = df.filter(F.col(target).isNotNull() & F.col(by).isNotNull())
    donors = (
        smallest_per_group(have.select(by, key, target), [by], [key], k)
        .groupBy(by)
        .agg(F.sort_array(F.collect_list(F.struct(F.col(key).alias("donor"), F.col(target).alias("donor_value")))).alias("_d"))
        .withColumn("_is", F.lit(1))
    )
    lack = df.filter(F.col(target).isNull() & F.col(by).isNotNull()).select(key, by)
    empty = F.lit(None).cast(donors.schema["_d"].dataType)
    places = lack.select(by).distinct().select(by, empty.alias("_d"), F.lit(0).alias("_is"))
    order = [F.asc(by), F.desc("_is")]
    placed = freeze(global_running(donors.unionByName(places), order, {"_t": ("sum", "_is")}))
    # A donor of rank r may serve every place from k below it to k - 1 above it.
    served = F.explode(F.array(*[F.col("_t") + s for s in range(-k, k)]))
    offers = (
        placed.filter("_is = 1")
        .select(served.alias("_t"), F.struct(F.col(by).alias("at"), F.col("_d").alias("d")).alias("_o"))
        .groupBy("_t")
        .agg(F.collect_list("_o").alias("_offers"))
    )
    gap = F.abs(F.col("_o.at") - F.col(by))
    chosen = (
        placed.filter("_is = 0")
        .select(by, "_t")
        .join(offers, "_t")
        .withColumn("_o", F.explode("_offers"))
        .withColumn("_one", F.explode("_o.d"))
        .select(by, (gap * F.lit(math.sqrt(2.0))).alias("distance"), "_one.donor", "_one.donor_value")
    )
    best = smallest_per_group(chosen, [by], ["distance", "donor"], k).withColumnRenamed("_place", "rank")
    return lack.join(best, by).select(key, "rank", "donor", "donor_value", "distance")


def impute_knn(df: DataFrame, key: str, columns: Sequence[str], k: int = 2) -> DataFrame:
    """Fill each of two columns with the mean of its k nearest donors in the other.

    Rows missing both cells share no coordinate with anyone and get the column mean.
    """
    first, second = columns
    means = df.agg(*[F.avg(c).alias(c) for c in columns]).first()
    out = df
    for target, by in ((first, second), (second, first)):
        filled = nearest_donors(df, key, target, by, k).groupBy(key).agg(F.avg("donor_value").alias(f"_{target}"))
        out = out.join(filled, key, "left")
    return out.withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_{c}"), F.lit(means[c])) for c in columns}
    ).drop(*[f"_{c}" for c in columns])
