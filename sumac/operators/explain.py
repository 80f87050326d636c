"""Model explanation as bulk scoring jobs.

A model is a function ``predict(columns) -> Column`` over a mapping of feature
columns, or for fitted pipelines any ``DataFrame -> DataFrame`` that adds a
prediction column.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from sumac.functions.scalars import base_name, seeded_hash
from sumac.operators.evaluate import binary_metrics
from sumac.operators.ordering import global_rank
from sumac.operators.quantiles import exact_quantiles
from sumac.operators.selection import seeded_sample
from sumac.session import freeze

#: Donors of one range, places and values of one block, and partitions they are spread over.
SOURCE_ROWS, BLOCK_ROWS, BLOCK_VALUES, MOST_PARTS = 1 << 18, 1 << 16, 1 << 23, 1000

Rule = Callable[[Mapping[str, Column]], Column]
Scorer = Callable[[DataFrame], DataFrame]


def as_scorer(rule: Rule, features: Sequence[str], name: str = "prediction") -> Scorer:
    return lambda df: df.withColumn(name, rule({f: F.col(f) for f in features}))


def shuffled_place(place: str, n: str, width: str, height: str, key: str, over: str = "div") -> str:
    """SQL text of a keyed bijection of [0, n), as whole-number arithmetic that other engines compute alike.

    A place is split into (left, right) of a rectangle ``width`` x ``height`` that holds n places; rounds add to one side a keyed function of the other,
    which any key can undo. A result beyond n goes round again until it is below; as fewer than ``height`` places lie beyond, few do, and small rectangles
    return within as many rounds as they have places.
    """
    left, right = f"(v {over} {height})", f"(v % {height})"
    for j in range(0, 6, 2):
        left = f"(({left} + ({right} * 1103515245 + ({key} + {j} * 15485863) % 2147483647) % 2147483629) % {width})"
        right = f"(({right} + ({left} * 1103515245 + ({key} + {j + 1} * 15485863) % 2147483647) % 2147483629) % {height})"
    moved = f"({left} * {height} + {right})"
    if over == "div":
        # Nearly all places are done after one round, which stays in generated code.
        once = re.sub(r"\bv\b", f"({place})", moved)
        again = f"aggregate(sequence(1, 64), {place}, (v, i) -> if(i > 1 and v < {n}, v, {moved}))"
        return f"if({once} < {n}, {once}, {again})"
    return f"list_reduce(range(1, 65), lambda v, i: CASE WHEN i > 1 AND v < {n} THEN v ELSE {moved} END, {place})"


def _moved(v: np.ndarray, n: int, width: int, height: int, key: int) -> np.ndarray:
    """``shuffled_place`` of whole arrays."""

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v // height, v % height
        for j in range(0, 6, 2):
            left = (left + (right * 1103515245 + (key + j * 15485863) % 2147483647) % 2147483629) % width
            right = (right + (left * 1103515245 + (key + (j + 1) * 15485863) % 2147483647) % 2147483629) % height
        return left * height + right

    return _until_below(v, n, once)


def _moved_back(v: np.ndarray, n: int, width: int, height: int, key: int) -> np.ndarray:
    """The places that ``_moved`` takes to ``v``."""

    def once(v: np.ndarray) -> np.ndarray:
        left, right = v // height, v % height
        for j in range(4, -2, -2):
            right = (right - (left * 1103515245 + (key + (j + 1) * 15485863) % 2147483647) % 2147483629) % height
            left = (left - (right * 1103515245 + (key + j * 15485863) % 2147483647) % 2147483629) % width
        return left * height + right

    return _until_below(v, n, once)


def _until_below(v: np.ndarray, n: int, once: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    v = once(v)
    while (beyond := np.flatnonzero(v >= n)).size:
        v[beyond] = once(v[beyond])
    return v


def permutations(
    df: DataFrame, key: str, features: Sequence[str], repeats: int, seed: int = 42, keep: Sequence[str] = ()
) -> DataFrame:
    """Row x repeat x feature table with that one feature taken from another row.

    Rows get a seeded random order once; every repeat and feature has a permutation of its own, a keyed bijection of the
    ranks. Values travel packed: a range of donors sends each block of places its values in the order of these places, and
    the receiver finds from the permutation alone which value is whose. No row is shuffled more than once, whatever the repeats.
    Repeat 0 (feature NULL) is the unchanged table.
    """
    ranked = freeze(
        global_rank(
            df.select(key, *keep, *features).withColumn("_token", seeded_hash(F.col(key), seed)), ["_token", key], "_rank"
        ).drop("_token")
    )
    n, cores = ranked.count(), df.sparkSession.sparkContext.defaultParallelism
    width = max(1, math.isqrt(max(n - 1, 0)) + 1)
    height = max(1, -(-n // width))
    drawn = [(r, k, seed * 1000003 + r * 7919 + k * 104729) for r in range(1, repeats + 1) for k in range(len(features))]
    fair = max(4096, -(-n // (2 * cores)))
    source, block = min(SOURCE_ROWS, fair), min(fair, BLOCK_ROWS, max(1, BLOCK_VALUES // max(1, len(drawn))))
    fields = {f.name: f for f in ranked.schema.fields}
    kinds = [fields[f].dataType.simpleString() for f in features]
    lists, own = [f"_v{k}" for k in range(len(features))], [key, *keep, *features]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per permutation and block of places: the values that go there, in the order of the places."""
        rows = pa.Table.from_batches(list(batches)).sort_by("_rank").combine_chunks()
        donors = rows.column("_rank").to_numpy() - 1
        values = [rows.column(f"_x{k}").combine_chunks() for k in range(len(features))]
        for rep, k, draw in drawn:
            places = _moved_back(donors, n, width, height, draw)
            order = np.argsort(places, kind="stable")
            to, starts = np.unique(places[order] // block, return_index=True)
            sent = pa.ListArray.from_arrays(pa.array(np.append(starts, len(order)), pa.int32()), values[k].take(pa.array(order)))
            m = len(to)
            where = [pa.array(to), pa.array(np.full(m, donors[0] // source)), pa.array(np.full(m, rep, "<i4")), pa.array(np.full(m, k, "<i4"))]
            others = [sent if j == k else pa.nulls(m, pa.list_(v.type)) for j, v in enumerate(values)]
            yield pa.RecordBatch.from_arrays([*where, *others], names=["_to", "_from", "rep", "_f", *lists])

    def receive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of one block of places, once per permutation with one feature from the donors."""
        rows, sent = [], {}
        for batch in batches:
            whose = batch.column("_from").to_numpy(zero_copy_only=False)
            rows.append(batch.filter(pa.array(whose < 0)))
            rep, k = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("rep", "_f"))
            for i in np.flatnonzero(whose >= 0):
                sent.setdefault((rep[i], k[i]), {})[whose[i]] = batch.column(lists[k[i]])[int(i)].values
        table = pa.Table.from_batches(rows)
        table = pa.Table.from_struct_array(table.column("_own")).sort_by("_rank").combine_chunks()
        places = table.column("_rank").to_numpy() - 1
        mine = [table.column(f"_x{j}").combine_chunks() for j in range(len(own))]
        for rep, k, draw in drawn:
            order = np.argsort(_moved(places, n, width, height, draw) // source, kind="stable")
            back = np.empty(len(order), np.int64)
            back[order] = np.arange(len(order))
            parts = sent.pop((rep, k))
            value = pa.concat_arrays([parts[i] for i in sorted(parts)]).take(pa.array(back))
            columns = [value if j == 1 + len(keep) + k else v for j, v in enumerate(mine)]
            named = [pa.array(np.full(len(order), rep, "<i4")), pa.array([features[k]] * len(order), pa.string())]
            yield pa.RecordBatch.from_arrays([*named, *columns], names=["rep", "feature", *own])

    units, blocks = -(-n // source), -(-n // block)
    place = F.col("_rank") - 1
    giving = ranked.select(F.floor(place / source).alias("_from"), "_rank", *[F.col(f).alias(f"_x{k}") for k, f in enumerate(features)])
    message = "_to long, _from long, rep int, _f int, " + ", ".join(f"{v} array<{kind}>" for v, kind in zip(lists, kinds))
    sent = giving.repartition(max(1, min(units, MOST_PARTS)), "_from").groupBy("_from").applyInArrow(send, message)
    getting = ranked.select(
        F.floor(place / block).alias("_to"), F.lit(-1).cast("long").alias("_from"), F.lit(0).alias("rep"), F.lit(0).alias("_f"),
        F.struct("_rank", *[F.col(c).alias(f"_x{j}") for j, c in enumerate(own)]).alias("_own"),
    )
    met = getting.unionByName(sent, allowMissingColumns=True).repartition(max(1, min(blocks, MOST_PARTS)), "_to")
    shape = T.StructType([T.StructField("rep", T.IntegerType()), T.StructField("feature", T.StringType()), *[fields[c] for c in own]])
    moved = met.groupBy("_to").applyInArrow(receive, shape)
    plain = ranked.select(F.lit(0).alias("rep"), F.lit(None).cast("string").alias("feature"), key, *keep, *features)
    return moved.unionByName(plain)


def permutation_importance(
    df: DataFrame, key: str, features: Sequence[str], label: str, predict: Scorer, repeats: int = 30, seed: int = 42
) -> DataFrame:
    """Mean and population deviation of the F1 lost when one feature is shuffled."""
    scored = predict(permutations(df, key, features, repeats, seed, keep=[label]))
    f1 = binary_metrics(scored, label, "prediction", by=["feature", "rep"]).select("feature", "rep", "f1")
    # features x repeats rows from here on; compute them once.
    f1 = freeze(f1)
    base = f1.filter(F.col("rep") == 0).select("f1").scalar()
    drops = f1.filter(F.col("rep") > 0).withColumn("drop", base - F.col("f1"))
    return drops.groupBy("feature").agg(
        F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std")
    )


def dependence_grid(sample: DataFrame, feature: str, points: int = 50) -> list[float]:
    """All distinct values if few, else evenly spaced between the 5th and 95th percentile."""
    distinct = sample.select(F.col(feature).cast("double").alias("v")).filter("v is not null").distinct()
    values = [r["v"] for r in distinct.limit(points + 1).collect()]
    if len(values) <= points:
        return sorted(values)
    low, high = exact_quantiles(sample, [feature], [0.05, 0.95])[feature]
    return [low + (high - low) * i / (points - 1) for i in range(points)]


def partial_dependence(
    df: DataFrame, key: str, features: Sequence[str], feature: str, predict: Scorer, sample_rows: int = 1000,
    points: int = 50, seed: int = 42,
) -> DataFrame:
    """Average prediction with ``feature`` forced to each grid value, over a seeded sample."""
    sample = freeze(seeded_sample(df.select(key, *features), key, sample_rows, seed))
    return grid_expand(sample, feature, dependence_grid(sample, feature, points)).transform(predict).groupBy(
        F.col(feature).alias("grid_value")
    ).agg(F.avg("prediction").alias("average"), F.count(F.lit(1)).alias("n"))


def grid_expand(df: DataFrame, feature: str, grid: Sequence[float]) -> DataFrame:
    """Every row once per grid value; the grid is a bounded literal list."""
    return df.withColumn(feature, F.explode(F.array(*[F.lit(float(v)) for v in grid])))


def shapley_exact(
    df: DataFrame, key: Sequence[str], features: Sequence[str], rule: Rule, background: DataFrame
) -> DataFrame:
    """(key, feature, value, phi, base, prediction) for at most four features.

    Contributions depend on the feature values only, so each distinct value
    combination is explained once, against the weighted distinct combinations of
    the background (a bounded sample), and joined back to its rows.
    """
    if len(features) > 4:
        raise ValueError("use shapley_sampled for more than four features")
    names = list(features)
    doubles = [F.col(f).cast("double").alias(f) for f in names]
    weighted = background.select(*doubles).groupBy(*names).agg(F.count(F.lit(1)).cast("double").alias("_w"))
    pool = weighted.agg(F.collect_list(F.struct(*names, "_w"))).scalar()
    total = background.agg(F.count(F.lit(1)).cast("double")).scalar()
    combos = df.select(*doubles).distinct().withColumns({"_pool": pool, "_total": total})

    def value_of(known: frozenset[str]) -> Column:
        def add(acc: Column, other: Column) -> Column:
            mixed = {f: F.col(f) if f in known else other[f] for f in names}
            return acc + rule(mixed).cast("double") * other["_w"]

        return F.aggregate("_pool", F.lit(0.0), add) / F.col("_total")

    subsets = [frozenset(s) for r in range(len(names) + 1) for s in combinations(names, r)]
    label = {s: "_v" + "".join(str(int(f in s)) for f in names) for s in subsets}
    valued = combos.withColumns({label[s]: value_of(s) for s in subsets})
    d = len(names)
    parts = []
    for f in names:
        phi = F.lit(0.0)
        for s in subsets:
            if f in s:
                continue
            weight = math.factorial(len(s)) * math.factorial(d - len(s) - 1) / math.factorial(d)
            phi = phi + (F.col(label[s | {f}]) - F.col(label[s])) * F.lit(weight)
        parts.append(F.struct(F.lit(f).alias("feature"), F.col(f).alias("value"), phi.alias("phi")))
    explained = valued.select(
        *names,
        F.col(label[frozenset()]).alias("base"),
        F.col(label[frozenset(names)]).alias("prediction"),
        F.array(*parts).alias("_parts"),
    )
    # Few distinct combinations make this a broadcast join; otherwise it is an
    # equi-join in which a frequent combination is split by adaptive execution.
    rows = df.select(*key, *doubles)
    same = [rows[f].eqNullSafe(explained[f]) for f in names]
    joined = rows.join(explained, same, "left").select(*[rows[k] for k in key], "base", "prediction", "_parts")
    # Unfold by literal position: exploding the computed array itself would make
    # the optimizer evaluate it in a filter on every input row.
    unfolded = joined.withColumn("_i", F.explode(F.array(*[F.lit(i) for i in range(d)])))
    return unfolded.withColumn("_p", F.get("_parts", F.col("_i"))).select(*key, "_p.*", "base", "prediction")


def shapley_sampled(
    df: DataFrame, key: str, features: Sequence[str], predict: Scorer, background: DataFrame, orders: int = 16, seed: int = 42
) -> DataFrame:
    """Shapley estimates from seeded feature orders, for any number of features.

    Each row walks ``orders`` seeded feature orders from a background row to
    itself; all walk steps are scored in bulk. Per row base + sum(phi) equals its
    prediction exactly, with ``base`` the mean over the background rows it met.
    """
    names = list(features)
    d = len(names)
    numbered = background.select(F.struct(*[F.col(f).cast("double").alias(f) for f in names]).alias("b"))
    pool = numbered.agg(F.sort_array(F.collect_list("b"))).scalar()
    walk = df.select(key, *[F.col(f).cast("double").alias(f) for f in names]).withColumns(
        {"_pool": pool, "walk": F.explode(F.sequence(F.lit(1), F.lit(orders)))}
    )
    mixed = F.xxhash64(F.col(key), F.col("walk"), F.lit(seed))
    walk = walk.withColumn("_b", F.get("_pool", F.pmod(mixed, F.size("_pool")).cast("int"))).drop("_pool")
    ordered = F.array_sort(
        F.array(*[F.struct(F.xxhash64(F.col(key), F.col("walk"), F.lit(seed), F.lit(f)), F.lit(f).alias("f")) for f in names])
    )
    walk = walk.withColumn("_order", F.transform(ordered, lambda s: s["f"]))
    steps = walk.withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(d))))
    place = {f: F.array_position("_order", F.lit(f)) for f in names}
    points = steps.select(
        key,
        "walk",
        "_step",
        F.when(F.col("_step") > 0, F.get("_order", F.col("_step") - 1)).alias("feature"),
        F.when(F.col("_step") < d, F.get("_order", F.col("_step"))).alias("_next"),
        *[F.when(place[f] <= F.col("_step"), F.col(f)).otherwise(F.col(f"_b.{f}")).alias(f) for f in names],
    )
    scored = predict(points)
    # A point adds to the feature just switched on and subtracts from the next one.
    sides = scored.withColumn("_on", F.explode(F.array(F.lit(True), F.lit(False))))
    moves = sides.select(
        key,
        F.when(F.col("_on"), F.col("feature")).otherwise(F.col("_next")).alias("feature"),
        F.when(F.col("_on"), F.col("prediction")).otherwise(-F.col("prediction")).alias("delta"),
    )
    sums = moves.filter(F.col("feature").isNotNull()).groupBy(key, "feature").agg((F.sum("delta") / orders).alias("phi"))
    bases = scored.filter(F.col("_step") == 0).groupBy(key).agg(F.avg("prediction").alias("base"))
    return sums.join(bases, key)


def shapley_global(phi: DataFrame) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    return phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_phi")).orderBy(F.desc("mean_abs_phi"), "feature")


def top_features(phi: DataFrame, n: int = 5) -> DataFrame:
    return shapley_global(phi).limit(n)


def shapley_scatter(phi: DataFrame, n: int = 5) -> DataFrame:
    """Value, contribution and prediction of the n most important features."""
    # n feature names: bounded by the request.
    keep = [r["feature"] for r in top_features(phi, n).collect()]
    return phi.filter(F.col("feature").isin(*keep))


def importance_rollup(importances: DataFrame, bases: Sequence[str]) -> DataFrame:
    """Sum one-hot importances back to their column, largest first."""
    base = base_name(F.col("feature"), bases)
    return importances.groupBy(base.alias("base")).agg(F.sum("importance").alias("importance")).orderBy(
        F.desc("importance"), "base"
    )


def tree_importance(spark, stage_path: str, features: Sequence[str]) -> DataFrame:
    """Gain, split count and cover per feature from a saved tree ensemble's node table."""
    nodes = spark.read.parquet(f"{stage_path}/data")
    names = F.array(*[F.lit(f) for f in features])
    splits = nodes.select(
        F.get(names, F.col("nodeData.split.featureIndex")).alias("feature"),
        F.col("nodeData.gain").alias("gain"),
        F.col("nodeData.rawCount").cast("double").alias("rows"),
        F.col("nodeData.split.featureIndex").alias("index"),
    ).filter(F.col("index") >= 0)
    table = splits.groupBy("feature").agg(
        F.avg("gain").alias("gain"), F.count(F.lit(1)).alias("weight"), F.avg("rows").alias("cover")
    )
    whole = table.agg(F.sum("gain")).scalar()
    return table.withColumn("gain_share", F.try_divide(F.col("gain"), whole)).orderBy(F.desc("gain"), "feature")
