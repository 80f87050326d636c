"""Density clustering on a grid, and the exact silhouette.

Cells are small enough that two points of one cell are always neighbours. A cell
with enough rows is therefore dense without comparing its points, and pairs are
only formed around sparse cells, which hold few points by definition.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from sumac.operators.neighbours import distance
from sumac.operators.ordering import global_rank
from sumac.session import freeze

DIRECT_PAIRS = 20_000_000


class _Grid:
    def __init__(self, columns: Sequence[str], eps: float):
        if len(columns) > 3:
            raise ValueError("grid clustering is for one to three coordinates")
        self.columns, self.eps = list(columns), float(eps)
        self.axes = [f"_x{i}" for i in range(len(columns))]
        self.cell = [f"_c{i}" for i in range(len(columns))]
        # Slightly under the exact width, so that float rounding stays inside eps.
        self.side = self.eps / math.sqrt(len(columns)) * (1 - 1e-9)
        self.reach = math.ceil(math.sqrt(len(columns))) + 1
        self.here = [F.col(a) for a in self.axes]

    def steps(self, half: bool = False) -> Column:
        moves = []
        for move in product(range(-self.reach, self.reach + 1), repeat=len(self.axes)):
            gap = math.sqrt(sum(max(abs(v) - 1, 0) ** 2 for v in move)) * self.side
            if gap <= self.eps and (not half or move > (0,) * len(move)):
                moves.append(f"array({', '.join(map(str, move))})")
        return F.explode(F.expr(f"array({', '.join(moves)})"))

    def in_cells(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.floor(x / F.lit(self.side)).cast("long") for c, x in zip(self.cell, self.here)})

    def spread(self, df: DataFrame) -> DataFrame:
        """Each row once per cell that can hold a neighbour, with ``_q`` coordinates."""
        moved = df.withColumn("_s", self.steps())
        return moved.select(
            *[x.alias(f"_q{a}") for a, x in zip(self.axes, self.here)],
            *[(F.col(c) + F.col("_s")[i]).alias(c) for i, c in enumerate(self.cell)],
        )

    def near(self) -> Column:
        return distance([F.col(f"_q{a}") for a in self.axes], self.here) <= F.lit(self.eps)


def _locations(df: DataFrame, key: str, grid: _Grid) -> DataFrame:
    points = df.dropna(subset=grid.columns).select(
        F.col(key).alias("_key"), *[(F.col(c).cast("double") + 0.0).alias(a) for c, a in zip(grid.columns, grid.axes)]
    )
    return grid.in_cells(points.groupBy(*grid.axes).agg(F.count(F.lit(1)).alias("_w"), F.min("_key").alias("_first")))


def _with_core(located: DataFrame, grid: _Grid, min_samples: int) -> DataFrame:
    """Adds ``_core``: at least ``min_samples`` rows (itself included) within eps."""
    rows = located.groupBy(*grid.cell).agg(F.sum("_w").alias("_rows"))
    known = located.join(rows, grid.cell)
    sparse = known.filter(F.col("_rows") < min_samples)
    counted = (
        grid.spread(sparse)
        .join(located, grid.cell)
        .filter(grid.near())
        .groupBy(*[f"_q{a}" for a in grid.axes])
        .agg(F.sum("_w").alias("_near"))
    )
    same = [F.col(a) == F.col(f"_q{a}") for a in grid.axes]
    core = (F.col("_rows") >= min_samples) | (F.coalesce("_near", F.lit(0)) >= min_samples)
    return known.join(counted, same, "left").select(*grid.axes, *grid.cell, "_w", "_first", core.alias("_core"))


def _back_to_rows(df: DataFrame, key: str, grid: _Grid, located: DataFrame, *names: str) -> DataFrame:
    rows = df.select(key, *[(F.col(c).cast("double") + 0.0).alias(a) for c, a in zip(grid.columns, grid.axes)])
    return rows.join(located.select(*grid.axes, *names), grid.axes, "left").select(key, *names)


def core_points(df: DataFrame, key: str, columns: Sequence[str], eps: float, min_samples: int) -> DataFrame:
    """(key, is_core): whether enough rows lie within ``eps``."""
    grid = _Grid(columns, eps)
    marked = _with_core(_locations(df, key, grid), grid, min_samples)
    return _back_to_rows(df, key, grid, marked.withColumnRenamed("_core", "is_core"), "is_core")


def _linked_cells(core: DataFrame, grid: _Grid) -> DataFrame:
    """Pairs (a, b) of cells, named by their first key, with two core points within eps.

    Bounding boxes decide most pairs. The rest are compared point by point while
    that is little work, otherwise their cells are halved and judged again.
    """
    d = len(grid.axes)

    def boxes(df: DataFrame, by: Sequence[str]) -> DataFrame:
        return df.groupBy(*by).agg(
            *[F.min(a).alias(f"lo{i}") for i, a in enumerate(grid.axes)],
            *[F.max(a).alias(f"hi{i}") for i, a in enumerate(grid.axes)],
            F.count(F.lit(1)).alias("n"),
        )

    def side(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
        return df.select(*[F.col(c).alias(f"{prefix}{c}") for c in df.columns if c not in keep], *keep)

    def judged(pairs: DataFrame) -> DataFrame:
        gaps, spans = [], []
        for i in range(d):
            gaps.append(
                F.greatest(F.col(f"b_lo{i}") - F.col(f"a_hi{i}"), F.col(f"a_lo{i}") - F.col(f"b_hi{i}"), F.lit(0.0))
            )
            spans.append(F.greatest(F.col(f"b_hi{i}") - F.col(f"a_lo{i}"), F.col(f"a_hi{i}") - F.col(f"b_lo{i}")))
        nearest = F.sqrt(sum((g * g for g in gaps), F.lit(0.0)))
        farthest = F.sqrt(sum((s * s for s in spans), F.lit(0.0)))
        verdict = F.when(farthest <= grid.eps, True).when(nearest > grid.eps * (1 + 1e-12), False)
        return pairs.withColumn("linked", verdict)

    ids = core.groupBy(*grid.cell).agg(F.min("_first").alias("id"))
    points = freeze(core.join(ids, grid.cell).select("id", *grid.axes, *grid.cell))
    cells = boxes(points, ["id", *grid.cell])
    left = side(cells.withColumn("_s", grid.steps(half=True)).withColumns(
        {c: F.col(c) + F.col("_s")[i] for i, c in enumerate(grid.cell)}
    ).drop("_s"), "a_", grid.cell)
    right = side(cells, "b_", grid.cell)
    pairs = freeze(judged(left.join(right, grid.cell).drop(*grid.cell)))
    found = pairs.filter("linked").select("a_id", "b_id")
    open_pairs = pairs.filter("linked is null")
    width, sub = grid.side, [f"s{i}" for i in range(d)]
    while True:
        work = open_pairs.agg(F.sum(F.col("a_n").cast("double") * F.col("b_n"))).first()[0]
        if not work:
            return found.distinct()
        ends = open_pairs.select("a_id", "b_id").distinct()
        if work <= DIRECT_PAIRS or width < grid.eps * 1e-12:
            a = points.select(F.col("id").alias("a_id"), *[x.alias(f"_q{n}") for n, x in zip(grid.axes, grid.here)])
            b = points.select(F.col("id").alias("b_id"), *grid.axes)
            met = ends.join(a, "a_id").join(b, "b_id").filter(grid.near()).select("a_id", "b_id")
            return found.unionByName(met).distinct()
        width /= 4
        parts = points.withColumns({s: F.floor(x / F.lit(width)).cast("long") for s, x in zip(sub, grid.here)})
        small = boxes(parts, ["id", *sub]).drop(*sub)
        pairs = freeze(judged(ends.join(side(small, "a_"), "a_id").join(side(small, "b_"), "b_id")))
        hits = pairs.filter("linked").select("a_id", "b_id").distinct()
        found = freeze(found.unionByName(hits).distinct())
        open_pairs = freeze(pairs.filter("linked is null").join(hits, ["a_id", "b_id"], "left_anti"))


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, root): smallest id reachable over undirected edges (a, b).

    Every round each node points to its smallest neighbour, follows pointers a
    few steps, and the graph shrinks to the edges between different ends. Rounds
    grow with the logarithm of the nodes, not with the length of a chain, and a
    hub becomes one node at once. Each round is a table in the shared folder.
    """
    graph = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    roots = nodes.select("id", F.col("id").alias("root"))
    while True:
        graph = freeze(graph)
        if graph.isEmpty():
            return roots
        points = graph.groupBy(F.col("a").alias("v")).agg(F.least(F.first("a"), F.min("b")).alias("p"))
        for _ in range(2):
            ahead = points.select(F.col("v").alias("p"), F.col("p").alias("q"))
            points = points.join(ahead, "p").select("v", F.col("q").alias("p"))
        points = freeze(points)
        moved = points.select(F.col("v").alias("root"), F.col("p").alias("q"))
        roots = roots.join(moved, "root", "left").select("id", F.coalesce("q", "root").alias("root"))
        ends = graph.join(points.select(F.col("v").alias("a"), F.col("p").alias("pa")), "a")
        ends = ends.join(points.select(F.col("v").alias("b"), F.col("p").alias("pb")), "b")
        graph = ends.filter(F.col("pa") != F.col("pb")).select(F.col("pa").alias("a"), F.col("pb").alias("b")).distinct()


def dbscan(df: DataFrame, key: str, columns: Sequence[str], eps: float, min_samples: int) -> DataFrame:
    """(key, cluster): density clusters, -1 for noise.

    Clusters are numbered by the smallest key among their core rows; a border row
    joins the lowest-numbered cluster it touches. Rows with a missing coordinate
    get NULL.
    """
    grid = _Grid(columns, eps)
    marked = freeze(_with_core(_locations(df, key, grid), grid, min_samples))
    core = marked.filter("_core")
    ids = core.groupBy(*grid.cell).agg(F.min("_first").alias("id"))
    links = _linked_cells(core, grid).select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))
    roots = components(ids.select("id"), links)
    numbers = global_rank(roots.select("root").distinct(), ["root"], "_number")
    numbered = freeze(ids.join(roots, "id").join(numbers, "root").select(*grid.cell, (F.col("_number") - 1).alias("cluster")))
    core_rows = core.join(numbered, grid.cell).select(*grid.axes, *grid.cell, "cluster")
    border = (
        grid.spread(marked.filter(~F.col("_core")))
        .join(core_rows, grid.cell)
        .filter(grid.near())
        .groupBy(*[f"_q{a}" for a in grid.axes])
        .agg(F.min("cluster").alias("cluster"))
        .select(*[F.col(f"_q{a}").alias(a) for a in grid.axes], "cluster")
    )
    reached = core_rows.select(*grid.axes, "cluster").unionByName(border)
    labelled = marked.select(*grid.axes).join(reached, grid.axes, "left").fillna(-1, ["cluster"])
    return _back_to_rows(df, key, grid, labelled, "cluster")


#: Bytes of sums a task of the silhouette holds before it hands them on, sums of one block, and coordinates up to which differences are taken.
HELD_BYTES, BLOCK_SUMS, FEW_COORDINATES = 128 << 20, 1 << 21, 8
_BLOCK = "block long, ids binary, vectors binary, at binary, code binary, weight binary"


def _gaps(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``x`` to all of ``y``.

    Long vectors go through the dot product; pairs so near that it would lose digits are taken again by their differences.
    """
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    if x.shape[1] <= FEW_COORDINATES or not (np.isfinite(xx).all() and np.isfinite(yy).all()):
        gap = np.zeros((len(x), len(y)))
        for k in range(x.shape[1]):
            part = x[:, k, None] - y[:, k]
            gap += np.multiply(part, part, out=part)
        return np.sqrt(gap, out=gap)
    norms = xx[:, None] + yy
    gap = norms - 2 * (x @ y.T)
    near, partner = np.nonzero(gap < 1e-6 * norms)
    for start in range(0, len(near), 32768):
        a, b = near[start : start + 32768], partner[start : start + 32768]
        part = x[a] - y[b]
        gap[a, b] = (part * part).sum(axis=1)
    return np.sqrt(np.maximum(gap, 0, out=gap), out=gap)


def _one_block(row: dict, side: str, codes: int) -> tuple[np.ndarray, np.ndarray]:
    """(vectors, weights by row and code) of a packed block."""
    ids, at, code = (np.frombuffer(row[side + c], t) for c, t in (("ids", "<i8"), ("at", "<i4"), ("code", "<i4")))
    held = np.zeros((len(ids), codes))
    held[at, code] = np.frombuffer(row[side + "weight"], "<f8")
    return np.frombuffer(row[side + "vectors"], "<f8").reshape(len(ids), -1), held


def _scored(rows: DataFrame, block_rows: int) -> DataFrame:
    """``rows`` (a, c, v and other columns) with ``silhouette`` instead of ``v``: that of row v in cluster c of clustering a.

    Every location must meet every other, once for all clusterings. Locations are packed into blocks; the product of the blocks with
    themselves needs no shuffle, and a task adds up the distances per location and cluster over all blocks it meets. What is
    shuffled are these sums, of each block once per partition of the other side. Memory is bounded, time is quadratic.
    """
    spark = rows.sparkSession
    rows = freeze(rows.dropna(subset=["a", "c", "v"]), "labelled")
    located = freeze(rows.select("v").distinct().withColumn("id", F.monotonically_increasing_id()), "located")
    narrow = freeze(rows.join(located, "v").drop("v"), "narrow")
    # One row per cluster, as every location's sums have.
    sizes = sorted(narrow.groupBy("a", "c").agg(F.count(F.lit(1)).alias("n")).collect())
    if not sizes:
        return narrow.drop("id").withColumn("silhouette", F.lit(None).cast("double"))
    size, kind = np.array([float(n) for *_, n in sizes]), narrow.schema["c"].dataType.simpleString()
    families = [[k for k, (a, *_) in enumerate(sizes) if a == name] for name in sorted({a for a, *_ in sizes})]
    named = spark.createDataFrame([(a, c, k) for k, (a, c, _) in enumerate(sizes)], f"a string, c {kind}, code int")
    coded = narrow.join(F.broadcast(named), ["a", "c"])
    counted = coded.groupBy("id", "code").agg(F.count(F.lit(1)).cast("double").alias("w"))
    points = located.join(counted.groupBy("id").agg(F.collect_list("code").alias("code"), F.collect_list("w").alias("w")), "id")
    most = max(64, min(block_rows, BLOCK_SUMS // len(size)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, most):
                piece = batch.slice(start, most)
                vectors, codes, weights = (piece.column(c) for c in ("v", "code", "w"))
                at = np.repeat(np.arange(piece.num_rows, dtype="<i4"), codes.value_lengths().to_numpy())
                flat = vectors.flatten().to_numpy(zero_copy_only=False).astype("<f8")
                data = [piece.column("id").to_numpy().astype("<i8"), flat, at, codes.flatten().to_numpy().astype("<i4"), weights.flatten().to_numpy().astype("<f8")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([(part << 32) + n]), *[pa.array([d.tobytes()], pa.binary()) for d in data]], names=["block", "ids", "vectors", "at", "code", "weight"]
                )
                n += 1

    packed = freeze(points.select("id", "v", "code", "w").mapInArrow(pack, _BLOCK), "blocks")
    left = packed.repartition(spark.sparkContext.defaultParallelism).select(*[F.col(c).alias(f"x_{c}") for c in packed.columns])
    pairs = left.join(packed.select(*[F.col(c).alias(f"y_{c}") for c in packed.columns]), F.col("x_block") <= F.col("y_block"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def handed() -> Iterator[pa.RecordBatch]:
            for block, sums in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([sums.tobytes()], pa.binary())], names=["block", "sums"])
            held.clear()

        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in batch.schema.names}
                i, j = row["x_block"], row["y_block"]
                (x, mine), (y, theirs) = _one_block(row, "x_", len(size)), _one_block(row, "y_", len(size))
                for block, other in ((i, x), (j, y)):
                    held.setdefault(block, np.zeros((len(other), len(size))))
                for start in range(0, len(x), 256):
                    part = slice(start, start + 256)
                    gap = _gaps(x[part], y)
                    held[i][part] += gap @ theirs
                    if i != j:
                        held[j] += gap.T @ mine[part]
                if sum(sums.nbytes for sums in held.values()) > HELD_BYTES:
                    yield from handed()
        yield from handed()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, own = 0.0, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["sums"] is None:
                    own = [np.frombuffer(row[c], t) for c, t in (("ids", "<i8"), ("at", "<i4"), ("code", "<i4"))]
                else:
                    total = total + np.frombuffer(row["sums"], "<f8").reshape(-1, len(size))
        ids, at, code = own
        out = np.zeros(len(at))
        for family in families:
            mine = np.flatnonzero(np.isin(code, family) & (size[code] > 1))
            if len(family) < 2:
                continue
            means = total[at[mine]][:, family] / size[family]
            means[np.arange(len(mine)), np.searchsorted(family, code[mine])] = np.nan
            a, b = total[at[mine], code[mine]] / (size[code[mine]] - 1), np.fmin.reduce(means, axis=1)
            top = np.maximum(a, b)
            out[mine] = np.divide(b - a, top, out=np.zeros(len(mine)), where=top != 0)
        yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(code), pa.array(out)], names=["id", "code", "silhouette"])

    sums = pairs.mapInArrow(meet, "block long, sums binary")
    blocks = packed.select("block", "ids", "at", "code", F.lit(None).cast("binary").alias("sums"))
    scored = blocks.unionByName(sums, allowMissingColumns=True).groupBy("block").applyInArrow(finish, "id long, code int, silhouette double")
    return coded.join(scored, ["id", "code"]).drop("id", "code")


def silhouette(df: DataFrame, key: str, vector: Column, cluster: str, block_rows: int = 2048) -> DataFrame:
    """(key, cluster, silhouette) with plain Euclidean distances; noise counts as a cluster. Copies of a vector are merged first."""
    rows = df.select(F.col(key).alias("_key"), F.lit("").alias("a"), F.col(cluster).alias("c"), vector.cast("array<double>").alias("v"))
    return _scored(rows, block_rows).select(F.col("_key").alias(key), F.col("c").alias(cluster), "silhouette")


def mean_silhouettes(labelled: Mapping[str, DataFrame], vector: Column, cluster: str, block_rows: int = 2048) -> dict[str, tuple[int, float | None]]:
    """(clusters, mean silhouette) by name, of several clusterings of the same locations, whose distances are taken once."""
    parts = [df.select(F.lit(n).alias("a"), F.col(cluster).cast("long").alias("c"), vector.cast("array<double>").alias("v")) for n, df in labelled.items()]
    means = _scored(reduce(DataFrame.unionByName, parts), block_rows).groupBy("a").agg(F.count_distinct("c").alias("n"), F.avg("silhouette").alias("s"))
    found = {r["a"]: (r["n"], r["s"]) for r in means.collect()}
    return {name: found.get(name, (0, None)) for name in labelled}
