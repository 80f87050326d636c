"""Near-duplicate vectors by an exact metric range join."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sumac.llm.components import components
from sumac.llm.texts import as_batch
from sumac.llm.vectors import distances, finite, matrix, parts_of, pivots
from sumac.session import freeze

#: Pivots at most, the share of the root of the number of vectors that are pivots, home vectors of a part, components of the guests of a part, and rows of one product.
MOST_PIVOTS, ROOT_SHARE, BLOCK, GUEST_CELLS, CHUNK = 1024, 8, 2048, 1 << 20, 1024


def _stars(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what the links of one block connect: one per vector reached."""
    out, seen_left, seen_right = [], np.zeros(len(left), bool), np.zeros(len(right), bool)
    for k in np.flatnonzero((linked & (left[:, None] != right)).any(axis=1)).tolist():
        if seen_left[k]:
            continue
        front = np.array([k])
        seen_left[k] = True
        while len(front):
            columns = linked[front].any(axis=0) & ~seen_right
            seen_right |= columns
            out += [(left[k], x) for x in right[columns]]
            rows = linked[:, columns].any(axis=1) & ~seen_left
            seen_left |= rows
            front = np.flatnonzero(rows)
            out += [(left[k], x) for x in left[front]]
    return out


def _pack(keys: list[np.ndarray], reps: np.ndarray, sizes: np.ndarray, x: np.ndarray, names: list[str]):
    """A batch of one row per distinct key: its ids, weights and vectors as three binaries."""
    order = np.lexsort(keys[::-1])
    keys = [k[order] for k in keys]
    cuts = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
    ends = [0, *cuts.tolist(), len(order)] if len(order) else [0]
    runs = list(zip(ends, ends[1:]))
    columns = {n: pa.array([int(k[at]) for at, _ in runs], pa.int64()) for n, k in zip(names, keys)}
    for n, values in (("reps", reps), ("sizes", sizes), ("x", x)):
        columns[n] = pa.array([np.ascontiguousarray(values[order[at:to]]).tobytes() for at, to in runs], pa.binary())
    return as_batch(columns)


def _part(reps: np.ndarray, parts: np.ndarray) -> np.ndarray:
    """Deals vectors evenly to the parts of their cells, by their ids alone."""
    mixed = reps.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)) % parts.astype(np.uint64)).astype(np.int64)


def _compare(cosine: float, width: int, kind: str):
    def unpacked(packs: pd.DataFrame):
        reps, sizes = (np.frombuffer(b"".join(packs[c]), "<i8") for c in ("reps", "sizes"))
        x = np.frombuffer(b"".join(packs["x"]), kind).reshape(-1, width).astype(float)
        return reps, sizes, x, np.sqrt((x * x).sum(axis=1))

    def compare(key, home: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        out = [np.empty((0, 3), np.int64)]
        if len(home) and len(others):
            left, weight, a, long_a = unpacked(home)
            right, heavy, b, long_b = unpacked(others)
            same = len(others["own"]) and bool(others["own"].iloc[0]) and key[1] == key[2]
            sums = np.zeros(len(left), np.int64)
            for at in range(0, len(right), CHUNK):
                to = at + CHUNK
                linked = (a @ b[at:to].T) / (long_a[:, None] * long_b[at:to]) >= cosine
                linked |= left[:, None] == right[at:to]  # a vector is its own neighbour whatever the rounding
                sums += linked @ heavy[at:to]
                if not same:
                    back = weight @ linked
                    some = np.flatnonzero(back)
                    out.append(np.column_stack([right[at:to][some], right[at:to][some], back[some]]))
                edges = np.array([e for e in _stars(linked, left, right[at:to]) if e[0] != e[1]], np.int64).reshape(-1, 2)
                out.append(np.column_stack([edges, np.zeros(len(edges), np.int64)]))
            some = np.flatnonzero(sums)
            out.append(np.column_stack([left[some], left[some], sums[some]]))
        return pd.DataFrame(np.concatenate(out), columns=["x", "y", "links"])

    return compare


def cosine_groups(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95
) -> DataFrame:
    """(vec_id, n_links, component_id): links are pairs of cosine at least ``cosine``.

    Unit vectors are placed in the cell of their nearest pivot. A partner within ``eps`` of x
    lies in another cell only if x is within ``eps`` of the plane between the two pivots and of that
    cell's ball; as this holds for both partners, only the one of the larger cell number is sent, as a
    guest. Each cell compares its home vectors with each other and with its guests, every pair once, in
    packed parts of bounded size, and returns counts of links for both partners and one edge
    per vector reached. Equal vectors are one weighted vector.

    Null, zero and non-finite vectors link with nothing and form groups of their own; rows without
    an id are left out; vectors of other lengths count as padded with zeros; rows of a repeated id
    each count as a vector; other columns are ignored. ``cosine`` must be positive.
    """
    spark = vectors.sparkSession
    clean = F.transform(F.col(vector_col), lambda x: x.cast("double") + F.lit(0.0))
    good = finite(F.col(vector_col)) & F.exists(F.col(vector_col), lambda x: x != 0)
    rows = vectors.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), F.when(F.coalesce(good, F.lit(False)), clean).alias("v")
    )
    points = freeze(
        rows.filter(F.col("v").isNotNull()).groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")), "points"
    )
    facts = points.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    width = max(1, facts[1] or 1)
    eps = float(np.sqrt(max(0.0, 2 - 2 * cosine))) + 1e-7
    centres = pivots(points, min(MOST_PIVOTS, math.isqrt(facts[0]) // ROOT_SHARE + 1), width)
    norms = np.sqrt((centres * centres).sum(axis=1))[:, None]
    centres = np.unique(centres / np.where(norms > 0, norms, 1), axis=0)
    gaps = distances(centres, centres)

    def unit(batch) -> np.ndarray:
        x = matrix(batch.column("v").to_pylist(), width)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        return x / np.sqrt((x * x).sum(axis=1))[:, None]

    def placed(batches):
        for batch in batches:
            away = distances(unit(batch), centres)
            cell = away.argmin(axis=1)
            yield as_batch(
                {"cell": pa.array(cell, pa.int32()), "away": pa.array(away[np.arange(len(cell)), cell]), **{c: batch.column(c) for c in ("rep", "n", "v")}}
            )

    home = freeze(points.mapInArrow(placed, "cell int, away double, rep long, n long, v array<double>"), "homes")
    summary = home.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("r")).collect()
    radius = np.full(len(centres), -np.inf)
    for r in summary:
        radius[r["cell"]] = r["r"]

    def near(batch) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the batch and the cells of smaller number to which they go as guests."""
        away = distances(unit(batch), centres)
        cell = batch.column("cell").to_numpy(zero_copy_only=False)
        own = away[np.arange(len(cell)), cell][:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (away**2 - own**2) / (2 * gaps[cell])
        return np.nonzero((away <= radius + eps) & (plane <= eps) & (np.arange(len(centres)) < cell[:, None]))

    def counted(batches):
        total = np.zeros(len(centres), np.int64)
        for batch in batches:
            total += np.bincount(near(batch)[1], minlength=len(centres))
        to = np.flatnonzero(total)
        yield as_batch({"cell": pa.array(to, pa.int32()), "n": pa.array(total[to])})

    homes = {r["cell"]: r["n"] for r in summary}
    sent = home.mapInArrow(counted, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # a row per cell
    a = parts_of(homes, BLOCK, len(centres))
    b = parts_of({r["cell"]: r["n"] for r in sent}, max(BLOCK, GUEST_CELLS // width), len(centres))
    element = vectors.schema[vector_col].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"

    def packed(guests: bool):
        def run(batches):
            for batch in batches:
                reps, sizes = (batch.column(c).to_numpy(zero_copy_only=False).astype("<i8") for c in ("rep", "n"))
                x = matrix(batch.column("v").to_pylist(), width).astype(kind)
                if guests:
                    row, to = near(batch)
                else:
                    row, to = np.arange(len(reps)), batch.column("cell").to_numpy(zero_copy_only=False)
                # Few targets at a time, so that copies of a batch stay small.
                order = np.argsort(to, kind="stable")
                for at in range(0, len(order), 8 * BLOCK):
                    some = order[at : at + 8 * BLOCK]
                    r, c = row[some], to[some].astype(np.int64)
                    yield _pack([c, _part(reps[r], (b if guests else a)[c])], reps[r], sizes[r], x[r], ["cell", "part"])

        return home.mapInArrow(run, "cell long, part long, reps binary, sizes binary, x binary")

    plan = F.broadcast(
        spark.createDataFrame([(c, int(a[c]), int(b[c])) for c in range(len(centres))], "cell long, a long, b long")
    )
    # Part pairs (i, j): j below a is a home part from i on, the others are guest parts.
    left = packed(False).join(plan, "cell").select("*", F.col("part").alias("i"), F.explode(F.expr("sequence(part, a + b - 1)")).alias("j")).drop("part", "a", "b")
    right_own = packed(False).join(plan, "cell").select("*", F.explode(F.expr("sequence(0L, part)")).alias("i"), F.col("part").alias("j"), F.lit(True).alias("own"))
    right = right_own.drop("part", "a", "b").unionByName(
        packed(True)
        .join(plan, "cell")
        .select("*", F.explode(F.expr("sequence(0L, a - 1)")).alias("i"), (F.col("part") + F.col("a")).alias("j"), F.lit(False).alias("own"))
        .drop("part", "a", "b")
    )
    keys = ["cell", "i", "j"]
    compared = freeze(
        left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_compare(cosine, width, kind), "x long, y long, links long"), "compared"
    )
    links = compared.filter("x = y").groupBy(F.col("x").alias("rep")).agg((F.sum("links") - 1).alias("n_links"))
    groups = components(compared.filter("x != y"), "x", "y")
    named = (
        points.join(links, "rep")
        .join(groups.withColumnRenamed("node", "rep"), "rep", "left")
        .select(F.col("v").alias("pv"), "n_links", F.coalesce("component", "rep").alias("group"))
    )
    found = rows.join(named, rows["v"] == named["pv"], "left")
    return found.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("group", "vec_id").alias("component_id")
    )
