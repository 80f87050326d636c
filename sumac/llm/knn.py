"""Exact top-k inner products as a Voronoi join."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from sumac.llm.texts import as_batch
from sumac.llm.vectors import distances, finite, matrix, parts_of, pivots
from sumac.session import freeze

#: Pivots at most, rows of a data block, and queries that meet it in one task.
MOST_PIVOTS, BLOCK, QUERIES = 2048, 4096, 4096


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer products; doubles hold them unless components are huge."""
    bound = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1]
    return (q @ x.T).astype(np.int64) if bound < 2**53 else q.astype(np.int64) @ x.astype(np.int64).T


def _solve(k: int, width: int):
    def solve(queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(data):
            data = data.sort_values("vec_id")
            ids, x = data["vec_id"].to_numpy(), matrix(data["v"], width)
            keep = min(k + 1, len(ids))
            for at in range(0, len(queries), 256):
                part = queries.iloc[at : at + 256]
                scores = _products(matrix(part["v"], width), x)
                least = np.partition(scores, len(ids) - keep, axis=1)[:, len(ids) - keep]
                for query, row, low in zip(part["query_id"].tolist(), scores, least):
                    near = np.flatnonzero((row >= low) & (ids != query))
                    near = near[np.argsort(-row[near], kind="stable")[:k]]
                    out.append((np.full(len(near), query), ids[near], row[near]))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 3
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))

    return solve


def top_inner_products(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` largest inner products with other rows.

    ``vectors`` has ``vec_id`` and integer components ``v``; ``is_query`` is an expression over
    vec_id. Data form Voronoi cells of at most MOST_PIVOTS pivots, each
    summed up by its count and radius. A query's first cells are those of largest
    products with their pivots; their k-th score then bounds what other cells
    must reach, first for the queries of one cell together, then for each, and only the query
    and cell pairs that can still matter are formed. Cells are cut in blocks of bounded size. Of equal
    vectors only the k + 1 smallest ids can be answers, so copies never crowd a cell.

    Null vectors or ids and null components take no part; repeated rows count once; shorter
    vectors count as padded with zeros; ties go to the smaller vec_id; other columns are ignored.
    """
    spark = vectors.sparkSession
    good = vectors.filter(F.col("vec_id").isNotNull() & finite(F.col("v")))
    rows = freeze(good.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("v").cast("array<bigint>").alias("v")).distinct(), "vectors")
    same = Window.partitionBy("v").orderBy("vec_id")
    data = freeze(rows.withColumn("_n", F.row_number().over(same)).filter(F.col("_n") <= k + 1).drop("_n"), "data")
    facts = data.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not facts[0]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    width = max(1, facts[1])
    centres = pivots(data, min(MOST_PIVOTS, math.isqrt(facts[0]) // 2 + 1), width)
    lengths = np.sqrt((centres * centres).sum(axis=1))

    def assign(batches):
        for batch in batches:
            lists = batch.column("v").to_pylist()
            away = distances(matrix(lists, width), centres)
            cell = away.argmin(axis=1)
            yield as_batch(
                {
                    "cell": pa.array(cell, pa.int32()),
                    "away": pa.array(away[np.arange(len(cell)), cell] * (1 + 1e-9) + 1e-6),
                    "vec_id": batch.column("vec_id"),
                    "v": batch.column("v"),
                }
            )

    shape = "cell int, away double, vec_id long, v array<bigint>"
    placed = freeze(data.mapInArrow(assign, shape), "cells")
    summary = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("r")).collect()
    counts = {r["cell"]: r["n"] for r in summary}
    sizes = np.array([counts.get(c, 0) for c in range(len(centres))])
    radius = np.full(len(centres), -np.inf)
    for r in summary:
        radius[r["cell"]] = r["r"]
    blocks = parts_of(counts, BLOCK, len(centres))

    def first_cells(batches):
        for batch in batches:
            q = matrix(batch.column("v").to_pylist(), width)
            order = np.argsort(-np.where(sizes > 0, q @ centres.T, -np.inf), axis=1, kind="stable")
            enough = np.minimum((np.cumsum(sizes[order], axis=1) < k + 1).sum(axis=1) + 1, int((sizes > 0).sum()))
            row = np.repeat(np.arange(len(q)), enough)
            cell = np.concatenate([o[:n] for o, n in zip(order, enough)]) if len(q) else np.empty(0, np.int64)
            yield as_batch({"query_id": batch.column("vec_id").take(pa.array(row)), "v": batch.column("v").take(pa.array(row)), "cell": pa.array(cell, pa.int32())})

    def solved(pairs: DataFrame) -> DataFrame:
        asked = {r["cell"]: r["count"] for r in pairs.groupBy("cell").count().collect()}
        turns = parts_of(asked, QUERIES, len(centres))
        plan = spark.createDataFrame([(c, int(blocks[c]), int(turns[c])) for c in asked], "cell int, blocks long, turns long")
        plan = F.broadcast(plan)  # at most MOST_PIVOTS rows
        left = pairs.join(plan, "cell").select(
            "cell", "query_id", "v", F.pmod(F.xxhash64("query_id"), F.col("turns")).alias("turn"), F.explode(F.expr("sequence(0, blocks - 1)")).alias("block")
        )
        right = placed.join(plan, "cell").select(
            "cell", "vec_id", "v", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).alias("block"), F.explode(F.expr("sequence(0, turns - 1)")).alias("turn")
        )
        keys = ["cell", "block", "turn"]
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_solve(k, width), "query_id long, vec_id long, score long")

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    asked = rows.filter(is_query)
    pairs = freeze(asked.mapInArrow(first_cells, "query_id long, v array<bigint>, cell int"), "pairs")
    near = freeze(solved(pairs).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k), "near")
    bounds = near.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("least"))
    done = pairs.groupBy("query_id").agg(F.collect_set("cell").alias("done"))  # at most MOST_PIVOTS cells
    queries = asked.withColumnRenamed("vec_id", "query_id").join(bounds, "query_id", "left").join(done, "query_id")

    def other_cells(batches):
        for batch in batches:
            q = matrix(batch.column("v").to_pylist(), width)
            least = np.array([-np.inf if x is None else float(x) for x in batch.column("least").to_pylist()])
            home = distances(q, centres).argmin(axis=1)
            rows_, cells_ = [], []
            for group in np.unique(home):
                own = np.flatnonzero(home == group)
                centre, reach = centres[group], distances(q[own], centres[group][None]).max() * (1 + 1e-9) + 1e-6
                # What any query of the group can reach in a cell, from the two summaries alone.
                most = centres @ centre + reach * lengths + (lengths[group] + reach) * radius
                cells = np.flatnonzero((sizes > 0) & (most >= least[own].min()))
                own_most = q[own] @ centres[cells].T + np.sqrt((q[own] ** 2).sum(axis=1))[:, None] * radius[cells]
                r, c = np.nonzero(own_most * (1 + 1e-9) + 1e-6 >= least[own][:, None])
                rows_.append(own[r])
                cells_.append(cells[c])
            row, cell = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (rows_, cells_))
            known = batch.column("done").to_pylist()
            seen = [set(d) for d in known]
            new = np.array([c not in seen[r] for r, c in zip(row.tolist(), cell.tolist())], bool)
            row, cell = row[new], cell[new]
            yield as_batch({"query_id": batch.column("query_id").take(pa.array(row)), "v": batch.column("v").take(pa.array(row)), "cell": pa.array(cell, pa.int32())})

    more = freeze(queries.mapInArrow(other_cells, "query_id long, v array<bigint>, cell int"), "more")
    both = near.drop("rank").unionByName(solved(more))
    return both.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
