"""A partition tree over points: crowded cells are cut at quantiles, so that every leaf holds few locations wherever the points lie."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sumac.session import freeze, scratch_path

#: Strips a crowded cell is cut into, and cells of a level that are broadcast at most (checked by counting).
WAYS, BROADCAST_CELLS = 8, 100_000


def _small(cells: DataFrame) -> DataFrame:
    return F.broadcast(cells) if cells.count() <= BROADCAST_CELLS else cells


class CellTree:
    """Leaves of at most ``cap`` locations, and the cells of every level as tables.

    ``points`` has one row per distinct location (columns ``axes``, all finite) with ``_w``, its number of rows. A level gives every cell
    its tight box, its rows and its axis of largest extent; cells with more than ``cap`` locations are cut along it at approximate
    quantiles, which are mergeable and of bounded size, so that the root needs no single task. Where ties leave nothing to cut at, the middle of the
    extent is taken, so every cut parts its cell. A cell is named by the strips that lead to it.
    """

    def __init__(self, points: DataFrame, axes: Sequence[str], cap: int):
        self.axes, self.levels, self.spark = list(axes), [], points.sparkSession
        self._path = scratch_path(self.spark, "leaves")
        rest = [c for c in points.columns if c not in axes]
        opened = points.withColumn("_cell", F.lit(""))
        shares = [i / WAYS for i in range(1, WAYS)]
        while True:
            extent = [(F.max(a) - F.min(a)) for a in axes]
            stats = opened.groupBy("_cell").agg(
                F.count(F.lit(1)).alias("_n"),
                F.sum("_w").alias("_rows"),
                *[F.min(a).alias(f"_lo{a}") for a in axes],
                *[F.max(a).alias(f"_hi{a}") for a in axes],
                F.array(*extent).alias("_extent"),
                F.array(*[F.percentile_approx(a, shares, 256) for a in axes]).alias("_quantiles"),
            )
            widest = F.array_position("_extent", F.array_max("_extent")).cast("int")
            stats = stats.withColumn("_axis", widest).withColumns(
                {f"_{n}": F.element_at(F.array(*[F.col(f"_{n}{a}") for a in axes]), F.col("_axis")) for n in ("lo", "hi")}
            )
            middle = F.col("_lo") / 2 + F.col("_hi") / 2
            inside = F.filter(F.element_at("_quantiles", F.col("_axis")), lambda q: q < F.col("_hi"))
            cuts = F.when(F.size(inside) > 0, inside).otherwise(F.array(F.when((middle >= F.col("_lo")) & (middle < F.col("_hi")), middle).otherwise(F.col("_lo"))))
            cells = stats.withColumn("_cuts", cuts).withColumn("_leaf", (F.col("_n") <= cap) | (F.col("_lo") >= F.col("_hi")))
            cells = freeze(cells.drop("_extent", "_quantiles", "_lo", "_hi"), "cells")
            self.levels.append(cells.select("_cell", "_leaf", "_rows", *self._box()))
            known = opened.join(_small(cells.select("_cell", "_leaf", "_axis", "_cuts")), "_cell")
            known.filter("_leaf").select("_cell", *axes, *rest).write.parquet(f"{self._path}/level={len(self.levels)}")
            if cells.filter("not _leaf").isEmpty():
                break
            here = F.element_at(F.array(*axes), F.col("_axis"))
            strip = F.size(F.filter("_cuts", lambda cut: cut < here)).cast("string")
            opened = freeze(known.filter("not _leaf").select(*axes, *rest, F.concat("_cell", strip).alias("_cell")), "opened")
        self.points = self.spark.read.parquet(self._path).select("_cell", *axes, *rest)

    def _box(self) -> list[str]:
        return [f"_{n}{a}" for n in ("lo", "hi") for a in self.axes]

    def _nearest(self, at: Sequence[Column]) -> Column:
        gaps = [F.greatest(F.col(f"_lo{a}") - x, x - F.col(f"_hi{a}"), F.lit(0.0)) for a, x in zip(self.axes, at)]
        return F.sqrt(sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]))

    def _farthest(self, at: Sequence[Column]) -> Column:
        gaps = [F.greatest(F.abs(F.col(f"_lo{a}") - x), F.abs(F.col(f"_hi{a}") - x)) for a, x in zip(self.axes, at)]
        return F.sqrt(sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]))

    def roomy(self, asking: DataFrame, at: Sequence[str], rows: int) -> DataFrame:
        """``asking`` (``at`` and the ``_cell`` of a point) with ``_reach``: the largest distance to the smallest cell around the point that holds ``rows`` rows; to the root's box if none does."""
        above = asking.withColumn("_depth", F.explode(F.expr("sequence(0, length(_cell))"))).withColumn("_above", F.expr("left(_cell, _depth)"))
        boxes = self.levels[0]
        for level in self.levels[1:]:
            boxes = boxes.unionByName(level)
        enough = boxes.filter((F.col("_rows") >= rows) | (F.col("_cell") == "")).withColumnRenamed("_cell", "_above")
        found = above.join(enough, "_above").withColumn("_reach", self._farthest([F.col(c) for c in at]))
        return found.groupBy(*at).agg(F.max_by("_reach", "_depth").alias("_reach"))

    def touched(self, balls: DataFrame, at: Sequence[str]) -> DataFrame:
        """(``at``, _reach, _cell): the leaves whose boxes the balls (centre ``at``, radius ``_reach``) touch, by descent from the root, one join per level."""
        out, front = None, balls.select(*at, "_reach", F.lit("").alias("_parent"))
        for depth, level in enumerate(self.levels):
            children = _small(level).withColumn("_parent", F.expr(f"left(_cell, {max(0, depth - 1)})"))
            met = front.join(children, "_parent").filter(self._nearest([F.col(c) for c in at]) <= F.col("_reach") * (1 + 1e-12))
            found = met.filter("_leaf").select(*at, "_reach", "_cell")
            out = found if out is None else out.unionByName(found)
            front = met.filter("not _leaf").select(*at, "_reach", F.col("_cell").alias("_parent"))
        return out
