"""Connected components of a graph held in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sumac.session import freeze


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node named by an edge.

    Union-find in rounds: every node hooks onto its least neighbour, hooks are
    followed twice, and the graph is contracted along them. The order of nodes is a hash, so
    that chains of ascending ids do not make long hooks. Each round's hooks and edges
    are written tables; a hot node is only ever one side of a join whose other side is
    unique, or the key of a partial minimum. Null ends and loops are ignored.
    """
    spark = edges.sparkSession
    left, right = F.col(a).cast("long"), F.col(b).cast("long")
    edges = edges.select(F.least(left, right).alias("a"), F.greatest(left, right).alias("b"))
    edges = freeze(edges.filter(F.col("a") < F.col("b")).distinct(), "edges")
    hooks: list[DataFrame] = []

    def ranked(name: str):
        return F.struct(F.xxhash64(name).alias("h"), F.col(name).alias("n"))

    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("u"), ranked("b").alias("v")).unionByName(
            edges.select(F.col("b").alias("u"), ranked("a").alias("v"))
        )
        nearest = both.groupBy("u").agg(F.min("v").alias("v"))
        hook = freeze(nearest.select("u", F.least(F.col("v"), ranked("u"))["n"].alias("p")), "hooks")
        up = hook.select(F.col("u").alias("p"), F.col("p").alias("q"))
        hook = freeze(hook.join(up, "p").select("u", F.col("q").alias("p")), "hooks")
        hooks.append(hook)
        ends = edges
        for end in ("a", "b"):
            ends = ends.join(hook.select(F.col("u").alias(end), F.col("p").alias(f"p{end}")), end)
        edges = freeze(
            ends.filter("pa != pb").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "edges"
        )
    if not hooks:
        return spark.createDataFrame([], "node long, component long")
    roots = hooks.pop()
    while hooks:
        above = roots.select(F.col("u").alias("p"), F.col("p").alias("q"))
        roots = freeze(
            hooks.pop().join(above, "p", "left").select("u", F.coalesce("q", "p").alias("p")), "roots"
        )
    least = roots.groupBy("p").agg(F.min("u").alias("component"))
    return roots.join(least, "p").select(F.col("u").alias("node"), "component")
