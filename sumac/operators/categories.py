"""Categories of any number, kept as a table: codes come by a join, indicators are sparse vectors.

``clean.OneHot`` and ``clean.LabelEncode`` make a column or a literal per category and suit
short lists; here the list may be as long as the data, and nothing of it passes the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import NumericType

from sumac.operators.ordering import global_rank
from sumac.session import freeze


class CategoryTable:
    """``table`` has (column, value, n, code, size): rows per value, its code and the codes of its column.

    Codes count from 0 in the order of the values, numbers by size. Values rarer than ``min_frequency`` times
    the rows share the last code. Null is no category; null and unknown values get the code ``size``.
    """

    def __init__(self, table: DataFrame, columns: Sequence[str]):
        self.table, self.columns = table, list(columns)

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], min_frequency: float = 0.0) -> CategoryTable:
        numbers = {f.name for f in df.schema if isinstance(f.dataType, NumericType)}

        def counted(c: str) -> DataFrame:
            number = F.col(c).cast("double") if c in numbers else F.lit(None).cast("double")
            value = df.select(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), number.alias("number"))
            return value.filter("value IS NOT NULL").groupBy("column", "value", "number").agg(F.count(F.lit(1)).alias("n"))

        rows = df.count() if min_frequency else 0
        counts = reduce(DataFrame.unionByName, map(counted, columns)).withColumn("rare", F.col("n") < F.lit(min_frequency * rows))
        ranked = global_rank(counts, ["column", "rare", F.asc_nulls_first("number"), "value"], "rank")
        kept = F.count_if(~F.col("rare"))
        per_column = ranked.groupBy("column").agg(
            F.min("rank").alias("start"), kept.alias("kept"), (kept + F.max(F.col("rare").cast("int"))).alias("size")
        )
        code = F.least(F.col("rank") - F.col("start"), F.col("kept"))
        table = ranked.join(F.broadcast(per_column), "column")  # a row per column
        return cls(freeze(table.select("column", "value", "n", code.alias("code"), "size"), "categories"), columns)

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, columns: Sequence[str]) -> CategoryTable:
        return cls(spark.read.parquet(path), columns)

    def sizes(self) -> dict[str, int]:
        found = {r["column"]: r["size"] for r in self.table.groupBy("column").agg(F.first("size").alias("size")).collect()}
        return {c: found.get(c, 0) for c in self.columns}

    def encode(self, df: DataFrame) -> DataFrame:
        """Adds ``<column>_code``. The lookup has a row per value, so a hot value only widens its own side."""
        sizes = self.sizes()
        for c in self.columns:
            lookup = self.table.filter(F.col("column") == c).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
            code = F.coalesce("_code", F.lit(sizes[c])).cast("long")
            df = df.join(lookup, F.col(c).cast("string") == F.col("_value"), "left").withColumn(f"{c}_code", code).drop("_value", "_code")
        return df

    def vectors(self, df: DataFrame, output: str = "indicators") -> DataFrame:
        """Adds one sparse vector: for each column in turn a place per code; unknown values leave theirs empty."""
        sizes = {c: n for c, n in self.sizes().items() if n}
        if not sizes:
            raise ValueError("no column has a category")
        out = self.encode(df)
        for c, n in sizes.items():
            # One value more than codes: the encoder gives the last one no place.
            nominal = {"ml_attr": {"type": "nominal", "num_vals": n + 1}}
            out = out.withColumn(f"_code_{c}", F.col(f"{c}_code").cast("double"))
            out = out.withMetadata(f"_code_{c}", nominal)
        codes, hots = [f"_code_{c}" for c in sizes], [f"_hot_{c}" for c in sizes]
        encoder = OneHotEncoder(inputCols=codes, outputCols=hots, dropLast=True).fit(out)
        done = VectorAssembler(inputCols=hots, outputCol=output).transform(encoder.transform(out))
        return done.drop(*codes, *hots)
