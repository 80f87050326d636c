"""Hold-out splits decided per row, for any number of classes and any type of key."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from sumac.functions.scalars import elapsed_micros, seeded_hash
from sumac.operators.ordering import global_rank
from sumac.operators.quantiles import order_statistics
from sumac.session import freeze

#: Rows of one class that may be ordered in one task to find its cut.
CUT_ROWS = 1000


def _ranked(df: DataFrame, key: str, label: str, seed: int) -> tuple[DataFrame, DataFrame]:
    """Rows with ``_rank`` in the order (class, seeded token), and (_class, _start, _n) per class.

    One global order replaces a window per class, so a class with most of the rows is still
    spread over many tasks.
    """
    token = df.withColumn("_token", seeded_hash(F.col(key), seed))
    ranked = global_rank(token, [F.asc_nulls_first(label), "_token", key], "_rank").drop("_token")
    classes = ranked.groupBy(F.col(label).alias("_class")).agg(F.min("_rank").alias("_start"), F.count(F.lit(1)).alias("_n"))
    return ranked, classes


def _quotas(classes: DataFrame, test_fraction: float) -> DataFrame:
    """Adds ``_quota``, the training rows per class: proportional, leftovers to the largest remainders."""
    total = classes.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    wanted = total - math.ceil(test_fraction * total)
    product = F.col("_n").cast("decimal(38,0)") * F.lit(wanted).cast("decimal(19,0)")
    rest = (product % F.lit(max(total, 1))).cast("long")
    shared = classes.withColumns({"_rest": rest, "_quota": F.floor((product - rest) / F.lit(max(total, 1))).cast("long")})
    placed = global_rank(shared, [F.desc("_rest"), F.asc_nulls_first("_class")], "_place")
    left = wanted - placed.agg(F.coalesce(F.sum("_quota"), F.lit(0))).first()[0]
    return placed.withColumn("_quota", F.col("_quota") + (F.col("_place") <= left).cast("long")).drop("_place", "_rest")


def rank_cuts(tokens: DataFrame, wanted: DataFrame) -> DataFrame:
    """(_class, _cut): the (token, key) at position ``_want`` (from 1) of each class.

    ``tokens`` has (_class, _token, _key) with evenly spread hexadecimal tokens, ``wanted`` (_class, _want, _n).
    All classes narrow together: a round counts the next two digits of the tokens that share a class's
    prefix and extends it by the digits in which the position falls. Rows are only counted until
    at most CUT_ROWS of a class are left, which are then ordered.
    """
    state = freeze(wanted.select("_class", F.lit("").alias("_prefix"), F.col("_want").cast("long"), F.col("_n").cast("long")), "cuts")

    def inside(part: DataFrame) -> DataFrame:
        rows = tokens.select(F.col("_class").alias("_c"), "_token", "_key")
        return rows.join(part, F.col("_c").eqNullSafe(F.col("_class")) & F.col("_token").startswith(F.col("_prefix"))).drop("_c")

    for digits in range(0, 30, 2):
        crowded = state.filter(F.col("_n") > CUT_ROWS)
        if crowded.isEmpty():
            break
        bins = inside(crowded).groupBy("_class", "_prefix", "_want", F.substring("_token", digits + 1, 2).alias("_bin")).agg(F.count(F.lit(1)).alias("_in"))
        # At most 256 rows a class.
        upto = F.sum("_in").over(Window.partitionBy("_class").orderBy("_bin")).alias("_upto")
        hit = bins.select("*", upto).filter((F.col("_upto") >= F.col("_want")) & (F.col("_upto") - F.col("_in") < F.col("_want")))
        narrower = hit.select(
            "_class", F.concat("_prefix", "_bin").alias("_prefix"), (F.col("_want") - F.col("_upto") + F.col("_in")).alias("_want"), F.col("_in").alias("_n")
        )
        state = freeze(state.filter(F.col("_n") <= CUT_ROWS).unionByName(narrower), "cuts")
    place = F.row_number().over(Window.partitionBy("_class").orderBy("_token", "_key"))
    return inside(state).withColumn("_place", place).filter("_place = _want").select("_class", F.struct("_token", "_key").alias("_cut"))


def stratified_split(
    df: DataFrame, key: str, label: str, test_fraction: float, seed: int = 42, name: str = "split"
) -> DataFrame:
    """Adds ``train``/``test``; class shares are kept exactly. ``key`` must be unique and not null.

    The training rows of a class are those up to a cut in the order of seeded tokens, so the rows are neither
    sorted nor written: scans of (class, token) count them, one join brings the cuts.
    """
    token = seeded_hash(F.col(key), seed)
    tokens = df.select(F.col(label).alias("_class"), token.alias("_token"), F.col(key).alias("_key"))
    classes = tokens.groupBy("_class").agg(F.count(F.lit(1)).alias("_n"))
    quotas = freeze(_quotas(freeze(classes, "classes"), test_fraction), "quotas")
    divided = quotas.filter("_quota > 0 and _quota < _n").withColumn("_want", F.col("_quota"))
    cuts = rank_cuts(tokens, divided).withColumnRenamed("_class", "_cut_class")
    cuts = quotas.join(cuts, F.col("_class").eqNullSafe(F.col("_cut_class")), "left").drop("_cut_class")
    below = F.struct(token.alias("_token"), F.col(key).alias("_key")) <= F.col("_cut")
    in_train = (F.col("_quota") > 0) & ((F.col("_quota") >= F.col("_n")) | F.coalesce(below, F.lit(False)))
    placed = df.join(cuts, F.col(label).eqNullSafe(F.col("_class")))
    return placed.withColumn(name, F.when(in_train, "train").otherwise("test")).select(*df.columns, name)


def split_rank(df: DataFrame, key: str, label: str, seed: int = 42, name: str = "rank") -> DataFrame:
    """1-based position inside the class, in the seeded order."""
    ranked, classes = _ranked(df, key, label, seed)
    placed = ranked.join(classes, F.col(label).eqNullSafe(F.col("_class")))
    return placed.withColumn(name, F.col("_rank") - F.col("_start") + 1).select(*df.columns, name)


def chronological_split(
    df: DataFrame,
    date: str,
    key: str,
    train_fraction: float = 0.7,
    test_fraction: float = 0.33,
    name: str = "split",
) -> DataFrame:
    """Oldest rows train, the next validate, the newest test; ties follow the key.

    ``test_fraction`` is the share of the rows left after training (rounded up).
    """
    epoch = F.lit("1970-01-01 00:00:00").cast(df.schema[date].dataType)
    when = elapsed_micros(epoch, F.col(date))
    dated = df.filter(F.col(date).isNotNull()).select(when.alias("t"), F.col(key).alias("id"))
    total = dated.count()
    n_train = math.floor(train_fraction * total)
    n_valid = (total - n_train) - math.ceil(test_fraction * (total - n_train))

    # Both cut points are found together: the date at each rank, then the key
    # inside that date up to which its rows still belong to the earlier part.
    ranks = [r for r in (n_train, n_train + n_valid) if r > 0]
    found = order_statistics(dated, {"t": F.col("t")}, [("t", r - 1) for r in ranks], {"t": total})
    cuts = {r: found["t", r - 1] for r in ranks}
    below = [F.count_if(F.col("t") < F.lit(t)).alias(f"below{r}") for r, t in cuts.items()]
    seen = dated.agg(*below).first() if cuts else {}
    last = {}
    for r, t in cuts.items():
        # Only the rows of that one date are ordered by key, whatever its type.
        tied = global_rank(dated.filter(F.col("t") == F.lit(t)), ["id"], "_rank")
        last[r] = tied.filter(F.col("_rank") == r - seen[f"below{r}"]).first()["id"]

    def before(rows: int) -> Column:
        if rows not in cuts:
            return F.lit(False)
        t, key_cut = F.lit(cuts[rows]), F.lit(last[rows])
        return (when < t) | ((when == t) & (F.col(key) <= key_cut))

    first, second = before(n_train), before(n_train + n_valid)
    return df.withColumn(
        name, F.when(F.col(date).isNull(), None).when(first, "train").when(second, "valid").otherwise("test")
    )


