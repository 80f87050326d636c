"""Profile, count and correlation queries."""

from pyspark.sql import functions as F

from sumac.operators import profile as ops
from sumac.plans.registry import query, table
from sumac.plans.tables import (
    FLAGS_SQL,
    HOLED_EVENTS_SQL,
    HOLED_LINES_SQL,
    REPEATED_EVENTS_SQL,
    flagged_lines,
    holed_events,
    holed_lines,
    repeated_events,
    rounded,
)

NUMBERS = ["quantity", "price", "discount"]


def each(columns, select: str, source: str) -> str:
    """The same SELECT once per column, stacked."""
    return " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {select.format(c=c)} FROM {source}" for c in columns)


@query(
    "describe_numeric",
    f"WITH {HOLED_LINES_SQL} "
    + each(
        NUMBERS,
        """count({c}) AS "count", round(CAST(sum(CAST({c} AS DECIMAL(18,2))) AS DOUBLE) / count({c}), 6) AS mean,
        round(stddev_samp({c}), 6) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS p25,
        round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75, max({c}) AS max""",
        "holed",
    ),
)
def describe_numeric(spark, folder):
    return rounded(ops.describe_numeric(holed_lines(spark, folder), NUMBERS), "mean", "std", "p25", "p50", "p75")


@query(
    "describe_categorical",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST(sum(n) AS BIGINT) AS "count", count(*) AS "unique",
        (SELECT v FROM (SELECT {c} AS v, count(*) AS n FROM orders WHERE {c} IS NOT NULL GROUP BY 1) ORDER BY n DESC, v LIMIT 1) AS top,
        max(n) AS freq FROM (SELECT {c} AS v, count(*) AS n FROM orders WHERE {c} IS NOT NULL GROUP BY 1)"""
        for c in ("o_orderstatus", "o_orderpriority")
    ),
)
def describe_categorical(spark, folder):
    return ops.describe_categorical(table(spark, folder, "orders"))


@query(
    "profile_schema",
    " UNION ALL ".join(
        f"""SELECT CAST({i} AS BIGINT) AS position, '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null, count(*) AS rows FROM events"""
        for i, (c, t) in enumerate(
            [
                ("event_id", "bigint"),
                ("ts", "timestamp_ntz"),
                ("user_id", "bigint"),
                ("event_type", "string"),
                ("value", "double"),
                ("props", "string"),
            ]
        )
    ),
)
def profile_schema(spark, folder):
    return ops.profile_schema(table(spark, folder, "events"))


@query("null_counts", f"WITH {HOLED_LINES_SQL} " + each(NUMBERS, "count(*) - count({c}) AS nulls", "holed"))
def null_counts(spark, folder):
    return ops.null_counts(holed_lines(spark, folder), NUMBERS)


@query(
    "value_counts",
    f"""WITH {HOLED_EVENTS_SQL} SELECT event_type AS value, count(*) AS n,
    round_even(count(*) / (SELECT count(*) FROM holed) * 100.0 * 100.0, 0) / 100.0 AS percent FROM holed GROUP BY event_type""",
)
def value_counts(spark, folder):
    return ops.value_counts(holed_events(spark, folder), "event_type")


@query(
    "group_total_share",
    """SELECT o_orderpriority AS value, count(*) AS n,
    round_even(count(*) / (SELECT count(*) FROM orders) * 100.0 * 100.0, 0) / 100.0 AS percent FROM orders GROUP BY 1""",
)
def group_total_share(spark, folder):
    return ops.value_counts(table(spark, folder, "orders"), "o_orderpriority", dropna=True)


_NUNIQUE = ["event_type", "user_id", "value"]


@query("nunique", f"WITH {HOLED_EVENTS_SQL} " + each(_NUNIQUE, "count(DISTINCT {c}) AS n_unique", "holed"))
def nunique(spark, folder):
    return ops.nunique(holed_events(spark, folder), _NUNIQUE)


@query(
    "duplicate_count",
    f"""WITH {REPEATED_EVENTS_SQL} SELECT (SELECT count(*) FROM repeated)
    - (SELECT count(*) FROM (SELECT DISTINCT * FROM repeated)) AS duplicates""",
)
def duplicate_count(spark, folder):
    return ops.duplicate_count(repeated_events(spark, folder))


@query("min_max_table", f"WITH {HOLED_LINES_SQL} " + each(NUMBERS, "min({c}) AS min, max({c}) AS max", "holed"))
def min_max_table(spark, folder):
    return ops.min_max_table(holed_lines(spark, folder), NUMBERS)


def _histogram_sql(columns, bins: int) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", b.bin, lo + (hi - lo) * b.bin / {bins}.0 AS left_edge,
        lo + (hi - lo) * (b.bin + 1) / {bins}.0 AS right_edge, coalesce(n, 0) AS n
        FROM (SELECT min({c}) AS lo, max({c}) AS hi FROM holed) AS r
        CROSS JOIN (SELECT unnest(range({bins})) AS bin) AS b
        LEFT JOIN (SELECT least(CAST(floor(({c} - (SELECT min({c}) FROM holed))
            / (SELECT max({c}) - min({c}) FROM holed) * {bins}) AS BIGINT), {bins - 1}) AS bin, count(*) AS n
            FROM holed WHERE {c} IS NOT NULL GROUP BY 1) AS h ON h.bin = b.bin"""
        for c in columns
    ]
    return " UNION ALL ".join(parts)


@query("histogram", f"WITH {HOLED_LINES_SQL} {_histogram_sql(NUMBERS, 30)}")
def histogram(spark, folder):
    return ops.histogram(holed_lines(spark, folder), NUMBERS, 30)


@query(
    "boxplot_stats",
    f"""WITH {HOLED_LINES_SQL}, q AS ({each(NUMBERS, '''quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
      quantile_cont({c}, 0.75) AS q3''', 'holed')})
    """
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
        min({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
        max({c}) FILTER ({c} BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
        count({c}) FILTER ({c} NOT BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS outliers
        FROM holed, q WHERE q."column" = '{c}'"""
        for c in NUMBERS
    ),
)
def boxplot_stats(spark, folder):
    return rounded(ops.boxplot_stats(holed_lines(spark, folder), NUMBERS), "q1", "median", "q3")


_FLAGS = ["returned", "finished", "discounted"]


@query(
    "binary_table",
    f"WITH {FLAGS_SQL} "
    + each(
        _FLAGS,
        """CAST(count(*) FILTER ({c} = 0) AS BIGINT) AS n_0, CAST(count(*) FILTER ({c} = 1) AS BIGINT) AS n_1,
        count(*) AS n_total, round_even(CAST(count(*) FILTER ({c} = 1) AS DOUBLE) / count(*) * 1000.0, 0) / 1000.0 AS pct_1""",
        "flags",
    ),
)
def binary_table(spark, folder):
    return ops.binary_table(flagged_lines(spark, folder), _FLAGS)


@query(
    "corr_matrix",
    f"WITH {HOLED_LINES_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round({'1.0::DOUBLE' if a == b else f'corr({a}, {b})'}, 6) AS r"
        + (" FROM holed" if a != b else "")
        for a in NUMBERS
        for b in NUMBERS
    ),
)
def corr_matrix(spark, folder):
    return rounded(ops.corr_matrix(holed_lines(spark, folder), NUMBERS), "r")


@query(
    "vif",
    """WITH g AS (SELECT sum(CAST(p_size AS DOUBLE) * p_size) AS aa, sum(p_retailprice * p_retailprice) AS bb,
      sum(p_size * p_retailprice) AS ab FROM part)
    SELECT 'p_size' AS "column", round(aa * bb / (aa * bb - ab * ab), 6) AS vif FROM g
    UNION ALL SELECT 'p_retailprice', round(aa * bb / (aa * bb - ab * ab), 6) FROM g""",
)
def vif(spark, folder):
    return rounded(ops.vif(table(spark, folder, "part"), ["p_size", "p_retailprice"]), "vif")


@query("class_ratio", f"""WITH {FLAGS_SQL} SELECT round(count(*) FILTER (returned = 0) / count(*) FILTER (returned = 1), 9)
    AS ratio FROM flags""")
def class_ratio(spark, folder):
    return rounded(ops.class_ratio(flagged_lines(spark, folder), "returned"), "ratio", digits=9)


@query(
    "balanced_class_weight",
    """WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1)
    SELECT event_type, n, round((SELECT sum(n) / count(*) FROM c) / n, 9) AS weight FROM c""",
)
def balanced_class_weight(spark, folder):
    return rounded(ops.class_weights(table(spark, folder, "events"), "event_type"), "weight", digits=9)


@query(
    "date_range",
    """SELECT strftime(min(o_orderdate), '%Y-%m-%d') AS first_date, strftime(max(o_orderdate), '%Y-%m-%d') AS last_date
    FROM orders""",
)
def date_range(spark, folder):
    from sumac.functions.scalars import parse_day_month_year

    text = table(spark, folder, "orders").select(F.date_format("o_orderdate", "dd/MM/yy").alias("date"))
    found = ops.date_range(text, parse_day_month_year(F.col("date")))
    return found.select(F.col("first_date").cast("string").alias("first_date"), F.col("last_date").cast("string").alias("last_date"))
