import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from sumac.functions.scalars import clip, parse_day_month_year, recode, round_even
from sumac.operators import profile
from sumac.operators.customers import lrmfp, visit_gaps


def at(day, hour=0, minute=0):
    return dt.datetime(2024, 3, day, hour, minute)


ROWS = [
    (1, "once", at(5), 10.0),
    (2, "same day", at(5, 8), 1.0),
    (3, "same day", at(5, 20), 2.0),
    (4, "midnight", at(5, 23), 4.0),
    (5, "midnight", at(6, 1), None),
    (6, "steady", at(1), 0.0),
    (7, "steady", at(3), 1.0),
    (8, "steady", at(9, 12), 2.0),
    (9, None, at(9, 12), 2.0),
]


def frame(spark):
    return spark.createDataFrame(ROWS, "id long, who string, day timestamp, amount double")


def test_customer_features(spark):
    out = {r["who"]: r for r in lrmfp(frame(spark), "who", "day", F.col("amount")).collect()}
    assert set(out) == {"once", "same day", "midnight", "steady"}
    assert out["once"][1:] == (0, 5, 10.0, 1, 0.0)
    assert out["same day"][1:] == (0, 4, 1.5, 1, 0.0)
    # 23:00 to 01:00 is less than a day, but two visit dates.
    assert out["midnight"][1:] == (0, 4, 4.0, 2, 0.0)
    gaps = [2, 6]
    assert out["steady"][1:] == (8, 0, 1.0, 3, round(float(np.std(gaps, ddof=1)), 1))


def test_gaps_keep_every_row(spark):
    gaps = {r["id"]: r["gap_days"] for r in visit_gaps(frame(spark), "who", "day", "id").collect()}
    assert gaps == {1: None, 2: None, 3: 0, 4: None, 5: 0, 6: None, 7: 2, 8: 6, 9: None}


def test_short_year_pivot_and_bad_dates(spark):
    df = spark.createDataFrame([("01/02/70",), ("31/12/18",), ("31/02/18",), ("x",), (None,)], "t string")
    got = [r[0] for r in df.select(parse_day_month_year(F.col("t")).cast("string")).collect()]
    assert got == ["1970-02-01", "2018-12-31", None, None, None]


def test_small_scalars(spark):
    df = spark.createDataFrame([(0.125, "a"), (0.375, "b"), (None, None)], "x double, s string")
    rows = df.select(
        round_even(F.col("x"), 2), clip(F.col("x"), 0.2, 0.3), recode(F.col("s"), {"a": 1})
    ).collect()
    assert [tuple(r) for r in rows] == [(0.12, 0.2, 1), (0.38, 0.3, None), (None, None, None)]


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    rows = profile.histogram(df, ["x"], 4).orderBy("bin").collect()
    assert sum(r["n"] for r in rows) == 2 and len(rows) == 4


def test_vif_with_intercept_matches_regression(spark):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=300), rng.normal(size=300)
    c = a + 0.5 * b + rng.normal(size=300) * 0.3
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(a, b, c)], "a double, b double, c double")
    got = {r["column"]: r["vif"] for r in profile.vif(df, ["a", "b", "c"], intercept=True).collect()}
    inverse = np.linalg.inv(np.corrcoef([a, b, c]))
    assert np.allclose([got["a"], got["b"], got["c"]], np.diag(inverse))


def test_mode_prefers_smallest_on_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "s string")
    assert profile.most_frequent(df, ["s"]).first()["top"] == "a"
