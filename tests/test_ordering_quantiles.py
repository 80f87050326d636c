import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from sumac.operators.ordering import global_rank, global_running
from sumac.operators.quantiles import exact_quantiles, order_statistics


def test_rank_spreads_a_hot_value(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 11).alias("v"))
    got = {r["id"]: r["rank"] for r in global_rank(df, ["v", "id"]).collect()}
    rows = sorted((r["v"], r["id"]) for r in df.collect())
    assert got == {i: n for n, (_, i) in enumerate(rows, start=1)}


def test_running_values_with_nulls(spark):
    data = [(i, None if i % 5 == 0 else (i * 37) % 101) for i in range(200)]
    df = spark.createDataFrame(data, "id long, v long")
    out = global_running(df, ["id"], {"s": ("sum", "v"), "lo": ("min", "v"), "hi": ("max", "v")})
    seen: list[int] = []
    for row in sorted(out.collect(), key=lambda r: r["id"]):
        seen += [] if row["v"] is None else [row["v"]]
        assert (row["s"], row["lo"], row["hi"]) == ((sum(seen), min(seen), max(seen)) if seen else (None, None, None))


@pytest.mark.parametrize("kind", ["uniform", "ties", "heavy tail"])
def test_narrowed_quantiles_equal_numpy(spark, kind):
    rng = np.random.default_rng(3)
    values = {
        "uniform": rng.uniform(size=5000),
        "ties": np.where(rng.uniform(size=5000) < 0.4, 5.0, rng.integers(0, 9, 5000)).astype(float),
        "heavy tail": np.exp(rng.normal(size=5000) * 20),
    }[kind]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
    probs = [0.0, 0.01, 0.25, 0.4, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(df, ["v"], probs, buffer_rows=20)["v"]
    assert got == pytest.approx(list(np.quantile(values, probs)), rel=1e-12)
    assert exact_quantiles(df, ["v"], probs)["v"] == pytest.approx(got, rel=1e-12)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-3, 3), min_size=1, max_size=40))
def test_order_statistics_property(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    targets = [("v", k) for k in range(len(values))]
    got = order_statistics(df, {"v": F.col("v")}, targets, {"v": len(values)}, buffer_rows=2)
    assert [got[t] for t in targets] == sorted(values)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(df, ["v"], [0.5])["v"] == [None]


def test_top_k_is_trimmed_before_the_shuffle(spark):
    from sumac.operators.neighbours import smallest_per_group

    df = spark.range(100).withColumn("g", F.col("id") % 2)
    plan = smallest_per_group(df, ["g"], ["id"], 3)._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[shuffle:], plan


def test_filters_and_columns_reach_the_scan(spark):
    from sumac.plans.catalogue import QUERIES

    plan = QUERIES["lrmfp"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in plan
    assert "IsNotNull(user_id)" in plan
