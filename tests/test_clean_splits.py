import math
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from sumac.operators import clean, splits
from sumac.operators.categories import CategoryTable
from sumac.session import scratch_path


def column(df, name="x"):
    return [r[name] for r in df.collect()]


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


def test_masks_keep_rows(spark):
    df = frame(spark, [1.0, 2.0, 3.0, 4.0, 100.0, None])
    out = column(clean.IqrMask(["x"], reach=1.5).fit(df).transform(df))
    assert out == [1.0, 2.0, 3.0, 4.0, None, None]


def test_imputers_treat_nan_as_missing(spark):
    df = frame(spark, [1.0, 2.0, 6.0, None, float("nan")])
    assert column(clean.ImputeMean(["x"]).fit(df).transform(df)) == [1, 2, 6, 3, 3]
    assert column(clean.ImputeMedian(["x"]).fit(df).transform(df)) == [1, 2, 6, 2, 2]


def test_scalers_on_constants_and_nulls(spark):
    df = frame(spark, [4.0, 4.0, None])
    for step in (clean.ScaleMinMax, clean.ScaleStandard, clean.ScaleRobust):
        assert column(step(["x"]).fit(df).transform(df)) == [0.0, 0.0, None]


def test_standard_scaling_uses_population_deviation(spark):
    df = frame(spark, [0.0, 2.0])
    assert column(clean.ScaleStandard(["x"]).fit(df).transform(df)) == [-1.0, 1.0]


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=30))
def test_minmax_range_and_winsorize_is_stable(spark, values):
    df = frame(spark, values)
    scaled = column(clean.ScaleMinMax(["x"]).fit(df).transform(df))
    assert all(0 <= v <= 1 for v in scaled)
    fitted = clean.Winsorize(["x"], 0.1, 0.9).fit(df)
    once = fitted.transform(df)
    assert column(fitted.transform(once)) == column(once)


def test_unseen_categories(spark):
    train = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    new = spark.createDataFrame([("b",), ("z",), (None,)], "s string")
    assert [tuple(r) for r in clean.OneHot(["s"]).fit(train).transform(new).collect()] == [(0, 1), (0, 0), (0, 0)]
    ordered = clean.OrdinalEncode(["s"], order=["b", "a"]).fit(train).transform(new)
    assert [r["s"] for r in ordered.collect()] == [0, -1, -1]
    labels = clean.LabelEncode(["s"]).fit(train)
    assert [r["s"] for r in clean.decode(labels.transform(new), labels, "s").collect()] == ["b", None, None]


def test_rare_categories_share_a_column(spark):
    df = spark.createDataFrame([(v,) for v in "aaaaabbbbc"], "s string")
    out = clean.OneHot(["s"], min_frequency=0.2).fit(df).transform(df)
    assert out.columns == ["s_a", "s_b", "s_infrequent"]
    assert out.agg(F.sum("s_infrequent")).first()[0] == 1


def test_saved_steps_give_the_same_result(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (9.0, None)], "x double, s string")
    steps = Pipeline(
        stages=[
            clean.IqrMask(["x"]),
            clean.ImputeMedian(["x"]),
            clean.Log1p(["x"]),
            clean.ScaleStandard(["x"]),
            clean.ImputeMode(["s"]),
            clean.OneHot(["s"]),
        ]
    )
    model = steps.fit(df)
    path = tempfile.mkdtemp() + "/m"
    model.write().save(path)
    assert PipelineModel.load(path).transform(df).collect() == model.transform(df).collect()


def _train_quotas(counts, test_fraction):
    """Largest remainders, by hand."""
    total = sum(counts.values())
    wanted = total - math.ceil(test_fraction * total)
    quotas = {c: n * wanted // total for c, n in counts.items()}
    order = sorted(counts, key=lambda c: (-(counts[c] * wanted % total), c))
    for c in order[: wanted - sum(quotas.values())]:
        quotas[c] += 1
    return quotas


@pytest.mark.parametrize("sizes", [(10, 5), (70, 29, 1), (1, 1), (400, 3)])
def test_stratified_split_quotas(spark, sizes):
    rows = [(i, f"c{c}") for c, n in enumerate(sizes) for i in range(1000 * c, 1000 * c + n)]
    df = spark.createDataFrame(rows, "id long, y string")
    out = splits.stratified_split(df, "id", "y", 0.3)
    got = {(r["y"], r["split"]): r["n"] for r in out.groupBy("y", "split").agg(F.count("*").alias("n")).collect()}
    quotas = _train_quotas({f"c{c}": n for c, n in enumerate(sizes)}, 0.3)
    assert sum(quotas.values()) == sum(sizes) - -(-3 * sum(sizes) // 10)
    for y, q in quotas.items():
        assert got.get((y, "train"), 0) == q
    assert out.count() == sum(sizes)


def test_one_class_splits_in_half(spark):
    df = spark.range(500).withColumn("y", F.lit(1))
    out = splits.stratified_split(df, "id", "y", 0.5)
    assert out.filter("split = 'train'").count() == 250


def test_chronological_split_with_one_hot_day(spark):
    rows = [(i, f"2024-01-{1 + (i > 20):02d} 00:00:00") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    out = splits.chronological_split(df, "t", "id").orderBy("t", "id").collect()
    # 70% of 60, then 33% of the remaining 18 rounded up.
    assert [r["split"] for r in out] == ["train"] * 42 + ["valid"] * 12 + ["test"] * 6


def test_split_of_thousands_of_classes(spark):
    df = spark.range(6000).select("id", (F.col("id") % 2000).alias("y"))
    out = splits.stratified_split(df, "id", "y", 1 / 3)
    rows = out.groupBy("y").pivot("split", ["train", "test"]).count().groupBy("train", "test").count().collect()
    assert [tuple(r) for r in rows] == [(2, 1, 2000)]
    ranks = splits.split_rank(df, "id", "y").groupBy("y").agg(F.sort_array(F.collect_list("rank")).alias("r"))
    assert [r["r"] for r in ranks.select("r").distinct().collect()] == [[1, 2, 3]]


def test_chronological_split_orders_text_keys_of_one_date(spark):
    df = spark.range(60_000).select(F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("id"), F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("t"))
    ends = splits.chronological_split(df, "t", "id").groupBy("split").agg(F.count(F.lit(1)), F.min("id"), F.max("id")).collect()
    assert sorted(tuple(r) for r in ends) == [
        ("test", 5940, "k054060", "k059999"),
        ("train", 42000, "k000000", "k041999"),
        ("valid", 12060, "k042000", "k054059"),
    ]


@pytest.mark.parametrize("most", [3, 1000])
def test_cuts_narrow_to_the_seeded_order(spark, monkeypatch, most):
    monkeypatch.setattr(splits, "CUT_ROWS", most)
    classes = [None] * 700 + ["a"] * 40 + ["b"] * 2 + ["c"]
    df = spark.createDataFrame([(i, y, "own") for i, y in enumerate(classes)], "id long, y string, n string")
    out = splits.stratified_split(df, "id", "y", 0.25)
    ranked = {r["id"]: r["rank"] for r in splits.split_rank(df, "id", "y").collect()}
    rows = out.collect()
    assert out.columns == ["id", "y", "n", "split"] and sorted(r["id"] for r in rows) == list(range(len(classes)))
    for y in set(classes):
        train = sorted(ranked[r["id"]] for r in rows if r["y"] == y and r["split"] == "train")
        assert train == list(range(1, len(train) + 1))
    assert sum(r["split"] == "train" for r in rows) == len(classes) - math.ceil(0.25 * len(classes))
    assert splits.stratified_split(df.limit(0), "id", "y", 0.25).count() == 0


def test_category_table(spark):
    rows = [(1, 10, "x"), (2, 9, "y"), (3, None, "x"), (4, 9, None), (5, 100, "x"), (6, 9, "z")]
    df = spark.createDataFrame(rows, "id long, number int, word string")
    found = CategoryTable.fit(df, ["number", "word"], min_frequency=0.3)
    # Numbers 10 and 100 and words y and z are rare and share the code behind the frequent ones.
    assert found.sizes() == {"number": 2, "word": 2}
    path = scratch_path(spark, "categories")
    found.save(path)
    found = CategoryTable.load(spark, path, ["number", "word"])
    other = df.unionByName(spark.createDataFrame([(7, 11, "w")], df.schema))
    out = {r["id"]: r for r in found.vectors(other).collect()}
    assert [(out[i]["number_code"], out[i]["word_code"]) for i in range(1, 8)] == [(1, 0), (0, 1), (2, 0), (0, 2), (1, 0), (0, 1), (2, 2)]
    assert [list(map(int, out[i]["indicators"].indices)) if hasattr(out[i]["indicators"], "indices") else out[i]["indicators"].toArray().tolist() for i in (7,)] == [[]]
    assert out[1]["indicators"].toArray().tolist() == [0, 1, 1, 0] and out[4]["indicators"].toArray().tolist() == [1, 0, 0, 0]
    every = CategoryTable.fit(df, ["number"]).table.orderBy("code").collect()
    assert [(r["value"], r["n"], r["code"], r["size"]) for r in every] == [("9", 3, 0, 3), ("10", 1, 1, 3), ("100", 1, 2, 3)]
    nothing = CategoryTable.fit(df.limit(0), ["word"])
    assert nothing.sizes() == {"word": 0} and {r["word_code"] for r in nothing.encode(df).collect()} == {0}


def test_hundred_thousand_categories(spark):
    df = spark.range(100_000).select("id", F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("v"))
    found = CategoryTable.fit(df, ["v"])
    assert found.encode(df).filter(F.col("v_code") != F.col("id")).isEmpty()
    assert [(v.size, list(v.indices)) for (v,) in found.vectors(df.filter("id IN (0, 99999)")).orderBy("id").select("indicators").collect()] == [
        (100_000, [0]),
        (100_000, [99_999]),
    ]
