import math

import pytest
from pyspark.sql import functions as F

from millrace.operators import missing as M
from millrace.operators import stats as S
from millrace.plans.inspect import exchanges, plan_text


@pytest.mark.parametrize("layout", [1, 7])
def test_repeated_samples_do_not_depend_on_the_layout(spark, rows, layout):
    df = spark.range(20_000).withColumn("_draw", F.lit("own"))
    found = M.sample_repeated(df.repartition(layout), "id", 0.7, "s")
    assert rows(found) == rows(M.sample_repeated(df, "id", 0.7, "s")) and found.columns == df.columns
    assert exchanges(M.sample_repeated(df, "id", 0.7, "s")) == []
    times = [r["count"] for r in found.groupBy("id").count().collect()]
    # shares of the Poisson distribution, within five deviations
    for k in (1, 2, 3):
        share = math.exp(-0.7) * 0.7 ** k / math.factorial(k)
        assert abs(times.count(k) - 20_000 * share) < 5 * math.sqrt(20_000 * share)
    assert rows(M.sample_repeated(df, "id", 0.7, "other")) != rows(found)


def test_rates():
    for rate in (0.01, 0.7, 5.0, 20.0):
        steps = M.poisson_steps(rate)
        assert steps == sorted(steps) and abs(sum(16 ** 8 - s for s in steps) / 16 ** 8 - rate) < 1e-6


def test_bad_rates_and_null_keys(spark):
    df = spark.createDataFrame([(None,), (1,)], "id long")
    with pytest.raises(ValueError):
        M.sample_repeated(df, "id", 0.0)
    assert M.sample_repeated(df, "id", 20.0).where("id IS NULL").count() == 0
    assert M.sample_exact(df, "id", 5).count() == 1


def test_samples_of_exact_size(spark, rows):
    df = spark.range(5000).select("id", F.when(F.col("id") < 4990, "hot").otherwise("rare").alias("g"))
    found = M.sample_exact(df, "id", 40, ["g"], "s")
    assert [(r.g, r["count"]) for r in found.groupBy("g").count().orderBy("g").collect()] == [("hot", 40), ("rare", 10)]
    assert rows(found) == rows(M.sample_exact(df.repartition(9), "id", 40, ["g"], "s"))
    assert "WindowGroupLimit" in plan_text(found, "simple")
    assert M.sample_exact(df, "id", 40).count() == 40


@pytest.mark.parametrize("support", [0.5, 0.1, 0.02])
def test_bounded_frequent_items_equal_the_exact_ones(spark, rows, support):
    """A hot value, some at the support, very many rare ones, nulls; dealt so that a value may miss tasks."""
    skewed = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 10 < 4, "hot").when(F.col("id") % 50 == 9, "edge").when(F.col("id") % 10 == 8, F.lit(None))
        .otherwise(F.col("id").cast("string")).alias("v"))
    assert rows(S.frequent_items_bounded(skewed, "v", support)) == rows(S.frequent_items(skewed, "v", support))
    ordered = skewed.repartitionByRange(6, "v")
    assert rows(S.frequent_items_bounded(ordered, "v", support)) == rows(S.frequent_items(skewed, "v", support))


def test_bounded_frequent_items_of_nothing(spark):
    assert S.frequent_items_bounded(spark.createDataFrame([], "v int"), "v", 0.1).count() == 0
