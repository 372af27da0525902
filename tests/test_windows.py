import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import windows as W
from millrace.operators.layout import partition_summary


@pytest.fixture
def skewed(spark):
    """A hot group that holds a hot order value, NULL keys, NULL values and NULL order values."""
    return spark.range(3000).select(
        F.when(F.col("id") < 2000, "hot").when(F.col("id") < 2050, F.lit(None)).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 20).cast("string"))).alias("k"),
        F.when(F.col("id") < 700, 5).when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.col("id") % 97).alias("o"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id")).cast("decimal(18,2)").alias("v"),
        "id").repartition(5)


LIMITS = [{"blocks": 13}, {}]


@pytest.mark.parametrize("limits", LIMITS)
def test_running_sum(skewed, rows, limits):
    expected = skewed.withColumn("r", F.sum("v").over(Window.partitionBy("k").orderBy("o")))
    assert rows(W.running_sum(skewed, ["k"], "o", F.col("v"), "r", **limits), "id", "r") == rows(expected, "id", "r")


def test_running_sum_without_values_yet(spark, rows):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 4), ("a", 3, None), ("b", 1, None)], "k string, o int, v int")
    expected = rows(df.withColumn("r", F.sum("v").over(Window.partitionBy("k").orderBy("o"))))
    summed = W.running_sum(df, ["k"], "o", F.col("v"), "r", blocks=3)
    assert rows(summed) == expected


def test_running_sum_has_the_type_of_sum(skewed):
    for blocks in (None, 3):
        assert dict(W.running_sum(skewed, ["k"], "o", F.col("v"), "r", blocks=blocks).dtypes)["r"] == "decimal(28,2)"


@pytest.mark.parametrize("limits", LIMITS)
def test_row_numbers(skewed, rows, limits):
    order = [F.desc("o"), F.asc("id")]
    expected = skewed.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy(*order)).cast("long"))
    assert rows(W.row_numbers(skewed, ["k"], order, "r", **limits), "id", "r") == rows(expected, "id", "r")


def test_row_numbers_over_everything(skewed, rows):
    numbered = W.row_numbers(skewed.select("id"), [], [F.desc("id")], "r", blocks=7)
    assert rows(numbered) == [(i, 3000 - i) for i in range(3000)]


def test_blocks_divide_a_hot_group(skewed):
    blocks = W._in_blocks(skewed, ["k"], [F.asc("o"), F.asc("id")], "test", 10)
    sizes = blocks.where("k = 'hot'").groupBy("_block").count().agg(F.max("count")).first()[0]
    assert sizes < 1000


def test_partition_aggregates(skewed, rows):
    totals = W.partition_aggregates(skewed, (["k"], [F.sum("v").alias("t"), F.count("v").alias("n")]),
                                    (["k", "o"], [F.max("v").alias("m")]))
    expected = skewed.select("*", F.sum("v").over(Window.partitionBy("k")).alias("t"),
                             F.count("v").over(Window.partitionBy("k")).alias("n"),
                             F.max("v").over(Window.partitionBy("k", "o")).alias("m"))
    columns = ["id", "t", "n", "m"]
    assert rows(totals, *columns) == rows(expected, *columns)


def test_totals_need_a_key(skewed):
    with pytest.raises(ValueError):
        W.partition_aggregates(skewed, ([], [F.sum("v").alias("t")]))


def test_group_count(skewed):
    assert W.join_group_count(skewed, ["k"], "n").where("k IS NULL AND n = 50").count() == 50


def test_share_of_total(spark, rows):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 0.0), (None, 2.0)], "k string, v double")
    shares = W.share_of_total(df, ["k"], "v", F.sum("v"), "t", "s")
    assert rows(shares, "k", "s") == [("a", 0.25), ("a", 0.75), ("b", None), (None, 1.0)]


def test_partition_summary(skewed):
    report = partition_summary(skewed).first()
    assert (report.partitions, report.rows) == (5, 3000) and report.least <= 600 <= report.most
