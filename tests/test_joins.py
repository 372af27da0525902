import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.operators import joins as J
from millrace.operators.layout import partition_report
from millrace.plans.inspect import exchanges, operators, plan_text


@pytest.fixture
def left(spark):
    return spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "k int, v string")


@pytest.fixture
def right(spark):
    return spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (9, "w"), (None, "n")], "k int, v string")


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_semi_and_anti_are_complements(left, right, rows):
    semi, anti = J.semi_join(left, right, ["k"]), J.anti_join(left, right, ["k"])
    assert rows(semi.unionByName(anti)) == rows(left)
    assert rows(semi) == rows(left.join(right.select("k").distinct(), "k").select("k", "v"))
    assert (None, "e") in rows(anti)


def test_shared_names(left, right, rows):
    with pytest.raises(AnalysisException):
        left.join(right, "k").select("v")
    assert J.join_prefixed(left, right, ["k"], "r_").columns == ["k", "v", "r_v"]
    both = J.join_on_condition(left, right, left.k == right.k)
    assert rows(both.select(left.v, right.k))[0] == ("a", 1)


def test_names_must_differ_on_write(left, right, tmp_path):
    with pytest.raises(AnalysisException):
        left.join(right, "k").write.parquet(str(tmp_path / "clash"))


def test_unbound_condition(left, right):
    condition = F.col("k") < F.col("r_k")
    assert J.join_on_condition(left, right.toDF("r_k", "r_v"), condition).count() == 6


@pytest.fixture
def hot(spark):
    """One key holds most of the rows; some keys are NULL."""
    return spark.range(4000).select(
        F.when(F.col("id") < 3000, 7).when(F.col("id") < 3010, F.lit(None)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("n"))


@pytest.fixture
def dimension(spark):
    return spark.range(3500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d")).union(
        spark.createDataFrame([(7, -1), (None, -2)], "k long, d long"))


@pytest.mark.parametrize("how", ["inner", "left", "leftsemi", "leftanti"])
def test_salted_joins_equal_plain_ones(hot, dimension, rows, how):
    expected = rows(hot.join(dimension, "k", how))
    assert rows(J.join_prepartitioned(hot, dimension, "k", 4, how, salts=8, support=0.1)) == expected
    assert rows(J.join_prepartitioned(hot, dimension, "k", 4, how)) == expected
    assert rows(J.join_bucketed(hot, dimension, "k", 4, how, salts=8, support=0.1)) == expected


def test_salts_spread_the_hot_key(hot, dimension):
    salted, repeated = J.salt_sides(hot, dimension, "k", salts=8, support=0.1)
    assert salted.where("k = 7").select("_salt").distinct().count() == 8
    assert salted.where("k <> 7 OR k IS NULL").select("_salt").distinct().count() == 1
    assert repeated.where("k = 7").count() == 16 and repeated.where("k = 8").count() == 1
    largest = partition_report(salted.repartition(16, "k", "_salt")).agg(F.max("rows")).first()[0]
    assert largest < 1500


def test_cells_follow_the_share_of_a_key(spark, rows):
    left = spark.range(0, 9000, 1, 6).select(F.when(F.col("id") < 4500, 7).otherwise(F.col("id")).alias("k"),
                                             F.col("id").alias("v"))
    right = spark.range(9000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    lines, columns = J.grid_by_share(left, right, "k", target_rows=500)
    assert lines.where("k = 7").select("_line").distinct().count() == 9
    report = partition_report(lines.repartition(16, "k", "_line", "_column")).agg(F.max("rows"), F.avg("rows")).first()
    assert report[0] < 4 * report[1] and columns.where("k = 7").count() == 9
    for how in ("inner", "left", "leftsemi", "leftanti"):
        expected = rows(left.join(right, "k", how))
        assert rows(J.join_prepartitioned(left, right, "k", 4, how, target_rows=500)) == expected


@pytest.fixture
def hot_sides(spark):
    """Key 7 holds half of both sides, 8 many rows of the left and few of the right, 9 none of the right; some are NULL."""
    left = spark.range(0, 1600, 1, 5).select(
        F.when(F.col("id") < 800, 7).when(F.col("id") < 1000, 8).when(F.col("id") < 1200, 9).when(F.col("id") < 1210, F.lit(None))
        .otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    right = spark.range(0, 600, 1, 3).select(
        F.when(F.col("id") < 300, 7).when(F.col("id") < 303, 8).when(F.col("id") < 310, F.lit(None))
        .otherwise(F.col("id") + 1000).alias("k"), F.col("id").alias("d"))
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "leftsemi", "leftanti"])
def test_keys_hot_on_both_sides(hot_sides, rows, how):
    left, right = hot_sides
    expected = rows(left.join(right, "k", how))
    # cells smaller than a slot's luck, so that some of a grid's cells are empty on one side
    for target in (100, 3):
        assert rows(J.join_grid(left, right, "k", target, how)) == expected
    assert rows(J.join_prepartitioned(left, right, "k", 4, how, target_rows=100)) == expected
    assert rows(J.join_bucketed(left, right, "k", 4, how, target_rows=100)) == expected


def test_a_cell_bounds_both_sides(hot_sides):
    lines, columns = J.grid_by_share(*hot_sides, "k", target_rows=100)
    sizes = [side.groupBy("k", "_line", "_column").count().agg(F.max("count")).first()[0] for side in (lines, columns)]
    assert max(sizes) < 200
    assert lines.where("k = 7").select("_line", "_column").distinct().count() == 8 * 3
    # repeated as often as the other side has cells, and not where it has one
    assert (lines.where("k = 7").count(), columns.where("k = 7").count()) == (800 * 3, 300 * 8)
    assert (lines.where("k = 8").count(), columns.where("k = 8").count()) == (200, 3 * 2)
    assert lines.where("k IS NULL").count() == 10


def test_repeats_do_not_grow_with_the_pairs(spark):
    """Rows in cells per given row, of one key with very many cells: the same at any size."""
    per_row = []
    for n in (2_000, 20_000):
        left, right = (spark.range(0, size, 1, 4).select(F.lit(7).alias("k"), F.col("id").alias(c)) for c, size in (("v", n), ("d", n // 4)))
        lines, columns = J.grid_by_share(left, right, "k", target_rows=5)
        sizes = [side.groupBy("_line", "_column").count().agg(F.count(F.lit(1)), F.max("count")).first() for side in (lines, columns)]
        assert all(cells > J.REPEATS ** 2 and most < n / J.REPEATS for cells, most in sizes)
        per_row.append((lines.count() + columns.count()) / (n + n // 4))
    assert max(per_row) <= 2 * J.REPEATS and per_row[0] == per_row[1]


@pytest.mark.parametrize("join", [J.join_grid, J.join_prepartitioned])
def test_tasks_follow_the_pairs(spark, join):
    """Few bytes are shuffled here and 300 million pairs come out: they are not left to as many tasks as the bytes need."""
    left, right = (spark.range(0, n, 1, 4).select(F.lit(7).alias("k"), F.col("id").alias(c)) for c, n in (("v", 30_000), ("d", 10_000)))
    report = join(left, right, "k", target_rows=5).groupBy(F.spark_partition_id()).count().agg(F.sum("count"), F.max("count")).first()
    assert report[0] == 30_000 * 10_000 and report[1] < 15_000_000


@pytest.mark.parametrize("own, other", [("timestamp_ntz", "date"), ("date", "timestamp_ntz"), ("int", "bigint")])
def test_keys_of_two_types(spark, rows, no_broadcast, own, other):
    """A date meets a time and an int a bigint without being shuffled a second time; the key keeps the type of the left side."""
    def side(kind, n, name):
        number = F.when(F.col("id") % 7 > 0, F.when(F.col("id") % 2 == 0, 3).otherwise(F.col("id") % 40))
        return spark.range(0, n, 1, 3).select(F.col("id").alias(name), (
            F.date_add(F.lit("1995-01-01").cast("date"), number.cast("int")) if kind in ("date", "timestamp_ntz") else number).cast(kind).alias("k"))
    left, right = side(own, 300, "v"), side(other, 90, "d").withColumn("k", F.when(F.col("d") > 80, None).otherwise(F.col("k")))
    plain, joined = left.join(right, "k", "left"), J.join_bucketed(left, right, "k", 3, "left", target_rows=5)
    assert joined.dtypes == plain.dtypes and rows(joined) == rows(plain) and exchanges(joined) == []
    for how in ("inner", "leftanti"):
        plain, joined = left.join(right, "k", how), J.join_grid(left, right, "k", 5, how)
        assert joined.dtypes == plain.dtypes and rows(joined) == rows(plain)


def test_copies_are_made_by_many_tasks(spark, monkeypatch):
    """A side that one task reads is dealt out before its rows are repeated, so a task's copies do not grow with the table."""
    monkeypatch.setattr(J, "COPIES", 2_000, raising=False)
    left, right = (spark.range(0, n, 1, 1).select(F.lit(7).alias("k"), F.col("id").alias(c)) for c, n in (("v", 3_000), ("d", 1_000)))
    for side in J.grid_by_share(left, right, "k", target_rows=5):
        report = side.groupBy(F.spark_partition_id()).count().agg(F.sum("count"), F.max("count")).first()
        assert report[0] > 20_000 and report[1] < 4_000


def test_buckets_follow_the_pairs(hot_sides, monkeypatch):
    """One task joins a bucket, so pairs that are too many for the given buckets get more of them."""
    monkeypatch.setattr(J, "PAIRS", 2_000)
    left, right = hot_sides
    report = J.join_bucketed(left, right, "k", 2, "left", target_rows=20).groupBy(F.spark_partition_id()).count().agg(
        F.sum("count"), F.max("count")).first()
    assert report[0] == left.join(right, "k", "left").count() and report[1] < report[0] / 5


def test_null_keys_lie_in_many_lines(spark):
    left = spark.range(0, 1000, 1, 2).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("v"))
    right = spark.range(100).select(F.col("id").alias("k"))
    lines, _ = J.grid_by_share(left, right, "k", target_rows=10)
    assert lines.count() == 1000 and lines.select("_line").distinct().count() > 32
    assert J.join_grid(left, right, "k", 10, "left").where("k IS NULL").count() == 1000


def test_the_grid_join_hashes_on_cells(hot_sides, no_broadcast):
    found = exchanges(J.join_grid(*hot_sides, "k", 100))
    assert len(found) == 2 and all("_line" in e and "_column" in e for e in found)


def test_salts_spread_copies_of_one_row(spark, rows):
    copies = spark.range(0, 4000, 1, 8).select(F.lit(7).alias("k"), F.lit("same").alias("v"))
    salted, _ = J.salt_sides(copies, copies.limit(1), "k", salts=4, support=0.1)
    sizes = [r["count"] for r in salted.groupBy("_salt").count().collect()]
    assert sum(sizes) == 4000 and len(sizes) == 4 and max(sizes) <= 1000


def test_hash_skips_maps(spark):
    df = spark.sql("SELECT 7 AS k, map('a', 1) AS m FROM range(10)")
    assert J.join_prepartitioned(df, df.select("k").distinct(), "k", 2, salts=2, support=0.5).count() == 10


def test_salting_needs_a_repeatable_side(left, right):
    for how in ("right", "full"):
        with pytest.raises(ValueError):
            J.join_prepartitioned(left, right, "k", 2, how, salts=4)
        with pytest.raises(ValueError):
            J.join_bucketed(left, right, "k", 2, how, salts=4)


def test_hot_keys(hot):
    assert [r.k for r in J.hot_keys(hot, "k", 0.1).collect()] == [7]


def test_broadcast_only_when_small(spark, left, right, no_broadcast):
    wide = right.toDF("k", "w")
    assert "BroadcastHashJoin" in plan_text(left.join(J.checked_broadcast(wide), "k"))
    assert "BroadcastHashJoin" not in plan_text(left.join(J.checked_broadcast(wide, max_rows=4), "k"))
    assert "BroadcastHashJoin" not in plan_text(left.join(J.checked_broadcast(wide, max_bytes=20), "k"))


def test_large_sides_sort_and_merge(left, right, no_broadcast):
    assert "SortMergeJoin" in operators(J.join_on_keys(left, right.toDF("k", "w"), "k"))


def test_prepartitioned_join_shuffles_once_per_side(spark, no_broadcast):
    a, b = spark.range(100).toDF("k"), spark.range(50).selectExpr("id AS k", "id AS w")
    counted = J.join_prepartitioned(a, b, "k", 4).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    assert len(exchanges(counted)) == 2


def test_bucketed_join_has_no_exchange(spark):
    a, b = spark.range(100).toDF("k"), spark.range(50).selectExpr("id AS k", "id AS w")
    joined = J.join_bucketed(a, b, "k", 4)
    assert exchanges(joined) == [] and "SortMergeJoin" in operators(joined) and joined.count() == 50
