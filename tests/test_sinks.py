import os

import pytest
from pyspark.sql import functions as F

from millrace.operators import layout
from millrace.sources import writers


def _frame(spark):
    return spark.range(100).selectExpr("id", "id % 4 AS k", "id * 2 AS v")


def _files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")]


def test_append_and_dedup(spark, tmp_path):
    path = str(tmp_path / "a")
    for _ in range(4):
        writers.write_parquet(_frame(spark), path, mode="append")
    stored = spark.read.parquet(path)
    assert stored.count() == 400 and stored.dropDuplicates().count() == 100


def test_file_counts(spark, tmp_path):
    writers.write_parquet(_frame(spark).repartition(6), str(tmp_path / "one"), files=1)
    assert len(_files(tmp_path / "one")) == 1
    writers.write_parquet(_frame(spark), str(tmp_path / "keyed"), files=3, distribute_by=["k"], partition_by=["k"])
    assert len(_files(tmp_path / "keyed")) == 4
    writers.write_parquet(_frame(spark).repartition(6), str(tmp_path / "sized"), distribute_by=["k"],
                          partition_by=["k"])
    assert len(_files(tmp_path / "sized")) == 4


def test_static_and_dynamic_replacement(spark, tmp_path):
    path = str(tmp_path / "p")
    df = _frame(spark)
    writers.replace_partitions(df, path, ["k"], dynamic=False)
    writers.replace_partitions(df.where("k = 1").withColumn("v", F.lit(0).cast("long")), path, ["k"])
    stored = spark.read.parquet(path)
    assert stored.count() == 100 and stored.where("k = 1 AND v = 0").count() == 25
    writers.replace_one_partition(df, path, "k", 1)
    assert spark.read.parquet(path).where("k = 1 AND v = 0").count() == 0
    writers.replace_partitions(df.where("k = 1"), path, ["k"], dynamic=False)
    assert spark.read.parquet(path).count() == 25


def test_overwriting_the_input_is_refused(spark, tmp_path):
    path = str(tmp_path / "with space")
    writers.write_parquet(_frame(spark), path)
    stored = spark.read.parquet(path)
    with pytest.raises(ValueError):
        writers.write_parquet(stored.where("k = 0"), path, mode="overwrite")
    with pytest.raises(ValueError):
        writers.replace_partitions(stored, path, ["k"])
    assert spark.read.parquet(path).count() == 100
    writers.write_parquet(stored, path, mode="append")
    assert spark.read.parquet(path).count() == 200


def test_column_names_are_cleaned(spark, tmp_path):
    path = str(tmp_path / "n")
    writers.write_parquet(spark.range(3).toDF("Size(L)"), path, clean_names=True)
    assert spark.read.parquet(path).columns == ["Size"]


def test_csv_header(spark, tmp_path):
    path = str(tmp_path / "c")
    writers.write_csv(_frame(spark), path)
    assert spark.read.csv(path, header=True).columns == ["id", "k", "v"]


def test_compaction(spark, tmp_path):
    small, large = str(tmp_path / "small"), str(tmp_path / "large")
    _frame(spark).repartition(100).write.parquet(small)
    result = layout.compact(spark, small, large, target_bytes=1 << 20)
    assert len(_files(large)) == 1 and result.count() == 100
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, _frame(spark).collect()))


def test_compaction_counts_files_of_any_name(spark, tmp_path):
    small, large = tmp_path / "small", str(tmp_path / "large")
    small.mkdir()
    for i in range(4):
        _frame(spark).toPandas().to_parquet(small / f"orders-{i}.parquet", index=False)
    size = sum(f.stat().st_size for f in small.iterdir())
    assert layout.target_files(spark, str(small), size // 3) >= 3
    assert layout.compact(spark, str(small), large, target_bytes=size).count() == 400
    empty = tmp_path / "empty"
    empty.mkdir()
    with pytest.raises(ValueError, match="no data files"):
        layout.target_files(spark, str(empty), 100)


def test_zorder_ranks_whole_strings(spark):
    df = spark.range(2000).select(F.format_string("Customer#%09d", F.col("id")).alias("s"), F.col("id").alias("n"))
    ranked = layout.with_z_value(df, ["s"], "z", bits=6)
    assert ranked.select("z").distinct().count() > 40
    pairs = ranked.orderBy("s").select("z").collect()
    assert [r.z for r in pairs] == sorted(r.z for r in pairs)
    assert layout.z_bits(100_000, 2) > layout.z_bits(16, 2) > 1


def test_compaction_keeps_folders(spark, tmp_path):
    small, large = str(tmp_path / "small"), str(tmp_path / "large")
    _frame(spark).repartition(20).write.partitionBy("k").parquet(small)
    assert layout.compact(spark, small, large, partition_by=["k"]).count() == 100
    assert len(_files(large)) == 4


def _mean_range(df, column):
    per = df.groupBy(F.spark_partition_id().alias("p")).agg((F.max(column) - F.min(column)).alias("r"))
    return per.agg(F.avg("r")).first()[0]


def test_zorder_narrows_both_columns(spark):
    df = spark.range(20000).select(F.pmod(F.xxhash64("id"), F.lit(1000)).alias("a"),
                                   F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).alias("b"))
    clustered = layout.zorder(df, ["a", "b"], partitions=16)
    assert clustered.count() == 20000 and clustered.columns == ["a", "b"]
    for column in ("a", "b"):
        assert _mean_range(clustered, column) < 0.6 * _mean_range(df.repartition(16), column)


def test_zorder_types_and_single_column(spark):
    df = spark.range(1000).select(F.concat(F.lit("n"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("s"),
                                  F.timestamp_seconds(F.col("id") * 60).alias("t"),
                                  F.when(F.col("id") > 10, F.col("id")).alias("n"))
    assert layout.zorder(df, ["s", "t", "n"], partitions=4).count() == 1000
    single = layout.zorder(df, ["t"], partitions=4)
    assert _mean_range(single.select(F.unix_timestamp("t").alias("u")), "u") < 60 * 400


def test_zorder_spreads_a_hot_value(spark):
    df = spark.range(8000).select(F.when(F.col("id") < 6000, 7).otherwise(F.col("id")).alias("a"), F.lit(1).alias("b"))
    for columns in (["a", "b"], ["a"]):
        report = layout.partition_report(layout.zorder(df, columns, partitions=8))
        assert report.agg(F.max("rows")).first()[0] < 2500


def test_partition_counts(spark):
    df = spark.range(100).repartition(5)
    assert layout.partition_count(df) == 5
    assert layout.partition_report(df).agg(F.sum("rows")).first()[0] == 100


def test_cached(spark):
    df = spark.range(10)
    with layout.cached(df) as kept:
        assert kept.is_cached and kept.count() == 10
    assert not df.is_cached
