import os

import pytest
from pyspark.sql import functions as F

from millrace.operators import layout as L
from millrace.plans import REGISTRY, storing
from millrace.sources import file_table as T


@pytest.fixture
def table(spark, tmp_path):
    """Two partitions with a large file each and six small ones from two appends; one value has blanks."""
    path = str(tmp_path / "table")
    rows = spark.range(40_000).select("id", F.xxhash64("id").alias("v"), F.when(F.col("id") % 2 == 0, "a b").otherwise("c").alias("p"))
    T.append(rows.where("id < 30000").coalesce(1), path, ["p"])
    T.append(rows.where("id BETWEEN 30000 AND 34999").repartition(3), path)
    T.append(rows.where("id >= 35000").repartition(3), path)
    return path


def _bytes(frame):
    return {r.path: r.bytes for r in frame.collect()}


def test_only_small_files_are_rewritten(spark, table, rows):
    before, old = rows(T.read(spark, table)), _bytes(T.manifest(spark, table))
    small = {p: b for p, b in old.items() if b < 50_000}
    assert (len(old), len(small)) == (14, 12)
    version = T.compact(spark, table, target_bytes=100_000, small=0.5)
    new = _bytes(T.manifest(spark, table))
    assert version == 3 and rows(T.read(spark, table)) == before
    # the large files are the same files, the small ones are gone from the list
    assert {p for p in old if p not in small} == {p for p in new if p in old}
    written = {p: b for p, b in new.items() if p not in old}
    assert 2 <= len(written) < len(small) and max(written.values()) < 200_000
    assert {p.split("/run=3/")[1].split("/")[0] for p in written} == {"p=a b", "p=c"}
    # nothing is left to do
    assert T.compact(spark, table, target_bytes=100_000, small=0.1) is None


def test_what_is_read_and_sent_is_the_small_files(spark, table):
    listed = T.manifest(spark, table)
    small = listed.where("bytes < 50000").collect()
    files = T._scan(spark, table, [r.path for r in small], small[0].schema)
    assert files.count() == 10_000 and len(files.inputFiles()) == 12


def test_readers_of_older_versions_are_unharmed(spark, table, rows):
    reading = T.read(spark, table)
    counts = [T.read(spark, table, v).count() for v in T.versions(spark, table)]
    T.compact(spark, table, target_bytes=100_000)
    assert counts == [30_000, 35_000, 40_000]
    assert [T.read(spark, table, v).count() for v in T.versions(spark, table)] == [*counts, 40_000]
    assert reading.count() == 40_000 and T.read(spark, table).columns == ["id", "v", "p"]


def test_a_version_without_its_marker_does_not_count(spark, table):
    last = T.versions(spark, table)[-1]
    os.rename(f"{table}/manifests/version={last}/_SUCCESS", f"{table}/manifests/version={last}/gone")
    assert T.versions(spark, table)[-1] == last - 1 and T.read(spark, table).count() == 35_000


def test_another_schema_is_refused(spark, table):
    with pytest.raises(ValueError, match="schema"):
        T.append(spark.range(3), table)


@pytest.fixture
def clustered(spark, tmp_path):
    # a path that a URI spells otherwise
    path, index = str(tmp_path / "some lines+"), str(tmp_path / "index")
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select("l_orderkey", "l_partkey", "l_suppkey")
    L.zorder(lines, ["l_partkey", "l_suppkey"], partitions=64).write.parquet(path)
    L.write_file_index(spark, path, ["l_partkey", "l_suppkey"], index)
    return lines, path, index


def test_a_range_opens_few_files_and_loses_no_row(spark, clustered, rows):
    lines, path, index = clustered
    ranges = {"l_partkey": (100, 400), "l_suppkey": (10, 30)}
    expected = lines.where("l_partkey BETWEEN 100 AND 400 AND l_suppkey BETWEEN 10 AND 30")
    assert rows(L.scan_range(spark, path, index, ranges)) == rows(expected)
    opened, all_files = L.files_in_range(spark, path, index, ranges)
    # the ranges hold 3 % of the rows
    assert all_files >= 60 and len(opened) <= 0.2 * all_files
    assert len(L.scan_range(spark, path, index, ranges).inputFiles()) == len(opened)
    assert L.scan_range(spark, path, index, {"l_partkey": (-9, -1)}).count() == 0


def test_files_newer_than_the_index_are_read(spark, clustered):
    lines, path, index = clustered
    lines.limit(50).withColumn("l_partkey", F.lit(-5).cast(lines.schema["l_partkey"].dataType)).write.mode("append").parquet(path)
    assert L.scan_range(spark, path, index, {"l_partkey": (-9, -1)}).count() == 50


def test_nulls_have_no_bounds(spark, tmp_path):
    path, index = str(tmp_path / "some"), str(tmp_path / "some-index")
    spark.createDataFrame([(None, 1), (None, 2)], "a int, b int").coalesce(1).write.parquet(path)
    found = L.write_file_index(spark, path, ["a"], index).first()
    assert (found._rows, found.nulls_a, found.low_a) == (2, 2, None)
    assert L.files_in_range(spark, path, index, {"a": (0, 9)}) == ([], 1)
    assert L.scan_range(spark, path, index, {"a": (0, 9)}).count() == 0


def test_the_first_files_are_written_by_as_many_tasks_as_the_table_needs(spark, tmp_path, rows, monkeypatch):
    folder, path = str(tmp_path), str(tmp_path / "stored")
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    orders.repartition(5).write.parquet(f"{folder}/orders.parquet")
    monkeypatch.setattr(storing, "new_path", lambda spark, label: path)
    found = REGISTRY["compact_incremental"].run(spark, folder)
    first = T.manifest(spark, path, 0).groupBy("folder").count().collect()
    assert max(r["count"] for r in first) == 5
    # and the small ones are merged
    assert T.versions(spark, path) == [0, 1, 2] and T.manifest(spark, path, 2).count() < T.manifest(spark, path, 1).count()
    assert rows(found) == rows(orders.select(found.columns))


def test_one_large_row_group_is_written_by_several_tasks(spark, tmp_path):
    """A scan gives a row group to one task, which would sort all its rows for the partitions."""
    rows = spark.range(0, 1_000_000, 1, 1).selectExpr("cast(id as int) AS o_orderkey", "cast(200000 + id % 7 as decimal(15, 2)) AS o_totalprice",
                                                      "'F' AS o_orderstatus")
    rows.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    found = REGISTRY["compact_incremental"].run(spark, str(tmp_path))
    per_file = [r["count"] for r in found.groupBy(F.input_file_name()).count().collect()]
    assert sum(per_file) == 1_000_000 and max(per_file) < 400_000
    assert found.agg(F.count_distinct("o_orderkey")).first()[0] == 1_000_000
