from unittest.mock import MagicMock

import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import cluster_builder
from millrace.sources import jdbc, kafka, readers, writers

LETTERS = T.StructType([T.StructField("index", T.ByteType(), False), T.StructField("character", T.StringType(), False)])


def test_rows_without_names(spark):
    df = readers.from_rows(spark, [[1, "a"], [2, "b"]])
    assert df.columns == ["_1", "_2"] and df.count() == 2


def test_rows_with_names(spark):
    assert readers.from_rows(spark, [[1, "a"]], ["n", "c"]).columns == ["n", "c"]


def test_rows_with_schema_fail_fast(spark):
    assert readers.from_rows(spark, [[1, "a"]], LETTERS).schema == LETTERS
    with pytest.raises(Exception):
        readers.from_rows(spark, [[1000, "a"]], LETTERS)
    with pytest.raises(Exception):
        readers.from_rows(spark, [[None, "a"]], LETTERS)


def test_row_objects(spark):
    df = readers.from_rows(spark, [Row(company="x", value=1.5), Row(company="y", value=2.5)])
    first = df.orderBy("company").first()
    assert first.company == "x" and first[1] == 1.5 and first["value"] == 1.5
    assert first.asDict() == {"company": "x", "value": 1.5}


def test_pandas_round_trip(spark):
    frame = pd.DataFrame({"a": [1, 2], "b": ["x", "y"]})
    back = readers.from_pandas(spark, frame).toPandas()
    assert list(back.columns) == ["a", "b"] and back.equals(frame)


def test_pandas_on_spark(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 3.0)], "k string, v double")
    counts = df.pandas_api().k.value_counts().to_pandas()
    assert counts["a"] == 2 and counts["b"] == 1
    assert df.pandas_api().to_spark().count() == 3
    assert df.pandas_api().groupby("k").v.mean().to_pandas()["a"] == 1.5


def test_csv_variants(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("n,t\n1,x\n2,N/A\n")
    plain = readers.csv(spark, str(folder))
    assert plain.columns == ["_c0", "_c1"] and plain.count() == 3
    inferred = readers.csv(spark, str(folder), header=True, infer=True)
    assert dict(inferred.dtypes) == {"n": "int", "t": "string"}
    declared = readers.csv(spark, str(folder), schema="n long, t string", header=True)
    assert declared.agg(F.sum("n")).first()[0] == 3
    with pytest.raises(ValueError):
        readers.csv(spark, str(folder), schema="n long", infer=True)


def test_csv_dialect(spark, tmp_path):
    (tmp_path / "b.csv").write_text("'a\tb'\t1\n'it''s'\t2\n", encoding="utf8")
    df = readers.csv(spark, str(tmp_path / "b.csv"), schema="s string, n int", sep="\t", quote="'", escape="'",
                     encoding="utf8")
    assert sorted(r.s for r in df.collect()) == ["a\tb", "it's"]


def test_reader_is_reusable(spark, small_tables):
    scan = readers.reader(spark, "parquet")
    assert scan.load(f"{small_tables}/region.parquet").count() == 5
    assert scan.load(f"{small_tables}/nation.parquet").count() == 25


def test_multi_line_json(spark, tmp_path):
    (tmp_path / "c.json").write_text('{\n "features": [\n {"geometry": {"type": "Point", "at": [[1.5, 2.5]]}}\n ]\n}')
    df = readers.json(spark, str(tmp_path / "c.json"), multi_line=True)
    assert df.select(F.col("features")[0]["geometry"]["at"][0][1].alias("x")).first().x == 2.5
    assert df.select(F.col("features")["geometry"]["type"].alias("t")).first().t == ["Point"]


def test_sql_on_file_with_options(spark, tmp_path):
    (tmp_path / "d.csv").write_text("n;t\n1;it's\n2;y\n")
    name = readers.view_on_file(spark, "csv", str(tmp_path / "d.csv"),
                                {"header": "true", "inferSchema": "true", "sep": ";"})
    assert spark.sql(f"SELECT sum(n) AS s FROM {name}").first().s == 3
    assert readers.sql_on_file(spark, "csv", str(tmp_path / "d.csv")).count() == 3
    with pytest.raises(ValueError):
        readers.sql_on_file(spark, "csv", "a`b")


def test_catalog(spark):
    name = readers.named_view(spark.range(3).toDF("id"))
    assert spark.table(name).count() == 3
    assert name in [r.tableName for r in readers.catalog_overview(spark).collect()]
    assert spark.catalog.currentDatabase() in [d.name for d in spark.catalog.listDatabases()]


def test_xml(spark, tmp_path):
    (tmp_path / "e.xml").write_text(
        "<reply><book><title>One</title><shelves><shelf name='a' count='3'/><shelf name='b' count='1'/></shelves>"
        "<similar><title>Two</title></similar></book></reply>")
    df = readers.xml(spark, str(tmp_path / "e.xml"), "book")
    shelves = df.select(F.explode("shelves.shelf").alias("s")).select("s._name", "s._count")
    assert sorted(map(tuple, shelves.collect())) == [("a", 3), ("b", 1)]
    assert df.select("similar.title").first()[0] == "Two"


def test_file_sizes_reads_no_content(spark, tmp_path):
    spark.range(100).repartition(4).write.parquet(str(tmp_path / "f"))
    sizes = readers.file_sizes(spark, str(tmp_path / "f")).collect()
    assert len(sizes) == 4 and all(r.length > 0 for r in sizes)


def test_jdbc_ranges():
    assert jdbc.range_options("id", 0, 100, 5) == {
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "5"}
    with pytest.raises(ValueError):
        jdbc.range_options("id", 5, 5, 2)
    with pytest.raises(ValueError):
        jdbc.range_options("id", 0, 5, 0)
    assert "min(id)" in jdbc.bounds_query("t", "id") and "max(id)" in jdbc.bounds_query("t", "id")


def test_jdbc_calls():
    fake = MagicMock()
    jdbc.scan_ranges(fake, "jdbc:x", "t", "id", 4, 0, 100, {"user": "u"})
    given = fake.read.format.return_value.options.call_args.kwargs
    assert given["numPartitions"] == "4" and given["dbtable"] == "t" and given["user"] == "u"
    found = fake.read.jdbc.return_value.agg.return_value.first
    found.return_value = MagicMock(lo=1, hi=9)
    jdbc.scan_ranges(fake, "jdbc:x", "t", "id", 2)
    given = fake.read.format.return_value.options.call_args.kwargs
    assert (given["lowerBound"], given["upperBound"]) == ("1", "9")
    found.return_value = MagicMock(lo=None, hi=None)
    jdbc.scan_ranges(fake, "jdbc:x", "t", "id", 2)
    fake.read.jdbc.assert_called_with("jdbc:x", "t", properties={})
    df = MagicMock()
    jdbc.write(df, "jdbc:x", "t", 3)
    df.repartition.assert_called_with(3)


def test_kafka_calls():
    fake = MagicMock()
    kafka.scan(fake, "h:1", "t")
    kafka.stream(fake, "h:1", "t")
    fake.read.format.assert_called_with("kafka")
    assert fake.readStream.format.return_value.options.call_args.kwargs["subscribe"] == "t"


def test_cluster_settings():
    settings = cluster_builder("app", "s3://shared/work")._options
    assert settings["spark.checkpoint.dir"] == "s3://shared/work" and "spark.master" not in settings


def test_kafka_options(spark):
    assert kafka.options("h:9092", "t", startingOffsets="earliest") == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "t", "startingOffsets": "earliest"}
    with pytest.raises(ValueError):
        kafka.options("", "t")


def test_retrieval(spark):
    df = spark.range(5).toDF("id").orderBy("id")
    assert [r.id for r in df.take(2)] == [0, 1] and df.head().id == 0
    assert df.toPandas().shape == (5, 1)


def test_tables(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id % 2 AS k")
    stored = writers.save_table(df, "numbers_by_k", path=str(tmp_path / "t"), partition_by=["k"])
    assert stored.where("k = 1").count() == 5
    with pytest.raises(ValueError):
        writers.save_table(df, "numbers_bad", buckets=4)
