import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.functions import nested as N
from millrace.functions import payload as Y
from millrace.functions import text as X
from millrace.functions import udfs as U

URLS = [("/shop/en/item/10092/blue-bolt",), ("/a/b",), ("x/x/x/x/7a",), (None,), ("a/a/a/a/99999999999",)]


def test_ids_agree(spark):
    df = spark.createDataFrame(URLS, "u string")
    U.register_for_sql(spark, "id_of")
    df.createOrReplaceTempView("urls")
    expected = [10092, None, None, None, None]
    for result in (df.select(X.extract_id("u").alias("i")), df.select(U.id_udf()("u").alias("i")),
                   df.select(U.id_pandas_udf()("u").alias("i")), spark.sql("SELECT id_of(u) AS i FROM urls")):
        assert [r.i for r in result.collect()] == expected


def test_pandas_double(spark):
    df = spark.createDataFrame([(0.05,), (None,)], "v double")
    assert [r[0] for r in df.select(U.twice_pandas_udf()("v")).collect()] == [0.1, None]


def test_literal_separator(spark):
    assert spark.createDataFrame([("a.b|c",)], "s string").select(X.split_plain("s", ".")).first()[0] == ["a", "b|c"]


def test_elements(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],)], "a array<string>")
    picked = df.select(X.element("a", 1), X.element("a", 5), X.element("a", -1), X.element("a", -3)).collect()
    assert tuple(picked[0]) == ("b", None, "b", None) and tuple(picked[1]) == (None,) * 4


def test_explode_and_renest(spark, rows):
    df = spark.createDataFrame([(1, "b a  b"), (2, ""), (3, "x\ny")], "id int, t string")
    exploded = X.explode_words(df, ["id"], "t", position="pos")
    assert rows(exploded) == [(1, 0, "b"), (1, 1, "a"), (1, 2, "b"), (3, 0, "x"), (3, 1, "y")]
    assert rows(X.renest_words(exploded, ["id"], "word", "pos", "t")) == [(1, "b a b"), (3, "x y")]
    repeated = X.explode_words(df.union(df), ["id"], "t", position="pos", parent="p")
    assert rows(X.renest_words(repeated, ["id", "p"], "word", "pos", "t"), "id", "t") == [
        (1, "b a b"), (1, "b a b"), (3, "x y"), (3, "x y")]
    kept = X.explode_words(df, ["id"], "t", position="pos", keep_empty=True)
    assert rows(X.renest_words(kept, ["id"], "word", "pos", "t")) == [(1, "b a b"), (2, ""), (3, "x y")]
    assert rows(X.word_frequencies(df, "t")) == [("a", 1), ("b", 2), ("x", 1), ("y", 1)]
    with pytest.raises(AnalysisException):
        df.select(F.explode("t"))


def test_minute_key(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-02 03:04:05' AS t")
    assert df.select(X.time_key("t")).first()[0] == "202401020304"


def test_structs(spark):
    df = spark.createDataFrame([(1, "n", 2.0)], "a int, b string, c double")
    packed = N.nest(df, "p", {"a": "a", "inner": ["b", "c"]})
    assert packed.select("p.inner.c").first()[0] == 2.0
    assert N.flatten(packed, "p.inner").columns == ["b", "c"]


def test_paths(spark):
    df = spark.sql("SELECT array(named_struct('g', named_struct('t', 'P'))) AS f, map('k', 'v') AS m")
    assert df.select(N.at_path("f", 0, "g", "t"), N.at_path("f", 4, "g", "t")).first() == ("P", None)
    assert df.select(N.field_of_each("f", "g", "t")).first()[0] == ["P"]
    assert df.select(N.map_value("m", "k"), N.map_value("m", "x")).first() == ("v", None)


MESSAGE = "lines array<struct<part int, amount float>>, at timestamp, sender string"


def test_payloads(spark, rows):
    messages = ['{"lines":[{"part":1,"amount":0.5},{"part":2,"amount":1}],"at":"2024-01-01T00:00:00Z",'
                '"sender":"ann"}', '{"sender":"bob"}', "broken", '{"lines":[],"sender":"eve"}']
    df = spark.createDataFrame([(bytearray(m, "utf8"),) for m in messages], "value binary")
    items = Y.decode_items(df, MESSAGE, "lines", ["sender", "at"], ["part", "amount"])
    assert rows(items, "sender", "pos", "part", "amount") == [("ann", 0, 1, 0.5), ("ann", 1, 2, 1.0)]
    every = Y.decode_items(df, MESSAGE, "lines", ["sender"], ["part"], keep_empty=True, malformed="bad")
    assert [(r.sender, r.bad, r.pos, r.part) for r in every.collect()] == [
        ("ann", None, 0, 1), ("ann", None, 1, 2), ("bob", None, None, None), (None, "broken", None, None),
        ("eve", None, None, None)]
    assert Y.decode_items(df, MESSAGE, "lines", ["sender"], ["part"], malformed="bad").count() == 3
    parsed = Y.decode_json(df, "sender string, other int")
    assert [r.msg.sender for r in parsed.collect()] == ["ann", "bob", None, "eve"]
    assert all(r.msg.other is None for r in parsed.collect())


def test_encode(spark):
    df = spark.range(1).select(Y.encode_json(F.col("id"), F.lit("x").alias("s")).alias("value"))
    assert bytes(df.first().value) == b'{"id":0,"s":"x"}'


def test_json_array_files_grow_in_number(spark, tmp_path):
    """Each file is one whole array of at most so many documents, whatever a task holds; a task without any writes an empty one."""
    docs = spark.range(0, 23, 1, 2).select(F.struct("id", F.lit("a\nb").alias("t")).alias("d"))
    for n, name in ((23, "all"), (0, "none")):
        path = str(tmp_path / name)
        Y.json_array_files(docs.where(F.col("d.id") < n), "d", path, documents=5)
        found = [json.loads(f.read_text()) for f in (tmp_path / name).glob("part-*")]
        # eleven and twelve documents are dealt to the tasks
        assert sorted(map(len, found)) == ([1, 2, 5, 5, 5, 5] if n else [0] * len(found))
        assert sorted(x["id"] for part in found for x in part) == list(range(n))
    scanned = spark.read.json(str(tmp_path / "all"), multiLine=True)
    assert sorted(r.id for r in scanned.collect()) == list(range(23)) and scanned.where("t = 'a\nb'").count() == 23


def test_words_of_a_task_are_sent_as_texts(spark, rows):
    """One row a text and batch instead of one a word, and the same texts whatever the words and keys are."""
    texts = [(1, "b a b"), (2, None), (3, "x\ty"), (None, "n"), (1, "c d"), (4, "w " * 3_000)]
    exploded = X.explode_words(spark.createDataFrame(texts, "id int, t string").coalesce(1), ["id"], "t", position="pos", parent="p", keep_empty=True)
    assert X.word_runs(exploded, ["id", "p"], "word", "pos").count() == 6
    assert X.renest_words(exploded, ["id", "p"], "word", "pos", "t").where("t = trim(repeat('w ', 3000))").count() == 1
    # words with blanks, empty ones, and positions that repeat or come in any order
    odd = spark.createDataFrame([(1, 1, "b c"), (1, 0, "a"), (1, 2, ""), (1, 2, "d"), (1, 3, "e"), (1, 4, ""), (None, 5, "f"), (1, 5, "g"), (1, 6, None)],
                                "k int, pos int, word string")
    for n in (1, 3):
        assert rows(X.renest_words(odd.repartition(n), ["k"], "word", "pos", "t")) == [(1, "a b c  d e  g"), (None, "f")]
