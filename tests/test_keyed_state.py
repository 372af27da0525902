from pathlib import Path

import pytest

from millrace.streaming import keyed as K

COLUMNS = "k int, v string"


def _frame(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def _written(path, number):
    return {p.name for p in Path(path, "data", f"_batch={number}").glob("_bucket=*")}


def test_only_touched_buckets_are_written(spark, tmp_path, rows):
    path = str(tmp_path / "state")
    K.upsert_batch(_frame(spark, [(k, "first") for k in range(200)] + [(None, "none")]), 0, path, ["k"], buckets=16)
    assert len(_written(path, 0)) == 16
    K.upsert_batch(_frame(spark, [(7, "second"), (7, "second"), (None, "other")]), 1, path, ["k"], buckets=16)
    # two keys lie in two buckets at most
    assert 1 <= len(_written(path, 1)) <= 2
    expected = {k: "first" for k in range(200)} | {7: "second", None: "other"}
    assert {r.k: r.v for r in K.read_keyed_state(spark, path).collect()} == expected
    assert K.read_keyed_state(spark, path).count() == 201


def test_a_repeated_batch_changes_nothing(spark, tmp_path, rows):
    path = str(tmp_path / "state")
    for number, batch in enumerate([[(1, "a"), (2, "b")], [(2, "B"), (3, "c")], [(1, "A")]]):
        for _ in range(2):
            K.upsert_batch(_frame(spark, batch), number, path, ["k"], buckets=4)
    assert rows(K.read_keyed_state(spark, path)) == [(1, "A"), (2, "B"), (3, "c")]


def test_a_batch_without_its_index_does_not_count(spark, tmp_path, rows):
    path = str(tmp_path / "state")
    K.upsert_batch(_frame(spark, [(1, "a")]), 0, path, ["k"], buckets=2)
    K.upsert_batch(_frame(spark, [(1, "b")]), 1, path, ["k"], buckets=2)
    Path(path, "index", "_batch=1", "_SUCCESS").rename(Path(path, "index", "_batch=1", "gone"))
    assert rows(K.read_keyed_state(spark, path)) == [(1, "a")]
    with pytest.raises(ValueError):
        K.read_keyed_state(spark, str(tmp_path / "none"))


def test_old_buckets_go(spark, tmp_path, rows):
    path = str(tmp_path / "state")
    for number in range(6):
        K.upsert_batch(_frame(spark, [(k, str(number)) for k in range(40)]), number, path, ["k"], buckets=4)
    left = sorted(int(p.name.split("=")[1]) for p in Path(path, "index").glob("_batch=*"))
    assert left == [4, 5]
    assert [n for n in range(6) if _written(path, n)] == [4, 5]
    assert rows(K.read_keyed_state(spark, path)) == sorted((k, "5") for k in range(40))
    # an empty batch keeps the state
    K.upsert_batch(_frame(spark, []), 6, path, ["k"], buckets=4)
    assert K.read_keyed_state(spark, path).count() == 40
