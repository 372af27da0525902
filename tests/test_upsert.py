import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators import upsert as U
from millrace.plans.inspect import operators
from millrace.sources import change_log
from millrace.sources.writers import scan_roots

T0, T1, T2 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)


@pytest.fixture
def base(spark):
    return spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")


@pytest.fixture
def changes(spark):
    return spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")


def test_insert_only(base, changes, rows):
    known = changes.where("k IS NOT NULL")
    once = U.merge_insert(base, known, ["k"])
    assert rows(once) == [(1, "a"), (2, "b"), (3, "C"), (None, "n")]
    assert rows(U.merge_insert(once, known, ["k"])) == rows(once)
    assert rows(U.merge_insert(base, changes, ["k"]))[-2:] == [(None, "N"), (None, "n")]


def test_merging_again_does_not_join_anew(base, changes, rows):
    """The result of a merge reads stored rows, so no task holds the sorts of several merges at once."""
    merged = base
    for _ in range(3):
        merged = U.merge_insert(merged, changes, ["k"])
    assert not [o for o in operators(merged) if "Join" in o or "Aggregate" in o or o == "Sort"]
    assert rows(merged)[:3] == [(1, "a"), (2, "b"), (3, "C")] and merged.where("k IS NULL").count() == 4


def test_upsert(base, changes, rows):
    merged = U.merge_upsert(base, changes, ["k"])
    assert rows(merged) == [(1, "a"), (2, "B"), (3, "C"), (None, "N"), (None, "n")]
    known = changes.where("k IS NOT NULL")
    again = U.merge_upsert(U.merge_upsert(base, known, ["k"]), known, ["k"])
    assert rows(again) == [(1, "a"), (2, "B"), (3, "C"), (None, "n")]


def test_duplicate_source_keys_are_rejected(base, changes):
    twice = changes.where("k IS NOT NULL").unionByName(changes.where("k = 2"))
    for merge in (lambda: U.merge_upsert(base, twice, ["k"]),
                  lambda: U.scd2_apply(U.open_history(base, T0), twice, ["k"], T1)):
        with pytest.raises(Exception, match="same merge key"):
            merge().count()


def test_key_only_table(spark, rows):
    keys = spark.createDataFrame([(1,), (2,)], "k int")
    assert rows(U.merge_upsert(keys, spark.createDataFrame([(2,), (3,)], "k int"), ["k"])) == [(1,), (2,), (3,)]


def test_delete_and_update(spark, rows):
    df = spark.createDataFrame([(1, 10), (2, None), (3, 30)], "k int, v int")
    assert rows(U.delete_where(df, F.col("v") > 20)) == [(1, 10), (2, None)]
    updated = U.update_where(df, F.col("v") > 5, {"v": F.col("k"), "k": F.col("v")})
    assert rows(updated) == [(2, None), (10, 1), (30, 3)]


def _versions(df, rows):
    return [(k, v, f.month, t.year if t.year > 2100 else t.month) for k, v, f, t in
            rows(df.where("k IS NOT NULL"), "k", "v", "valid_from", "valid_to")]


def test_history(base, changes, rows):
    with pytest.raises(Exception, match="a change has no key"):
        U.scd2_apply(U.open_history(base, T0), changes, ["k"], T1).count()
    history = U.scd2_apply(U.open_history(base, T0), changes, ["k"], T1, skip_null_keys=True)
    again = U.scd2_apply(history, changes, ["k"], T1, skip_null_keys=True)
    assert sorted(map(str, again.collect())) == sorted(map(str, history.collect()))
    assert _versions(history, rows) == [(1, "a", 1, 2199), (2, "B", 2, 2199), (2, "b", 1, 2), (3, "C", 2, 2199)]
    assert history.where("k IS NULL").count() == 1


def test_history_is_idempotent(base, changes, rows):
    known = changes.where("k IS NOT NULL")
    once = U.scd2_apply(U.open_history(base, T0), known, ["k"], T1)
    assert rows(U.scd2_apply(once, known, ["k"], T1)) == rows(once)


def test_history_grows_by_one_version(base, changes, rows):
    known = changes.where("k IS NOT NULL")
    once = U.scd2_apply(U.open_history(base, T0), known, ["k"], T1)
    later = U.scd2_apply(once, known.withColumn("v", F.lower("v")), ["k"], T2)
    assert later.where("k = 2").count() == 3
    assert later.where(F.col("valid_to") == U.moment(U.OPEN_END)).where("k = 2").count() == 1


def test_unchanged_rows_keep_their_version(base, spark, rows):
    same = spark.createDataFrame([(1, "a"), (2, "B")], "k int, v string")
    history = U.scd2_apply(U.open_history(base, T0), same, ["k"], T1, compare=["v"])
    assert _versions(history, rows) == [(1, "a", 1, 2199), (2, "B", 2, 2199), (2, "b", 1, 2)]


def test_changes_from_the_past_are_rejected(base, changes):
    with pytest.raises(Exception, match="before the open version"):
        U.scd2_apply(U.open_history(base, T1), changes.where("k IS NOT NULL"), ["k"], T0).count()


@pytest.fixture
def log(spark, tmp_path):
    path = str(tmp_path / "log")
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    change_log.append_version(first, path, 1, "insert", T0)
    change_log.append_version(spark.createDataFrame([(2, "B")], "k int, v string"), path, 2, "update", T1)
    for _ in range(2):  # a retried version replaces itself
        change_log.append_version(spark.createDataFrame([(3, "c")], "k int, v string"), path, 3, U.DELETE, T2)
    return change_log.read_log(spark, path)


def test_a_version_holds_one_change_per_key(spark, tmp_path):
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="same merge key"):
        change_log.append_version(twice, str(tmp_path / "log"), 1, "insert", T0, keys=["k"])
    change_log.append_version(twice, str(tmp_path / "log"), 1, "insert", T0)
    found = {tuple(U.as_of(change_log.read_log(spark, str(tmp_path / "log")).repartition(n), ["k"], version=1)
                   .select("k", "v").first()) for n in (1, 2, 3)}
    assert len(found) == 1


def test_as_of(log, rows):
    assert rows(U.as_of(log, ["k"], version=1), "k", "v") == [(1, "a"), (2, "b"), (3, "c")]
    assert rows(U.as_of(log, ["k"], version=2), "k", "v") == [(1, "a"), (2, "B"), (3, "c")]
    assert rows(U.as_of(log, ["k"], version=9), "k", "v") == [(1, "a"), (2, "B")]
    assert rows(U.as_of(log, ["k"], timestamp=datetime(2024, 2, 15)), "k", "v") == [(1, "a"), (2, "B"), (3, "c")]
    with pytest.raises(ValueError):
        U.as_of(log, ["k"])


def test_times_do_not_depend_on_the_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert spark.range(1).select(U.moment(T1)).first()[0] == T1
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_change_history(log, rows):
    assert [(r._version, r._op, r.rows) for r in U.change_history(log).collect()] == [
        (3, "delete", 1), (2, "update", 1), (1, "insert", 3)]
    assert U.change_history(log, last=1).first()._version == 3
    assert rows(U.output_sizes(log)) == [(1, 2), (3, 1)]


def _random_log(spark, path, seed, versions=6):
    """Versions with gaps, out of time order and with deletions."""
    rng = random.Random(seed)
    for step in range(1, versions + 1):
        rows = [(k, f"{step}-{k}") for k in rng.sample(range(12), rng.randint(1, 6))]
        op = rng.choice(["insert", "update", U.DELETE]) if step > 1 else "insert"
        at = datetime(2024, 1, rng.randint(1, 20))
        change_log.append_version(spark.createDataFrame(rows, "k int, v string"), path, 2 * step, op, at, ["k"])


@pytest.mark.parametrize("seed", [1, 2])
def test_snapshots_equal_the_ranked_log(spark, tmp_path, rows, seed):
    path = str(tmp_path / "log")
    _random_log(spark, path, seed)
    for version in (4, 10):
        change_log.write_snapshot(spark, path, ["k"], version)
    log = change_log.read_log(spark, path)
    columns = ["k", "v", U.OP]
    for version in (2, 4, 5, 8, 10, 12, 99):
        assert rows(change_log.read_as_of(spark, path, ["k"], version=version), *columns) == rows(
            U.as_of(log, ["k"], version=version), *columns)
    for day in (8, 15, 20):
        at = datetime(2024, 1, day, 12)
        assert rows(change_log.read_as_of(spark, path, ["k"], timestamp=at), *columns) == rows(
            U.as_of(log, ["k"], timestamp=at), *columns)


def test_a_read_opens_one_snapshot_and_the_later_versions(spark, tmp_path):
    path = str(tmp_path / "log")
    _random_log(spark, path, 3)
    change_log.write_snapshot(spark, path, ["k"], 4)
    change_log.write_snapshot(spark, path, ["k"], 8)
    found = change_log.read_as_of(spark, path, ["k"], version=8)
    assert [p.rsplit("/", 1)[1] for p in scan_roots(found)] == ["upto=8"]
    later = change_log._versions(spark, path, 8, 12)
    assert {p.rsplit("=", 1)[1] for p in (r for r in later.inputFiles()) for p in [p.rsplit("/", 1)[0]]} == {"10", "12"}
    # the snapshot is not shuffled for a few later changes
    joined = change_log.read_as_of(spark, path, ["k"], version=12)
    assert "SortMergeJoin" not in operators(joined) and "Window" not in operators(joined)


def test_a_version_written_again_drops_its_snapshots(spark, tmp_path, rows):
    path = str(tmp_path / "log")
    _random_log(spark, path, 4)
    for version in (2, 6, 12):
        change_log.write_snapshot(spark, path, ["k"], version)
    change_log.append_version(spark.createDataFrame([(1, "late")], "k int, v string"), path, 6, "update", datetime(2024, 1, 3), ["k"])
    assert change_log._snapshots(spark, path) == [2]
    assert rows(change_log.read_as_of(spark, path, ["k"], version=12), "k", "v") == rows(
        U.as_of(change_log.read_log(spark, path), ["k"], version=12), "k", "v")
    with pytest.raises(ValueError):
        change_log.write_snapshot(spark, path, ["k"], 7)
    with pytest.raises(ValueError):
        change_log.read_as_of(spark, str(tmp_path / "none"), ["k"], version=1)
