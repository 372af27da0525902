"""What Spark makes of the operators."""

import re

import pytest
from pyspark.sql import functions as F

from millrace.plans import REGISTRY
from millrace.plans.inspect import exchanges, operators, plan_text
from millrace.workspace import materialize, new_path, shared_folder, staging_scope


def _plan(spark, name, folder, mode="formatted"):
    return plan_text(REGISTRY[name].run(spark, folder), mode)


def test_columns_are_pruned(spark, small_tables):
    for name in ("group_count_desc", "crosstab"):
        schemas = re.findall(r"ReadSchema: (.*)", _plan(spark, name, small_tables))
        assert schemas and all("o_totalprice" not in s for s in schemas)


def test_filters_reach_the_scan(spark, small_tables):
    assert "GreaterThan(l_quantity,45.0)" in _plan(spark, "filter_sql", small_tables)


def test_partitions_are_pruned(spark, small_tables):
    assert re.search(r"PartitionFilters: \[.*o_orderstatus", _plan(spark, "scan_partitioned", small_tables))
    assert re.search(r"PartitionFilters: \[.*_version", _plan(spark, "as_of_version", small_tables))


def test_filter_is_inferred_on_both_sides_of_a_join(spark, small_tables):
    plan = _plan(spark, "join_filtered", small_tables)
    assert len(re.findall(r"PushedFilters: \[.*EqualTo\(o_orderpriority,2-HIGH\)", plan)) == 2


def test_rank_limit_runs_before_the_shuffle(spark, small_tables):
    for name in ("dedup_by_key", "as_of_version"):
        plan = _plan(spark, name, small_tables, "simple")
        assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit.*Partial", plan)


def test_top_k_needs_no_full_sort(spark, small_tables):
    found = operators(REGISTRY["top_k"].run(spark, small_tables))
    assert "TakeOrderedAndProject" in found and "Exchange" not in found


def test_group_totals_leave_the_detail_side_in_place(spark, small_tables):
    result = REGISTRY["partition_totals"].run(spark, small_tables)
    assert exchanges(result) == [] and operators(result).count("BroadcastHashJoin") == 2


def test_small_changes_leave_the_base_in_place(spark, small_tables):
    for name in ("scd2_apply", "merge_upsert"):
        result = REGISTRY[name].run(spark, small_tables)
        assert "SortMergeJoin" not in operators(result)


def test_few_keys_and_few_orders_do_not_shuffle_the_large_side(spark, small_tables):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        # not by estimate, but because their size was checked
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for name in ("join_using_sql", "join_filtered"):
            assert exchanges(REGISTRY[name].run(spark, small_tables)) == []
        plan = _plan(spark, "star_join_top_k", small_tables, "simple")
        assert "l_orderkey" not in "".join(re.findall(r"hashpartitioning\([^)]*\)", plan))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_the_wide_frame_is_joined_once(spark, small_tables):
    found = operators(REGISTRY["star_split"].run(spark, small_tables))
    assert sum("Join" in name for name in found) == 1


def test_overwriting_lists_no_files():
    import inspect

    from millrace.sources import writers
    assert "inputFiles" not in inspect.getsource(writers)


def test_a_scope_leaves_nothing_staged(spark, tmp_path):
    with staging_scope(spark):
        path = new_path(spark, "gone")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_projections_need_no_shuffle(spark, small_tables):
    for name in ("derived_columns", "casts", "fill_missing", "update_where", "decode_and_explode", "explode_words",
                 "extract_id", "nested_path"):
        assert exchanges(REGISTRY[name].run(spark, small_tables)) == []


def test_no_cartesian_products(spark, small_tables):
    for name in ("join_on_condition", "partition_totals", "share_of_total", "frequent_items", "corr_matrix",
                 "count_distinct", "star_join_top_k"):
        found = operators(REGISTRY[name].run(spark, small_tables))
        assert not {"CartesianProduct", "BroadcastNestedLoopJoin"} & set(found)


def test_small_sides_are_broadcast_without_a_hint(spark, small_tables):
    assert "BroadcastHashJoin" in operators(REGISTRY["join_inner"].run(spark, small_tables))


def test_adaptive_execution_broadcasts_what_turns_out_small(spark, small_tables):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10m")
        joined = REGISTRY["join_inner"].run(spark, small_tables)
        assert "SortMergeJoin" in operators(joined)
        joined.collect()
        assert "BroadcastHashJoin" in plan_text(joined, "simple").split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_adaptive_execution_splits_a_skewed_join(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10000",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000"}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        hot = spark.range(0, 200000, 1, 8).select(F.when(F.col("id") < 120000, 1).otherwise(F.col("id")).alias("k"),
                                                  F.col("id").alias("v"))
        joined = hot.join(spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("w")), "k")
        joined.collect()
        assert "SortMergeJoin(skew=true)" in plan_text(joined, "simple")
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_path(spark, "a") != new_path(spark, "a")
    stored = materialize(spark.range(3).toDF("id"), "three")
    assert stored.count() == 3 and stored.inputFiles()[0].startswith(f"file://{shared_folder(spark)}")


class _Cluster:
    class sparkContext:
        master, applicationId = "spark://host:7077", "app"

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError):
        shared_folder(_Cluster())
