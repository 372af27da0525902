"""Time the headline queries and the join variants; prints one JSON line.

Environment: BENCH_SF_DIR (folder of the tables), BENCH_CPUS (local cores),
BENCH_RUNS (timed runs per query after one warm-up; the median counts),
BENCH_QUERIES (comma-separated names instead of the headline list).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from millrace.operators.joins import checked_broadcast, join_prepartitioned  # noqa: E402
from millrace.operators.layout import compact  # noqa: E402
from millrace.operators.windows import partition_aggregates  # noqa: E402
from millrace.plans import REGISTRY  # noqa: E402
from millrace.plans.nested import decoded_lines, line_messages  # noqa: E402
from millrace.plans.registry import Tables  # noqa: E402
from millrace.session import local_session  # noqa: E402
from millrace.sources.writers import save_table  # noqa: E402
from millrace.workspace import materialize, new_name, new_path  # noqa: E402

HEADLINE = (
    "group_count_desc", "group_stats", "dynamic_aggs", "conditional_aggs", "pivot_mean", "describe_numeric",
    "corr_matrix", "count_distinct", "group_count_distinct", "frequent_items", "dedup_by_key", "top_k",
    "join_inner", "join_broadcast", "join_semi", "join_salted", "star_join_top_k", "running_sum", "row_numbers",
    "partition_totals", "share_of_total", "word_count", "extract_id",
    "pandas_udf_extract_id", "merge_insert", "merge_upsert", "scd2_apply", "as_of_version", "partition_replace",
    "compact", "zorder", "tumbling_counts", "watermark_append", "etl_group_max", "ml_linear")


def run(df) -> None:
    """Compute every row and column without bringing any to the driver."""
    df.write.format("noop").mode("overwrite").save()


def timed(build, runs: int) -> float:
    run(build())
    seconds = []
    for _ in range(runs):
        start = time.perf_counter()
        run(build())
        seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 3)


def staged_inputs(spark, folder: str) -> dict:
    """Queries whose input is made beforehand: messages, a table of many files, and a key that holds half the rows."""
    tables = Tables(spark, folder)
    messages = materialize(line_messages(tables), "messages")
    many = new_path(spark, "many-files")
    tables.orders.repartition(200).write.parquet(many)
    half = F.when(F.col("o_orderkey") % 2 == 0, F.lit(0)).otherwise(F.col("o_custkey")).alias("k")
    skewed = materialize(tables.orders.select(half, "o_orderkey", "o_totalprice"), "skewed")
    customers = tables.customer.select(F.col("c_custkey").alias("k"), "c_name")
    return {
        "decode_and_explode": lambda: decoded_lines(messages),
        "compact_many_files": lambda: compact(spark, many, new_path(spark, "compacted"), target_bytes=8 << 20),
        "skewed_totals": lambda: partition_aggregates(skewed, (["k"], [F.sum("o_totalprice").alias("total")])),
        "skewed_join": lambda: join_prepartitioned(skewed, customers, "k", 16, "left", target_rows=20_000),
    }


def join_variants(spark, folder: str) -> dict:
    """One join with a distinct count, laid out in seven ways."""
    orders = spark.read.parquet(f"{folder}/orders.parquet").withColumnRenamed("o_custkey", "k")
    customers = spark.read.parquet(f"{folder}/customer.parquet").withColumnRenamed("c_custkey", "k")

    def distinct(joined, *keys):
        return joined.groupBy(*keys).agg(F.count_distinct("o_orderpriority").alias("n"))

    def bucketed(df):
        return save_table(df, new_name("bench"), path=new_path(spark, "bench"), bucket_by=["k"], buckets=20)
    sides = [bucketed(orders), bucketed(customers)]
    four = {"spark.sql.shuffle.partitions": "4"}
    plain = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    return {
        "variant_plain": (plain, lambda: distinct(orders.join(customers, "k"), "c_nationkey")),
        "variant_prepartitioned": (plain, lambda: distinct(
            join_prepartitioned(orders, customers, "k", 4), "c_nationkey")),
        "variant_prepartitioned_few": (plain | four, lambda: distinct(
            join_prepartitioned(orders, customers, "k", 4), "c_nationkey")),
        "variant_few_partitions": (plain | four, lambda: distinct(orders.join(customers, "k"), "c_nationkey")),
        "variant_key_aggregate": (plain, lambda: distinct(orders.join(customers, "k"), "k")),
        "variant_broadcast": (plain, lambda: distinct(
            orders.join(checked_broadcast(customers), "k"), "c_nationkey")),
        "variant_bucketed": (plain, lambda: distinct(sides[0].join(sides[1], "k"), "c_nationkey")),
    }


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session("bench", os.environ.get("BENCH_CPUS", "8"))
    found = {name: timed(lambda: REGISTRY[name].run(spark, folder), runs) for name in names}
    if names is HEADLINE:
        found |= {name: timed(build, runs) for name, build in staged_inputs(spark, folder).items()}
        for name, (settings, build) in join_variants(spark, folder).items():
            old = {key: spark.conf.get(key, None) for key in settings}
            for key, value in settings.items():
                spark.conf.set(key, value)
            found[name] = timed(build, max(runs, 5))
            for key, value in old.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(found.values()), 3), "unit": "sec",
                      "queries": found, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
