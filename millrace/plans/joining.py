"""Joins and window results."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import aggregate as A
from millrace.operators import joins as J
from millrace.operators import windows as W
from millrace.operators.ordering import common_columns, top_k
from millrace.operators.project import rename_columns
from millrace.plans.registry import query
from millrace.plans.relational import MONEY, sql_sum
from millrace.sources.readers import named_view
from millrace.workspace import materialize


def _orders_on_custkey(t):
    return rename_columns(t.orders, {"o_custkey": "custkey"})


def _customers_on_custkey(t):
    return rename_columns(t.customer, {"c_custkey": "custkey"})


_JOINED = """SELECT o_custkey AS custkey, o_orderkey, o_totalprice, c_name, c_mktsegment
             FROM orders JOIN customer ON o_custkey = c_custkey"""


@query("join_inner", "JN1 JN11 SET2", _JOINED)
def join_inner(t):
    orders, customers = _orders_on_custkey(t), _customers_on_custkey(t)
    return J.join_on_keys(orders, customers, common_columns(orders, customers)).select(
        "custkey", "o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@query("join_left", "JN2", """
    SELECT c_custkey AS custkey, c_name, o_orderkey FROM customer LEFT JOIN orders ON o_custkey = c_custkey""")
def join_left(t):
    return J.join_on_keys(_customers_on_custkey(t), _orders_on_custkey(t), "custkey", "left").select(
        "custkey", "c_name", "o_orderkey")


@query("join_using_sql", "JN3 D6", """
    SELECT o_orderkey, o_orderpriority, o_totalprice, n AS orders_of_priority FROM orders
    JOIN (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1) USING (o_orderpriority)""")
def join_using_sql(t):
    orders = named_view(t.orders)
    # staged, so that a few groups are sent to the orders and the orders are not shuffled onto a few keys
    counted = named_view(J.checked_broadcast(materialize(t.spark.sql(
        f"SELECT o_orderpriority, count(*) AS n FROM {orders} GROUP BY 1"), "priorities")))
    return t.spark.sql(f"""SELECT o_orderkey, o_orderpriority, o_totalprice, n AS orders_of_priority
                           FROM {orders} JOIN {counted} USING (o_orderpriority)""")


@query("join_on_condition", "JN4", """
    SELECT o_orderkey, c_custkey, c_acctbal, o_totalprice FROM orders
    JOIN customer ON o_custkey = c_custkey AND o_totalprice > c_acctbal * 20""")
def join_on_condition(t):
    condition = (F.col("o_custkey") == F.col("c_custkey")) & (F.col("o_totalprice") > F.col("c_acctbal") * 20)
    return J.join_on_condition(t.orders, t.customer, condition).select(
        "o_orderkey", "c_custkey", "c_acctbal", "o_totalprice")


@query("join_disambiguated", "JN5", """
    SELECT c_custkey AS custkey, c_nationkey AS nationkey, c_name AS name, n_name AS nation_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def join_disambiguated(t):
    customers = t.customer.select(F.col("c_custkey").alias("custkey"), F.col("c_nationkey").alias("nationkey"),
                                  F.col("c_name").alias("name"))
    nations = t.nation.select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("name"))
    return J.join_prefixed(customers, J.checked_broadcast(nations), ["nationkey"], "nation_")


@query("join_semi", "JN6 JN8", """
    SELECT c_custkey AS custkey, c_name FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)""")
def join_semi(t):
    large = _orders_on_custkey(t).where("o_totalprice > 450000")
    return J.semi_join(_customers_on_custkey(t).select("custkey", "c_name"), large, ["custkey"])


@query("join_distinct_inner", "JN8", """
    SELECT c_custkey AS custkey, c_name FROM customer
    WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)""")
def join_distinct_inner(t):
    # the same rows as the semi join: distinct keys cannot multiply the left side
    large = _orders_on_custkey(t).where("o_totalprice > 450000").select("custkey").distinct()
    return _customers_on_custkey(t).select("custkey", "c_name").join(large, "custkey")


@query("join_anti", "JN7", """
    SELECT c_custkey AS custkey, c_name FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)""")
def join_anti(t):
    large = _orders_on_custkey(t).where("o_totalprice > 450000")
    return J.anti_join(_customers_on_custkey(t).select("custkey", "c_name"), large, ["custkey"])


@query("join_broadcast", "JN9 JN10", """
    SELECT n_name, count(*) AS orders, count(DISTINCT o_custkey) AS customers
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name""")
def join_broadcast(t):
    customers = J.checked_broadcast(t.customer.select("c_custkey", "c_nationkey"))
    nations = J.checked_broadcast(t.nation.select("n_nationkey", "n_name"))
    return (t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("n_name").agg(F.count(F.lit(1)).alias("orders"),
                                   F.count_distinct("o_custkey").alias("customers")))


@query("join_prepartitioned", "JN12 LAY2 LAY5", """
    SELECT o_custkey AS custkey, count(*) AS orders, count(DISTINCT o_orderpriority) AS priorities
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def join_prepartitioned(t):
    joined = J.join_prepartitioned(_orders_on_custkey(t), _customers_on_custkey(t), "custkey", target_rows=1_000_000)
    return joined.groupBy("custkey").agg(F.count(F.lit(1)).alias("orders"),
                                         F.count_distinct("o_orderpriority").alias("priorities"))


@query("join_salted", "JN12", _JOINED)
def join_salted(t):
    joined = J.join_prepartitioned(_orders_on_custkey(t), _customers_on_custkey(t), "custkey",
                                   salts=8, support=0.001)
    return joined.select("custkey", "o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@query("bucketed_join", "JN13 SNK9 SNK10", _JOINED)
def bucketed_join(t):
    joined = J.join_bucketed(_orders_on_custkey(t), _customers_on_custkey(t), "custkey", buckets=8,
                             target_rows=1_000_000)
    return joined.select("custkey", "o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@query("bucketed_join_salted", "JN13", _JOINED)
def bucketed_join_salted(t):
    joined = J.join_bucketed(_orders_on_custkey(t), _customers_on_custkey(t), "custkey", buckets=8,
                             salts=4, support=0.001)
    return joined.select("custkey", "o_orderkey", "o_totalprice", "c_name", "c_mktsegment")


@query("join_grid", "JN11 JN12", """
    SELECT n_regionkey, c_custkey, s_suppkey FROM customer JOIN nation c ON c_nationkey = n_nationkey
    JOIN (SELECT s_suppkey, n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey) USING (n_regionkey)""")
def join_grid(t):
    # suppliers of a customer's region: five keys, each frequent on both sides
    regions = J.checked_broadcast(t.nation.select("n_nationkey", "n_regionkey"))
    customers = t.customer.join(regions, F.col("c_nationkey") == F.col("n_nationkey")).select("n_regionkey", "c_custkey")
    suppliers = t.supplier.join(regions, F.col("s_nationkey") == F.col("n_nationkey")).select("n_regionkey", "s_suppkey")
    return J.join_grid(customers, suppliers, "n_regionkey", target_rows=50)


@query("join_grid_left", "JN2 JN11 JN13", """
    SELECT o_orderkey, o_orderdate, p_partkey FROM orders
    LEFT JOIN (SELECT p_partkey, DATE '1995-01-01' + CAST(p_size * p_size AS INTEGER) AS day FROM part) ON day = o_orderdate""")
def join_grid_left(t):
    # parts by a day that their size names: few days, which have many parts and many orders; bucketed in cells
    parts = t.part.select("p_partkey", F.date_add(F.lit("1995-01-01").cast("date"), (F.col("p_size") * F.col("p_size")).cast("int"))
                          .alias("o_orderdate"))
    return J.join_bucketed(t.orders.select("o_orderkey", "o_orderdate"), parts, "o_orderdate", buckets=8, how="left", target_rows=5)


@query("star_join_top_k", "JN14", """
    WITH top AS (SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(*) DESC, o_custkey LIMIT 20)
    SELECT p_type, count(*) AS count
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    WHERE o_custkey IN (SELECT o_custkey FROM top)
    GROUP BY p_type ORDER BY 2 DESC, 1""")
def star_join_top_k(t):
    orders = t.orders.select("o_orderkey", "o_custkey")
    counted = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    # at most k rows, so the broadcast has a bound; the orders shrink before they meet the line items
    best = F.broadcast(top_k(counted, 20, F.desc("n"), F.asc("o_custkey")).select("o_custkey"))
    # staged, so that its true size decides and the line items are not shuffled for a few orders
    wanted = J.checked_broadcast(materialize(orders.join(best, "o_custkey", "leftsemi"), "wanted"))
    parts = J.checked_broadcast(t.part.select("p_partkey", "p_type"))
    lines = (t.lineitem.select("l_orderkey", "l_partkey")
             .join(wanted, F.col("l_orderkey") == F.col("o_orderkey"))
             .join(parts, F.col("l_partkey") == F.col("p_partkey")))
    return A.frequencies(lines, ["p_type"])


@query("agg_then_join", "JN15 ST18", f"""
    SELECT c_name, volume FROM customer
    JOIN (SELECT user_id, {sql_sum('value')} AS volume FROM events GROUP BY 1) ON user_id = c_custkey""")
def agg_then_join(t):
    volumes = t.events.groupBy("user_id").agg(F.round(F.sum("value"), 2).alias("volume"))
    return volumes.join(t.customer, F.col("user_id") == F.col("c_custkey")).select("c_name", "volume")


@query("join_filtered", "JN17", """
    SELECT o_orderkey, o_orderpriority, priciest FROM orders
    JOIN (SELECT o_orderpriority, max(o_totalprice) AS priciest FROM orders GROUP BY 1) USING (o_orderpriority)
    WHERE o_orderpriority = '2-HIGH'""")
def join_filtered(t):
    orders = t.orders.select("o_orderkey", "o_orderpriority")
    priciest = J.checked_broadcast(materialize(
        t.orders.groupBy("o_orderpriority").agg(F.max("o_totalprice").alias("priciest")), "priciest"))
    return J.join_on_keys(orders, priciest, "o_orderpriority").where("o_orderpriority = '2-HIGH'")


@query("join_group_count", "JN18", """
    SELECT p_partkey, p_type, count(*) OVER (PARTITION BY p_type) AS parts_of_type FROM part""")
def join_group_count(t):
    return W.join_group_count(t.part.select("p_partkey", "p_type"), ["p_type"], "parts_of_type")


# windows

def _orders_with_amount(t):
    return t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice",
                           F.col("o_totalprice").cast(MONEY).alias("amount"))


_RUNNING = """
    SELECT o_orderkey, o_orderpriority, round(sum(o_totalprice) OVER (
        PARTITION BY o_orderpriority ORDER BY o_orderdate), 2) AS running FROM orders"""


def _running(t, **limits):
    summed = W.running_sum(_orders_with_amount(t), ["o_orderpriority"], "o_orderdate", F.col("amount"),
                           "running", **limits)
    return summed.select("o_orderkey", "o_orderpriority", F.col("running").cast("double").alias("running"))


@query("running_sum", "WIN1", _RUNNING)
def running_sum(t):
    return _running(t)


@query("running_sum_blocks", "WIN1", _RUNNING)
def running_sum_blocks(t):
    return _running(t, blocks=16)


_NUMBERED = """
    SELECT o_orderkey, o_orderpriority, row_number() OVER (
        PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders"""


def _numbered(t, **limits):
    source = t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return W.row_numbers(source, ["o_orderpriority"], [F.desc("o_totalprice"), F.asc("o_orderkey")],
                         "position", **limits).drop("o_totalprice")


@query("row_numbers", "WIN2 D5", _NUMBERED)
def row_numbers(t):
    return _numbered(t)


@query("row_numbers_blocks", "WIN2", _NUMBERED)
def row_numbers_blocks(t):
    return _numbered(t, blocks=16)


@query("partition_totals", "WIN3 WIN5", """
    SELECT o_orderkey, o_totalprice,
           round(sum(o_totalprice) OVER (PARTITION BY o_orderpriority, o_orderstatus), 2) AS total_priority_status,
           round(sum(o_totalprice) OVER (PARTITION BY o_orderpriority), 2) AS total_priority
    FROM orders""")
def partition_totals(t):
    source = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus")
    total = A.exact_sum("o_totalprice", 2)
    attached = W.partition_aggregates(
        source, (["o_orderpriority", "o_orderstatus"], [total.alias("total_priority_status")]),
        (["o_orderpriority"], [total.alias("total_priority")]))
    return attached.drop("o_orderpriority", "o_orderstatus")


@query("share_of_total", "WIN4 JOB5", """
    SELECT o_orderkey, o_orderpriority, o_totalprice, total,
           o_totalprice / total AS share FROM (
        SELECT *, round(sum(o_totalprice) OVER (PARTITION BY o_orderpriority), 2) AS total
        FROM orders WHERE o_orderstatus = 'F')""")
def share_of_total(t):
    cases = t.orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return W.share_of_total(cases, ["o_orderpriority"], "o_totalprice", A.exact_sum("o_totalprice", 2),
                            "total", "share")


_AMENDED = ("o_totalprice", "total_priority_status", "total_priority")


@query("amended_aggs", "JOB10", "SELECT " + ", ".join(
    f"round(avg({c}), 4) AS {c}_avg, max({c}) AS {c}_max, min({c}) AS {c}_min" for c in _AMENDED) + """ FROM (
    SELECT o_totalprice, round(sum(o_totalprice) OVER (PARTITION BY o_orderpriority, o_orderstatus), 2)
               AS total_priority_status,
           round(sum(o_totalprice) OVER (PARTITION BY o_orderpriority), 2) AS total_priority FROM orders)""")
def amended_aggs(t):
    """Figures of every numeric column of the frame with its totals, but not of the row id."""
    amended = partition_totals(t)
    columns = A.numeric_columns(amended, id_suffix="key")
    functions = {"avg": A.rounded_mean(4), "max": F.max, "min": F.min}
    return A.group_aggregate(amended, [], A.build_aggregates(columns, functions))
