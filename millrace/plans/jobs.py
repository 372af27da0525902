"""Whole data jobs made of the operators: one source, pure steps, one sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import aggregate as A
from millrace.operators import project as P
from millrace.operators.missing import keep, matches_ignoring_case
from millrace.operators.ordering import top_k, union_all
from millrace.plans.registry import query
from millrace.plans.relational import sql_mean, sql_sum
from millrace.sources import readers as R
from millrace.sources.readers import named_view
from millrace.sources.writers import write_csv, write_parquet
from millrace.workspace import materialize, new_path


def group_maxima(df, key):
    """Highest value of every numeric column per group."""
    columns = A.numeric_columns(df, exclude=[key])
    return A.group_aggregate(df, [key], A.build_aggregates(columns, {"max": F.max}))


@query("etl_group_max", "JOB1", """
    SELECT p_brand, max(p_partkey) AS p_partkey_max, max(p_size) AS size_max, max(p_retailprice) AS p_retailprice_max
    FROM part GROUP BY p_brand""")
def etl_group_max(t):
    raw = P.rename_columns(t.part, {"p_size": "Size(L)"})
    loaded = P.rename_columns(raw, {"Size(L)": "size"})
    result = group_maxima(loaded, "p_brand")
    path = new_path(t.spark, "group-maxima")
    write_csv(result, path)
    return R.csv(t.spark, path, schema=result.schema, header=True)


def clean(df):
    """Lower-case names and no duplicate rows."""
    return P.normalize_names(df).dropDuplicates()


@query("etl_clean", "JOB2", "SELECT DISTINCT p_name AS name, p_brand AS brand, p_type AS type FROM part")
def etl_clean(t):
    raw = t.part.select(F.col("p_name").alias("Name"), F.col("p_brand").alias("BRAND"),
                        F.col("p_type").alias("Type"))
    result = clean(raw)
    path = new_path(t.spark, "cleaned")
    write_parquet(result, path)
    return R.parquet(t.spark, path)


def _wide(t):
    return materialize(t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")), "wide")


@query("star_split", "JOB3", """
    SELECT 'customers' AS relation, count(DISTINCT o_custkey) AS rows FROM orders
    UNION ALL SELECT 'segments', count(*) FROM (
        SELECT DISTINCT c_mktsegment, c_nationkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders))
    UNION ALL SELECT 'facts', count(*) FROM orders
    UNION ALL SELECT 'rejoined', count(*) FROM orders""")
def star_split(t):
    wide = _wide(t)
    customers = wide.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment").distinct()
    segments = wide.select("c_mktsegment", "c_nationkey").distinct()
    facts = wide.select("c_custkey", "o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus")
    rejoined = facts.join(customers, "c_custkey")
    parts = {"customers": customers, "segments": segments, "facts": facts, "rejoined": rejoined}
    return union_all(*[df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("relation"), "rows")
                       for name, df in parts.items()])


def _cases(t):
    """Orders of final status stand for the cases with a loss."""
    return keep(t.orders, F.col("o_orderstatus") == "F")


@query("loss_by_category", "JOB4", f"""
    SELECT o_orderpriority, {sql_sum('o_totalprice')} AS amount FROM orders WHERE o_orderstatus = 'F'
    GROUP BY 1 ORDER BY 2 DESC""")
def loss_by_category(t):
    return (_cases(t).groupBy("o_orderpriority").agg(A.exact_sum("o_totalprice", 2).alias("amount"))
            .orderBy(F.desc("amount")))


@query("largest_case_category", "JOB4", """
    SELECT o_orderpriority FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 1""")
def largest_case_category(t):
    return top_k(_cases(t), 1, F.desc("o_totalprice"), F.asc("o_orderkey")).select("o_orderpriority")


@query("top_customer_in_category", "JOB4", """
    SELECT c_custkey, c_nationkey, count(*) AS count FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderstatus = 'F' AND lower(o_orderpriority) LIKE '%urgent%'
    GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 1""")
def top_customer_in_category(t):
    urgent = keep(_cases(t), matches_ignoring_case("o_orderpriority", "%urgent%"))
    counted = urgent.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("count"))
    # grouped before the join: one row per customer meets the dimension
    joined = counted.join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey")
    return top_k(joined, 1, F.desc("count"), F.asc("c_custkey"))


@query("max_per_category", "JOB6", """
    SELECT o_orderpriority, o_orderstatus, round(max(o_totalprice), 0) AS amount FROM orders
    WHERE o_orderstatus = 'F' GROUP BY 1, 2""")
def max_per_category(t):
    return (_cases(t).groupBy("o_orderpriority", "o_orderstatus")
            .agg(F.round(F.max("o_totalprice"), 0).alias("amount")).orderBy(F.desc("amount")))


@query("yearly_summary", "JOB7", f"""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year_no, max(o_totalprice) AS highest,
           {sql_mean('o_totalprice')} AS mean, min(o_totalprice) AS lowest
    FROM orders GROUP BY 1""")
def yearly_summary(t):
    summary = t.spark.sql(f"""
        SELECT CAST(date_format(o_orderdate, 'yyyy') AS INT) AS year_no, max(o_totalprice) AS highest,
               {sql_mean('o_totalprice')} AS mean, min(o_totalprice) AS lowest
        FROM {named_view(t.orders)} GROUP BY 1""")
    path = new_path(t.spark, "yearly-summary")
    write_csv(summary, path)
    return R.csv(t.spark, path, schema=summary.schema, header=True)


@query("top_k_stats", "JOB8", f"""
    SELECT o_custkey, count(*) AS orders, {sql_mean('o_totalprice')} AS mean, max(o_totalprice) AS highest,
           min(o_totalprice) AS lowest, min(o_orderdate) AS first_day
    FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def top_k_stats(t):
    stats = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), A.rounded_mean()(F.col("o_totalprice")).alias("mean"),
        F.max("o_totalprice").alias("highest"), F.min("o_totalprice").alias("lowest"),
        F.min("o_orderdate").alias("first_day"))
    return top_k(stats, 10, F.desc("orders"), F.asc("o_custkey"))


@query("count_distinct_filtered", "JOB9", """
    SELECT count(DISTINCT o_custkey) AS customers FROM orders
    WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'""")
def count_distinct_filtered(t):
    flagged = P.derive_columns(t.orders, {"is_final": P.flag(F.col("o_orderstatus") == "F"),
                                          "is_urgent": P.flag(F.col("o_orderpriority") == "1-URGENT")})
    return keep(flagged, (F.col("is_final") == 1) & (F.col("is_urgent") == 1)).agg(
        F.count_distinct("o_custkey").alias("customers"))
