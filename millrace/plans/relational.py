"""Projections, filters, missing data, aggregation, statistics, order and set operations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from millrace.operators import aggregate as A
from millrace.operators import missing as M
from millrace.operators import ordering as O
from millrace.operators import project as P
from millrace.operators import stats as S
from millrace.plans.registry import query
from millrace.sources.readers import named_view

MONEY = "decimal(18,2)"


def sql_mean(column: str) -> str:
    """The mean in SQL; the result is rounded, the values are not."""
    return f"round(avg({column}), 6)"


def sql_sum(column: str) -> str:
    """The sum in SQL; the result is rounded, the values are not."""
    return f"round(sum({column}), 2)"


# projections

@query("project_columns", "PRJ1 PRJ2", """
    SELECT o_orderkey AS order_id, o_custkey, o_totalprice AS price, o_orderpriority FROM orders""")
def project_columns(t):
    orders = t.orders
    return orders.select(orders.o_orderkey.alias("order_id"), orders["o_custkey"],
                         F.col("o_totalprice").alias("price"), "o_orderpriority")


@query("select_expr", "PRJ3 PRJ10", """
    SELECT o_orderkey, o_totalprice * 2 AS double_price, 'EUR' AS currency,
           CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_final FROM orders""")
def select_expr(t):
    return P.select_exprs(t.orders, {
        "o_orderkey": "o_orderkey", "double_price": "o_totalprice * 2", "currency": "'EUR'",
        "is_final": "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END"})


@query("sql_project", "PRJ4", """
    SELECT c_custkey, c_name, c_acctbal / 2 AS half_balance FROM customer WHERE c_acctbal > 0""")
def sql_project(t):
    view = named_view(t.customer)
    return t.spark.sql(
        f"SELECT c_custkey, c_name, c_acctbal / 2 AS half_balance FROM {view} WHERE c_acctbal > 0")


@query("derived_columns", "PRJ5 PRJ6 PRJ11", """
    SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber AS line_no,
           l_extendedprice * (1 - l_discount) AS net, l_extendedprice / l_quantity AS unit_price
    FROM lineitem""")
def derived_columns(t):
    added = P.derive_columns(t.lineitem, {
        "net": F.col("l_extendedprice") * (1 - F.col("l_discount")),
        "unit_price": F.col("l_extendedprice") / F.col("l_quantity")})
    renamed = P.rename_columns(added, {"l_linenumber": "line_no", "not_there": "ignored"})
    return renamed.select("l_orderkey", "l_partkey", "l_suppkey", "line_no", "net", "unit_price")


@query("drop_by_pattern", "PRJ7", """
    SELECT s_suppkey, s_acctbal, s_nationkey FROM supplier""")
def drop_by_pattern(t):
    return P.drop_columns(t.supplier, "not_there", suffix="name")


@query("normalize_columns", "PRJ8 SNK12", """
    SELECT p_partkey, p_size AS size, p_retailprice AS retail_price FROM part""")
def normalize_columns(t):
    odd = t.part.select(F.col("p_partkey").alias("P_PartKey"), F.col("p_size").alias("Size(L)"),
                        F.col("p_retailprice").alias("Retail Price"))
    return P.normalize_names(odd)


@query("casts", "PRJ9", """
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(trunc(o_totalprice) AS INTEGER) AS whole_price,
           TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rank_no,
           TRY_CAST(o_orderstatus AS DOUBLE) IS NULL AS is_text
    FROM orders""")
def casts(t):
    source = t.orders.select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("whole_price"),
                             F.substring("o_orderpriority", 1, 1).alias("rank_no"),
                             F.col("o_orderstatus").alias("no_number"))
    cast = P.cast_columns(source, {"o_custkey": "string", "whole_price": "int", "rank_no": "int",
                                   "no_number": "double"})
    return cast.withColumn("is_text", F.col("no_number").isNull()).drop("no_number")


@query("case_flags", "PRJ12 PRJ14 AGG17", """
    SELECT o_orderpriority, sum(CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END)::BIGINT AS large_orders,
           sum(CASE WHEN year(o_orderdate) > 1997 THEN 1 ELSE 0 END)::BIGINT AS recent_orders,
           DATE '2024-01-31' AS work_day
    FROM orders GROUP BY o_orderpriority""")
def case_flags(t):
    flagged = P.derive_columns(t.orders, {
        "large": P.flag(F.col("o_totalprice") > 200000),
        "recent": P.flag(F.year("o_orderdate") > 1997)})
    return (flagged.groupBy("o_orderpriority")
            .agg(F.sum("large").alias("large_orders"), F.sum("recent").alias("recent_orders"))
            .transform(P.with_work_date, date(2024, 1, 31), "work_day"))


# filters and missing data

@query("filter_eq", "FLT1", "SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'")
def filter_eq(t):
    return M.keep(t.orders, F.col("o_orderpriority") == "1-URGENT")


@query("filter_sql", "FLT2",
       "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R'")
def filter_sql(t):
    return M.keep(t.lineitem, "l_quantity > 45 AND l_returnflag = 'R'").select(
        "l_orderkey", "l_partkey", "l_quantity")


@query("filter_and", "FLT3", """
    SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING' AND c_acctbal < 1000""")
def filter_and(t):
    customer = t.customer
    return M.keep(customer, (customer.c_mktsegment == "BUILDING") & (customer.c_acctbal < 1000)).select(
        "c_custkey", "c_acctbal")


@query("filter_like", "FLT4 STR3", "SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE '%ring%'")
def filter_like(t):
    return M.keep(t.part, M.matches_ignoring_case("p_name", "%RING%")).select("p_partkey", "p_name")


@query("filter_null", "FLT5", """
    SELECT o_orderkey, o_totalprice FROM (
        SELECT o_orderkey, o_totalprice, nullif(o_orderstatus, 'P') AS status FROM orders)
    WHERE status IS NULL""")
def filter_null(t):
    return (t.orders.withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
            .where(F.col("status").isNull()).select("o_orderkey", "o_totalprice"))


@query("filter_count", "FLT6 AGG20", """
    SELECT count(*) AS cheap_promo FROM part WHERE p_type = 'PROMO' AND p_retailprice < 1000""")
def filter_count(t):
    return (M.keep(t.part, F.col("p_type") == "PROMO", F.col("p_retailprice") < 1000)
            .agg(F.count(F.lit(1)).alias("cheap_promo")))


@query("replace_values", "FLT7 FLT8", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE o_orderstatus END
               AS o_orderstatus,
           CASE o_orderpriority WHEN '5-LOW' THEN '5' ELSE o_orderpriority END AS o_orderpriority
    FROM orders""")
def replace_values(t):
    source = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    everywhere = M.replace_values(source, {"5-LOW": "5"})
    return M.replace_values(everywhere, {"F": "final", "O": "open"}, subset=["o_orderstatus"])


def _with_gaps(t):
    """The given tables hold no NULLs, so two columns lose one value each."""
    return t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"),
                           F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"), "o_totalprice")


_GAPS = """(SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status,
                   nullif(o_orderpriority, '5-LOW') AS priority, o_totalprice FROM orders)"""


@query("fill_missing", "FLT9", f"""
    SELECT o_orderkey, coalesce(status, 'unknown') AS status, coalesce(priority, 'none') AS priority,
           o_totalprice FROM {_GAPS}""")
def fill_missing(t):
    gaps = _with_gaps(t)
    named = [c for c in gaps.columns if c.startswith("stat")]
    return M.fill_missing(M.fill_missing(gaps, "unknown", named), "none")


@query("drop_missing", "FLT10", f"""
    SELECT o_orderkey, 'both' AS kept FROM {_GAPS} WHERE status IS NOT NULL AND priority IS NOT NULL
    UNION ALL
    SELECT o_orderkey, 'either' AS kept FROM {_GAPS} WHERE status IS NOT NULL OR priority IS NOT NULL""")
def drop_missing(t):
    gaps = _with_gaps(t)
    both = M.drop_missing(gaps, subset=["status", "priority"])
    either = M.drop_missing(gaps, subset=["status", "priority"], at_least=1)
    return O.union_all(both.select("o_orderkey", F.lit("both").alias("kept")),
                       either.select("o_orderkey", F.lit("either").alias("kept")))


@query("null_profile", "FLT11", f"""
    SELECT avg(CASE WHEN o_orderkey IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS null_share_o_orderkey,
           avg(CASE WHEN status IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS null_share_status,
           avg(CASE WHEN priority IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS null_share_priority,
           avg(CASE WHEN o_totalprice IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS null_share_o_totalprice
    FROM {_GAPS}""")
def null_profile(t):
    return M.null_profile(_with_gaps(t))


@query("distinct_rows", "FLT12", "SELECT DISTINCT l_returnflag, l_linestatus, l_quantity FROM lineitem")
def distinct_rows(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity").distinct()


@query("dedup_by_key", "FLT13", """
    SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""")
def dedup_by_key(t):
    source = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return M.dedup_by_key(source, ["o_custkey"], [F.desc("o_orderdate"), F.asc("o_orderkey")])


@query("sample_rows", "FLT14")
def sample_rows(t):
    return M.sample_rows(t.orders, 0.5, seed=42)


@query("sample_facts", "FLT14", "SELECT true AS is_subset, true AS is_unique, true AS is_half")
def sample_facts(t):
    """The sample holds only given rows, each once, and its size is within five deviations of the half."""
    sampled = sample_rows(t)
    strangers = sampled.join(t.orders, list(t.orders.columns), "leftanti").agg(F.count(F.lit(1)))
    total = t.orders.agg(F.count(F.lit(1))).scalar()
    figures = sampled.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("keys"))
    return figures.select((strangers.scalar() == 0).alias("is_subset"), (F.col("n") == F.col("keys")).alias("is_unique"),
                          (F.abs(F.col("n") - total / 2) <= 5 * F.sqrt(total / 4)).alias("is_half"))


@query("row_id_unique", "PRJ13", "SELECT count(*) AS rows, count(*) AS ids FROM lineitem")
def row_id_unique(t):
    return t.lineitem.select(P.unique_row_id().alias("id")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("id").alias("ids"))


@query("sample_stable", "FLT14", """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE CAST('0x' || substr(md5('s' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) < 2147483648""")
def sample_stable(t):
    return M.sample_stable(t.orders, "o_orderkey", 0.5, seed="s").select("o_orderkey", "o_totalprice")


_DIGEST = "CAST('0x' || substr(md5('r' || CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT)"
_TIMES = " + ".join(f"CASE WHEN {_DIGEST} >= {step} THEN 1 ELSE 0 END" for step in M.poisson_steps(0.7))


@query("sample_repeated", "FLT14", f"""
    SELECT o_orderkey, o_totalprice FROM (SELECT o_orderkey, o_totalprice, unnest(generate_series(1, {_TIMES})) FROM orders)""")
def sample_repeated(t):
    return M.sample_repeated(t.orders, "o_orderkey", 0.7, seed="r").select("o_orderkey", "o_totalprice")


@query("sample_exact", "FLT14", f"""
    SELECT o_orderkey, o_orderpriority FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_DIGEST}, o_orderkey) <= 25""")
def sample_exact(t):
    return M.sample_exact(t.orders, "o_orderkey", 25, ["o_orderpriority"], seed="r").select("o_orderkey", "o_orderpriority")


# aggregation

@query("row_count", "AGG1", "SELECT count(*) AS rows FROM lineitem")
def row_count(t):
    return t.lineitem.agg(F.count(F.lit(1)).alias("rows"))


@query("group_count_desc", "AGG2 AGG19 SRT1", """
    SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1 ORDER BY 2 DESC, 1""")
def group_count_desc(t):
    return A.frequencies(t.orders, ["o_orderpriority"])


@query("count_distinct", "AGG3 AGG16", """
    SELECT count(o_custkey) AS orders, count(DISTINCT o_custkey) AS customers,
           (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY o_custkey)) AS groups
    FROM orders""")
def count_distinct(t):
    orders = t.orders
    groups = orders.groupBy("o_custkey").count().agg(F.count(F.lit(1)).alias("groups"))
    return orders.agg(F.count("o_custkey").alias("orders"), F.count_distinct("o_custkey").alias("customers"),
                      ).withColumn("groups", groups.scalar())


@query("group_count_distinct", "AGG4", """
    SELECT l_returnflag, count(*) AS count, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1""")
def group_count_distinct(t):
    return A.distinct_count(t.lineitem, ["l_returnflag"], "l_partkey", "parts")


@query("group_all_numeric", "AGG5", """
    SELECT p_type, CAST(max(p_partkey) AS BIGINT) AS p_partkey_max, max(p_size) AS p_size_max,
           max(p_retailprice) AS p_retailprice_max
    FROM part GROUP BY p_type""")
def group_all_numeric(t):
    return A.group_all_numeric(t.part, ["p_type"], "max", F.max)


@query("dict_aggs", "AGG8", """
    SELECT l_returnflag, avg(l_linenumber)::DOUBLE AS "avg(l_linenumber)", max(l_quantity) AS "max(l_quantity)",
           count(l_tax) AS "count(l_tax)"
    FROM lineitem GROUP BY l_returnflag""")
def dict_aggs(t):
    return A.group_aggregate(t.lineitem, ["l_returnflag"], {"l_linenumber": "avg", "l_quantity": "max", "l_tax": "count"})


@query("group_stats", "AGG6 AGG18", f"""
    SELECT l_returnflag, {sql_sum('l_quantity')} AS sum_qty,
           {sql_sum('l_extendedprice * (1 - l_discount)')} AS sum_net,
           {sql_mean('l_extendedprice * (1 - l_discount) * (1 + l_tax)')} AS mean_charge, max(l_quantity) AS max_qty,
           min(l_quantity) AS min_qty, {sql_mean('l_extendedprice')} AS mean_price,
           max(l_extendedprice) AS max_price, avg(l_linenumber)::DOUBLE AS "avg(l_linenumber)"
    FROM lineitem GROUP BY l_returnflag""")
def group_stats(t):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    named = A.group_aggregate(t.lineitem, ["l_returnflag"], [
        A.exact_sum("l_quantity", 2).alias("sum_qty"),
        F.round(F.sum(net), 2).alias("sum_net"), A.rounded_mean()(net * (1 + F.col("l_tax"))).alias("mean_charge"), F.max("l_quantity").alias("max_qty"),
        F.min("l_quantity").alias("min_qty"), A.rounded_mean()(F.col("l_extendedprice")).alias("mean_price"),
        F.max("l_extendedprice").alias("max_price"), F.expr("avg(l_linenumber)")])
    return named


@query("rounded_means", "AGG7 MTH1", f"""
    SELECT l_linestatus, round(avg(l_quantity), 2) AS qty, round(avg(l_extendedprice), 1) AS price
    FROM lineitem GROUP BY l_linestatus
    UNION ALL
    SELECT 'all' AS l_linestatus, round(avg(l_quantity), 2) AS qty,
           round(avg(l_extendedprice), 1) AS price
    FROM lineitem""")
def rounded_means(t):
    means = [F.round(F.avg("l_quantity"), 2).alias("qty"),
             F.round(F.avg("l_extendedprice"), 1).alias("price")]
    grouped = A.group_aggregate(t.lineitem, ["l_linestatus"], means)
    overall = A.group_aggregate(t.lineitem, [], means).withColumn("l_linestatus", F.lit("all"))
    return O.union_all(grouped, overall)


@query("group_two_keys", "AGG9", """
    SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY 1, 2""")
def group_two_keys(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("count"))


_LINE_MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("dynamic_aggs", "AGG10", "SELECT l_returnflag, " + ", ".join(
    f"{sql_mean(c)} AS {c}_avg, min({c}) AS {c}_min, max({c}) AS {c}_max" for c in _LINE_MEASURES)
    + " FROM lineitem GROUP BY l_returnflag")
def dynamic_aggs(t):
    lineitem = t.lineitem
    columns = A.numeric_columns(lineitem, exclude=["l_linenumber"], id_suffix="key")
    functions = {"avg": A.rounded_mean(), "min": F.min, "max": F.max}
    return A.group_aggregate(lineitem, ["l_returnflag"], A.build_aggregates(columns, functions))


_LINE_CONDITIONS = {"every": "true", "open": "l_linestatus = 'O'", "filled": "l_linestatus = 'F'"}


def _when_mean(column: str, condition: str) -> str:
    return sql_mean(f"CASE WHEN {condition} THEN {column} END")


@query("conditional_aggs", "AGG11", "SELECT l_returnflag, " + ", ".join(
    f"{_when_mean(c, w)} AS {c}_avg_{n}, min(CASE WHEN {w} THEN {c} END) AS {c}_min_{n}, "
    f"max(CASE WHEN {w} THEN {c} END) AS {c}_max_{n}"
    for c in _LINE_MEASURES for n, w in _LINE_CONDITIONS.items()) + " FROM lineitem GROUP BY l_returnflag")
def conditional_aggs(t):
    functions = {"avg": A.rounded_mean(), "min": F.min, "max": F.max}
    conditions = {"every": None, "open": F.col("l_linestatus") == "O", "filled": F.col("l_linestatus") == "F"}
    return A.group_aggregate(t.lineitem, ["l_returnflag"],
                             A.build_aggregates(_LINE_MEASURES, functions, conditions))


#: The statuses of the given tables, for the SQL only.
_STATUSES = ("F", "O", "P")


@query("pivot_mean", "AGG12", "SELECT o_orderpriority, " + ", ".join(
    _when_mean("o_totalprice", f"o_orderstatus = '{s}'") + f' AS "{s}"' for s in _STATUSES)
    + " FROM orders GROUP BY o_orderpriority")
def pivot_mean(t):
    return A.pivot_aggregate(t.orders, ["o_orderpriority"], "o_orderstatus", A.pivot_values(t.orders, "o_orderstatus"),
                             [A.rounded_mean()(F.col("o_totalprice"))])


@query("pivot_max", "AGG13", "SELECT o_orderpriority, " + ", ".join(
    f"max(CASE WHEN o_orderstatus = '{s}' THEN o_totalprice END) AS \"{s}\"" for s in _STATUSES)
    + " FROM orders GROUP BY o_orderpriority")
def pivot_max(t):
    return A.pivot_aggregate(t.orders, ["o_orderpriority"], "o_orderstatus", A.pivot_values(t.orders, "o_orderstatus"), [F.max("o_totalprice")])


@query("first_by_order", "AGG15", """
    SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order,
           arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS first_price
    FROM orders GROUP BY o_custkey""")
def first_by_order(t):
    return A.first_by(t.orders, ["o_custkey"], {"first_order": "o_orderkey", "first_price": "o_totalprice"},
                      F.struct("o_orderdate", "o_orderkey"))


# statistics

def _sql_describe(column: str) -> str:
    figures = {"count": f"count({column})::DOUBLE", "mean": sql_mean(column),
               "stddev": f"round(stddev_samp({column}), 6)", "min": f"min({column})::DOUBLE",
               "max": f"max({column})::DOUBLE"}
    return " UNION ALL ".join(
        f"SELECT '{column}' AS \"column\", '{stat}' AS stat, {value} AS value FROM lineitem"
        for stat, value in figures.items())


@query("describe_numeric", "STA1", " UNION ALL ".join(_sql_describe(c) for c in _LINE_MEASURES))
def describe_numeric(t):
    return S.describe_long(t.lineitem, _LINE_MEASURES)


@query("crosstab", "STA2", """
    SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F",
           count(*) FILTER (o_orderstatus = 'O') AS "O", count(*) FILTER (o_orderstatus = 'P') AS "P"
    FROM orders GROUP BY o_orderpriority""")
def crosstab(t):
    return S.crosstab_wide(t.orders, "o_orderpriority", "o_orderstatus", A.pivot_values(t.orders, "o_orderstatus"))


@query("crosstab_pairs", "STA2", """
    SELECT l_quantity, l_returnflag, count(*) AS count FROM lineitem GROUP BY 1, 2""")
def crosstab_pairs(t):
    return S.crosstab_long(t.lineitem, "l_quantity", "l_returnflag")


@query("correlation", "STA3",
       "SELECT round(corr(l_quantity, l_extendedprice), 6) AS qty_price FROM lineitem")
def correlation(t):
    return t.lineitem.agg(S.correlation("l_quantity", "l_extendedprice").alias("qty_price"))


@query("corr_matrix", "STA4", " UNION ALL ".join(
    f"SELECT '{a}' AS first, '{b}' AS second, "
    + ("1.0::DOUBLE" if a == b else f"round(corr({a}, {b}), 6)") + " AS corr FROM "
    + ("(SELECT 1)" if a == b else "lineitem")
    for a in _LINE_MEASURES for b in _LINE_MEASURES))
def corr_matrix(t):
    return S.correlation_matrix(t.lineitem, _LINE_MEASURES)


@query("frequent_items", "STA5", """
    SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1
    HAVING count(*) >= 0.2 * (SELECT count(*) FROM orders)""")
def frequent_items(t):
    return S.frequent_items(t.orders, "o_orderpriority", 0.2)


@query("frequent_items_bounded", "STA5", """
    SELECT l_linenumber, count(*) AS count FROM lineitem GROUP BY 1
    HAVING count(*) >= 0.15 * (SELECT count(*) FROM lineitem)""")
def frequent_items_bounded(t):
    return S.frequent_items_bounded(t.lineitem, "l_linenumber", 0.15)


# order and set operations

@query("limit_rows", "SRT2", "SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 100")
def limit_rows(t):
    return O.top_k(t.customer.select("c_custkey", "c_name"), 100, F.asc("c_custkey"))


@query("top_k", "SRT3", """
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def top_k(t):
    return O.top_k(t.orders.select("o_orderkey", "o_totalprice"), 10, F.desc("o_totalprice"),
                   F.asc("o_orderkey"))


@query("union_all", "SET1", """
    SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_name, s_nationkey, s_acctbal FROM supplier""")
def union_all(t):
    customers = P.select_as(t.customer, {"name": "c_name", "nation": "c_nationkey", "balance": "c_acctbal"})
    suppliers = P.select_as(t.supplier, {"balance": "s_acctbal", "name": "s_name", "nation": "s_nationkey"})
    return O.union_all(customers, suppliers)
