"""Regression on the line items: the price from quantity, discount and flag."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.models import stages as M
from millrace.plans.registry import query
from millrace.workspace import new_path


@query("ml_string_index", "ML1", """
    SELECT o_orderkey, o_orderpriority, i AS priority_index FROM orders JOIN (
        SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY count(*) DESC, o_orderpriority) - 1 AS DOUBLE) AS i
        FROM orders GROUP BY 1) USING (o_orderpriority)""")
def ml_string_index(t):
    orders = t.orders.select("o_orderkey", "o_orderpriority")
    return M.category_index("o_orderpriority", "priority_index").fit(orders).transform(orders)


@query("ml_string_index_wide", "ML1", """
    SELECT p_partkey, p_name, i AS name_index FROM part JOIN (
        SELECT p_name, CAST(row_number() OVER (ORDER BY count(*) DESC, p_name) - 1 AS DOUBLE) AS i
        FROM part GROUP BY 1) USING (p_name)""")
def ml_string_index_wide(t):
    return M.index_by_frequency(t.part.select("p_partkey", "p_name"), "p_name", "name_index")


@query("ml_features", "ML2 D11", """
    SELECT l_orderkey, l_partkey, l_quantity AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem""")
def ml_features(t):
    names = ["l_quantity", "l_discount", "l_tax"]
    assembled = M.features(names).transform(t.lineitem).select("l_orderkey", "l_partkey", "features")
    return M.unpack(assembled, "features", ["f0", "f1", "f2"])


@query("ml_quantile_bins", "ML3")
def ml_quantile_bins(t):
    orders = t.orders.select("o_orderkey", "o_totalprice")
    return M.quantile_bins("o_totalprice", "bin", 10).fit(orders).transform(orders)


@query("ml_scaled", "ML4", """
    SELECT l_orderkey, l_partkey,
           round((l_quantity - (SELECT avg(l_quantity) FROM lineitem))
                 / (SELECT stddev_samp(l_quantity) FROM lineitem), 6) AS scaled
    FROM lineitem""")
def ml_scaled(t):
    lines = M.features(["l_quantity"], "raw").transform(t.lineitem)
    scaled = M.scaler("raw", "centred").fit(lines).transform(lines).select("l_orderkey", "l_partkey", "centred")
    return M.unpack(scaled, "centred", ["scaled"]).withColumn("scaled", F.round("scaled", 6))


@query("ml_formula", "ML5", """
    WITH ranked AS (SELECT o_orderstatus, row_number() OVER (ORDER BY count(*) DESC, o_orderstatus) AS r
                    FROM orders GROUP BY 1)
    SELECT o_orderkey, o_totalprice AS label, CAST(o_custkey AS DOUBLE) AS f0,
           CASE WHEN r = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS f1, CASE WHEN r = 2 THEN 1.0 ELSE 0.0 END::DOUBLE AS f2
    FROM orders JOIN ranked USING (o_orderstatus)""")
def ml_formula(t):
    orders = t.orders.select("o_orderkey", "o_totalprice", "o_custkey", "o_orderstatus")
    modelled = M.formula("o_totalprice ~ o_custkey + o_orderstatus").fit(orders).transform(orders)
    return M.unpack(modelled.select("o_orderkey", "label", "features"), "features", ["f0", "f1", "f2"])


def _linear(t):
    lines = M.features(["l_quantity", "l_discount"]).transform(
        t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_discount", "l_extendedprice"))
    return lines, M.linear("l_extendedprice").fit(lines)


#: Least squares with two features, solved from the sample covariances.
_LEAST_SQUARES = """
    WITH s AS (
        SELECT covar_samp(l_quantity, l_quantity) AS s11, covar_samp(l_discount, l_discount) AS s22,
               covar_samp(l_quantity, l_discount) AS s12, covar_samp(l_quantity, l_extendedprice) AS s1y,
               covar_samp(l_discount, l_extendedprice) AS s2y, covar_samp(l_extendedprice, l_extendedprice) AS syy,
               avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_extendedprice) AS my, count(*) AS n
        FROM lineitem),
    b AS (SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
                 (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM s)"""


@query("ml_linear", "ML6", _LEAST_SQUARES + """
    SELECT 'l_quantity' AS term, round(b1, 3) AS estimate FROM b
    UNION ALL SELECT 'l_discount', round(b2, 3) FROM b
    UNION ALL SELECT 'intercept', round(my - b1 * m1 - b2 * m2, 3) FROM b""")
def ml_linear(t):
    lines, model = _linear(t)
    return M.coefficients(lines, model, ["l_quantity", "l_discount"]).select(
        "term", F.round("estimate", 3).alias("estimate"))


@query("ml_evaluate", "ML8", _LEAST_SQUARES + """
    SELECT round(sqrt((syy - b1 * s1y - b2 * s2y) * (n - 1) / n), 3) AS rmse,
           round((b1 * s1y + b2 * s2y) / syy, 6) AS r2 FROM b""")
def ml_evaluate(t):
    lines, model = _linear(t)
    return M.evaluate(model.transform(lines), "l_extendedprice").select(
        F.round("rmse", 3).alias("rmse"), F.round("r2", 6).alias("r2"))


def _part_stages(label):
    return (M.category_index("p_type", "type_index"), M.quantile_bins("p_size", "size_bin", 5),
            M.features(["p_partkey", "type_index", "size_bin"]), M.forest(label, trees=5, depth=4))


@query("ml_forest", "ML7")
def ml_forest(t):
    model = M.chained(*_part_stages("p_retailprice")).fit(t.part)
    return M.predict(model, t.part, ["p_partkey", "p_retailprice"])


@query("ml_cross_validate", "ML9")
def ml_cross_validate(t):
    *prepare, forest = _part_stages("p_retailprice")
    parts = M.chained(*prepare).fit(t.part).transform(t.part)
    fitted = M.cross_validate(parts, forest, M.grid(forest, {"maxDepth": [2, 4], "numTrees": [3, 5]}),
                              "p_retailprice", folds=2)
    return M.combination_scores(parts, fitted)


@query("ml_stages_validated", "ML10")
def ml_stages_validated(t):
    stages = _part_stages("p_retailprice")
    fitted = M.cross_validate(t.part, M.chained(*stages), M.grid(stages[-1], {"maxDepth": [2, 4]}),
                              "p_retailprice", folds=2)
    path = new_path(t.spark, "best-model")
    M.store(fitted.bestModel, path)
    return M.predict(M.load(path), t.part, ["p_partkey", "p_retailprice"])


@query("ml_quantile_facts", "ML3", "SELECT 10 AS bins, count(*) AS rows, true AS is_even FROM orders")
def ml_quantile_facts(t):
    """Every bin is within twice the stated error of a tenth of the rows."""
    sizes = ml_quantile_bins(t).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    rows = F.sum("n")
    return sizes.agg(F.count(F.lit(1)).cast("int").alias("bins"), rows.alias("rows"),
                     (F.greatest(F.max("n") - rows / 10, rows / 10 - F.min("n")) <= rows * 0.002 + 1).alias("is_even"))


@query("ml_forest_facts", "ML7", "SELECT count(*) AS rows, true AS in_range, true AS better_than_mean FROM part")
def ml_forest_facts(t):
    """Predictions are means of labels, so they lie in the labels' range, and they beat the plain mean."""
    error = F.col("p_retailprice") - F.col("prediction")
    return ml_forest(t).agg(
        F.count(F.lit(1)).alias("rows"),
        ((F.min("prediction") >= F.min("p_retailprice")) & (F.max("prediction") <= F.max("p_retailprice"))).alias("in_range"),
        (F.avg(error * error) < F.var_pop("p_retailprice")).alias("better_than_mean"))


@query("ml_cross_validate_facts", "ML9", "SELECT 4 AS combinations, true AS is_score")
def ml_cross_validate_facts(t):
    """One score for each combination of two depths and two sizes, none above 1."""
    scores = ml_cross_validate(t)
    return scores.agg(F.count_distinct("params").cast("int").alias("combinations"), (F.max("score") <= 1).alias("is_score"))


@query("ml_stored_facts", "ML10", "SELECT count(*) AS rows, 0 AS differences FROM part")
def ml_stored_facts(t):
    """The reloaded model predicts what the stored one does."""
    model = M.chained(*_part_stages("p_retailprice")).fit(t.part)
    path = new_path(t.spark, "stored-model")
    M.store(model, path)
    stored = M.predict(model, t.part, ["p_partkey"]).withColumnRenamed("prediction", "before")
    both = stored.join(M.predict(M.load(path), t.part, ["p_partkey"]), "p_partkey")
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("before") != F.col("prediction")).cast("int").alias("differences"))
