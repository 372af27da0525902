import pytest
from pyspark.sql import functions as F

from millrace.models import stages as M


@pytest.fixture(scope="module")
def data(spark):
    return spark.range(300).select(
        "id", (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
        F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("c")).withColumn(
        "y", 2 * F.col("a") - 3 * F.col("b") + 1)


def test_linear_finds_the_terms(data):
    prepared = M.features(["a", "b"]).transform(data)
    model = M.linear("y").fit(prepared)
    found = {r.term: round(r.estimate, 6) for r in M.coefficients(prepared, model, ["a", "b"]).collect()}
    assert found == {"a": 2.0, "b": -3.0, "intercept": 1.0}
    noisy = prepared.withColumn("y", F.col("y") + F.col("id") % 2)
    terms = M.coefficients(noisy, M.linear("y").fit(noisy), ["a", "b"]).collect()
    assert all(r.t_value is not None for r in terms)
    shrunk = M.linear("y", regularization=0.5).fit(noisy)
    assert all(r.t_value is None for r in M.coefficients(noisy, shrunk, ["a", "b"]).collect())
    scores = M.evaluate(model.transform(prepared), "y").first()
    assert scores.rmse < 1e-6 and scores.r2 > 0.999999


def test_metrics_match_their_definition(data):
    prepared = M.features(["a"]).transform(data)
    predicted = M.linear("y").fit(prepared).transform(prepared)
    scores = M.evaluate(predicted, "y").first()
    mean = predicted.agg(F.avg("y")).first()[0]
    sums = predicted.agg(F.sum((F.col("y") - F.col("prediction")) ** 2).alias("e"),
                         F.sum((F.col("y") - mean) ** 2).alias("t"), F.count(F.lit(1)).alias("n")).first()
    assert abs(scores.rmse - (sums.e / sums.n) ** 0.5) < 1e-9 and abs(scores.r2 - (1 - sums.e / sums.t)) < 1e-9
    for metric in ("rmse", "r2", "mae"):
        assert abs(M.evaluator("y", metric).evaluate(predicted) - scores[metric]) < 1e-9


def test_index_keeps_unseen_values(data, spark):
    model = M.category_index("c", "i").fit(data)
    seen = model.transform(spark.createDataFrame([("y",), ("x",), ("new",)], "c string")).collect()
    assert [r.i for r in seen] == [0.0, 1.0, 2.0]


def test_index_without_a_model(data):
    plain = M.category_index("c", "i").fit(data).transform(data).select("id", "i")
    assert plain.exceptAll(M.index_by_frequency(data, "c", "i").select("id", "i")).count() == 0


def test_index_of_unknown_values(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate([None, None, None, "a", "a", "b"])], "id int, c string")
    fitted = M.category_index("c", "i").fit(df).transform(df)
    assert sorted(map(tuple, M.index_by_frequency(df, "c", "i").select("id", "i").collect())) == sorted(
        map(tuple, fitted.select("id", "i").collect()))


def test_bins_are_even(data):
    binned = M.quantile_bins("id", "bin", 4).fit(data).transform(data)
    sizes = [r["count"] for r in binned.groupBy("bin").count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 6


def test_scaling(data):
    raw = M.features(["a"], "raw").transform(data)
    scaled = M.unpack(M.scaler("raw", "s").fit(raw).transform(raw), "s", ["v"])
    mean, deviation = scaled.agg(F.avg("v"), F.stddev_samp("v")).first()
    assert abs(mean) < 1e-9 and abs(deviation - 1) < 1e-9


def test_stages_are_stored_and_loaded(data, tmp_path):
    forest = M.forest("y", trees=5, depth=4)
    chain = M.chained(M.category_index("c", "i"), M.quantile_bins("a", "bin", 3), M.features(["b", "i", "bin"]), forest)
    fitted = M.cross_validate(data, chain, M.grid(forest, {"maxDepth": [1, 4]}), "y", folds=2)
    scores = [r.score for r in M.combination_scores(data, fitted).collect()]
    assert len(scores) == 2 and scores[1] > scores[0]
    path = str(tmp_path / "m")
    M.store(fitted.bestModel, path)
    again = M.predict(M.load(path), data, ["id"])
    assert again.exceptAll(M.predict(fitted.bestModel, data, ["id"])).count() == 0


def test_formula(data):
    modelled = M.formula("y ~ a + c").fit(data).transform(data)
    assert modelled.select("features").first()[0].size == 2 and "label" in modelled.columns
