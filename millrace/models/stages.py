"""Feature stages, estimators and evaluation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import (QuantileDiscretizer, RFormula, StandardScaler, StringIndexer,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.windows import row_numbers


def category_index(column: str, output: str) -> StringIndexer:
    """Index by falling frequency; unseen values get an index of their own.

    The fitted model holds every distinct value, so the column must be a
    category; ``index_by_frequency`` has no such bound.
    """
    return StringIndexer(inputCol=column, outputCol=output, handleInvalid="keep")


def index_by_frequency(df: DataFrame, column: str, output: str) -> DataFrame:
    """The same index for any number of distinct values, without a model on the driver.

    Unknown values get the index after the last, as in the fitted one.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    numbered = row_numbers(counted, [], [F.desc("_n"), F.asc(column)], "_i")
    index = numbered.select(F.col(column), (F.col("_i") - 1).cast("double").alias(output))
    last = numbered.agg(F.count(F.lit(1)).cast("double")).scalar()
    return df.join(index, column, "left").withColumn(output, F.coalesce(F.col(output), last))


def quantile_bins(column: str, output: str, bins: int, error: float = 0.001) -> QuantileDiscretizer:
    """Bins of about equal size; NULL and NaN get a bin of their own."""
    return QuantileDiscretizer(inputCol=column, outputCol=output, numBuckets=bins, relativeError=error,
                               handleInvalid="keep")


def features(columns: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output)


def scaler(column: str, output: str) -> StandardScaler:
    """Centre and scale an assembled vector."""
    return StandardScaler(inputCol=column, outputCol=output, withMean=True, withStd=True)


def formula(text: str) -> RFormula:
    """Label and features from a formula such as ``y ~ a + b``."""
    return RFormula(formula=text)


def unpack(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Vector elements as plain columns."""
    values = df.withColumn("_v", vector_to_array(vector))
    return values.withColumns({n: F.col("_v")[i] for i, n in enumerate(names)}).drop("_v", vector)


def linear(label: str, elastic_net: float = 0.5, iterations: int = 50, regularization: float = 0.0,
           **params) -> LinearRegression:
    """Linear regression; the elastic-net mix acts once the regularization is above 0."""
    return LinearRegression(labelCol=label, elasticNetParam=elastic_net, maxIter=iterations,
                            regParam=regularization, **params)


def coefficients(df: DataFrame, model: LinearRegressionModel, names: Sequence[str]) -> DataFrame:
    """Terms of a fitted model with their t-values where the solver has them."""
    t_values = list(model.summary.tValues) if model.summary is not None and model.getRegParam() == 0 else []
    estimates = [*model.coefficients, model.intercept]
    rows = [(n, float(e), float(t_values[i]) if i < len(t_values) else None)
            for i, (n, e) in enumerate(zip([*names, "intercept"], estimates))]
    return df.sparkSession.createDataFrame(rows, "term string, estimate double, t_value double")


def forest(label: str, trees: int = 20, depth: int = 5, seed: int = 7, **params) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, **params)


def evaluate(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """One row with rmse, r2 and mae, all from a single pass over the predictions."""
    error = F.col(label) - F.col(prediction)
    return df.agg(F.sqrt(F.avg(error * error)).alias("rmse"),
                  (1 - F.avg(error * error) / F.var_pop(label)).alias("r2"),
                  F.avg(F.abs(error)).alias("mae"))


def evaluator(label: str, metric: str, prediction: str = "prediction") -> RegressionEvaluator:
    """The evaluator that model selection needs."""
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName=metric)


def grid(estimator, values: Mapping[str, Sequence]) -> list:
    """All combinations of the parameter values of one estimator."""
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(estimator.getParam(name), list(options))
    return builder.build()


def cross_validate(df: DataFrame, estimator, param_maps: Sequence, label: str, metric: str = "r2",
                   folds: int = 3, seed: int = 7, parallelism: int = 4) -> CrossValidatorModel:
    """Fit every parameter combination on every fold and refit the best on all rows."""
    validator = CrossValidator(estimator=estimator, estimatorParamMaps=list(param_maps),
                               evaluator=evaluator(label, metric),
                               numFolds=folds, seed=seed, parallelism=parallelism)
    return validator.fit(df)


def combination_scores(df: DataFrame, fitted: CrossValidatorModel) -> DataFrame:
    """Mean metric of each parameter combination."""
    rows = []
    for params, score in zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics):
        named = ", ".join(f"{p.name}={v}" for p, v in sorted(params.items(), key=lambda e: e[0].name))
        rows.append((named, float(score)))
    return df.sparkSession.createDataFrame(rows, "params string, score double")


def chained(*stages) -> Pipeline:
    return Pipeline(stages=list(stages))


def store(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict(model: Transformer, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return model.transform(df).select(*columns, "prediction")
