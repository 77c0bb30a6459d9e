"""Spark ML training: assembler + estimator pipelines, hold-out metrics, best model.

Training runs distributed in the JVM (Spark ML). The split is a hash split on a
row key (`split` column, see `plans.datasets.with_split`), so it is the same for
every run and every partitioning. The training rows are assembled into feature
vectors once, and these are persisted for the iterative estimators and released
afterwards; the hold-out metrics of all models come from one pass over the test rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_SEED = 42
# The three estimators and their settings, in preference order.
ESTIMATORS = ("linear_regression", "random_forest", "gbt")


def estimator(name: str, target: str, seed: int = DEFAULT_SEED):
    if name == "linear_regression":
        return LinearRegression(labelCol=target, featuresCol="features")
    if name == "random_forest":
        return RandomForestRegressor(labelCol=target, featuresCol="features", numTrees=50,
                                     maxDepth=8, seed=seed)
    if name == "gbt":
        return GBTRegressor(labelCol=target, featuresCol="features", maxIter=40, maxDepth=5,
                            seed=seed)
    raise ValueError(f"unknown model {name!r}; expected one of {list(ESTIMATORS)}")


def assembler(features: Sequence[str]) -> VectorAssembler:
    """Feature vector; rows with a null or NaN feature are skipped."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")


def fit(train: DataFrame, features: Sequence[str], target: str, name: str,
        seed: int = DEFAULT_SEED) -> PipelineModel:
    return Pipeline(stages=[assembler(features), estimator(name, target, seed)]).fit(
        train.select(*features, target))


@dataclass(frozen=True)
class TrainResult:
    name: str
    order: int
    model: PipelineModel
    n_rows: int
    rmse: float
    mae: float


def hold_out_metrics(models: Mapping[str, PipelineModel], test: DataFrame, target: str
                     ) -> dict[str, tuple[int, float, float]]:
    """(n_rows, rmse, mae) of every model on `test`, one aggregation for all of them."""
    scored = test
    for i, model in enumerate(models.values()):
        scored = model.transform(scored).select(
            *scored.columns, F.col("prediction").alias(f"_p{i}"))
    aggs = []
    for i in range(len(models)):
        err = F.col(target) - F.col(f"_p{i}")
        aggs += [F.count(f"_p{i}").alias(f"n{i}"), F.sqrt(F.avg(err * err)).alias(f"rmse{i}"),
                 F.avg(F.abs(err)).alias(f"mae{i}")]
    row = scored.agg(*aggs).first()
    return {name: (row[f"n{i}"], row[f"rmse{i}"], row[f"mae{i}"])
            for i, name in enumerate(models)}


def train_models(split: DataFrame, features: Sequence[str], target: str,
                 names: Sequence[str] = ESTIMATORS, seed: int = DEFAULT_SEED,
                 engine: str = "spark") -> dict[str, TrainResult]:
    """Fit every estimator on `split == 'train'`, evaluate on `split == 'test'`."""
    if engine != "spark":
        raise ValueError(f"unknown engine {engine!r}; only 'spark' is available")
    for n in names:
        estimator(n, target)  # validates names before any job runs
    cols = [*features, target]
    vectors = assembler(features)
    train = vectors.transform(split.filter(F.col("split") == "train").select(*cols)).select(
        "features", target).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        models = {n: PipelineModel([vectors, estimator(n, target, seed).fit(train)])
                  for n in names}
    finally:
        train.unpersist()
    test = split.filter(F.col("split") == "test").select(*cols)
    metrics = hold_out_metrics(models, test, target)
    return {n: TrainResult(n, i, models[n], *metrics[n]) for i, n in enumerate(names)}


def best_result(results: Mapping[str, TrainResult]) -> TrainResult:
    """The smallest RMSE, the first listed on ties."""
    return min(results.values(), key=lambda r: (r.rmse, r.order))


def results_frame(spark: SparkSession, results: Mapping[str, TrainResult]) -> DataFrame:
    """(model, model_order, n_rows, rmse, mae, is_best), one row per model."""
    best = best_result(results).name
    return spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(r.name).alias("model"), F.lit(r.order).alias("model_order"),
                 F.lit(r.n_rows).cast("bigint").alias("n_rows"), F.lit(r.rmse).alias("rmse"),
                 F.lit(r.mae).alias("mae"), F.lit(r.name == best).alias("is_best"))
        for r in results.values()])))


def coefficients(spark: SparkSession, model: PipelineModel,
                 features: Sequence[str]) -> DataFrame:
    """(term, value) of a fitted linear model: intercept and one row per feature."""
    stage = model.stages[-1]
    terms = [("intercept", float(stage.intercept))] + [
        (f, float(w)) for f, w in zip(features, stage.coefficients.toArray().tolist())]
    return spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(t).alias("term"), F.lit(v).alias("value")) for t, v in terms])))
