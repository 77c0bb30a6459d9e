"""Batch scoring and regression metrics.

A linear model is its coefficients; scoring is a projection (JVM, whole-stage
codegen, no Python worker). Spark ML models score through `transform`.
Metrics for several models come out of one aggregation over the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import linear_combination


@dataclass(frozen=True)
class LinearModel:
    """prediction = intercept + Σ weight · feature (features not listed weigh 0)."""

    intercept: float
    weights: tuple[tuple[str, float], ...]

    def prediction(self) -> Column:
        return linear_combination(self.intercept, self.weights)

    @classmethod
    def from_spark(cls, model, features: Sequence[str]) -> LinearModel:
        """From a fitted `LinearRegressionModel` (or a PipelineModel ending in one)."""
        stage = model.stages[-1] if hasattr(model, "stages") else model
        coef = stage.coefficients.toArray().tolist()
        return cls(float(stage.intercept), tuple(zip(features, map(float, coef))))


def score(df: DataFrame, model, target: str | None = None, features: Sequence[str] = (),
          prediction_col: str = "prediction", round_to: int | None = None) -> DataFrame:
    """Add the prediction (and `abs_error` when the target is given).

    `model` is a LinearModel (column arithmetic) or a fitted Spark ML
    PipelineModel over `features` (its `transform`, then the helper columns are
    dropped).
    """
    if isinstance(model, LinearModel):
        pred = model.prediction()
        if round_to is not None:
            pred = F.bround(pred, round_to)
        out = df.withColumn(prediction_col, pred)
    else:
        cols = df.columns
        out = model.transform(df).select(*cols, F.col("prediction").alias(prediction_col))
        if round_to is not None:
            out = out.withColumn(prediction_col, F.bround(prediction_col, round_to))
    if target is not None:
        out = out.withColumn("abs_error", F.abs(F.col(target) - F.col(prediction_col)))
    return out


def regression_metrics(df: DataFrame, target: str, models: Mapping[str, LinearModel]
                       ) -> DataFrame:
    """(model, model_order, n_rows, rmse, mae) for every model, in one pass."""
    y = F.col(target)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, (_, m) in enumerate(models.items()):
        err = y - m.prediction()
        aggs += [F.avg(err * err).alias(f"_mse{i}"), F.avg(F.abs(err)).alias(f"_mae{i}")]
    one = df.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(name).alias("model"), F.lit(i).alias("model_order"),
                 F.sqrt(F.col(f"_mse{i}")).alias("rmse"), F.col(f"_mae{i}").alias("mae"))
        for i, name in enumerate(models)])
    return one.select("n_rows", F.inline(rows)).select(
        "model", "model_order", "n_rows", "rmse", "mae")


def best_model(metrics: DataFrame) -> DataFrame:
    """(best_model, rmse): smallest RMSE, the first listed model on ties."""
    return metrics.agg(
        F.min_by("model", F.struct("rmse", "model_order")).alias("best_model"),
        F.min("rmse").alias("rmse"))


def performance(scored: DataFrame, train_metrics: DataFrame, group_col: str = "model",
                error_col: str = "abs_error") -> DataFrame:
    """(group, train_mae, window_mae, mae_ratio): mean absolute error of the scored
    window against the training MAE of the same model (null ratio for a 0 or
    missing training MAE)."""
    window = scored.groupBy(group_col).agg(F.avg(error_col).alias("window_mae"),
                                           F.count(F.lit(1)).alias("n_rows"))
    return (window.join(train_metrics.select(group_col, F.col("mae").alias("train_mae")),
                        group_col, "left")
            .select(group_col, "n_rows", "train_mae", "window_mae",
                    F.try_divide(F.col("window_mae"), F.col("train_mae")).alias("mae_ratio")))


def window_performance(rows: DataFrame, target: str, models: Mapping[str, LinearModel],
                       trained_on: Column, watched: Column) -> DataFrame:
    """(model, n_rows, train_mae, window_mae, mae_ratio) of every model from one aggregation:
    the error on the rows `trained_on` holds for (the hold-out) and on those `watched` does."""
    aggs = [F.count_if(watched).alias("n_rows")]
    for i, m in enumerate(models.values()):
        err = F.abs(F.col(target) - m.prediction())
        aggs += [F.avg(F.when(trained_on, err)).alias(f"_train{i}"),
                 F.avg(F.when(watched, err)).alias(f"_window{i}")]
    each = F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(f"_train{i}").alias("train_mae"),
                 F.col(f"_window{i}").alias("window_mae"),
                 F.try_divide(F.col(f"_window{i}"), F.col(f"_train{i}")).alias("mae_ratio"))
        for i, name in enumerate(models)])
    return rows.agg(*aggs).select("n_rows", F.inline(each)).select(
        "model", "n_rows", "train_mae", "window_mae", "mae_ratio")


def stack_predictions(df: DataFrame, models: Mapping[str, LinearModel], target: str,
                      keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., model, prediction, abs_error): every row scored by every model."""
    preds = F.array(*[F.struct(F.lit(n).alias("model"), m.prediction().alias("prediction"))
                      for n, m in models.items()])
    return (df.select(*keep, target, F.inline(preds))
            .withColumn("abs_error", F.abs(F.col(target) - F.col("prediction"))))
