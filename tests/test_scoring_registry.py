from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import gates as G
from tidemark.operators import registry as R
from tidemark.operators import scoring as S


def test_linear_score_and_abs_error(spark):
    df = spark.createDataFrame([(1.0, 2.0, 10.0), (3.0, 0.0, 5.0)], "a double, b double, y double")
    m = S.LinearModel(1.0, (("a", 2.0), ("b", 0.5)))
    out = S.score(df, m, target="y").collect()
    assert [r["prediction"] for r in out] == [4.0, 7.0]
    assert [r["abs_error"] for r in out] == [6.0, 2.0]


def test_metrics_and_best_model(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(0, 10, 500)
    y = 2 * x + 1 + rng.normal(0, 0.1, 500)
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist())), "x double, y double")
    models = {"good": S.LinearModel(1.0, (("x", 2.0),)), "bad": S.LinearModel(0.0, (("x", 1.0),)),
              "good_too": S.LinearModel(1.0, (("x", 2.0),))}
    m = {r["model"]: r for r in S.regression_metrics(df, "y", models).collect()}
    err = y - (2 * x + 1)
    assert m["good"]["rmse"] == pytest.approx(np.sqrt(np.mean(err ** 2)), rel=1e-9)
    assert m["good"]["mae"] == pytest.approx(np.mean(np.abs(err)), rel=1e-9)
    best = S.best_model(S.regression_metrics(df, "y", models)).first()
    assert best["best_model"] == "good"  # first listed wins the tie


@pytest.mark.parametrize("champion_rmse,new_rmse,expected", [
    (None, 2.0, "champion"), (3.0, 2.0, "champion"), (1.5, 2.0, "challenger"),
    (2.0, 2.0, "challenger")])
def test_promotion_rule(spark, champion_rmse, new_rmse, expected):
    t = datetime(2024, 1, 1)
    versions = spark.createDataFrame(
        [("m", 1, "r1", champion_rmse, 1.0), ("m", 2, "r2", new_rmse, 1.0)],
        "model_name string, version long, run_id string, rmse double, mae double")
    aliases = spark.createDataFrame([("m", "champion", 1, t)] if champion_rmse else [],
                                    "model_name string, alias string, version long, set_at timestamp")
    d = R.promotion_decision(versions, aliases).first()
    assert d["decision"] == expected and d["candidate_version"] == 2


def test_champion_without_rmse_is_replaced(spark):
    versions = spark.createDataFrame([("m", 1, "r1", None, None), ("m", 2, "r2", 9.0, 1.0)],
                                     "model_name string, version long, run_id string, rmse double, mae double")
    aliases = spark.createDataFrame([("m", "champion", 1, datetime(2024, 1, 1))],
                                    "model_name string, alias string, version long, set_at timestamp")
    assert R.promotion_decision(versions, aliases).first()["decision"] == "champion"


def test_latest_version_with_run_fallback(spark):
    versions = spark.createDataFrame(
        [("m", 1, "a", 1.0, 1.0), ("m", 2, "b", 1.0, 1.0), ("m", 3, "a", 1.0, 1.0),
         ("n", 7, "c", 1.0, 1.0)],
        "model_name string, version long, run_id string, rmse double, mae double")
    got = {r["model_name"]: r["version"] for r in R.latest_version(versions, "b").collect()}
    assert got == {"m": 2, "n": 7}
    assert {r["version"] for r in R.latest_version(versions).collect()} == {3, 7}


def test_current_alias_is_latest_move(spark):
    rows = [("m", "champion", 1, datetime(2024, 1, 1)), ("m", "champion", 3, datetime(2024, 1, 3)),
            ("m", "champion", 2, datetime(2024, 1, 2)), ("m", "challenger", 4, datetime(2024, 1, 4))]
    aliases = spark.createDataFrame(rows, "model_name string, alias string, version long, set_at timestamp")
    got = {r["alias"]: r["version"] for r in R.current_alias(aliases).collect()}
    assert got == {"champion": 3, "challenger": 4}


@pytest.mark.parametrize("rows_in,rows_out,min_rows,failed", [
    (1000, 900, 100, None), (1000, 500, 100, "too_many_dropped"), (50, 50, 100, "too_few_rows"),
    (0, 0, 0, None), (300, 20, 100, "too_few_rows, too_many_dropped")])
def test_quality_gate_cases(spark, rows_in, rows_out, min_rows, failed):
    counts = G.table_counts(spark.range(rows_in), spark.range(rows_out))
    if failed:
        with pytest.raises(G.DataQualityError, match=failed):
            G.enforce_quality(counts, min_rows, max_drop_ratio=0.2)
    else:
        row = G.enforce_quality(counts, min_rows, max_drop_ratio=0.2)
        assert (row["rows_in"], row["rows_out"]) == (rows_in, rows_out)
        assert row["dropped_ratio"] == (0.1 if rows_in else 0.0)


def test_performance_gate(spark):
    perf = spark.createDataFrame([("a", 1.0, 1.5, 1.5), ("b", 1.0, 1.2, 1.2), ("c", 0.0, 1.0, None)],
                                 "model string, train_mae double, window_mae double, mae_ratio double")
    got = {r["model"]: r["degraded"] for r in G.performance_verdict(perf).collect()}
    assert got == {"a": True, "b": False, "c": False}
    with pytest.raises(G.ModelDegraded):
        G.raise_if_degraded(perf)


def test_drift_gate_raises_with_features(spark):
    rep = spark.createDataFrame([("x", "alert"), ("y", "ok")], "feature string, status string")
    with pytest.raises(G.DriftAlert, match="x"):
        G.raise_on_alerts(rep)
    assert G.raise_on_alerts(rep.filter(F.col("status") == "ok")) == []
