"""Sketches: stated errors on skewed, tied, tiny and empty data; merging; the stored table."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import kll
from tidemark.operators import drift as D
from tidemark.operators import profile as P
from tidemark.operators import sketches as K
from tidemark.operators.timeline import time_cutoff

FEATURES = ["skewed", "tied", "negative", "empty"]


@pytest.fixture(scope="module")
def sides(spark):
    """Two frames of 60,000 rows: heavy tails, few values, values around zero, no value."""
    def frame(seed, shift):
        return spark.range(0, 60_000, 1, 6).select(
            F.exp(F.randn(seed) + shift).alias("skewed"),
            F.floor(F.rand(seed + 1) * (5 + 3 * shift)).cast("double").alias("tied"),
            (F.rand(seed + 2) - 0.5 - shift).alias("negative"),
            F.lit(None).cast("double").alias("empty"),
            F.expr("date'2024-01-01' + cast(id % 9 as int)").cast("timestamp").alias("ts"))
    from tidemark.sources.tables import materialize
    return materialize(frame(1, 0.0)), materialize(frame(7, 0.3))


def test_small_data_is_exact(spark):
    df = spark.createDataFrame([(float(v),) for v in [5, 1, 1, 2, 9, 9, 9, 4, 3, 0]], "x double")
    sketch = K.feature_sketches(df, ["x"])
    exact = P.quantile_edges(df, ["x"]).first()["edges"]
    assert K.sketch_edges(sketch, ["x"]).first()["edges"] == exact
    assert P.quantile_edges(df, ["x"], exact=False).first()["edges"] == exact


def test_edges_are_within_the_rank_error(sides):
    ref, _ = sides
    edges = K.sketch_edges(K.feature_sketches(ref, FEATURES), FEATURES)
    got = {r["feature"]: r["edges"] for r in edges.collect()}
    assert got["empty"] == [0.0]
    data = ref.toPandas()
    for f in FEATURES[:3]:
        v = np.sort(data[f].to_numpy())
        for p, e in zip(np.arange(1, 10) / 10, got[f] if f != "tied" else []):
            assert np.searchsorted(v, e) / len(v) - kll.RANK_ERROR <= p
            assert np.searchsorted(v, e, "right") / len(v) + kll.RANK_ERROR >= p
    assert set(got["tied"]) <= set(data["tied"])


def test_drift_limits_hold(sides):
    ref, new = sides
    edges = P.quantile_edges(ref, FEATURES)
    exact_psi = {r["feature"]: r["psi"] for r in D.psi(
        new, FEATURES, P.baseline_profile(ref, FEATURES, edges=edges)).collect()}
    exact_ks = {r["feature"]: r["ks"] for r in D.ks_statistic(ref, new, FEATURES).collect()}
    out = K.sketch_drift(K.feature_sketches(ref, FEATURES), K.feature_sketches(new, FEATURES), edges)
    for r in out.collect():
        f = r["feature"]
        if f == "empty":
            assert (r["psi"], r["ks"], r["status"], r["n_new"]) == (None, None, "no_data", None)
            continue
        assert r["psi_low"] <= exact_psi[f] <= r["psi_high"]
        if f == "skewed":  # every bin has a share on both sides: the limits are narrow
            assert r["psi_high"] - r["psi_low"] < 0.1
        assert abs(r["ks"] - exact_ks[f]) <= K.KS_ERROR
        assert r["n_reference"] == r["n_new"] == 60_000


def test_psi_limits_hold_for_any_shares(spark):
    rng = np.random.default_rng(4)
    e, a = rng.random((2, 400)) ** 4
    off = (rng.random((2, 400)) * 2 - 1) * 0.004
    df = spark.createDataFrame([(float(w), float(x), float(y), float(z)) for w, x, y, z in zip(
        e, a, np.clip(e + off[0], 0, 1), np.clip(a + off[1], 0, 1))],
        "e double, a double, true_e double, true_a double")
    low, high = K.psi_limits(F.col("e"), F.col("a"), 0.004)
    te, ta = (F.greatest(F.col(c), F.lit(D.PSI_EPS)) for c in ("true_e", "true_a"))
    wrong = df.select(low.alias("low"), high.alias("high"), ((ta - te) * F.ln(ta / te)).alias("t"))
    assert wrong.filter("t < low - 1e-12 or t > high + 1e-12").count() == 0


def test_days_merge_to_any_range(sides):
    ref, _ = sides
    days = K.daily_sketches(ref, FEATURES, "ts")
    assert days.count() == 9 * 3
    some = days.filter("day between date'2024-01-03' and date'2024-01-06'")
    whole = K.feature_sketches(ref.filter("ts between '2024-01-03' and '2024-01-06'"), FEATURES)
    both = K.merged(some).withColumnRenamed("sketch", "m").join(
        whole.withColumnRenamed("n", "n_whole"), "feature")
    for r in both.select("n", "n_whole", K.ks_between(kll.grid("m"), kll.grid("sketch")).alias("d")
                         ).collect():
        assert r["n"] == r["n_whole"] and r["d"] <= K.KS_ERROR


def test_profile_of_sketches(sides):
    ref, new = sides
    edges = P.quantile_edges(ref, FEATURES)
    got = K.sketch_profile(K.feature_sketches(new, FEATURES), edges)
    exact = P.baseline_profile(new, FEATURES, edges=edges)
    both = got.join(exact.select("feature", "bin", "expected_pct"), ["feature", "bin"])
    assert both.count() == exact.count()
    assert both.filter(F.abs(F.col("pct") - F.col("expected_pct")) > K.SHARE_ERROR).count() == 0


def test_cutoff_of_a_sketch(sides, spark):
    ref, _ = sides
    assert time_cutoff(ref, "ts", 0.7, exact=False).first() == time_cutoff(ref, "ts", 0.7).first()
    assert time_cutoff(ref.limit(0), "ts", exact=False).count() == 0


def test_rank_bounds(spark):
    long = spark.createDataFrame([("x", float(v)) for v in [1, 1, 2, 3, 3, 3, 7]] + [("y", 4.0)],
                                 "feature string, value double")
    points = spark.createDataFrame([("x", [0.0, 1.0, 2.5, 3.0, 9.0]), ("y", [4.0])],
                                   "feature string, points array<double>")
    got = {r["feature"]: (r["total"], r["below"], r["at_most"])
           for r in K.rank_bounds(long, points).collect()}
    assert got == {"x": (7, [0, 0, 3, 3, 7], [0, 2, 3, 6, 7]), "y": (1, [0], [1])}
