import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift as D
from tidemark.operators import profile as P
from tidemark.operators.clean import TRIP_FEATURES
from tidemark.plans.datasets import build_silver
from tidemark.sources.adapters import trips_from_events


def _one(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} double")


def _ks_numpy(a, b):
    a, b = np.sort(a), np.sort(b)
    grid = np.concatenate([a, b])
    fa = np.searchsorted(a, grid, side="right") / len(a)
    fb = np.searchsorted(b, grid, side="right") / len(b)
    return float(np.max(np.abs(fa - fb)))


def test_edges_are_sorted_distinct_deciles(spark):
    df = _one(spark, [float(i % 4) for i in range(100)])
    edges = P.quantile_edges(df, ["x"]).first()["edges"]
    assert edges == sorted(set(edges)) and len(edges) <= 9


def test_constant_feature_gives_one_edge_two_bins(spark):
    df = _one(spark, [5.0] * 20)
    prof = P.baseline_profile(df, ["x"]).orderBy("bin").collect()
    assert [r["expected_count"] for r in prof] == [0, 20]
    assert prof[1]["lower"] == 5.0 and prof[0]["upper"] == 5.0


def test_feature_without_values_gets_zero_edge(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert P.quantile_edges(df, ["x"]).first()["edges"] == [0.0]


def test_value_on_edge_goes_to_upper_bin_and_counts_sum(spark):
    df = _one(spark, [0.0, 1.0, 1.0, 2.0, 3.0, None, float("nan")])
    edges = spark.createDataFrame([("x", [1.0, 2.0])], "feature string, edges array<double>")
    counts = {r["bin"]: r["count"] for r in P.bin_counts(df, ["x"], edges).collect()}
    assert counts == {0: 1, 1: 2, 2: 2}


def test_psi_zero_on_identical_and_symmetric(spark):
    rng = np.random.default_rng(1)
    a = _one(spark, rng.normal(size=2000).tolist())
    b = _one(spark, rng.normal(0.5, 1.2, size=2000).tolist())
    prof_a = P.baseline_profile(a, ["x"])
    assert D.psi(a, ["x"], prof_a).first()["psi"] == pytest.approx(0.0, abs=1e-12)
    # symmetric in its arguments on fixed bins
    ea = P.bin_counts(a, ["x"], P.profile_edges(prof_a))
    eb = P.bin_counts(b, ["x"], P.profile_edges(prof_a))
    sa = P.with_shares(ea, "count", "expected_pct")
    sb = P.with_shares(eb, "count", "actual_pct")
    ab = D.psi_from_bins(sa, sb).first()["psi"]
    ba = D.psi_from_bins(sb.withColumnRenamed("actual_pct", "expected_pct"),
                         sa.withColumnRenamed("expected_pct", "actual_pct")).first()["psi"]
    assert ab == pytest.approx(ba, rel=1e-12) and ab > 0


def test_status_limits():
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    df = spark.createDataFrame([(0.05,), (0.1,), (0.2,), (0.25,), (float("nan"),), (None,)],
                               "psi double")
    got = [r[0] for r in df.select(D.psi_status(F.col("psi"))).collect()]
    assert got == ["ok", "warning", "warning", "alert", "alert", "no_data"]


def test_ks_matches_numpy_and_bounds(spark):
    rng = np.random.default_rng(5)
    a = np.round(rng.normal(size=1500), 2)
    b = np.round(rng.normal(0.2, 1.0, size=900), 2)
    got = D.ks_statistic(_one(spark, a.tolist()), _one(spark, b.tolist()), ["x"]).first()["ks"]
    assert got == pytest.approx(_ks_numpy(a, b), abs=1e-12)
    same = D.ks_statistic(_one(spark, a.tolist()), _one(spark, a.tolist()), ["x"]).first()["ks"]
    assert same == 0.0
    far = D.ks_statistic(_one(spark, [1.0, 2.0]), _one(spark, [5.0, 6.0]), ["x"]).first()["ks"]
    assert far == 1.0


def test_report_on_test_events_matches_fixture_values(spark, events_check):
    s = build_silver(trips_from_events(events_check))
    ref, new = s.filter("window = 'reference'"), s.filter("window = 'new'")
    prof = P.baseline_profile(ref, TRIP_FEATURES)
    rep = {r["feature"]: r for r in
           D.drift_report(ref, new, TRIP_FEATURES, prof, digits=None).collect()}
    assert rep["trip_distance"]["psi"] == pytest.approx(0.001031608, abs=1e-9)
    assert rep["pickup_dow"]["ks"] == pytest.approx(0.136733275, abs=1e-9)
    assert [rep[f]["status"] for f in TRIP_FEATURES] == ["ok", "ok", "ok", "warning"]
    scaled = D.scale_columns(new, {"trip_distance": 3.0, "duration_min": 3.0})
    rep3 = {r["feature"]: r for r in
            D.drift_report(ref, scaled, TRIP_FEATURES, prof, digits=None).collect()}
    assert rep3["duration_min"]["psi"] == pytest.approx(1.859609142, abs=1e-9)
    assert sorted(r["feature"] for r in D.alerts(
        D.drift_report(ref, scaled, TRIP_FEATURES, prof)).collect()) == \
        ["duration_min", "trip_distance"]


def test_drift_is_independent_of_partitioning(spark, events_small):
    s = build_silver(trips_from_events(events_small))
    outs = []
    for parts in (1, 4, 7):
        r = s.repartition(parts)
        ref, new = r.filter("window = 'reference'"), r.filter("window = 'new'")
        rep = D.drift_report(ref, new, TRIP_FEATURES, P.baseline_profile(ref, TRIP_FEATURES))
        outs.append(sorted(map(tuple, rep.collect())))
    assert outs[0] == outs[1] == outs[2]


def test_sample_is_bottom_k_by_hash_and_partition_independent(spark):
    rows = [(i, float(i % 37)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, x double")
    import hashlib
    want = sorted(sorted(rows, key=lambda r: (hashlib.md5(str(r[0]).encode()).hexdigest(),
                                              r[1]))[:100], key=lambda r: r[1])
    for parts in (1, 5):
        got = P.sample_values(df.repartition(parts), ["x"], ["k"], k=100).collect()
        assert sorted(r["value"] for r in got) == sorted(r[1] for r in want)


def test_sample_keeps_repeated_rows(spark):
    df = spark.createDataFrame([(1, 2.0)] * 50 + [(2, 3.0)], "k long, x double")
    got = sorted(r["value"] for r in P.sample_values(df, ["x"], ["k"], k=10).collect())
    assert len(got) == 10


def test_sample_and_split_ignore_partitioning_with_repeated_times(spark, events_small):
    """Pickups cut to the hour: only all columns together tell rows apart."""
    from tidemark.plans import datasets as ds
    s = build_silver(trips_from_events(events_small)).withColumn(
        "pickup_ts", F.date_trunc("hour", "pickup_ts")).distinct()
    assert s.select("pickup_ts").distinct().count() < s.count()
    seen = []
    for parts in (1, 6):
        r = s.repartition(parts).withColumns({f"_k{i}": c for i, c in enumerate(ds.trip_key())})
        keys = [c for c in r.columns if c.startswith("_k")]
        sample = sorted(map(tuple, P.sample_values(r, TRIP_FEATURES, keys, k=50).collect()))
        signature = sorted(map(tuple, ds.signature_rows(r, 40).collect()))
        split = sorted(map(tuple, ds.with_split(r).collect()))
        seen.append((sample, signature, split))
    assert seen[0] == seen[1]
    hours = {v for f, v in seen[0][0] if f == "pickup_hour"}
    assert len(hours) > 12  # a sample of rows, not of a few hours


def test_sample_is_a_rank_limit_on_one_scan(spark, events_small):
    path = "/root/testdata/sf0.001/events.parquet"
    df = spark.read.parquet(path).selectExpr("event_id as k", "value as x")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "10000")
    plan = P.sample_values(df, ["x"], ["k"], k=2000)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.count("FileScan") == 1


@pytest.mark.parametrize("old,new", [([None, None], [1.0, 2.0]), ([1.0, 2.0], [None]),
                                     ([None], [None])])
def test_no_data_on_either_side(spark, old, new):
    ref, act = _one(spark, old), _one(spark, new)
    row = D.psi(act, ["x"], P.baseline_profile(ref, ["x"])).first()
    assert row["psi"] is None
    both = (ref.withColumn("window", F.lit("reference"))
            .unionByName(act.withColumn("window", F.lit("new"))))
    report = D.window_drift(both, ["x"]).first()
    assert (report["psi"], report["ks"], report["status"]) == (None, None, "no_data")


def test_ks_against_stored_values_is_the_full_test(spark):
    rng = np.random.default_rng(6)
    a, b = np.round(rng.normal(size=3000), 2), np.round(rng.normal(0.1, 1, size=700), 2)
    stored = P.baseline_values(_one(spark, a.tolist()), ["x"])
    new = P.baseline_values(_one(spark, b.tolist()), ["x"])
    got = D.ks_against_baseline(stored, new).first()["ks"]
    assert got == pytest.approx(_ks_numpy(a, b), abs=1e-12)


def test_more_bins_than_any_fixed_limit(spark):
    df = _one(spark, [float(i) for i in range(1000)])
    prof = P.baseline_profile(df, ["x"], n_bins=200)
    assert prof.count() == 200
    assert D.psi(df, ["x"], prof).first()["psi"] == pytest.approx(0.0, abs=1e-12)
