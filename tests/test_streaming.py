"""The streaming request-drift job on a file stream of the test request log."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift as D
from tidemark.operators import profile as P
from tidemark.operators import requests as Q
from tidemark.operators import sketches as K
from tidemark.operators.clean import TRIP_FEATURES
from tidemark.plans.datasets import build_silver
from tidemark.sources.adapters import request_log_from_events, trips_from_events
from tidemark.sources.tables import materialize
from tidemark.streaming.request_bins import (
    start_request_drift_stream,
    start_request_sketch_stream,
    store_batch,
    window_psi,
)


def test_stream_matches_batch_bins(spark, events_small):
    silver = build_silver(trips_from_events(events_small))
    profile = P.baseline_profile(silver.filter("window = 'reference'"), TRIP_FEATURES)
    profile = materialize(profile)
    scratch = tempfile.mkdtemp(prefix="tidemark-stream-")
    src = os.path.join(scratch, "log")
    log = request_log_from_events(events_small)
    log.write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(log.schema).parquet(src)
    q = start_request_drift_stream(stream, TRIP_FEATURES, profile, "stream_psi",
                                   os.path.join(scratch, "ckpt"), window="7 days",
                                   watermark="0 seconds", min_rows=1,
                                   trigger={"availableNow": True})
    q.awaitTermination(300)
    out = spark.table("stream_psi")
    # windows close only when the watermark passes them; at least one closed
    assert out.count() >= 4
    assert set(r["feature"] for r in out.collect()) == set(TRIP_FEATURES)
    # each closed window equals the batch report over its records
    records = Q.parse_requests(log, TRIP_FEATURES)
    for w in {r["window"] for r in out.collect()}:
        inside = records.filter((F.col("request_time") >= F.lit(w["start"]))
                                & (F.col("request_time") < F.lit(w["end"])))
        batch = {r["feature"]: r["psi"] for r in D.psi(inside, TRIP_FEATURES, profile).collect()}
        for r in out.filter(F.col("window.start") == F.lit(w["start"])).collect():
            assert r["n_rows"] == inside.count()
            assert r["psi"] == pytest.approx(batch[r["feature"]], abs=1e-12)


def _profile(spark):
    return spark.createDataFrame(
        [("x", 0, None, 1.0, 5, 0.5), ("x", 1, 1.0, None, 5, 0.5), ("y", 0, None, 0.0, 0, None),
         ("y", 1, 0.0, None, 0, None)],
        "feature string, bin int, lower double, upper double, expected_count long, "
        "expected_pct double")


def _counts(spark):
    return spark.createDataFrame(
        [("w", "x", 0, 10), ("w", "x", 1, 10), ("w", "y", 0, 3), ("w", "_records", 0, 25),
         ("v", "_records", 0, 4)], "window string, feature string, bin int, count long")


def test_window_psi_counts_records_and_knows_missing_data(spark):
    got = {(r["window"], r["feature"]): (r["psi"], r["n_rows"], r["status"])
           for r in window_psi(_counts(spark), _profile(spark), ["x", "y"]).collect()}
    assert got == {("w", "x"): (0.0, 25, "ok"), ("w", "y"): (None, 25, "no_data"),
                   ("v", "x"): (None, 4, "no_data"), ("v", "y"): (None, 4, "no_data")}


def test_replayed_batch_adds_nothing(spark):
    rows = window_psi(_counts(spark), _profile(spark), ["x", "y"])
    for _ in range(2):
        store_batch(rows, "replayed_psi", "stream-a", 7)
    assert spark.table("replayed_psi").count() == 4
    store_batch(rows, "replayed_psi", "stream-a", 8)
    store_batch(rows, "replayed_psi", "stream-b", 7)
    assert spark.table("replayed_psi").count() == 12


def test_sketch_stream_is_within_the_bounds_of_the_batch(spark, events_check, tmp_path):
    """PSI and KS of every closed window, from sketches kept as state over several files."""
    reference = materialize(build_silver(trips_from_events(events_check)).filter(
        "window = 'reference'"))
    edges = materialize(P.quantile_edges(reference, TRIP_FEATURES))
    sketches = materialize(K.feature_sketches(reference, TRIP_FEATURES))
    log = request_log_from_events(events_check)
    src = str(tmp_path / "log")
    log.repartitionByRange(6, "request_time").write.parquet(src)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(src)
    q = start_request_sketch_stream(stream, TRIP_FEATURES, sketches, edges, "stream_sketches",
                                    str(tmp_path / "ckpt"), window="7 days", watermark="2 days",
                                    trigger={"availableNow": True})
    q.awaitTermination(600)
    out = spark.table("stream_sketches").collect()
    windows = {(r["window"]["start"], r["window"]["end"]) for r in out}
    assert len(windows) > 2 and len(out) == len(windows) * len(TRIP_FEATURES)
    records = materialize(Q.parse_requests(log, TRIP_FEATURES))
    profile = materialize(P.baseline_profile(reference, TRIP_FEATURES, edges=edges))
    for start, end in sorted(windows)[:3]:
        inside = records.filter((F.col("request_time") >= F.lit(start))
                                & (F.col("request_time") < F.lit(end)))
        ks = {r["feature"]: r["ks"] for r in D.ks_statistic(reference, inside, TRIP_FEATURES).collect()}
        psi = {r["feature"]: r["psi"] for r in D.psi(inside, TRIP_FEATURES, profile).collect()}
        n = inside.count()
        for r in out:
            if r["window"]["start"] == start:
                assert r["n_rows"] == n
                assert r["ks_low"] <= ks[r["feature"]] <= r["ks_high"]
                assert r["psi_low"] - 1e-9 <= psi[r["feature"]] <= r["psi_high"] + 1e-9
