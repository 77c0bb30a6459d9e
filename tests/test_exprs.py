import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions.exprs import count_at_most, hash_bucket, row_hash
from tidemark.operators.clean import quality_rules, trip_spec, typed_projection
from tidemark.operators.gates import DataQualityError, enforce_quality, quality_counts
from tidemark.sources.adapters import trips_from_events


def test_bin_index_matches_searchsorted(spark):
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(200):
        m = int(rng.integers(0, 150))
        edges = sorted(set(np.round(rng.normal(size=m), 1).tolist()))
        probes = np.round(rng.normal(size=5), 1).tolist() + edges[:2]
        rows += [(edges, float(v)) for v in probes]
    df = spark.createDataFrame(rows, "edges array<double>, v double")
    got = df.select("edges", "v", count_at_most(F.col("edges"), F.col("v")).alias("b")).collect()
    for r in got:
        assert r["b"] == int(np.searchsorted(np.array(r["edges"]), r["v"], side="right"))


def test_bin_index_is_never_null(spark):
    df = spark.createDataFrame([(None, 1.0)], "edges array<double>, v double").select(
        count_at_most(F.col("edges"), F.col("v")).alias("b"))
    assert not df.schema["b"].nullable and df.first()["b"] == -1


def test_hash_split_is_stable_text_hash(spark):
    df = spark.createDataFrame([(123,)], "k long")
    r = df.select(row_hash("k").alias("h"), hash_bucket(row_hash("k"), 10).alias("b")).first()
    assert r["h"] == "202cb962ac59075b964b07152d234b70"
    assert r["b"] == int("202cb962", 16) % 10


def test_enforce_quality_on_test_events(spark, events_small):
    spec = trip_spec()
    typed = typed_projection(trips_from_events(events_small), spec)
    counts = quality_counts(typed, quality_rules(spec), spec.names)
    out = enforce_quality(counts, min_rows=100)
    assert out["rows_in"] == events_small.count() and out["rows_out"] > 900
    with pytest.raises(DataQualityError):
        enforce_quality(counts, min_rows=10**6)
