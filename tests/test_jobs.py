"""End to end on the sf0.001 test tables: every job, every table it writes."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift as D
from tidemark.operators import learn
from tidemark.operators import requests as Q
from tidemark.operators.clean import TRIP_FEATURES
from tidemark.plans import jobs
from tidemark.plans.datasets import build_silver
from tidemark.sources.adapters import request_log_from_events, trips_from_events
from tidemark.sources.names import TableNames


@pytest.fixture(scope="module")
def names(spark, events_small):
    n = TableNames(schema="tidemark_e2e")
    cfg = jobs.JobConfig(min_rows=100)
    jobs.run_ingest(spark, n, trips_from_events(events_small))
    jobs.run_silver(spark, n, cfg)
    jobs.run_train(spark, n, cfg, estimators=("linear_regression",))
    jobs.run_score(spark, n)
    return n


def test_bronze_and_silver(spark, names, events_small):
    assert spark.table(names.bronze).count() == events_small.count()
    silver = spark.table(names.silver)
    assert set(r["window"] for r in silver.select("window").distinct().collect()) == \
        {"reference", "new"}


def test_failing_quality_gate_leaves_silver_untouched(spark, names):
    from tidemark.operators.gates import DataQualityError
    before = sorted(spark.table(names.silver).collect())
    with pytest.raises(DataQualityError, match="too_few_rows"):
        jobs.run_silver(spark, names, jobs.JobConfig(min_rows=10**9, fraction=0.1))
    assert sorted(spark.table(names.silver).collect()) == before


def test_train_registers_version_profile_sample_alias(spark, names):
    v = spark.table(names.model_versions).collect()
    assert len(v) == 1 and v[0]["version"] == 1
    assert spark.table(names.baseline_bins).select("feature").distinct().count() == 4
    assert spark.table(names.baseline_sample).count() > 0
    assert spark.table(names.model_signatures).count() == 200
    run = spark.table(names.model_runs).first()
    assert (run["engine"], run["best_model"], run["silver_table"]) == (
        "spark", "linear_regression", names.silver)
    ref = spark.table(names.silver).filter("window = 'reference'").count()
    kept = spark.table(names.baseline_values).groupBy("feature").agg(F.sum("n").alias("n"))
    assert {r["n"] for r in kept.collect()} == {ref}  # every row is in the stored baseline
    assert jobs.alias_version(spark, names, "champion")["version"] == 1


def test_second_training_is_compared_with_champion(spark, names):
    out = jobs.run_train(spark, names, jobs.JobConfig(min_rows=100),
                         estimators=("linear_regression",))
    assert out["version"] == 2
    # same data, same hash split, same model: equal RMSE is not strictly better
    assert out["alias"] == "challenger"
    assert jobs.alias_version(spark, names, "champion")["version"] == 1


def test_scoring_and_monitor(spark, names):
    pred = spark.table(names.predictions)
    assert {"prediction", "abs_error", "model_version"} <= set(pred.columns)
    assert pred.count() == spark.table(names.silver).filter("window = 'new'").count()
    assert pred.agg(F.avg("abs_error")).first()[0] < 5
    rep = jobs.run_monitor(spark, names).collect()
    assert sorted(r["feature"] for r in rep) == sorted(TRIP_FEATURES)
    perf = spark.table(names.performance_metrics).collect()
    assert perf and perf[0]["mae_ratio"] > 0
    from tidemark.operators.gates import DriftAlert
    with pytest.raises(DriftAlert):
        jobs.run_monitor(spark, names, what_if={"trip_distance": 3.0, "duration_min": 3.0},
                         fail_on_alert=True)
    assert spark.table(names.drift_metrics).filter("simulated").count() == 4


def test_degraded_model_fails_the_monitor(spark, names):
    from tidemark.operators.gates import ModelDegraded
    jobs.run_monitor(spark, names, fail_on_degraded=True)  # as trained: no alarm
    worse = spark.table(names.predictions).withColumn("abs_error", F.col("abs_error") + 100)
    other = TableNames(schema=names.schema, own={"predictions": "worse_predictions_e2e"})
    worse.write.mode("overwrite").saveAsTable(other.predictions)
    with pytest.raises(ModelDegraded):
        jobs.run_monitor(spark, other, fail_on_degraded=True)
    assert spark.table(names.performance_metrics).filter("mae_ratio > 1.3").count() == 1


def test_request_monitor(spark, names, events_small):
    log = request_log_from_events(events_small)
    log.write.mode("overwrite").saveAsTable(names.payload)
    as_of = log.agg(F.max("request_time")).scalar()
    report = jobs.run_request_monitor(spark, names, minutes=30 * 24 * 60, min_rows=30,
                                      as_of=as_of, run_key="noon")
    assert report.count() == 4 and report.first()["n_rows"] > 30
    assert spark.table(names.endpoint_drift_metrics).count() == 4
    rejects = spark.table(names.request_rejects).filter("level = 'request' and reason <> 'ok'")
    assert {r["reason"] for r in rejects.collect()} == {Q.NOT_SERVED}
    # the scheduler runs it again: the run's rows are replaced
    jobs.run_request_monitor(spark, names, minutes=30 * 24 * 60, as_of=as_of, run_key="noon")
    assert spark.table(names.endpoint_drift_metrics).count() == 4
    few = jobs.run_request_monitor(spark, names, minutes=1, min_rows=10**6, as_of=as_of)
    assert few.count() == 0 and spark.table(names.endpoint_drift_metrics).count() == 4


def test_a_retried_monitor_adds_nothing(spark, names):
    before = {t: spark.table(t).count() for t in (names.drift_metrics, names.performance_metrics)}
    for _ in range(2):
        jobs.run_monitor(spark, names, run_key="nightly-17")
    assert spark.table(names.drift_metrics).count() == before[names.drift_metrics] + 4
    assert spark.table(names.performance_metrics).count() == before[names.performance_metrics] + 1


def test_concurrent_trainers_get_versions_of_their_own(spark, names, tmp_path):
    cfg = jobs.JobConfig(model_root=f"file://{tmp_path}/models")
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: jobs.allocate_version(spark, names, cfg), range(12)))
    last = spark.table(names.model_versions).agg(F.max("version")).first()[0]
    assert sorted(got) == list(range(last + 1, last + 13))


def test_baseline_of_a_version_is_one_partition(spark, names):
    _, values = jobs._baseline(spark, names, 1)
    plan = values._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_key" in plan
    ref = spark.table(names.silver).filter("window = 'reference'").count()
    assert {r["n"] for r in values.groupBy("feature").agg(F.sum("n").alias("n")).collect()} == {ref}


def test_sketch_monitor_agrees_with_the_rows(spark, names):
    days = spark.table(names.silver_sketches).filter("window = 'new'").agg(
        F.min("day").cast("string"), F.max("day").cast("string")).first()
    told = {r["feature"]: r for r in jobs.run_sketch_monitor(spark, names, *days).collect()}
    exact = {r["feature"]: r for r in D.drift_from_baseline(
        spark.table(names.silver).filter("window = 'new'"), TRIP_FEATURES,
        *jobs._baseline(spark, names, 1), digits=None).collect()}
    assert set(told) == set(TRIP_FEATURES)
    for f, r in told.items():
        assert r["ks_low"] <= exact[f]["ks"] <= r["ks_high"]
        assert r["psi_low"] - 1e-9 <= exact[f]["psi"] <= r["psi_high"] + 1e-9


def test_failed_publication_keeps_predictions(spark, names):
    before = spark.table(names.predictions).count()
    broken = spark.table(names.silver).withColumn("prediction", F.raise_error(F.lit("no disk")))
    with pytest.raises(Exception, match="no disk"):
        jobs._publish(broken, names.predictions, jobs.JobConfig())
    assert spark.table(names.predictions).count() == before


def test_silver_from_batches_serves_the_other_jobs(spark, events_small):
    n = TableNames(schema="tidemark_batches")
    trips = trips_from_events(events_small)
    for batch, part in enumerate((trips.filter("trip_id < 400"), trips, trips)):
        jobs.run_silver_batch(spark, n, part, batch)
    whole = build_silver(trips)
    columns = whole.columns
    assert sorted(spark.table(n.silver).select(*columns).collect()) == sorted(whole.collect())
    jobs.run_train(spark, n, estimators=("linear_regression",))
    assert jobs.run_score(spark, n) == whole.filter("window = 'new'").count()
    assert jobs.run_monitor(spark, n).count() == 4


def test_three_models_train_and_best_is_min(spark, events_small):
    from tidemark.operators.clean import clean, trip_spec
    from tidemark.plans.datasets import with_split
    spec = trip_spec()
    split = with_split(clean(trips_from_events(events_small), spec))
    results = learn.train_models(split, list(TRIP_FEATURES), "fare_amount")
    frame = {r["model"]: r for r in learn.results_frame(spark, results).collect()}
    assert {r["n_rows"] for r in frame.values()} == {split.filter("split = 'test'").count()}
    assert set(frame) == {"linear_regression", "random_forest", "gbt"}
    for r in frame.values():
        assert r["rmse"] < 5 and r["mae"] >= 0
    best = [m for m, r in frame.items() if r["is_best"]]
    assert best == [min(frame, key=lambda m: frame[m]["rmse"])]
    with pytest.raises(ValueError):
        learn.train_models(split, list(TRIP_FEATURES), "fare_amount", engine="other")


def test_table_names():
    assert TableNames(schema="dev", own={"payload": "log"}).payload == "dev.log"
    with pytest.raises(AttributeError):
        TableNames(schema="dev").nothing  # noqa: B018
    n = TableNames(schema="dev", catalog="main")
    assert n.silver == "main.dev.silver_trips"
    assert TableNames(schema="dev").model_versions == "dev.model_versions"
