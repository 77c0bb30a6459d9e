import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidemark.operators import requests as Q
from tidemark.operators.clean import TRIP_FEATURES
from tidemark.sources.adapters import request_log_from_events

FEATS = list(TRIP_FEATURES)
T = datetime(2024, 1, 10, 12, 0, 0)
REC = {"trip_distance": 2.0, "duration_min": 9.0, "pickup_hour": 8.0, "pickup_dow": 3.0}


def _log(spark, bodies, status=200):
    rows = [(T, status, b) for b in bodies]
    return spark.createDataFrame(rows, "request_time timestamp, status_code int, request string")


def test_permissive_parse_drops_bad_bodies(spark):
    bodies = ["not json", json.dumps({"x": 1}), json.dumps({"dataframe_records": []}), None,
              json.dumps({"dataframe_records": [REC, REC]})]
    assert Q.parse_requests(_log(spark, bodies), FEATS).count() == 2


def test_missing_or_mistyped_field_becomes_null(spark):
    recs = [{k: v for k, v in REC.items() if k != "pickup_hour"},
            {**REC, "trip_distance": "abc"}, {**REC, "duration_min": "1.5"}]
    out = Q.parse_requests(_log(spark, [json.dumps({"dataframe_records": recs})]), FEATS).collect()
    assert out[0]["pickup_hour"] is None
    assert out[1]["trip_distance"] is None
    assert out[2]["duration_min"] is None


def test_failed_requests_are_skipped(spark):
    body = json.dumps({"dataframe_records": [REC]})
    assert Q.parse_requests(_log(spark, [body], status=500), FEATS).count() == 0


def test_lookback_is_inclusive_without_upper_bound(spark):
    rows = [(T - timedelta(minutes=61), 200, "{}"), (T - timedelta(minutes=60), 200, "{}"),
            (T + timedelta(minutes=5), 200, "{}")]
    log = spark.createDataFrame(rows, "request_time timestamp, status_code int, request string")
    assert Q.lookback(log, 60, as_of=F.lit(T)).count() == 2


def test_validation_reasons(spark):
    recs = [REC, {**REC, "trip_distance": 0.0}, {**REC, "pickup_dow": 8.0, "duration_min": 241.0},
            {k: v for k, v in REC.items() if k != "pickup_hour"}]
    parsed = Q.parse_requests(_log(spark, [json.dumps({"dataframe_records": recs})]), FEATS)
    out = [(r["is_valid"], r["reasons"]) for r in Q.validate(parsed).collect()]
    assert out == [(True, ""), (False, "trip_distance"), (False, "duration_min;pickup_dow"),
                   (False, "pickup_hour")]


def test_request_log_adapter_roundtrip(spark, events_small):
    log = request_log_from_events(events_small)
    parsed = Q.parse_requests(log, FEATS)
    ok_events = events_small.filter((F.floor(F.col("event_id") / 5) % 20) != 0).count()
    assert parsed.count() == ok_events
    s = parsed.agg(F.sum("trip_distance")).first()[0]
    want = events_small.filter((F.floor(F.col("event_id") / 5) % 20) != 0).agg(
        F.sum(F.col("value") / 10.0)).first()[0]
    assert abs(s - want) < 1e-6


def test_rejects_are_counted_by_reason(spark):
    ok = {"dataframe_records": [REC, {**REC, "trip_distance": "far"}, {"pickup_dow": None}, 7]}
    bodies = ["{cut", None, "[1]", json.dumps({"dataframe_records": {}}), "null",
              json.dumps({"dataframe_records": []}), json.dumps(ok), json.dumps(ok)]
    log = _log(spark, bodies).unionByName(_log(spark, [json.dumps(ok)], status=500)).unionByName(
        _log(spark, [json.dumps(ok)], status=None))
    got = {(r["level"], r["reason"]): r["n"] for r in Q.reject_counts(log, FEATS).collect()}
    assert got == {
        ("request", "not_json"): 1, ("request", "no_body"): 1, ("request", "no_records"): 3,
        ("request", "empty"): 1, ("request", "not_served"): 2, ("request", "ok"): 2,
        ("record", "ok"): 2, ("record", "trip_distance_unreadable"): 2, ("record", "not_a_record"): 2,
        **{("record", f"{f}_missing"): 2 for f in FEATS}}
    aside = Q.quarantine(log)
    assert aside.count() == 8 and set(log.columns) < set(aside.columns)
    assert Q.reject_counts(log.limit(0), FEATS).count() == 0
