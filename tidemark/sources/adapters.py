"""Adapters that turn the shared test tables into the inputs of the product.

* trips (`events` → source trips): pickup = `ts`, dropoff = `ts + k minutes`
  (k = integer `$.k` of `props`), distance = value / 10 (null on every 499th
  event), fare = a learnable function of distance and duration with small
  deterministic noise (−5 on every 997th event, a row the rules must drop).
* request log (`events` → one logged request per five events): body
  `{"dataframe_records": [...]}` with the four model features per event,
  `status_code` 500 on every 20th request.
* lineitem drift source: ship time and four numeric features.

All are plain projections / one bounded group-by; they scale with the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRIP_SOURCE_COLUMNS = ["tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance",
                       "fare_amount"]

# Fixed values of the adapters (they define the test inputs, see FIXTURES.md).
NULL_DISTANCE_EVERY = 499
BAD_FARE_EVERY = 997
COPY_EVERY = 100
BAD_TIME_EVERY = 307
BAD_NUMBER_EVERY = 301
EMPTY_FARE_EVERY = 311
EVENTS_PER_REQUEST = 5
FAILED_REQUEST_EVERY = 20
CUT_BODY_EVERY = 17
LIST_BODY_EVERY = 19
EMPTY_BODY_EVERY = 23
NO_BODY_EVERY = 29
OTHER_NAME_EVERY = 31
WORD_FOR_NUMBER_EVERY = 37
TEXT_RECORDS_EVERY = 41


def trips_from_events(events: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Source trips: `trip_id`, the four source columns, and `extra` columns of the events."""
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    pickup = F.col("ts").cast("timestamp")
    noise = ((F.col("event_id") * 7919) % 101 - 50).cast("double") / 100.0
    fare = F.lit(2.5) + F.col("value") * 0.22 + k.cast("double") * 0.35 + noise
    return events.select(
        F.col("event_id").alias("trip_id"),
        pickup.alias("tpep_pickup_datetime"),
        (pickup + F.make_dt_interval(F.lit(0), F.lit(0), k)).alias("tpep_dropoff_datetime"),
        F.when(F.col("event_id") % NULL_DISTANCE_EVERY == 0, F.lit(None).cast("double"))
        .otherwise(F.col("value") / 10.0).alias("trip_distance"),
        F.when(F.col("event_id") % BAD_FARE_EVERY == 0, F.lit(-5.0))
        .otherwise(fare).alias("fare_amount"),
        *extra,
    )


def trips_with_copies(events: DataFrame) -> DataFrame:
    """Trips plus an exact copy of every 100th trip (a de-duplication case), from one read."""
    trips = trips_from_events(events)
    times = F.when(F.col("trip_id") % COPY_EVERY == 0, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1)))
    return trips.withColumn("_copy", F.explode(times)).drop("_copy")


def trips_as_text(events: DataFrame) -> DataFrame:
    """Trips as a text source writes them: every column a string, some of them unreadable
    (the event's raw `props` where a number belongs, words where a time does)."""
    trips = trips_from_events(events, extra=["props"])

    def spoiled(c: str, every: int, text: Column) -> Column:
        return F.when(F.col("trip_id") % every == 0, text).otherwise(F.col(c).cast("string"))

    return trips.select(
        "trip_id", spoiled("tpep_pickup_datetime", BAD_TIME_EVERY, F.lit("not a time"))
        .alias("tpep_pickup_datetime"),
        F.col("tpep_dropoff_datetime").cast("string").alias("tpep_dropoff_datetime"),
        spoiled("trip_distance", BAD_NUMBER_EVERY, F.col("props")).alias("trip_distance"),
        spoiled("fare_amount", EMPTY_FARE_EVERY, F.lit("")).alias("fare_amount"))


def request_log_from_events(events: DataFrame, numbered: bool = False) -> DataFrame:
    """Logged requests: `request_time timestamp, status_code int, request string`, and `g`
    if they are to be numbered.

    Group g = event_id div 5 (at most five events per request, so every group
    is bounded); `request_time` is the latest event time of the group.
    """
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    ts = F.col("ts").cast("timestamp")
    record = F.struct(
        (F.col("value") / 10.0).alias("trip_distance"),
        k.cast("double").alias("duration_min"),
        F.hour(ts).cast("double").alias("pickup_hour"),
        F.dayofweek(ts).cast("double").alias("pickup_dow"),
    )
    grouped = (
        events.select(F.floor(F.col("event_id") / EVENTS_PER_REQUEST).alias("g"),
                      F.col("event_id"), ts.alias("ts"), record.alias("rec"))
        .groupBy("g")
        .agg(F.max("ts").alias("request_time"),
             F.array_sort(F.collect_list(F.struct("event_id", "rec"))).alias("recs"))
    )
    return grouped.select(
        *(["g"] if numbered else []), F.col("request_time"),
        F.when(F.col("g") % FAILED_REQUEST_EVERY == 0, F.lit(500)).otherwise(F.lit(200))
        .alias("status_code"),
        F.to_json(F.struct(F.transform("recs", lambda r: r["rec"]).alias("dataframe_records")))
        .alias("request"),
    )


def spoiled_request_log(events: DataFrame, numbered: bool = False) -> DataFrame:
    """The request log as a careless client writes it: bodies that are cut, lists, empty or
    missing, records that are texts, a feature under another name, a word for a number."""
    def every(n: int) -> Column:
        return F.col("g") % n == 0

    body = F.col("request")
    spoiled = (
        F.when(every(CUT_BODY_EVERY), F.substring(body, 1, 25))
        .when(every(LIST_BODY_EVERY), F.lit("[1, 2]"))
        .when(every(EMPTY_BODY_EVERY), F.lit('{"dataframe_records": []}'))
        .when(every(NO_BODY_EVERY), F.lit(None).cast("string"))
        .when(every(OTHER_NAME_EVERY), F.replace(body, F.lit('"trip_distance"'), F.lit('"miles"')))
        .when(every(WORD_FOR_NUMBER_EVERY),
              F.regexp_replace(body, '"duration_min":[0-9.]+', '"duration_min":"long"'))
        .when(every(TEXT_RECORDS_EVERY), F.lit('{"dataframe_records": ["a", "b"]}'))
        .otherwise(body))
    log = request_log_from_events(events, numbered=True).withColumn("request", spoiled)
    return log if numbered else log.drop("g")


LINEITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def lineitem_drift_source(lineitem: DataFrame) -> DataFrame:
    """Ship time + four features, as they are."""
    return lineitem.select(F.col("l_shipdate").cast("timestamp").alias("ship_ts"),
                           *LINEITEM_FEATURES)
