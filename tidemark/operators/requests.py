"""Logged model requests: parse, look back, validate, check drift.

Body layout: `{"dataframe_records": [{feature: number, ...}, ...]}`. The JSON
schema is built from the feature list, so `from_json` materialises only those
fields. Parsing is permissive: unparseable text, another layout, a null body or
an empty list yield no record; a missing or mistyped field yields a null feature.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.rules import Rule, all_pass, broken_rules_text

# The status of a served request, and the body's field of records.
OK_STATUS = 200
RECORDS = "dataframe_records"


def request_schema(features: Sequence[str]) -> T.StructType:
    """Type of a request body: one struct of doubles per record."""
    record = T.StructType([T.StructField(f, T.DoubleType()) for f in features])
    return T.StructType([T.StructField(RECORDS, T.ArrayType(record))])


def parse_requests(payload: DataFrame, features: Sequence[str],
                   time_col: str = "request_time") -> DataFrame:
    """One row per record of every successful request: (request_time, features...)."""
    served = payload.where(F.col("status_code") == OK_STATUS)
    body = F.from_json("request", request_schema(features))
    return served.select(time_col, F.inline(body.getField(RECORDS)))


def lookback(payload: DataFrame, minutes: int, as_of: Column | None = None,
             time_col: str = "request_time") -> DataFrame:
    """Rows with `time_col >= as_of − minutes` (no upper bound). `as_of` defaults to
    the current time; pass a scalar subquery or literal for a reproducible run."""
    as_of = as_of if as_of is not None else F.current_timestamp()
    start = as_of - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(int(minutes)))
    return payload.filter(F.col(time_col) >= start)


def recent_records(payload: DataFrame, features: Sequence[str], minutes: int,
                   as_of: Column | None = None) -> DataFrame:
    """Look-back first (a pushable filter on the raw log), then parse."""
    return parse_requests(lookback(payload, minutes, as_of), features)


# ---------------------------------------------------------------- quarantine
# Reasons why a request, or a record of a readable request, gives no features.
NOT_SERVED, NO_BODY, NOT_JSON = "not_served", "no_body", "not_json"
NO_RECORDS, EMPTY, NOT_A_RECORD = "no_records", "empty", "not_a_record"


def _body() -> Column:
    return F.try_parse_json("request")


def _records(body: Column) -> Column:
    return F.try_variant_get(body, f"$.{RECORDS}", "array<variant>")


def request_reason() -> Column:
    """Why a logged request gives no record; null for one that gives some. The body is read
    as VARIANT, so any JSON can be told from text that is none."""
    body, records = _body(), _records(_body())
    return (F.when(F.coalesce(F.col("status_code") != OK_STATUS, F.lit(True)), F.lit(NOT_SERVED))
            .when(F.col("request").isNull(), F.lit(NO_BODY))
            .when(body.isNull(), F.lit(NOT_JSON))
            .when(records.isNull(), F.lit(NO_RECORDS))
            .when(F.size(records) == 0, F.lit(EMPTY)))


def record_reasons(record: Column, features: Sequence[str]) -> Column:
    """array<string>: what is wrong with a record (a VARIANT): `<feature>_missing`,
    `<feature>_unreadable`, or that it is no object at all."""
    def of(f: str) -> Column:
        text = F.try_variant_get(record, f"$.{f}", "string")
        number = F.try_variant_get(record, f"$.{f}", "double")
        return (F.when(text.isNull(), F.lit(f"{f}_missing"))
                .when(number.isNull(), F.lit(f"{f}_unreadable")))

    is_object = F.startswith(F.schema_of_variant(record), F.lit("OBJECT"))
    return F.when(F.coalesce(is_object, F.lit(False)), F.array_compact(F.array(*map(of, features)))
                  ).otherwise(F.array(F.lit(NOT_A_RECORD)))


def quarantine(payload: DataFrame) -> DataFrame:
    """The logged requests that give no record, with their `reason`, to be stored aside."""
    return payload.withColumn("reason", request_reason()).filter(F.col("reason").isNotNull())


def reject_counts(payload: DataFrame, features: Sequence[str]) -> DataFrame:
    """(level, reason, n): requests without records by reason, records by every reason they
    have, and what is left (`ok`), so that nothing disappears uncounted. One pass."""
    reason = request_reason()
    records = F.transform(_records(_body()), lambda r: record_reasons(r, features))

    def entries(level: str, reasons: Column) -> Column:
        return F.transform(reasons, lambda x: F.struct(F.lit(level).alias("level"),
                                                       x.alias("reason")))

    def or_ok(reasons: Column) -> Column:
        return F.when(F.size(reasons) > 0, reasons).otherwise(F.array(F.lit("ok")))

    found = F.concat(
        entries("request", F.array(F.coalesce(reason, F.lit("ok")))),
        F.when(reason.isNull(), entries("record", F.flatten(F.transform(records, or_ok))))
        .otherwise(F.array().cast("array<struct<level:string,reason:string>>")))
    return payload.select(F.inline(found)).groupBy("level", "reason").agg(
        F.count(F.lit(1)).alias("n"))


# The valid ranges of a request (serving-side validation):
# distance (0, 100], duration (0, 240], hour [0, 23], day of week [1, 7].
def request_rules() -> list[Rule]:
    d, m = F.col("trip_distance"), F.col("duration_min")
    h, w = F.col("pickup_hour"), F.col("pickup_dow")
    return [
        Rule("trip_distance", (d > 0) & (d <= 100)),
        Rule("duration_min", (m > 0) & (m <= 240)),
        Rule("pickup_hour", (h >= 0) & (h <= 23)),
        Rule("pickup_dow", (w >= 1) & (w <= 7)),
    ]


def validate(records: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """Add `is_valid` and `reasons` (names of broken rules joined by ';'). A missing
    field fails its rule (null predicate)."""
    rules = list(rules) if rules is not None else request_rules()
    return records.withColumns({"is_valid": all_pass(rules),
                                "reasons": broken_rules_text(rules)})


def request_report(records: DataFrame, features: Sequence[str], profile: DataFrame,
                   values: DataFrame, window_minutes: int, min_rows: int,
                   digits: int | None = 4) -> DataFrame:
    """Drift of logged records from a stored baseline: PSI on the training profile, exact KS
    against all of the baseline's values (feature, value, n), tagged with the record count
    and look-back. Empty when fewer than `min_rows` records arrived (no verdict on too
    little traffic).

    The count is a scalar subquery, so the gate needs no separate action.
    """
    from tidemark.operators import drift as D

    n_rows = records.agg(F.count(F.lit(1))).scalar()
    rep = D.drift_from_baseline(records, features, profile, values, digits)
    return (rep.withColumns({"n_rows": n_rows,
                             "window_minutes": F.lit(int(window_minutes))})
            .filter(F.col("n_rows") >= min_rows))
