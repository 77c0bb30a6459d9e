"""Checked queries of the table life cycle: versions, batches, as-of lookups, quarantine.

Where a query stores tables it uses a folder of its own below the shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import round_doubles
from tidemark.operators import drift as D
from tidemark.operators import incremental as I
from tidemark.operators import registry as R
from tidemark.operators import requests as Q
from tidemark.operators.asof import asof_join
from tidemark.operators.clean import clean, trip_spec
from tidemark.operators.timeline import NEW
from tidemark.plans import datasets as ds
from tidemark.plans.catalogue import _REGISTRY_CTE, TFEATS, _with, query, trips_cte
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources.adapters import COPY_EVERY, spoiled_request_log, trips_from_events
from tidemark.sources.versions import commits, publish, read_version


def _root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored-tables-{uuid.uuid4().hex}"


# ------------------------------------------------------------------ versions
@query("published_versions", _with(trips_cte(True)) + """
SELECT 1 AS version, "window", count(*) AS n_rows, round(sum(trip_distance), 4) AS distance,
       false AS is_newest FROM silver GROUP BY "window"
UNION ALL
SELECT 2, "window", count(*), round(sum(CASE WHEN "window" = 'new' THEN trip_distance * 3.0
                                             ELSE trip_distance END), 4), true
FROM silver GROUP BY "window" """)
def published_versions(spark, sf):
    """Silver published, published again with scaled columns, then a write that fails
    half-way: the newest version and the one before it are read back whole."""
    root, silver = _root(spark), ds.silver(spark, sf)
    publish(silver, root, ["window"])
    publish(D.scale_columns(silver, ds.SIMULATION, F.col("window") == NEW), root, ["window"])
    broken = silver.withColumn("fare_amount", F.when(
        F.col("window") == NEW, F.raise_error(F.lit("disk full"))).otherwise(F.col("fare_amount")))
    try:
        publish(broken, root, ["window"])
    except Exception as e:  # noqa: BLE001 - the failure is the case
        if "disk full" not in str(e):
            raise
    newest = commits(spark, root).agg(F.max("version")).first()[0]

    def summed(version: int) -> DataFrame:
        per = read_version(spark, root, version).groupBy("window").agg(
            F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("trip_distance"), 4).alias("distance"))
        return per.select(F.lit(version).alias("version"), "window", "n_rows", "distance",
                          F.lit(version == newest).alias("is_newest"))

    return summed(1).unionByName(summed(2))


# ------------------------------------------------------------------- batches
def _batches(spark, sf) -> list[DataFrame]:
    """The trips in three deliveries: the earlier half of the ids, the later half with the
    exact copies of all, and the second once more."""
    events = ds.table(spark, sf, "events")
    trips = trips_from_events(events)
    half = events.agg((F.max("event_id") / 2).cast("long")).scalar()
    copies = trips.filter(F.col("trip_id") % COPY_EVERY == 0)  # the copies of `trips_with_copies`
    later = trips.filter(F.col("trip_id") > half).unionByName(copies)
    return [trips.filter(F.col("trip_id") <= half), later, later]


@query("silver_incremental", _with(trips_cte(True)) + "SELECT * FROM silver")
def silver_incremental(spark, sf):
    """S1 + S2 + A2 + A3: silver from batches, each joined only with the days it touches, and
    its labels from the rows per day; equal to silver cleaned in one run."""
    root, spec = _root(spark), trip_spec()
    for number, batch in enumerate(_batches(spark, sf)):
        # the last delivery repeats the second one under a number of its own
        I.add_batch(clean(batch, spec), root, number, spec.time_column)
    return I.labelled(I.read_silver(spark, root), spec.time_column)


@query("silver_batches", _with(trips_cte(True)) + """
SELECT count(*) AS n_rows, 0 AS added_by_a_repeat, 1 AS commits_of_a_batch, 3 AS n_commits
FROM silver0""")
def silver_batches(spark, sf):
    """What the batches added — a repeated delivery adds no row, a batch that is run again
    commits nothing, and compaction changes no row."""
    root, spec = _root(spark), trip_spec()
    first, later, _ = _batches(spark, sf)
    for number, batch in ((0, first), (1, later), (1, later)):
        I.add_batch(clean(batch, spec), root, number, spec.time_column)
    again = I.add_batch(clean(later, spec), root, 2, spec.time_column)
    before = I._commits(spark, root)
    n = I.read_silver(spark, root).count()
    I.compact(spark, root)
    same = I.read_silver(spark, root).agg(F.count(F.lit(1)).alias("n_rows"))
    return same.filter(F.col("n_rows") == n).select(
        "n_rows", F.lit(again["n_new"]).cast("int").alias("added_by_a_repeat"),
        F.lit(sum(c["batch"] == 1 for c in before)).alias("commits_of_a_batch"),
        F.lit(len(before)).alias("n_commits"))


# --------------------------------------------------------------------- as of
_ASOF_SQL = """
, champ AS (
  SELECT model_name, set_at, max(version) AS version FROM aliases
  WHERE alias = 'champion' GROUP BY model_name, set_at
),
scored AS (
  SELECT l_orderkey, l_linenumber, o_orderpriority AS model_name,
         CAST(l_shipdate AS TIMESTAMP) AS scored_at, l_quantity, l_discount, l_tax
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
held AS (
  SELECT s.*, c.version, c.set_at
  FROM scored s ASOF LEFT JOIN champ c
    ON s.model_name = c.model_name AND s.scored_at >= c.set_at
)"""


def _held(spark, sf) -> DataFrame:
    """Lineitems as scored rows (the order's priority is the model, the ship time when it was
    scored), with the champion then in force."""
    orders = ds.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("model_name"))
    scored = ds.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp").alias("scored_at"),
        "l_quantity", "l_discount", "l_tax").join(orders, "l_orderkey")
    return R.in_force(scored, ds.model_aliases(spark, sf), R.CHAMPION, "scored_at")


@query("champion_at_scoring", _with(_REGISTRY_CTE) + _ASOF_SQL + """
SELECT l_orderkey, l_linenumber, model_name, version, set_at FROM held""")
def champion_at_scoring(spark, sf):
    """M9 + M10 as of a time: the version that was champion when a row was scored."""
    return _held(spark, sf).select("l_orderkey", "l_linenumber", "model_name", "version", "set_at")


@query("performance_by_champion", _with(_REGISTRY_CTE) + _ASOF_SQL + """
SELECT model_name, version, count(*) AS n_rows,
       round(avg(abs(l_quantity * (1 - l_discount) - l_quantity * (1 - l_tax))), 6) AS window_mae
FROM held GROUP BY model_name, version""")
def performance_by_champion(spark, sf):
    """A14 as of a time: rows and mean absolute error under each champion's rule."""
    q = F.col("l_quantity")
    error = F.abs(q * (1 - F.col("l_discount")) - q * (1 - F.col("l_tax")))
    return round_doubles(_held(spark, sf).groupBy("model_name", "version").agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(error).alias("window_mae")))


# ---------------------------------------------------------------- quarantine
_SPOILED_CTE = """
qev AS (
  SELECT event_id, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         event_id // 5 AS g
  FROM events
),
req AS (
  SELECT g, count(*) AS n, count(value) AS n_value, count(k) AS n_k,
         CASE WHEN g % 20 = 0 THEN 'not_served' WHEN g % 17 = 0 THEN 'not_json'
              WHEN g % 19 = 0 THEN 'no_records' WHEN g % 23 = 0 THEN 'empty'
              WHEN g % 29 = 0 THEN 'no_body' END AS reason,
         CASE WHEN g % 31 = 0 THEN 'trip_distance_missing'
              WHEN g % 37 = 0 THEN 'duration_min_unreadable'
              WHEN g % 41 = 0 THEN 'not_a_record' ELSE 'ok' END AS record
  FROM qev GROUP BY g
)"""


@query("request_rejects", _with(_SPOILED_CTE) + """
SELECT 'request' AS level, coalesce(reason, 'ok') AS reason, count(*) AS n FROM req GROUP BY ALL
UNION ALL
SELECT 'record', record, CAST(sum(CASE WHEN record = 'not_a_record' THEN 2 ELSE n END) AS BIGINT)
FROM req WHERE reason IS NULL GROUP BY record""")
def request_rejects(spark, sf):
    """A spoiled request log by reason; nothing disappears uncounted."""
    return Q.reject_counts(spoiled_request_log(ds.table(spark, sf, "events")), TFEATS)


@query("request_quarantine", _with(_SPOILED_CTE) + """
SELECT reason, count(*) AS n_requests, CAST(sum(n) AS BIGINT) AS n_records_sent
FROM req WHERE reason IS NOT NULL GROUP BY reason""")
def request_quarantine(spark, sf):
    """The requests set aside, with the records that their clients sent."""
    events = ds.table(spark, sf, "events")
    log = spoiled_request_log(events, numbered=True)
    sent = events.groupBy(F.floor(F.col("event_id") / 5).alias("g")).agg(
        F.count(F.lit(1)).alias("n"))
    return Q.quarantine(log).join(sent, "g").groupBy("reason").agg(
        F.count(F.lit(1)).alias("n_requests"), F.sum("n").alias("n_records_sent"))
