"""The checked queries: each key has a Spark plan (`QUERIES`) and, where SQL can
express it, a DuckDB oracle over the raw tables (`ORACLE_SQL`).

Conventions: doubles that come out of aggregations are rounded to 6 places on
both sides (sums differ in the last bits with order); row-level doubles are
computed with the same operations in the same order on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.exprs import round_doubles
from tidemark.operators import drift as D
from tidemark.operators import gates as G
from tidemark.operators import learn
from tidemark.operators import profile as P
from tidemark.operators import registry as R
from tidemark.operators import requests as Q
from tidemark.operators import scoring as S
from tidemark.operators.clean import (
    add_ingest_time,
    apply_rules,
    deduplicate,
    TRIP_COLUMNS,
    quality_rules,
    reject_counts,
    trip_spec,
    typed_projection,
)
from tidemark.operators.timeline import NEW, REFERENCE, label_windows, time_cutoff, window_summary
from tidemark.plans import datasets as ds
from tidemark.session import apply_defaults
from tidemark.sources.adapters import trips_as_text
from tidemark.sources.tables import materialize

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return run
    return register


# ----------------------------------------------------------------- SQL pieces
def _dbl(x: float) -> str:
    return f"{x!r}::DOUBLE"


def _probs(n_bins: int = 10) -> str:
    return "[" + ", ".join(_dbl(i / n_bins) for i in range(1, n_bins)) + "]"


def _model_sql(name: str) -> str:
    m = ds.LINEAR_MODELS[name]
    expr = _dbl(m.intercept)
    for f, w in m.weights:
        expr = f"({expr} + {f} * {_dbl(w)})"
    return expr


def _long_sql(src: str, features: list[str], extra: str = '"window"') -> str:
    return "\n  UNION ALL ".join(
        f"SELECT {extra}, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {src}"
        for f in features)


TRIPS_CTE = """
ev AS (
  SELECT event_id, ts, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
trips_once AS (
  SELECT event_id AS trip_id,
         CAST(ts AS TIMESTAMP) AS tpep_pickup_datetime,
         CAST(ts AS TIMESTAMP) + to_minutes(CAST(k AS BIGINT)) AS tpep_dropoff_datetime,
         CASE WHEN event_id % 499 = 0 THEN NULL ELSE value / 10.0::DOUBLE END AS trip_distance,
         CASE WHEN event_id % 997 = 0 THEN -5.0::DOUBLE
              ELSE 2.5::DOUBLE + value * 0.22::DOUBLE + CAST(k AS DOUBLE) * 0.35::DOUBLE
                   + CAST((event_id * 7919) % 101 - 50 AS DOUBLE) / 100.0::DOUBLE
         END AS fare_amount
  FROM ev
),
trips_copies AS (
  SELECT * FROM trips_once UNION ALL SELECT * FROM trips_once WHERE trip_id % 100 = 0
),
typed AS (
  SELECT tpep_pickup_datetime AS pickup_ts,
         trip_distance,
         CAST(epoch_us(tpep_dropoff_datetime) // 1000000
              - epoch_us(tpep_pickup_datetime) // 1000000 AS DOUBLE) / 60.0::DOUBLE
           AS duration_min,
         CAST(hour(tpep_pickup_datetime) AS DOUBLE) AS pickup_hour,
         CAST(dayofweek(tpep_pickup_datetime) + 1 AS DOUBLE) AS pickup_dow,
         fare_amount
  FROM {trips}
),
cleaned AS (
  SELECT * FROM typed
  WHERE pickup_ts IS NOT NULL
    AND trip_distance IS NOT NULL AND NOT isnan(trip_distance)
    AND duration_min IS NOT NULL AND NOT isnan(duration_min)
    AND pickup_hour IS NOT NULL AND pickup_dow IS NOT NULL
    AND fare_amount IS NOT NULL AND NOT isnan(fare_amount)
    AND trip_distance BETWEEN 0.1 AND 100
    AND duration_min BETWEEN 1 AND 240
    AND fare_amount > 0 AND fare_amount <= 300
),
silver0 AS (SELECT DISTINCT * FROM cleaned),
cutoff AS (SELECT quantile_disc(epoch_us(pickup_ts) // 1000000, 0.7::DOUBLE) AS c FROM silver0),
silver AS (
  SELECT s.*, CASE WHEN epoch_us(s.pickup_ts) // 1000000 <= cutoff.c THEN 'reference'
                   ELSE 'new' END AS "window"
  FROM silver0 s CROSS JOIN cutoff
),
keyed AS (
  SELECT *, md5(concat_ws('|', epoch_us(pickup_ts), {millionths})) AS row_key FROM silver
),
split AS (
  SELECT *, CASE WHEN ('0x' || substr(row_key, 1, 8))::BIGINT
                      % 10 < 8 THEN 'train' ELSE 'test' END AS split
  FROM keyed
)""".replace("{millionths}", ", ".join(
    f"CAST(round({c} * 1e6) AS BIGINT)" for c in TRIP_COLUMNS[1:]))


def trips_cte(copies: bool = True) -> str:
    return TRIPS_CTE.replace("{trips}", "trips_copies" if copies else "trips_once")


TFEATS = ds.FEATURES
LFEATS = ds.LINEITEM_FEATURES

# edges, dense profile, actual bins, PSI and KS for a labelled long table
DRIFT_CTE = """
long_all AS (
  {long}
),
long_p AS (SELECT * FROM long_all WHERE value IS NOT NULL AND NOT isnan(value)),
edges AS (
  SELECT feature, list_sort(list_distinct(quantile_disc(value, {probs}))) AS edges
  FROM long_p WHERE "window" = 'reference' GROUP BY feature
),
grid AS (
  SELECT feature, edges, unnest(generate_series(0, len(edges))) AS bin FROM edges
),
binned AS (
  SELECT l."window", l.feature, len(list_filter(e.edges, lambda x: x <= l.value)) AS bin
  FROM long_p l JOIN edges e USING (feature)
),
bincnt AS (
  SELECT feature, bin,
         count(*) FILTER (WHERE "window" = 'reference') AS n_ref,
         count(*) FILTER (WHERE "window" = 'new') AS n_new
  FROM binned GROUP BY feature, bin
),
dense AS (
  SELECT g.feature, g.bin,
         CASE WHEN g.bin > 0 THEN g.edges[g.bin] END AS lower,
         CASE WHEN g.bin < len(g.edges) THEN g.edges[g.bin + 1] END AS upper,
         coalesce(c.n_ref, 0) AS n_ref, coalesce(c.n_new, 0) AS n_new
  FROM grid g LEFT JOIN bincnt c USING (feature, bin)
),
shares AS (
  SELECT *, n_ref / sum(n_ref) OVER (PARTITION BY feature) AS e,
            n_new / sum(n_new) OVER (PARTITION BY feature) AS a
  FROM dense
),
psi AS (
  SELECT feature,
         sum((greatest(a, 1e-6) - greatest(e, 1e-6)) * ln(greatest(a, 1e-6) / greatest(e, 1e-6)))
           AS psi,
         count(*) AS bins
  FROM shares GROUP BY feature
),
vcnt AS (
  SELECT feature, value,
         count(*) FILTER (WHERE "window" = 'reference') AS na,
         count(*) FILTER (WHERE "window" = 'new') AS nb
  FROM long_p GROUP BY feature, value
),
cdf AS (
  SELECT feature,
         sum(na) OVER w / sum(na) OVER (PARTITION BY feature) AS fa,
         sum(nb) OVER w / sum(nb) OVER (PARTITION BY feature) AS fb
  FROM vcnt
  WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
ks AS (SELECT feature, max(abs(fa - fb)) AS ks FROM cdf GROUP BY feature),
report AS (
  SELECT p.feature, p.psi, k.ks, p.bins,
         CASE WHEN p.psi < 0.1 THEN 'ok' WHEN p.psi < 0.25 THEN 'warning' ELSE 'alert' END
           AS status
  FROM psi p LEFT JOIN ks k USING (feature)
)"""


def drift_cte(long_sql: str) -> str:
    return DRIFT_CTE.replace("{long}", long_sql).replace("{probs}", _probs())


TRIP_LONG = _long_sql("silver", TFEATS)
TRIP_LONG_SCALED = "\n  UNION ALL ".join(
    f"SELECT \"window\", '{f}' AS feature, CAST({f} AS DOUBLE) * "
    f"(CASE WHEN \"window\" = 'new' THEN {_dbl(ds.SIMULATION.get(f, 1.0))} ELSE 1.0::DOUBLE END)"
    f" AS value FROM silver" if f in ds.SIMULATION else
    f"SELECT \"window\", '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM silver"
    for f in TFEATS)

LI_CTE = """
li AS (
  SELECT l_orderkey, l_linenumber, l_shipdate AS ship_ts,
         l_quantity, l_extendedprice, l_discount, l_tax
  FROM lineitem
),
licut AS (SELECT quantile_disc(epoch_us(ship_ts) // 1000000, 0.7::DOUBLE) AS c FROM li),
lilab AS (
  SELECT li.*, CASE WHEN epoch_us(ship_ts) // 1000000 <= licut.c THEN 'reference'
                    ELSE 'new' END AS "window"
  FROM li CROSS JOIN licut
)"""
LI_LONG = _long_sql("lilab", LFEATS)


def _with(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n"


# ======================================================= bronze / silver slice
@query("bronze_ingest", _with(trips_cte(False)) + """
SELECT trip_id, tpep_pickup_datetime, tpep_dropoff_datetime, trip_distance, fare_amount,
       true AS has_ingest_time
FROM trips_once""")
def bronze_ingest(spark, sf):
    """Faithful copy + ingest time (compared as 'present')."""
    b = add_ingest_time(ds.trips(spark, sf))
    return b.select(*[c for c in b.columns if c != "_ingested_at"],
                    F.col("_ingested_at").isNotNull().alias("has_ingest_time"))


@query("silver_typed", _with(trips_cte(False)) + "SELECT * FROM typed")
def silver_typed(spark, sf):
    """Typed projection with duration and calendar features."""
    return typed_projection(ds.trips(spark, sf), trip_spec())


@query("silver_rules", _with(trips_cte(False)) + "SELECT * FROM cleaned")
def silver_rules(spark, sf):
    """Presence and range rules."""
    return apply_rules(typed_projection(ds.trips(spark, sf), trip_spec()), trip_spec())


@query("silver_dedup", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def silver_dedup(spark, sf):
    """A2: distinct rows."""
    return deduplicate(ds.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))


@query("silver_rejects", _with(trips_cte(False)) + """
, bad AS (
  SELECT event_id % 307 = 0 AS bad_time, event_id % 301 = 0 AS bad_number,
         event_id % 311 = 0 AS no_fare, event_id FROM events
),
read AS (
  SELECT bad_time, bad_number, no_fare,
         CASE WHEN bad_time THEN NULL ELSE y.pickup_ts END AS pickup_ts,
         CASE WHEN bad_number THEN NULL ELSE y.trip_distance END AS trip_distance,
         CASE WHEN bad_time THEN NULL ELSE y.duration_min END AS duration_min,
         CASE WHEN no_fare THEN NULL ELSE y.fare_amount END AS fare_amount,
         y.dropoff
  FROM bad JOIN (
    SELECT trip_id, tpep_pickup_datetime AS pickup_ts, tpep_dropoff_datetime AS dropoff,
           trip_distance, fare_amount,
           CAST(epoch_us(tpep_dropoff_datetime) // 1000000
                - epoch_us(tpep_pickup_datetime) // 1000000 AS DOUBLE) / 60.0 AS duration_min
    FROM trips_once) y ON y.trip_id = bad.event_id
),
reasons AS (
  SELECT unnest(list_filter([
    CASE WHEN bad_time THEN 'pickup_ts_unreadable' END,
    CASE WHEN bad_number THEN 'trip_distance_unreadable' END,
    CASE WHEN bad_time AND dropoff IS NOT NULL THEN 'duration_min_unreadable' END,
    CASE WHEN bad_time THEN 'pickup_hour_unreadable' END,
    CASE WHEN bad_time THEN 'pickup_dow_unreadable' END,
    CASE WHEN no_fare THEN 'fare_amount_unreadable' END,
    CASE WHEN pickup_ts IS NULL THEN 'pickup_ts_present' END,
    CASE WHEN trip_distance IS NULL THEN 'trip_distance_present' END,
    CASE WHEN duration_min IS NULL THEN 'duration_min_present' END,
    CASE WHEN pickup_ts IS NULL THEN 'pickup_hour_present' END,
    CASE WHEN pickup_ts IS NULL THEN 'pickup_dow_present' END,
    CASE WHEN fare_amount IS NULL THEN 'fare_amount_present' END,
    CASE WHEN NOT coalesce(trip_distance BETWEEN 0.1 AND 100, false) THEN 'trip_distance' END,
    CASE WHEN NOT coalesce(duration_min BETWEEN 1 AND 240, false) THEN 'duration_min' END,
    CASE WHEN NOT coalesce(fare_amount > 0 AND fare_amount <= 300, false) THEN 'fare_amount' END
  ], lambda x: x IS NOT NULL)) AS reason
  FROM read
)
SELECT reason, count(*) AS n_rows FROM reasons GROUP BY reason""")
def silver_rejects(spark, sf):
    """P3 + F1-F4 on a text source: rows by the reason that keeps them out."""
    return reject_counts(trips_as_text(ds.table(spark, sf, "events")), trip_spec())


@query("silver_full", _with(trips_cte(True)) + "SELECT * FROM silver")
def silver_full(spark, sf):
    """P3 -> rules -> distinct -> chronological label (trips with exact copies)."""
    return ds.silver(spark, sf, copies=True)


# ============================================================= time windows
@query("window_cutoff", _with(trips_cte(True)) + "SELECT c AS cutoff_seconds FROM cutoff")
def window_cutoff(spark, sf):
    """A3: exact 0.7 quantile of whole pickup seconds."""
    silver0 = deduplicate(apply_rules(typed_projection(ds.trips(spark, sf, True), trip_spec()),
                                      trip_spec()))
    return time_cutoff(silver0, "pickup_ts")


@query("window_label", _with(LI_CTE) + 'SELECT l_orderkey, l_linenumber, "window" FROM lilab')
def window_label(spark, sf):
    """reference/new label of every lineitem by ship time."""
    li = ds.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_shipdate").cast("timestamp").alias("ship_ts"))
    return label_windows(li, "ship_ts").select("l_orderkey", "l_linenumber", "window")


@query("window_share", _with(trips_cte(True)) + """
SELECT "window", count(*) AS n_rows,
       round(count(*) / sum(count(*)) OVER (), 6) AS share,
       round(sum(trip_distance), 6) AS sum_trip_distance,
       round(avg(fare_amount), 6) AS avg_fare_amount
FROM silver GROUP BY "window" """)
def window_share(spark, sf):
    """F5 + A1: rows, share, distance sum and mean fare per window."""
    s = window_summary(ds.silver(spark, sf), sums=("trip_distance",), means=("fare_amount",))
    return round_doubles(s.select("window", "n_rows", "share", "sum_trip_distance",
                                  "avg_fare_amount"))


@query("window_bounds", _with(LI_CTE) + """
SELECT "window", count(*) AS n_rows, min(ship_ts) AS min_ts, max(ship_ts) AS max_ts
FROM lilab GROUP BY "window" """)
def window_bounds(spark, sf):
    """Time bounds per window (reference max <= new min)."""
    s = window_summary(ds.lineitem_labelled(spark, sf), ts_col="ship_ts")
    return s.select("window", "n_rows", "min_ts", "max_ts")


# ============================================================ quality gate
_QUALITY_SQL = """
counts AS (
  SELECT (SELECT count(*) FROM trips_copies) AS rows_in,
         (SELECT count(*) FROM silver0) AS rows_out
)"""


@query("quality_counts", _with(trips_cte(True), _QUALITY_SQL) + """
SELECT rows_in, rows_out,
       round(CASE WHEN rows_in = 0 THEN 0.0 ELSE 1.0 - rows_out / rows_in END, 6)
         AS dropped_ratio
FROM counts""")
def quality_counts(spark, sf):
    """Rows in, distinct rows out, drop ratio; one grouped pass."""
    typed = typed_projection(ds.trips(spark, sf, True), trip_spec())
    return round_doubles(G.quality_counts(typed, quality_rules(trip_spec()), list(TRIP_COLUMNS)))


@query("quality_gate", _with(trips_cte(True), _QUALITY_SQL) + """
, r AS (SELECT rows_in, rows_out,
              CASE WHEN rows_in = 0 THEN 0.0 ELSE 1.0 - rows_out / rows_in END AS d FROM counts)
SELECT rows_in, rows_out, round_even(d, 4) AS dropped_ratio,
       rows_out < 1000 AS too_few_rows, d > 0.5 AS too_many_dropped,
       NOT (rows_out < 1000) AND NOT (d > 0.5) AS passed
FROM r""")
def quality_gate(spark, sf):
    """G1 as columns: at least 1000 rows out, at most 50 % dropped."""
    typed = typed_projection(ds.trips(spark, sf, True), trip_spec())
    return G.quality_verdict(G.quality_counts(typed, quality_rules(trip_spec()), list(TRIP_COLUMNS)))


# ================================================================== profile
def _li_windows(spark, sf):
    """(reference, new) lineitem windows."""
    lab = ds.lineitem_labelled(spark, sf)
    return ds.window(lab, REFERENCE), ds.window(lab, NEW)


def _li_reference(spark, sf):
    return ds.window(ds.lineitem_labelled(spark, sf), REFERENCE)


@query("quantile_edges", _with(LI_CTE, drift_cte(LI_LONG)) + """
SELECT feature, unnest(generate_series(1, len(edges))) AS edge_no, unnest(edges) AS edge
FROM edges""")
def quantile_edges(spark, sf):
    """A4 + L4: exact deciles per feature, sorted and de-duplicated."""
    return P.edges_long(P.quantile_edges(_li_reference(spark, sf), LFEATS))


@query("bin_counts", _with(LI_CTE, drift_cte(LI_LONG)) + """
SELECT feature, bin, lower, upper, n_new AS n FROM dense""")
def bin_counts(spark, sf):
    """Dense histogram of the new window on the reference bins."""
    ref, new = _li_windows(spark, sf)
    edges = P.quantile_edges(ref, LFEATS)
    return P.bin_counts(new, LFEATS, edges).withColumnRenamed("count", "n")


@query("baseline_profile", _with(LI_CTE, drift_cte(LI_LONG)) + """
SELECT feature, bin, lower, upper, n_ref AS expected_count, round(e, 6) AS expected_pct
FROM shares""")
def baseline_profile(spark, sf):
    """A7 + A8: bins, counts and shares of the reference window."""
    values = P.stored_values(_li_reference(spark, sf), LFEATS)
    return round_doubles(P.profile_from_counts(values, LFEATS), only=["expected_pct"])


@query("psi_by_feature", _with(LI_CTE, drift_cte(LI_LONG)) + """
SELECT feature, round(psi, 6) AS psi, bins FROM psi""")
def psi_by_feature(spark, sf):
    """PSI of the new window against the reference profile, all features."""
    rep = D.window_drift(ds.lineitem_labelled(spark, sf), LFEATS, digits=None)
    return round_doubles(rep.select("feature", "psi", "bins"))


@query("ks_by_feature", _with(LI_CTE, drift_cte(LI_LONG)) + """
SELECT feature, round(ks, 6) AS ks FROM ks""")
def ks_by_feature(spark, sf):
    """A10: exact two-sample KS statistic, reference vs new, all features."""
    long = P.to_long(ds.lineitem_labelled(spark, sf), LFEATS, keep=["window"]).withColumnRenamed("window", "side")
    return round_doubles(D.ks_from_long(long, a=REFERENCE, b=NEW))


def _trip_report(spark, sf, factors=None, digits=4):
    s = D.scale_columns(ds.silver(spark, sf), factors or {}, F.col("window") == NEW)
    return D.window_drift(s, TFEATS, digits=digits).select("feature", "psi", "ks", "status")


_REPORT_SQL = """
SELECT feature, round_even(psi, 4) AS psi, round_even(ks, 4) AS ks, status FROM report"""


@query("drift_report", _with(trips_cte(True), drift_cte(TRIP_LONG)) + _REPORT_SQL)
def drift_report(spark, sf):
    """PSI, KS and status per feature, rounded to 4."""
    return _trip_report(spark, sf)


@query("drift_report_simulated",
       _with(trips_cte(True), drift_cte(TRIP_LONG_SCALED)) + _REPORT_SQL)
def drift_report_simulated(spark, sf):
    """P7 + A12: the same report with new distance and duration scaled by 3."""
    return _trip_report(spark, sf, ds.SIMULATION)


@query("drift_from_stored", _with(trips_cte(True), drift_cte(TRIP_LONG)) + _REPORT_SQL)
def drift_from_stored(spark, sf):
    """S5 + J3 + A12: the monitor's path — drift of the new window from a stored profile and
    stored value counts of the reference window, read back from tables."""
    s = ds.silver(spark, sf)
    ref = ds.window(s, REFERENCE)
    values = P.stored_values(ref, TFEATS)
    profile = materialize(P.profile_from_counts(values, TFEATS))
    return D.drift_from_baseline(ds.window(s, NEW), TFEATS, profile, values)


_HOLES = ("trip_distance", "duration_min")  # features without reference, without new values
TRIP_LONG_HOLES = "\n  UNION ALL ".join(
    f"SELECT \"window\", '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM silver"
    + (f" WHERE \"window\" <> '{(REFERENCE, NEW)[_HOLES.index(f)]}'" if f in _HOLES else "")
    for f in TFEATS)


@query("drift_without_data", _with(trips_cte(True), drift_cte(TRIP_LONG_HOLES)) + """
SELECT f.feature, round(CASE WHEN f.feature IN ('trip_distance', 'duration_min') THEN NULL
                        ELSE r.psi END, 6) AS psi,
       CASE WHEN f.feature IN ('trip_distance', 'duration_min') THEN 'no_data'
            ELSE r.status END AS status
FROM (SELECT unnest(""" + repr(list(TFEATS)) + """) AS feature) f LEFT JOIN report r USING (feature)""")
def drift_without_data(spark, sf):
    """A9 + A11: a feature that one of the windows has no value of is `no_data`."""
    s = ds.silver(spark, sf)
    for feature, label in zip(_HOLES, (REFERENCE, NEW)):
        s = s.withColumn(feature, F.when(F.col("window") != label, F.col(feature)))
    rep = D.window_drift(s, TFEATS, digits=None)
    return round_doubles(rep.select("feature", "psi", "status"))


@query("drift_alerts", _with(trips_cte(True), drift_cte(TRIP_LONG_SCALED)) + """
SELECT feature, round_even(psi, 4) AS psi, status FROM report WHERE status = 'alert'""")
def drift_alerts(spark, sf):
    """alerting features of the simulated report."""
    return D.alerts(_trip_report(spark, sf, ds.SIMULATION)).select("feature", "psi", "status")


@query("simulate_scale", _with(trips_cte(True)) + """
SELECT pickup_ts, trip_distance * 3.0::DOUBLE AS trip_distance,
       duration_min * 3.0::DOUBLE AS duration_min, pickup_hour, pickup_dow, fare_amount
FROM silver WHERE "window" = 'new'""")
def simulate_scale(spark, sf):
    """What-if scaling of two columns of the new window."""
    return D.scale_columns(ds.new(spark, sf), ds.SIMULATION).drop("window")


# ================================================================= sampling
def _keyed(df: DataFrame):
    """Arguments of `sample_values`: the rows with their key columns, features, key names."""
    keys = {f"_k{i}": c for i, c in enumerate(ds.trip_key())}
    return df.withColumns(keys), TFEATS, list(keys)


@query("sample_values", _with(trips_cte(True)) + """
, long_r AS (
  """ + _long_sql("keyed WHERE \"window\" = 'reference'", TFEATS, "row_key") + """
),
ranked AS (
  SELECT feature, value,
         row_number() OVER (PARTITION BY feature ORDER BY row_key, value) AS rn
  FROM long_r WHERE value IS NOT NULL AND NOT isnan(value)
)
SELECT feature, value FROM ranked WHERE rn <= 2000""")
def sample_values(spark, sf):
    """L2: per feature the 2000 values with the smallest key hash."""
    return P.sample_values(*_keyed(ds.reference(spark, sf)), k=2000)


@query("signature_sample", _with(trips_cte(True)) + f"""
SELECT {', '.join(TFEATS)}, round({_model_sql(ds.CHECKED_MODEL)}, 6) AS prediction
FROM keyed WHERE "window" = 'reference'
ORDER BY row_key LIMIT 200""")
def signature_sample(spark, sf):
    """L1: 200 deterministic rows of model inputs with their predictions (the feature
    of the model signature; the top-k limit is the operator)."""
    top = ds.signature_rows(ds.reference(spark, sf)).select(*TFEATS)
    scored = S.score(top, ds.LINEAR_MODELS[ds.CHECKED_MODEL])
    return scored.withColumn("prediction", F.round("prediction", 6))


@query("train_test_split", _with(trips_cte(True)) + """
SELECT pickup_ts, fare_amount, split FROM split WHERE "window" = 'reference'""")
def train_test_split(spark, sf):
    """L3: reproducible 80/20 split on md5 of the trip key."""
    return ds.with_split(ds.reference(spark, sf)).select("pickup_ts", "fare_amount", "split")


# ================================================================== scoring
def _scored_new(spark, sf, name=ds.CHECKED_MODEL):
    return S.score(ds.new(spark, sf), ds.LINEAR_MODELS[name], target=ds.TARGET)


@query("score_linear", _with(trips_cte(True)) + f"""
, scored AS (SELECT *, {_model_sql(ds.CHECKED_MODEL)} AS prediction FROM silver
             WHERE "window" = 'new')
SELECT pickup_ts, {', '.join(TFEATS)}, fare_amount, round(prediction, 6) AS prediction,
       round(abs(fare_amount - prediction), 6) AS abs_error
FROM scored""")
def score_linear(spark, sf):
    """U1 + P8 + M11: score the new window, add the absolute error."""
    out = _scored_new(spark, sf).drop("window")
    return round_doubles(out, only=["prediction", "abs_error"])


@query("score_rounded", _with(trips_cte(True)) + f"""
SELECT pickup_ts, round({_model_sql(ds.CHECKED_MODEL)}, 2) AS prediction
FROM silver WHERE "window" = 'new'""")
def score_rounded(spark, sf):
    """Prediction rounded to 2 decimals, as the serving answer."""
    return S.score(ds.new(spark, sf), ds.LINEAR_MODELS[ds.CHECKED_MODEL], round_to=2).select(
        "pickup_ts", "prediction")


_METRICS_SQL = ",\nmetrics AS (\n" + "\n  UNION ALL ".join(
    f"SELECT '{name}' AS model, {i} AS model_order, count(*) AS n_rows, "
    f"sqrt(avg(power(fare_amount - {_model_sql(name)}, 2))) AS rmse, "
    f"avg(abs(fare_amount - {_model_sql(name)})) AS mae "
    f"FROM split WHERE \"window\" = 'reference' AND split = 'test'"
    for i, name in enumerate(ds.LINEAR_MODELS)) + "\n)"


def _metrics(spark, sf):
    test = ds.with_split(ds.reference(spark, sf)).filter(F.col("split") == "test")
    return S.regression_metrics(test, ds.TARGET, ds.LINEAR_MODELS)


@query("model_metrics", _with(trips_cte(True)) + _METRICS_SQL + """
SELECT model, model_order, n_rows, round(rmse, 6) AS rmse, round(mae, 6) AS mae FROM metrics""")
def model_metrics(spark, sf):
    """RMSE and MAE of every model on the hold-out, one pass."""
    return round_doubles(_metrics(spark, sf))


@query("best_model", _with(trips_cte(True)) + _METRICS_SQL + """
SELECT arg_min(model, rmse) AS best_model, round(min(rmse), 6) AS rmse FROM metrics""")
def best_model(spark, sf):
    """The model with the smallest RMSE."""
    return round_doubles(S.best_model(_metrics(spark, sf)))


_PERF_SQL = _METRICS_SQL + ",\nwin AS (\n" + "\n  UNION ALL ".join(
    f"SELECT '{name}' AS model, count(*) AS n_rows, "
    f"avg(abs(fare_amount - {_model_sql(name)})) AS window_mae "
    f"FROM silver WHERE \"window\" = 'new'"
    for name in ds.LINEAR_MODELS) + """
),
perf AS (
  SELECT w.model, w.n_rows, m.mae AS train_mae, w.window_mae, w.window_mae / m.mae AS mae_ratio
  FROM win w LEFT JOIN metrics m USING (model)
)"""


def _performance(spark, sf):
    rows = ds.with_split(ds.silver(spark, sf))
    return S.window_performance(
        rows, ds.TARGET, ds.LINEAR_MODELS,
        trained_on=(F.col("window") == REFERENCE) & (F.col("split") == "test"),
        watched=F.col("window") == NEW)


@query("performance_metrics", _with(trips_cte(True)) + _PERF_SQL + """
SELECT model, n_rows, round(train_mae, 6) AS train_mae, round(window_mae, 6) AS window_mae,
       round(mae_ratio, 6) AS mae_ratio
FROM perf""")
def performance_metrics(spark, sf):
    """A13 + A14: window MAE against the training MAE, per model."""
    return round_doubles(_performance(spark, sf))


@query("performance_gate", _with(trips_cte(True)) + _PERF_SQL + """
SELECT model, round(mae_ratio, 6) AS mae_ratio, coalesce(mae_ratio > 1.3, false) AS degraded
FROM perf""")
def performance_gate(spark, sf):
    """Degraded when the window MAE exceeds 1.3 x the training MAE."""
    v = G.performance_verdict(_performance(spark, sf))
    return round_doubles(v.select("model", "mae_ratio", "degraded"))


# ================================================================= registry
_REGISTRY_CTE = """
versions AS (
  SELECT o_orderpriority AS model_name, o_orderkey + 1 AS version,
         'run-' || CAST(o_orderkey AS VARCHAR) AS run_id,
         o_totalprice / 100000.0::DOUBLE AS rmse, o_totalprice / 125000.0::DOUBLE AS mae
  FROM orders
),
aliases AS (
  SELECT o_orderpriority AS model_name,
         CASE o_orderstatus WHEN 'F' THEN 'champion' WHEN 'O' THEN 'challenger'
                            WHEN 'P' THEN 'shadow' END AS alias,
         o_orderkey + 1 AS version, o_orderdate AS set_at
  FROM orders
),
latest AS (
  SELECT model_name, max(version) AS version FROM versions GROUP BY model_name
),
cur AS (
  SELECT model_name, alias, arg_max(version, (set_at, version)) AS version,
         max(set_at) AS set_at
  FROM aliases GROUP BY model_name, alias
)"""


@query("latest_version", _with(_REGISTRY_CTE) + """
SELECT l.model_name, l.version, v.run_id, v.rmse, v.mae
FROM latest l JOIN versions v USING (model_name, version)""")
def latest_version(spark, sf):
    """L6 + F12: the highest version of every model."""
    return R.latest_version(ds.model_versions(spark, sf))


_RUN = "run-7"


@query("version_of_run", _with(_REGISTRY_CTE) + f"""
, chosen AS (
  SELECT model_name, coalesce(max(version) FILTER (WHERE run_id = '{_RUN}'), max(version)) AS version
  FROM versions GROUP BY model_name
)
SELECT c.model_name, c.version, v.run_id, v.rmse, v.mae
FROM chosen c JOIN versions v USING (model_name, version)""")
def version_of_run(spark, sf):
    """the version of a run, or a model's highest where that run has none."""
    return R.latest_version(ds.model_versions(spark, sf), _RUN)


@query("current_alias", _with(_REGISTRY_CTE) + """
SELECT model_name, alias, version, set_at FROM cur""")
def current_alias(spark, sf):
    """M9 + M10: current holder of every alias from the append-only history."""
    return R.current_alias(ds.model_aliases(spark, sf))


@query("promotion_decision", _with(_REGISTRY_CTE) + """
, cand AS (
  SELECT l.model_name, l.version AS candidate_version, v.rmse AS candidate_rmse
  FROM latest l JOIN versions v USING (model_name, version)
),
champ AS (
  SELECT c.model_name, c.version AS champion_version, v.rmse AS champion_rmse
  FROM cur c LEFT JOIN versions v ON v.model_name = c.model_name AND v.version = c.version
  WHERE c.alias = 'champion'
)
SELECT cand.model_name, candidate_version, candidate_rmse, champion_version, champion_rmse,
       CASE WHEN champion_version IS NULL THEN 'champion'
            WHEN champion_rmse IS NULL THEN 'champion'
            WHEN candidate_rmse < champion_rmse THEN 'champion'
            ELSE 'challenger' END AS decision
FROM cand LEFT JOIN champ USING (model_name)""")
def promotion_decision(spark, sf):
    """M8: champion if none yet or strictly better RMSE, else challenger."""
    return R.promotion_decision(ds.model_versions(spark, sf), ds.model_aliases(spark, sf))


# ============================================================== request log
_REQ_CTE = """
qev AS (
  SELECT event_id, ts, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         event_id // 5 AS g
  FROM events
),
qreq AS (SELECT *, max(ts) OVER (PARTITION BY g) AS request_time FROM qev),
records AS (
  SELECT request_time, value / 10.0::DOUBLE AS trip_distance, CAST(k AS DOUBLE) AS duration_min,
         CAST(hour(ts) AS DOUBLE) AS pickup_hour, CAST(dayofweek(ts) + 1 AS DOUBLE) AS pickup_dow
  FROM qreq WHERE g % 20 <> 0
),
recent AS (
  SELECT * FROM records
  WHERE request_time >= (SELECT max(ts) FROM events) - INTERVAL 1440 MINUTE
)"""


def _as_of(log: DataFrame):
    return log.agg(F.max("request_time")).scalar()


@query("parse_requests", _with(_REQ_CTE) + "SELECT * FROM records")
def parse_requests(spark, sf):
    """One row per record of every successful request."""
    return Q.parse_requests(ds.request_log(spark, sf), TFEATS)


@query("request_lookback", _with(_REQ_CTE) + "SELECT * FROM recent")
def request_lookback(spark, sf):
    """records of the last 1440 minutes before the latest request."""
    log = ds.request_log(spark, sf)
    return Q.recent_records(log, TFEATS, ds.LOOKBACK_MINUTES, as_of=_as_of(log))


@query("request_validation", _with(_REQ_CTE) + """
SELECT *,
       coalesce(trip_distance > 0 AND trip_distance <= 100, false)
       AND coalesce(duration_min > 0 AND duration_min <= 240, false)
       AND coalesce(pickup_hour >= 0 AND pickup_hour <= 23, false)
       AND coalesce(pickup_dow >= 1 AND pickup_dow <= 7, false) AS is_valid,
       concat_ws(';',
         CASE WHEN NOT coalesce(trip_distance > 0 AND trip_distance <= 100, false)
              THEN 'trip_distance' END,
         CASE WHEN NOT coalesce(duration_min > 0 AND duration_min <= 240, false)
              THEN 'duration_min' END,
         CASE WHEN NOT coalesce(pickup_hour >= 0 AND pickup_hour <= 23, false)
              THEN 'pickup_hour' END,
         CASE WHEN NOT coalesce(pickup_dow >= 1 AND pickup_dow <= 7, false)
              THEN 'pickup_dow' END) AS reasons
FROM records""")
def request_validation(spark, sf):
    """serving-side validity of every logged record, with the broken rules."""
    return Q.validate(Q.parse_requests(ds.request_log(spark, sf), TFEATS))


_REQ_DRIFT_SQL = """
, ref_long AS (
  """ + _long_sql("silver WHERE \"window\" = 'reference'", TFEATS, "pickup_ts") + """
),
ref_p AS (SELECT * FROM ref_long WHERE value IS NOT NULL AND NOT isnan(value)),
edges AS (
  SELECT feature, list_sort(list_distinct(quantile_disc(value, """ + _probs() + """))) AS edges
  FROM ref_p GROUP BY feature
),
req_long AS (
  """ + _long_sql("recent", TFEATS, "request_time") + """
),
req_p AS (SELECT * FROM req_long WHERE value IS NOT NULL AND NOT isnan(value)),
grid AS (SELECT feature, edges, unnest(generate_series(0, len(edges))) AS bin FROM edges),
ref_bins AS (
  SELECT r.feature, len(list_filter(e.edges, lambda x: x <= r.value)) AS bin, count(*) AS n
  FROM ref_p r JOIN edges e USING (feature) GROUP BY ALL
),
req_bins AS (
  SELECT r.feature, len(list_filter(e.edges, lambda x: x <= r.value)) AS bin, count(*) AS n
  FROM req_p r JOIN edges e USING (feature) GROUP BY ALL
),
dense AS (
  SELECT g.feature, g.bin, coalesce(a.n, 0) AS n_ref, coalesce(b.n, 0) AS n_new
  FROM grid g LEFT JOIN ref_bins a USING (feature, bin) LEFT JOIN req_bins b USING (feature, bin)
),
shares AS (
  SELECT *, n_ref / sum(n_ref) OVER (PARTITION BY feature) AS e,
            n_new / sum(n_new) OVER (PARTITION BY feature) AS a
  FROM dense
),
psi AS (
  SELECT feature,
         sum((greatest(a, 1e-6) - greatest(e, 1e-6)) * ln(greatest(a, 1e-6) / greatest(e, 1e-6)))
           AS psi
  FROM shares GROUP BY feature
),
sided AS (
  SELECT feature, value, 1 AS na, 0 AS nb FROM ref_p
  UNION ALL SELECT feature, value, 0, 1 FROM req_p
),
vcnt AS (SELECT feature, value, sum(na) AS na, sum(nb) AS nb FROM sided GROUP BY ALL),
cdf AS (
  SELECT feature,
         sum(na) OVER w / sum(na) OVER (PARTITION BY feature) AS fa,
         sum(nb) OVER w / sum(nb) OVER (PARTITION BY feature) AS fb
  FROM vcnt
  WINDOW w AS (PARTITION BY feature ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
ks AS (SELECT feature, max(abs(fa - fb)) AS ks FROM cdf GROUP BY feature),
n AS (SELECT count(*) AS n_rows FROM recent)
SELECT p.feature, round_even(p.psi, 4) AS psi, round_even(k.ks, 4) AS ks,
       CASE WHEN p.psi < 0.1 THEN 'ok' WHEN p.psi < 0.25 THEN 'warning' ELSE 'alert' END AS status,
       n.n_rows, 1440 AS window_minutes
FROM psi p LEFT JOIN ks k USING (feature) CROSS JOIN n
WHERE n.n_rows >= 30"""


@query("request_drift", _with(trips_cte(True), _REQ_CTE) + _REQ_DRIFT_SQL)
def request_drift(spark, sf):
    """R2 + G4: drift of the last 1440 minutes of traffic against the training
    profile (PSI) and all baseline values (KS), only with >= 30 records."""
    values = P.stored_values(ds.reference(spark, sf), TFEATS)
    profile = materialize(P.profile_from_counts(values, TFEATS))
    log = ds.request_log(spark, sf)
    recent = materialize(Q.recent_records(log, TFEATS, ds.LOOKBACK_MINUTES, as_of=_as_of(log)))
    return Q.request_report(recent, TFEATS, profile, values, ds.LOOKBACK_MINUTES,
                            ds.MIN_REQUEST_ROWS)


# ============================================================ model training
@query("train_univariate", _with(trips_cte(True)) + """
, train AS (SELECT * FROM split WHERE "window" = 'reference' AND split = 'train')
SELECT 'intercept' AS term, round(regr_intercept(fare_amount, trip_distance), 6) AS value
FROM train
UNION ALL
SELECT 'trip_distance', round(regr_slope(fare_amount, trip_distance), 6) FROM train""")
def train_univariate(spark, sf):
    """M1 + M2: Spark ML linear regression of the fare on the distance, coefficients."""
    train = ds.with_split(ds.reference(spark, sf)).filter(F.col("split") == "train")
    model = learn.fit(train, ["trip_distance"], ds.TARGET, "linear_regression")
    return round_doubles(learn.coefficients(spark, model, ["trip_distance"]))


@query("train_linear", _with(trips_cte(True)) + """
, train AS (SELECT * FROM split WHERE "window" = 'reference' AND split = 'train')
SELECT unnest(['intercept', """ + ", ".join(f"'{f}'" for f in TFEATS) + """]) AS term,
       (SELECT count(*) FROM train) AS n_rows, true AS is_least_squares""")
def train_linear(spark, sf):
    """M1 + M2: linear regression on all features. The coefficients are the least-squares
    solution exactly if the residuals are orthogonal to the constant and to every
    feature (the normal equations), which is checked per term on the training rows."""
    train = ds.with_split(ds.reference(spark, sf)).filter(F.col("split") == "train")
    model = S.LinearModel.from_spark(
        learn.fit(train, TFEATS, ds.TARGET, "linear_regression"), TFEATS)
    residual = F.col(ds.TARGET) - model.prediction()
    terms = {"intercept": F.lit(1.0), **{f: F.col(f) for f in TFEATS}}
    size = {t: F.avg(residual * c) / F.greatest(F.avg(F.abs(c)), F.lit(1.0))
            for t, c in terms.items()}
    row = train.agg(F.count(F.lit(1)).alias("n_rows"), *[
        (F.abs(e) < 1e-6).alias(f"ok_{t}") for t, e in size.items()])
    return row.select(F.explode(F.array(*[
        F.struct(F.lit(t).alias("term"), F.col("n_rows"), F.col(f"ok_{t}").alias(
            "is_least_squares")) for t in terms])).alias("r")).select("r.*")


@query("train_models", _with(trips_cte(True)) + """
, test AS (SELECT * FROM split WHERE "window" = 'reference' AND split = 'test')
SELECT model, model_order, (SELECT count(*) FROM test) AS n_rows,
       true AS rmse_below_5, true AS mae_at_most_rmse, true AS one_best_of_least_rmse
FROM (VALUES ('linear_regression', 0), ('random_forest', 1), ('gbt', 2)) t(model, model_order)""")
def train_models(spark, sf):
    """M3-M6: linear regression, random forest and gradient-boosted trees, evaluated on the
    hold-out; what holds whatever the seeds: rows, error limits, which is flagged best."""
    split = ds.with_split(ds.reference(spark, sf))
    results = learn.results_frame(spark, learn.train_models(split, TFEATS, ds.TARGET))
    all_rows = Window.partitionBy()
    best = ((F.sum(F.col("is_best").cast("int")).over(all_rows) == 1)
            & (F.col("is_best") == (F.col("rmse") == F.min("rmse").over(all_rows))))
    return results.select("model", "model_order", "n_rows", (F.col("rmse") < 5).alias("rmse_below_5"),
                          (F.col("mae") <= F.col("rmse")).alias("mae_at_most_rmse"),
                          best.alias("one_best_of_least_rmse"))
