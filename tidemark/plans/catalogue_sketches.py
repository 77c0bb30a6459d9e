"""Checked queries of the quantile sketches: what the sketches say, held against exact values.

Each row carries the exact value, which the oracle computes from all rows, and whether the
sketch's answer lies within its stated error of it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import kll
from tidemark.functions.exprs import round_doubles, whole_seconds
from tidemark.operators import drift as D
from tidemark.operators import profile as P
from tidemark.operators import sketches as K
from tidemark.operators.clean import clean, trip_spec
from tidemark.operators.cumulative import exact_quantiles
from tidemark.operators.timeline import NEW, REFERENCE, time_cutoff
from tidemark.plans import datasets as ds
from tidemark.plans.catalogue import (
    LFEATS,
    LI_CTE,
    LI_LONG,
    _probs,
    _with,
    drift_cte,
    query,
    trips_cte,
)
from tidemark.sources.tables import materialize

PROBS = [i / 10 for i in range(1, 10)]


def _li_sketches(rows):
    """Stored sketches of labelled lineitems, per window, day and feature."""
    return materialize(K.daily_sketches(rows, LFEATS, "ship_ts", keep=["window"]))


def _of_window(sketches, label):
    return K.merged(sketches.filter(F.col("window") == label))


@query("sketch_quantiles", _with(LI_CTE, drift_cte(LI_LONG)) + f"""
, q AS (
  SELECT feature, count(*) AS n_rows, quantile_disc(value, {_probs()}) AS edges
  FROM long_p WHERE "window" = 'reference' GROUP BY feature
)
SELECT feature, n_rows, unnest(generate_series(1, 9)) AS decile, unnest(edges) AS exact_edge,
       true AS within_bound
FROM q""")
def sketch_quantiles(spark, sf):
    """A4 from sketches: deciles of the reference window out of merged daily sketches; their
    ranks among all rows are within the stated error."""
    rows = materialize(ds.lineitem_labelled(spark, sf))
    long = P.present(P.to_long(ds.window(rows, REFERENCE), LFEATS))
    found = materialize(_of_window(_li_sketches(rows), REFERENCE).select(
        "feature", kll.quantiles("sketch", PROBS).alias("edges")))
    exact = exact_quantiles(long, ["feature"], "value", PROBS)
    points = found.select("feature", F.array_sort(F.array_distinct("edges")).alias("points"))
    counts = K.rank_bounds(long, points)
    at = F.array_position("points", F.col("edge")).cast("int")
    judged = (found.select("feature", F.posexplode("edges").alias("p_index", "edge"))
              .join(counts, "feature").select(
        "feature", "p_index", F.col("total").alias("n_rows"), K.within_ranks(
            F.col("total"), F.element_at("below", at), F.element_at("at_most", at),
            (F.col("p_index") + 1) / 10).alias("within_bound")))
    return judged.join(exact, ["feature", "p_index"]).select(
        "feature", "n_rows", (F.col("p_index") + 1).cast("long").alias("decile"),
        F.col("value").alias("exact_edge"), "within_bound")


@query("sketch_cutoff", _with(trips_cte(True)) + """
SELECT c AS cutoff_seconds, (SELECT count(*) FROM silver0) AS n_rows, true AS within_bound
FROM cutoff""")
def sketch_cutoff(spark, sf):
    """A3, the jobs' default: the time cutoff from a sketch, held against the exact one."""
    silver = materialize(clean(ds.trips(spark, sf, True), trip_spec()))
    about = time_cutoff(silver, "pickup_ts", exact=False).scalar()
    seconds = whole_seconds("pickup_ts")
    exact = time_cutoff(silver, "pickup_ts").scalar()
    counts = silver.agg(F.count(seconds).alias("n_rows"),
                        F.count_if(seconds < about).alias("below"),
                        F.count_if(seconds <= about).alias("at_most"))
    return counts.select(exact.alias("cutoff_seconds"), "n_rows", K.within_ranks(
        F.col("n_rows"), F.col("below"), F.col("at_most"), 0.7).alias("within_bound"))


@query("sketch_drift", _with(LI_CTE, drift_cte(LI_LONG)) + """
, n AS (
  SELECT feature, count(*) FILTER (WHERE "window" = 'reference') AS n_reference,
         count(*) FILTER (WHERE "window" = 'new') AS n_new
  FROM long_p GROUP BY feature
)
SELECT feature, n_reference, n_new, round(psi, 6) AS exact_psi, round(ks, 6) AS exact_ks,
       true AS psi_within, true AS ks_within
FROM report JOIN n USING (feature)""")
def sketch_drift(spark, sf):
    """A9 + A10 from sketches only, on the stored edges: exact PSI and KS of all rows lie
    between the limits that the sketches state."""
    rows = materialize(ds.lineitem_labelled(spark, sf))
    sketches = _li_sketches(rows)
    exact = D.window_drift(rows, LFEATS, digits=None)
    edges = P.quantile_edges(ds.window(rows, REFERENCE), LFEATS)
    told = K.sketch_drift(_of_window(sketches, REFERENCE), _of_window(sketches, NEW), edges)
    both = told.drop("status").withColumnsRenamed({"psi": "s_psi", "ks": "s_ks"}).join(
        exact, "feature")
    tiny = 1e-9  # sums of doubles in another order
    return round_doubles(both.select(
        "feature", "n_reference", "n_new", F.col("psi").alias("exact_psi"),
        F.col("ks").alias("exact_ks"),
        F.col("psi").between(F.col("psi_low") - tiny, F.col("psi_high") + tiny)
        .alias("psi_within"),
        F.col("ks").between(F.col("ks_low"), F.col("ks_high")).alias("ks_within")))


@query("sketch_merge", _with(LI_CTE, drift_cte(LI_LONG)) + """
SELECT feature, count(*) AS n_rows, true AS same_count, true AS within_bound
FROM long_p GROUP BY feature""")
def sketch_merge(spark, sf):
    """Sketches of the two halves of the table, merged, against the sketch of the whole and
    against all rows at 99 ranks."""
    rows = ds.table(spark, sf, "lineitem").select("l_linenumber", *LFEATS)
    halves = K.feature_sketches(rows.withColumn("half", F.col("l_linenumber") % 2), LFEATS, ["half"])
    both = K.merged(halves).withColumnsRenamed({"n": "n_halves", "sketch": "merged"})
    whole = K.feature_sketches(rows, LFEATS).join(both, "feature")
    probs = [i / 100 for i in range(1, 100)]
    found = materialize(whole.select(
        "feature", "n", "n_halves", kll.size("merged").alias("n_merged"),
        K.ks_between(kll.grid("sketch"), kll.grid("merged")).alias("apart"),
        kll.quantiles("merged", probs).alias("found")))
    points = found.select("feature", F.array_sort(F.array_distinct("found")).alias("points"))
    counts = K.rank_bounds(P.present(P.to_long(rows, LFEATS)), points)
    ok = found.join(counts, "feature")
    at = F.transform("found", lambda v: F.array_position("points", v).cast("int"))
    good = F.forall(F.transform(at, lambda a, i: K.within_ranks(
        F.col("total"), F.element_at("below", a), F.element_at("at_most", a), (i + 1) / 100)),
        lambda x: x)
    return ok.select(
        "feature", F.col("total").alias("n_rows"),
        ((F.col("n") == F.col("total")) & (F.col("n_halves") == F.col("total"))
         & (F.col("n_merged") == F.col("total"))).alias("same_count"),
        (good & (F.col("apart") <= K.KS_ERROR)).alias("within_bound"))
