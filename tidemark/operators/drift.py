"""Population stability (PSI), exact two-sample Kolmogorov–Smirnov, status, report.

* PSI = Σ (a − e) · ln(a / e) over the bins of a feature, with both shares
  clipped below at 1e-6 and not renormalised.
* KS = max |F_a(x) − F_b(x)| over all values, computed exactly and distributed
  from per-value counts and two-level running sums (no driver-side sample).
* status from the unrounded PSI: < 0.1 ok, < 0.25 warning, else alert (NaN →
  alert); no data → `no_data`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.cumulative import PIECE, in_pieces, running_totals
from tidemark.operators.profile import (
    baseline_values,
    bin_counts,
    bins_from_counts,
    edges_from_totals,
    present,
    profile_edges,
    to_long,
    with_shares,
)
from tidemark.sources.tables import materialize

# Clip of empty shares, PSI limits.
PSI_EPS = 1e-6
PSI_WARNING = 0.1
PSI_ALERT = 0.25

OK, WARNING, ALERT, NO_DATA = "ok", "warning", "alert", "no_data"


def psi_status(psi: Column) -> Column:
    return (F.when(psi.isNull(), F.lit(NO_DATA))
            .when(psi < PSI_WARNING, F.lit(OK))
            .when(psi < PSI_ALERT, F.lit(WARNING))
            .otherwise(F.lit(ALERT)))


def actual_bins(df: DataFrame, features: Sequence[str], profile: DataFrame) -> DataFrame:
    """(feature, bin, actual_count, actual_pct) of new data on the profile's bins."""
    counts = bin_counts(df, features, profile_edges(profile)).select(
        "feature", "bin", F.col("count").alias("actual_count"))
    return with_shares(counts, "actual_count", "actual_pct")


def psi_terms(expected_pct: Column, actual_pct: Column) -> Column:
    """PSI over a group of bins; null when either side has no data (a share is null)."""
    e, a = F.greatest(expected_pct, F.lit(PSI_EPS)), F.greatest(actual_pct, F.lit(PSI_EPS))
    unknown = F.count_if(expected_pct.isNull() | actual_pct.isNull())
    return F.when(unknown == 0, F.sum((a - e) * F.ln(a / e)))


def psi_from_bins(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(feature, psi, bins). `expected` has (feature, bin, expected_pct), `actual`
    (feature, bin, actual_pct); both dense and small."""
    joined = expected.select("feature", "bin", "expected_pct").join(
        actual.select("feature", "bin", "actual_pct"), ["feature", "bin"], "left")
    return joined.groupBy("feature").agg(
        psi_terms(F.col("expected_pct"), F.col("actual_pct")).alias("psi"),
        F.count(F.lit(1)).alias("bins"))


def psi(df: DataFrame, features: Sequence[str], profile: DataFrame) -> DataFrame:
    """(feature, psi, bins) of `df` against a baseline profile."""
    return psi_from_bins(profile, actual_bins(df, features, profile))


def sided_counts(sided: DataFrame, side_col: str = "side", a: str = "a", b: str = "b"
                 ) -> DataFrame:
    """(feature, value, n_a, n_b): one aggregation of a long frame (feature, value, side)."""
    return present(sided).groupBy("feature", "value").agg(
        F.count_if(F.col(side_col) == a).alias("n_a"),
        F.count_if(F.col(side_col) == b).alias("n_b"))


def ks_from_totals(cum: DataFrame) -> DataFrame:
    """(feature, ks) from running totals of n_a and n_b; null if a side is empty."""
    def cdf(w: str) -> Column:
        return F.try_divide(F.col(f"cum_{w}").cast("double"), F.col(f"total_{w}"))
    return cum.groupBy("feature").agg(F.max(F.abs(cdf("n_a") - cdf("n_b"))).alias("ks"))


def ks_from_counts(counts: DataFrame) -> DataFrame:
    """(feature, ks) from (feature, value, n_a, n_b)."""
    return ks_from_totals(running_totals(counts, ["feature"], "value", ["n_a", "n_b"]))


def ks_from_long(sided: DataFrame, side_col: str = "side", a: str = "a",
                 b: str = "b") -> DataFrame:
    """(feature, ks) from a long frame (feature, value, side)."""
    return ks_from_counts(sided_counts(sided, side_col, a, b))


def ks_statistic(expected: DataFrame, actual: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, ks) between two wide DataFrames over the same features."""
    sided = (to_long(expected, features).withColumn("side", F.lit("a"))
             .unionByName(to_long(actual, features).withColumn("side", F.lit("b"))))
    return ks_from_long(sided)


def ks_against_baseline(baseline: DataFrame, counts: DataFrame) -> DataFrame:
    """(feature, ks) of new per-value counts (feature, value, n) against those of a stored
    baseline, see `profile.baseline_values`."""
    none = F.lit(0).cast("bigint")
    new = counts.select("feature", "value", none.alias("n_a"), F.col("n").alias("n_b"))
    old = baseline.select("feature", F.col("value").cast("double").alias("value"),
                          F.col("n").alias("n_a"), none.alias("n_b"))
    both = old.unionByName(new).groupBy("feature", "value").agg(
        F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    return ks_from_counts(both)


def report(psi_df: DataFrame, ks_df: DataFrame, digits: int | None = 4) -> DataFrame:
    """(feature, psi, ks, status, and `bins` if given): status from the unrounded PSI, then rounding (half to even)."""
    joined = psi_df.join(ks_df, "feature", "left")
    status, more = psi_status(F.col("psi")), [c for c in psi_df.columns if c == "bins"]
    if digits is None:
        return joined.select("feature", "psi", "ks", status.alias("status"), *more)
    return joined.select("feature", F.bround("psi", digits).alias("psi"),
                         F.bround("ks", digits).alias("ks"), status.alias("status"), *more)


def drift_report(reference: DataFrame, new: DataFrame, features: Sequence[str],
                 profile: DataFrame, digits: int | None = 4) -> DataFrame:
    """One row per feature: PSI of `new` on the profile's bins and exact KS between
    the reference data and `new`."""
    found = psi(new, features, profile).drop("bins")
    return report(found, ks_statistic(reference, new, features), digits)


def drift_from_baseline(new: DataFrame, features: Sequence[str], profile: DataFrame,
                        values: DataFrame, digits: int | None = 4) -> DataFrame:
    """One row per feature: drift of `new` from a stored baseline (its profile and its value
    counts), without reading the reference data again. The new rows are read once: PSI and KS
    both come out of their stored per-value counts."""
    counts = materialize(baseline_values(new, features))
    actual = bins_from_counts(counts, profile_edges(profile), len(features), {"n": "actual_count"})
    shares = with_shares(actual, "actual_count", "actual_pct")
    found = psi_from_bins(profile, shares).drop("bins")
    return report(found, ks_against_baseline(values, counts), digits)


def scale_columns(df: DataFrame, factors: Mapping[str, float], where: Column | None = None
                  ) -> DataFrame:
    """What-if scaling of columns (drift simulation), of the rows `where` is true of."""
    def scaled(c: str, f: float) -> Column:
        by = F.col(c) * F.lit(float(f))
        return by if where is None else F.when(where, by).otherwise(F.col(c))
    return df.withColumns({c: scaled(c, f) for c, f in factors.items()})


def alerts(report_df: DataFrame) -> DataFrame:
    """Rows of the report whose status is `alert`."""
    return report_df.filter(F.col("status") == ALERT)


def window_drift(labelled: DataFrame, features: Sequence[str], label_col: str = "window",
                 reference: str = "reference", new: str = "new", n_bins: int = 10,
                 digits: int | None = 4) -> DataFrame:
    """(feature, psi, ks, status, bins): the drift of the rows labelled `new` from those
    labelled `reference`, from one aggregation of the data.

    The rows are reduced once to (feature, value, n_a, n_b), stored in value order. One pass
    of running totals over that gives the reference quantiles (the bin edges) and both
    empirical CDFs (KS); the histograms are sums of the per-value counts by bin.
    """
    long = to_long(labelled, features, keep=[label_col])
    counts = in_pieces(sided_counts(long, label_col, reference, new), ["feature"], "value")
    cum = running_totals(counts, ["feature"], "value", ["n_a", "n_b"])

    edges = edges_from_totals(cum, features, n_bins, "n_a")
    dense = bins_from_counts(counts.drop(PIECE), edges, len(features),
                             {"n_a": "expected_count", "n_b": "actual_count"})
    shares = with_shares(with_shares(dense, "expected_count", "expected_pct"),
                         "actual_count", "actual_pct")
    psi_df = shares.groupBy("feature").agg(
        psi_terms(F.col("expected_pct"), F.col("actual_pct")).alias("psi"),
        F.count(F.lit(1)).alias("bins"))
    return report(psi_df, ks_from_totals(cum), digits)
