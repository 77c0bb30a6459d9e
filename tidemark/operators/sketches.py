"""Drift from stored quantile sketches: edges, shares, PSI and KS without the rows.

One aggregation of the rows gives a KLL sketch per feature and day (and whatever else the
caller keeps, such as the window label); these are stored. Any set of days is then merged
into one sketch per feature, and the report between two such sets reads sketches only.

Errors are stated, not hoped for. Distributions are compared by their quantile grids, whose
ranks are off by at most `GRID_ERROR` (see `functions.kll`), so a bin's share is off by at
most twice that, and so is KS; PSI is given with the least and largest value that shares
within that distance can have.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import kll
from tidemark.operators import drift as D
from tidemark.operators import profile as P

SHARE_ERROR = 2 * kll.GRID_ERROR  # a share is the difference of two ranks
KS_ERROR = 2 * kll.GRID_ERROR  # KS compares one rank of each side


# ---------------------------------------------------------------- build
def feature_sketches(df: DataFrame, features: Sequence[str], keep: Sequence[str] = (),
                     k: int = kll.K) -> DataFrame:
    """(keep..., feature, n, sketch): present values only. Partial aggregation: tasks send
    sketches, not values, so a hot feature or day costs a few of them."""
    long = P.present(P.to_long(df, features, keep))
    return long.groupBy(*keep, "feature").agg(F.count(F.lit(1)).alias("n"),
                                              kll.sketch("value", k).alias("sketch"))


def daily_sketches(df: DataFrame, features: Sequence[str], ts_col: str,
                   keep: Sequence[str] = (), k: int = kll.K) -> DataFrame:
    """(keep..., day, feature, n, sketch): one row per feature and day of `ts_col`."""
    return feature_sketches(df.withColumn("day", F.to_date(ts_col)), features, [*keep, "day"], k)


def merged(sketches: DataFrame, keys: Sequence[str] = ("feature",), k: int = kll.K) -> DataFrame:
    """(keys..., n, sketch) of the union of what the sketches have seen."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), kll.merge("sketch", k).alias("sketch"))


# ---------------------------------------------------------------- read
def sketch_edges(sketches: DataFrame, features: Sequence[str],
                 n_bins: int = P.DEFAULT_BINS) -> DataFrame:
    """(feature, edges) from one sketch per feature: sorted distinct quantiles; the single
    edge 0.0 where there is none."""
    probs = [i / n_bins for i in range(1, n_bins)]
    per = sketches.select("feature", F.array_sort(F.array_distinct(
        kll.quantiles("sketch", probs))).alias("edges"))
    names = P.feature_list(sketches.sparkSession, features)
    return names.join(per, "feature", "left").select(
        "feature", F.coalesce("edges", F.array(F.lit(0.0))).alias("edges"))


def shares_of(grid: Column, edges: Column) -> Column:
    """array<double>: share of each bin [e_i, e_i+1) of the distribution of a grid."""
    def below(e: Column) -> Column:
        return F.size(F.filter(grid, lambda v: v < e)) / F.size(grid)

    upto = F.concat(F.array(F.lit(0.0)), F.transform(edges, below), F.array(F.lit(1.0)))
    return F.when(grid.isNotNull(), F.transform(
        F.sequence(F.lit(1), F.size(edges) + 1),
        lambda i: F.element_at(upto, i + 1) - F.element_at(upto, i)))


def sketch_profile(sketches: DataFrame, edges: DataFrame) -> DataFrame:
    """(feature, bin, lower, upper, n, pct): the profile of sketched values on given edges;
    shares are off by at most `SHARE_ERROR`."""
    known = edges.join(sketches.select("feature", "n", kll.grid("sketch").alias("grid")), "feature")
    shares = known.select("feature", "n", F.posexplode(
        shares_of(F.col("grid"), F.col("edges"))).alias("bin", "pct"))
    return P.bin_grid(edges).join(shares, ["feature", "bin"], "left")


# ---------------------------------------------------------------- compare
def psi_limits(e: Column, a: Column, error: float) -> tuple[Column, Column]:
    """Least and largest PSI term of shares within `error` of `e` and `a`.

    The term (a - e) ln(a / e) is convex in both shares: the largest lies at a corner, and
    no value is below the tangent plane at the middle (nor below zero).
    """
    def clip(x: Column) -> Column:
        return F.greatest(F.least(x, F.lit(1.0)), F.lit(D.PSI_EPS))

    def term(x: Column, y: Column) -> Column:
        return (x - y) * F.ln(x / y)

    a, e = clip(a), clip(e)
    slope = F.abs(F.ln(a / e) + 1 - e / a) + F.abs(F.ln(a / e) - 1 + a / e)
    corners = [term(clip(a + s * error), clip(e + t * error)) for s in (-1, 1) for t in (-1, 1)]
    return F.greatest(term(a, e) - slope * error, F.lit(0.0)), F.greatest(*corners)


def _total(terms: Column) -> Column:
    return F.aggregate(terms, F.lit(0.0), lambda x, y: x + y)


def ks_between(a: Column, b: Column) -> Column:
    """KS statistic of two grids, exact for them: their values are passed in ascending order
    and the distance of the two running shares is taken wherever the value changes."""
    def steps(grid: Column, da: float, db: float) -> Column:
        return F.transform(grid, lambda v: F.struct(
            v.alias("v"), F.lit(da).alias("a"), F.lit(db).alias("b")))

    def apart(s: Column) -> Column:
        return F.greatest(s["most"], F.abs(s["a"] / F.size(a) - s["b"] / F.size(b)))

    def passed(s: Column, x: Column) -> Column:
        return F.struct(x["v"].alias("v"), (s["a"] + x["a"]).alias("a"), (s["b"] + x["b"]).alias("b"),
                        F.when(x["v"] > s["v"], apart(s)).otherwise(s["most"]).alias("most"))

    ordered = F.array_sort(F.concat(steps(a, 1.0, 0.0), steps(b, 0.0, 1.0)))
    start = F.struct(F.lit(float("-inf")).alias("v"), F.lit(0.0).alias("a"), F.lit(0.0).alias("b"),
                     F.lit(0.0).alias("most"))
    return F.aggregate(ordered, start, passed, lambda s: apart(s))


def _names(edges: DataFrame) -> list[str]:
    """The feature names of an edge table (one row per configured feature)."""
    return [r["feature"] for r in edges.select("feature").collect()]


def sketch_drift(reference: DataFrame, new: DataFrame, edges: DataFrame, by: Sequence[str] = ()
                 ) -> DataFrame:
    """(by..., feature, n_reference, n_new, psi, psi_low, psi_high, ks, ks_low, ks_high, status)
    from one sketch per feature of the reference and one per (by..., feature) of the new
    values; `edges` names the features and their bins. PSI and KS of all rows lie between
    `low` and `high`. A feature that one side has no value of is `no_data`."""
    def side(df: DataFrame, name: str, keys: Sequence[str]) -> DataFrame:
        return df.select(*keys, F.col("n").alias(f"n_{name}"), kll.grid("sketch").alias(name))

    keys = [*by, "feature"]
    base = edges.select("feature", "edges")
    if by:  # every feature of every group, also those that the group has no value of
        base = new.select(*by).distinct().select(
            *by, F.explode(F.array(*map(F.lit, _names(edges)))).alias("feature")).join(base, "feature")
    both = base.join(side(reference, "reference", ["feature"]), "feature", "left").join(
        side(new, "new", keys), keys, "left")
    both = both.select(
        *keys, "n_reference", "n_new",
        F.zip_with(shares_of(F.col("reference"), F.col("edges")),
                   shares_of(F.col("new"), F.col("edges")),
                   lambda e, a: F.struct(e.alias("e"), a.alias("a"))).alias("bins"),
        ks_between(F.col("reference"), F.col("new")).alias("ks"))

    def clipped(x: Column) -> Column:
        return F.greatest(x, F.lit(D.PSI_EPS))

    def summed(term) -> Column:
        return _total(F.transform("bins", term))

    out = both.select(
        *keys, "n_reference", "n_new",
        summed(lambda b: (clipped(b["a"]) - clipped(b["e"]))
               * F.ln(clipped(b["a"]) / clipped(b["e"]))).alias("psi"),
        summed(lambda b: psi_limits(b["e"], b["a"], SHARE_ERROR)[0]).alias("psi_low"),
        summed(lambda b: psi_limits(b["e"], b["a"], SHARE_ERROR)[1]).alias("psi_high"),
        "ks", F.greatest(F.col("ks") - KS_ERROR, F.lit(0.0)).alias("ks_low"),
        F.least(F.col("ks") + KS_ERROR, F.lit(1.0)).alias("ks_high"))
    return out.withColumn("status", D.psi_status(F.col("psi")))


# ---------------------------------------------------------------- check
def rank_bounds(long: DataFrame, points: DataFrame, keys: Sequence[str] = ("feature",)
                ) -> DataFrame:
    """(keys..., total, points, below, at_most): exactly how many values of a long frame
    (keys..., value) lie below and at or below each point. `points` has one sorted array
    without repeats per group. One pass: values are counted by their place among the points."""
    value = F.col("value")
    place = F.struct(F.size(F.filter("points", lambda p: p < value)).alias("lt"),
                     F.size(F.filter("points", lambda p: p <= value)).alias("le"))
    placed = long.join(points, list(keys)).groupBy(*keys, "points", place.alias("place")).agg(
        F.count(F.lit(1)).alias("n"))
    cells = placed.groupBy(*keys, "points").agg(
        F.sum("n").alias("total"), F.collect_list(F.struct("place.*", "n")).alias("cells"))

    def counted(passed: str) -> Column:
        # below point i is a value that at most i of the sorted points have reached
        return F.transform(F.sequence(F.lit(0), F.size("points") - 1), lambda i: F.aggregate(
            "cells", F.lit(0).cast("long"),
            lambda n, c: n + F.when(c[passed] <= i, c["n"]).otherwise(0)))

    return cells.select(*keys, "total", "points", counted("le").alias("below"),
                        counted("lt").alias("at_most"))


def within_ranks(total: Column, below: Column, at_most: Column, p: Column | float,
                 error: float = kll.RANK_ERROR) -> Column:
    """Whether a value with these counts is a quantile at `p` up to the rank error."""
    slack = F.lit(error) + 1 / total
    return (below / total <= F.lit(p) + slack) & (at_most / total >= F.lit(p) - slack)
