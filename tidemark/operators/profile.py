"""Quantile-bin profiles of many features in one plan.

The wide table is unpivoted once into (feature, value); edges, bin counts and
shares for all features then come out of single grouped aggregations instead
of one job per feature.

Bin i of a feature with sorted distinct inner edges e_1 < ... < e_m is
[e_i, e_{i+1}) with open ends: bin = number of edges <= value. Empty bins are
kept with count 0. Null and NaN values are not counted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import kll
from tidemark.functions.exprs import count_at_most, is_present, row_hash
from tidemark.operators.cumulative import (
    PIECE,
    exact_quantiles,
    in_pieces,
    quantile_hits,
    running_totals,
    value_counts,
)

DEFAULT_BINS = 10
SAMPLE_SIZE = 2000  # rows that the sampling operator returns
BROADCAST_FEATURES = 100_000  # edge tables of more features are joined without a broadcast


def to_long(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(keep..., feature, value double): one row per input row and feature."""
    cast = df.select(*keep, *[F.col(f).cast("double").alias(f) for f in features])
    return cast.unpivot(list(keep), list(features), "feature", "value")


def present(long: DataFrame) -> DataFrame:
    return long.filter(is_present("value"))


def feature_list(spark: SparkSession, features: Sequence[str]) -> DataFrame:
    """The configured feature names as a one-column DataFrame (keeps features that
    have no value at all in the output)."""
    return spark.range(1).select(
        F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))


def quantile_edges(df: DataFrame, features: Sequence[str], n_bins: int = DEFAULT_BINS,
                   exact: bool = True) -> DataFrame:
    """(feature, edges array<double>): deciles (for n_bins=10) per feature, sorted and
    de-duplicated. A feature without values gets the single edge 0.0."""
    probs = [i / n_bins for i in range(1, n_bins)]
    long = present(to_long(df, features))
    if exact:
        q = exact_quantiles(long, ["feature"], "value", probs)
        per = q.groupBy("feature").agg(
            F.array_sort(F.array_distinct(F.collect_list("value"))).alias("edges"))
    else:
        held = long.groupBy("feature").agg(kll.sketch("value").alias("sketch"))
        per = held.select("feature", F.array_sort(F.array_distinct(
            kll.quantiles("sketch", probs))).alias("edges"))
    names = feature_list(df.sparkSession, features)
    return names.join(per, "feature", "left").select(
        "feature",
        F.when(F.coalesce(F.size("edges"), F.lit(0)) > 0, F.col("edges"))
        .otherwise(F.array(F.lit(0.0))).alias("edges"))


def edges_long(edges: DataFrame) -> DataFrame:
    """(feature, edge_no 1-based, edge) from the array form."""
    return edges.select("feature", F.posexplode("edges").alias("pos", "edge")).select(
        "feature", (F.col("pos") + 1).alias("edge_no"), "edge")


def assign_bins(long: DataFrame, edges: DataFrame, n_features: int | None = None) -> DataFrame:
    """Add `bin` = number of edges <= value. `edges` has one row per feature; it is broadcast
    if the caller states that the features are few enough, else Spark decides."""
    if n_features is not None and n_features <= BROADCAST_FEATURES:
        edges = F.broadcast(edges)
    joined = long.join(edges, "feature")
    return joined.withColumn("bin", count_at_most(F.col("edges"), F.col("value"))).drop("edges")


def bin_grid(edges: DataFrame) -> DataFrame:
    """Every bin of every feature: (feature, bin, lower, upper); open ends are null."""
    return edges.select(
        "feature", "edges", F.explode(F.sequence(F.lit(0), F.size("edges"))).alias("bin")
    ).select(
        "feature", "bin",
        F.when(F.col("bin") > 0, F.element_at("edges", F.col("bin"))).alias("lower"),
        F.when(F.col("bin") < F.size("edges"), F.element_at("edges", F.col("bin") + 1))
        .alias("upper"),
    )


def bin_counts(df: DataFrame, features: Sequence[str], edges: DataFrame) -> DataFrame:
    """(feature, bin, lower, upper, count): dense histogram of `df` on `edges`."""
    long = present(to_long(df, features))
    counted = assign_bins(long, edges, len(features)).groupBy("feature", "bin").agg(
        F.count(F.lit(1)).alias("count"))
    return (bin_grid(edges).join(counted, ["feature", "bin"], "left")
            .withColumn("count", F.coalesce(F.col("count"), F.lit(0).cast("bigint"))))


def with_shares(counts: DataFrame, count_col: str = "count",
                share_col: str = "pct") -> DataFrame:
    """count / (sum of counts of the feature); null when the feature has none."""
    total = F.sum(count_col).over(Window.partitionBy("feature"))
    return counts.withColumn(share_col, F.try_divide(F.col(count_col).cast("double"), total))


def baseline_profile(df: DataFrame, features: Sequence[str], n_bins: int = DEFAULT_BINS,
                     exact: bool = True, edges: DataFrame | None = None) -> DataFrame:
    """(feature, bin, lower, upper, expected_count, expected_pct) of the training data."""
    edges = edges if edges is not None else quantile_edges(df, features, n_bins, exact)
    counts = bin_counts(df, features, edges).withColumnRenamed("count", "expected_count")
    return with_shares(counts, "expected_count", "expected_pct")


def edges_from_totals(totals: DataFrame, features: Sequence[str], n_bins: int = DEFAULT_BINS,
                      weight: str = "n") -> DataFrame:
    """(feature, edges): deciles (for n_bins=10) from running totals of per-value counts, see
    `quantile_edges`. Values that only another side has (weight 0) never qualify."""
    probs = [i / n_bins for i in range(1, n_bins)]
    hits = quantile_hits(F.col(f"total_{weight}"), F.col(f"cum_{weight}"), F.col(weight), probs)
    found = totals.filter(F.size(hits) > 0).groupBy("feature").agg(
        F.array_sort(F.collect_list("value")).alias("edges"))
    names = feature_list(totals.sparkSession, features)
    return names.join(found, "feature", "left").select(
        "feature", F.when(F.coalesce(F.size("edges"), F.lit(0)) > 0, F.col("edges"))
        .otherwise(F.array(F.lit(0.0))).alias("edges"))


def bins_from_counts(counts: DataFrame, edges: DataFrame, n_features: int,
                     weights: Mapping[str, str]) -> DataFrame:
    """(feature, bin, lower, upper, names...): dense histogram of per-value counts on `edges`;
    `weights` maps each count column to the name of its sum."""
    per_bin = assign_bins(counts, edges, n_features).groupBy("feature", "bin").agg(
        *[F.sum(w).alias(name) for w, name in weights.items()])
    return bin_grid(edges).join(per_bin, ["feature", "bin"], "left").fillna(
        0, list(weights.values()))


def profile_from_counts(counts: DataFrame, features: Sequence[str], n_bins: int = DEFAULT_BINS
                        ) -> DataFrame:
    """The baseline profile (exact edges) out of stored per-value counts (feature, value, n),
    plain or as `stored_values` has them: the rows themselves are not read."""
    edges = edges_from_totals(running_totals(counts, ["feature"], "value", ["n"]), features, n_bins)
    return with_shares(bins_from_counts(counts.drop(PIECE), edges, len(features), {"n": "expected_count"}),
                       "expected_count", "expected_pct")


def profile_edges(profile: DataFrame) -> DataFrame:
    """Recover (feature, edges) from a stored profile (lower bounds of its bins)."""
    return profile.groupBy("feature").agg(
        F.array_sort(F.collect_list("lower")).alias("edges"))


def baseline_values(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, value, n): how often each present value occurs. Stored with a baseline, it
    lets a later KS test compare with all of it."""
    return value_counts(to_long(df, features), ["feature"], "value")


def stored_values(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """`baseline_values`, written once in (feature, value) order and read back: every later
    running total over them starts from the stored pieces."""
    return in_pieces(baseline_values(df, features), ["feature"], "value")


def sample_values(df: DataFrame, features: Sequence[str], key_cols: Sequence[str],
                  k: int = SAMPLE_SIZE) -> DataFrame:
    """(feature, value): per feature the k present values whose rows have the smallest
    md5 of `key_cols` (ties by value) — a deterministic sample that does not depend
    on partitioning.

    A rank limit by feature: each task keeps its own k best before the shuffle (window
    group limit), so k rows per task and feature move.
    """
    keyed = df.select(row_hash(*key_cols).alias("_h"), *features)
    long = present(to_long(keyed, features, keep=["_h"]))
    order = Window.partitionBy("feature").orderBy("_h", "value")
    return (long.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k)
            .select("feature", "value"))
