"""Exact running totals in value order, without an un-partitioned window.

An ordered running count over a whole column (exact quantiles, empirical CDFs) would,
written as `Window.orderBy(value)`, move every row into one task. Here it is split:

1. the caller pre-aggregates to one row per distinct (group, value) with weights (partial
   aggregation collapses hot values before any shuffle);
2. a range exchange on (group, value) cuts these rows into as many pieces as the session's
   `spark.sql.shuffle.partitions` says (fewer where the data is small), whatever the
   number of groups; the pieces are written once, so all that follows sees the same cut;
3. a running sum inside (group, piece);
4. the pieces' totals, at most one row per piece and group border, give each piece its
   offset, and are joined back.

A value lies in exactly one piece, so ties are exact, and a task's share shrinks with the
number of pieces: nothing here is fixed by a constant.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.tables import materialize

PIECE = "_piece"


def in_pieces(counts: DataFrame, group_cols: Sequence[str], value_col: str) -> DataFrame:
    """`counts` (one row per distinct group and value) in value order, cut into pieces:
    adds `_piece`, which rises with (group, value). Stored, so it can be read repeatedly."""
    ordered = counts.repartitionByRange(*group_cols, value_col)
    return materialize(ordered.withColumn(PIECE, F.spark_partition_id()))


def running_totals(counts: DataFrame, group_cols: Sequence[str], value_col: str,
                   weight_cols: Sequence[str]) -> DataFrame:
    """Add `cum_<w>` (inclusive running sum of `w` in `value_col` order within the group)
    and `total_<w>` (group total) for every weight column.

    `counts` has one row per distinct (group, value), plain or from `in_pieces`.
    """
    keys = list(group_cols)
    names = [c for c in counts.columns if c != PIECE]
    cut = counts if PIECE in counts.columns else in_pieces(counts, keys, value_col)

    inside = (Window.partitionBy(*keys, PIECE).orderBy(value_col)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = cut.select("*", *[F.sum(w).over(inside).alias(f"_run_{w}") for w in weight_cols])

    per_piece = cut.groupBy(*keys, PIECE).agg(*[F.sum(w).alias(f"_sum_{w}") for w in weight_cols])
    before = Window.partitionBy(*keys).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = per_piece.select(
        *keys, PIECE,
        *[F.coalesce(F.sum(f"_sum_{w}").over(before), F.lit(0)).alias(f"_before_{w}")
          for w in weight_cols],
        *[F.sum(f"_sum_{w}").over(whole).alias(f"total_{w}") for w in weight_cols])

    # no hint: the offsets are broadcast where the session's threshold says they fit
    return running.join(offsets, [*keys, PIECE]).select(
        *names,
        *[(F.col(f"_before_{w}") + F.col(f"_run_{w}")).alias(f"cum_{w}") for w in weight_cols],
        *[F.col(f"total_{w}") for w in weight_cols])


def value_counts(values: DataFrame, group_cols: Sequence[str], value_col: str) -> DataFrame:
    """(group..., value, n): rows of each distinct value; null and NaN are left out."""
    v = F.col(value_col)
    present = values.filter(v.isNotNull() & ~F.isnan(v.cast("double")))
    return present.groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("n"))


def exact_quantiles(values: DataFrame, group_cols: Sequence[str], value_col: str,
                    probs: Sequence[float]) -> DataFrame:
    """Discrete quantiles: for each p the smallest value whose running count reaches
    max(1, ceil(n * p)) — the `percentile_disc` definition.

    Returns (group..., `p_index` int, `p` double, `value_col`) with one row per
    group and probability (groups without values give no rows). Null and NaN
    values are ignored.
    """
    keys = list(group_cols)
    cum = running_totals(value_counts(values, keys, value_col), keys, value_col, ["n"])
    hits = quantile_hits(F.col("total_n"), F.col("cum_n"), F.col("n"), probs)
    at = F.array(*[F.lit(float(p)) for p in probs])
    return (cum.select(*keys, value_col, F.explode(hits).alias("p_index"))
            .select(*keys, "p_index", F.element_at(at, F.col("p_index") + 1).alias("p"), value_col))


def quantile_hits(total: Column, cum: Column, n: Column, probs: Sequence[float]) -> Column:
    """array<int> of the indices i whose discrete quantile probs[i] is this row's
    value: max(1, ceil(total * p)) falls in (cum - n, cum]. One codegen'd
    comparison pair per probability (no lambda); usually an empty array."""
    def rank(p: float) -> Column:
        return F.greatest(F.lit(1).cast("bigint"), F.ceil(total.cast("double") * F.lit(float(p))))

    return F.array_compact(F.array(*[
        F.when((rank(p) > cum - n) & (rank(p) <= cum), F.lit(i)) for i, p in enumerate(probs)]))
