"""As-of join: each left row meets the newest right row of its key at or before its time.

Both sides are put in one order, (key, time, right before left), and cut into pieces by a
range exchange, as `cumulative` does; inside a piece the last right row is carried forward,
and a piece's first rows take theirs from the last earlier piece that has one for the key
(one row per key and piece). So a key, or an instant, that holds most rows is spread over
many tasks, and nothing is broadcast or expanded: the output has the left side's rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.tables import materialize

PIECE = "_piece"


def asof_join(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str,
              right_time: str, take: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """All columns of `left`, and the columns `take` of the newest right row with equal `on`
    and `right_time <= left_time`; of right rows at one time the largest in `tie` counts.

    Left rows without such a row get nulls, as do those with a null key or time; right rows
    with a null key or time match nothing. Both sides' times must be of one type.
    """
    keys = list(on)
    known = [F.col(c).isNotNull() for c in (*keys, right_time)]
    rights = right.filter(reduce(lambda a, b: a & b, known)).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(right_time).alias("_t"),
        F.lit(0).alias("_side"), F.lit(0).cast("long").alias("_salt"),
        *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie)],
        F.struct(*take).alias("_right"))
    lefts = left.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(left_time).alias("_t"),
        F.lit(1).alias("_side"), F.monotonically_increasing_id().alias("_salt"),
        F.struct(*left.columns).alias("_left"))
    names = [f"_k{i}" for i in range(len(keys))]
    ties = [f"_tie{i}" for i in range(len(tie))]
    cut = materialize(rights.unionByName(lefts, allowMissingColumns=True)
                      .repartitionByRange(*names, "_t", "_side", "_salt")
                      .withColumn(PIECE, F.spark_partition_id()))

    so_far = (Window.partitionBy(*names, PIECE).orderBy("_t", "_side", *ties)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = cut.withColumn("_seen", F.last("_right", ignorenulls=True).over(so_far)).filter(
        F.col("_side") == 1)
    newest = F.max_by("_right", F.struct("_t", *ties))
    per_piece = cut.groupBy(*names, PIECE).agg(
        F.max_by("_right", F.when(F.col("_side") == 0, F.struct("_t", *ties))).alias("_newest")
        if ties else newest.alias("_newest"))
    earlier = Window.partitionBy(*names).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    carried = per_piece.select(
        *[F.col(n).alias(f"{n}_p") for n in names], F.col(PIECE).alias("_piece_p"),
        F.last("_newest", ignorenulls=True).over(earlier).alias("_carried"))
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"{n}_p")) for n in names],
                  F.col(PIECE) == F.col("_piece_p"))
    out = inside.join(carried, same).select(
        "_left", F.coalesce("_seen", "_carried").alias("_right"))
    return out.select("_left.*", *[F.col("_right")[c].alias(c) for c in take])
