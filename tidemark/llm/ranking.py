"""Ranks of all rows in the order of some columns, without a task that holds a whole group.

A range exchange on (group, order, a number of the row) cuts the rows into pieces of about
equal size, also where one group or one key holds most of them; each piece is sorted and
numbered while it is written, once. What is left is one row per group and piece: how many
rows of the group lie in earlier pieces, which a join adds to the numbers in the piece.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

ROW_BITS = 33  # monotonically_increasing_id: the partition, then 33 bits of row number


def ranked(df: DataFrame, group: list[str], order: list[str], rank: str = "rank",
           total: str = "total") -> DataFrame:
    """`df` with `rank`, from 0 in the order of `order` within the group (nulls first), and
    `total`, the rows of the group. Rows equal in all of `order` are ranked in any order;
    null group keys are groups of their own. Built from `df` by one write; `df` must give the
    same rows in the same order when it is computed again (a scan or a stored table does)."""
    tie, at = f"{rank}_tie", f"{rank}_at"
    cut = (df.withColumn(tie, F.monotonically_increasing_id())
           .repartitionByRange(*group, *order, tie).sortWithinPartitions(*group, *order, tie)
           .drop(tie).withColumn(at, F.monotonically_increasing_id()))
    cut = stored(cut).withColumn(f"{rank}_piece", F.shiftrightunsigned(at, ROW_BITS))
    keys = [*group, f"{rank}_piece"]
    runs = cut.groupBy(*keys).agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy(f"{rank}_piece").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        *[F.col(k).alias(f"{k}_run") for k in keys], F.sum("n").over(whole).alias(total),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}_run")) for k in keys])
    return cut.join(runs, same).select(
        *df.columns, (F.col(at) + F.col("shift")).alias(rank), total)
