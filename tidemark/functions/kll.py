"""KLL quantile sketches as column expressions (built-in aggregates and functions).

A sketch summarises any number of values in bounded memory, and sketches merge: that of a
union comes from those of its parts, whatever the cut. Its rank error is a share of all
values, the same for every rank: `RANK_ERROR` is stated well above the error that the
sketch's size gives with 99 % confidence (2.296 / K ** 0.9723, here 0.0007), so that many
ranks read from one sketch keep it together. Up to K values a sketch is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.exprs import col_of

K = 4096
RANK_ERROR = 0.002
GRID = 2000
GRID_ERROR = RANK_ERROR + 0.5 / GRID


def sketch(value: str | Column, k: int = K) -> Column:
    """Aggregate: the sketch of a double column. Callers drop null and NaN before."""
    return F.kll_sketch_agg_double(col_of(value), F.lit(k))


def merge(sketches: str | Column, k: int = K) -> Column:
    """Aggregate: the sketch of everything that the sketches of a column have seen."""
    return F.kll_merge_agg_double(col_of(sketches), F.lit(k))


def size(sketch_col: str | Column) -> Column:
    """Number of values seen."""
    return F.kll_sketch_get_n_double(col_of(sketch_col))


def quantiles(sketch_col: str | Column, probs: Sequence[float]) -> Column:
    """array<double>: per probability the smallest value whose rank reaches it (about);
    null for a sketch of nothing."""
    c = col_of(sketch_col)
    return F.when(size(c) > 0, F.kll_sketch_get_quantile_double(
        c, F.array(*[F.lit(float(p)) for p in probs])))


def grid(sketch_col: str | Column, points: int = GRID) -> Column:
    """array<double>: `points` values in ascending order that stand for equal shares of the
    sketched ones (the quantiles in the middle of each share); null for a sketch of nothing.

    Ranks at values that are no literals are read from it (the built-in rank function takes
    literals only): the share of grid values below, or at or below, a value is off by at most
    `GRID_ERROR`, which is the rank error and half a step.
    """
    return quantiles(sketch_col, [(i + 0.5) / points for i in range(points)])
