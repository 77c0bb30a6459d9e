"""Chronological windows: the oldest `fraction` of rows is `reference`, the rest `new`.

The cutoff is a quantile of whole epoch seconds. It stays lazy: a one-row
DataFrame used as a scalar subquery (evaluated once by Spark, broadcast as a
value), never a number pulled to the driver while the plan is being built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import kll
from tidemark.functions.exprs import whole_seconds
from tidemark.operators.cumulative import exact_quantiles

REFERENCE = "reference"
NEW = "new"
DEFAULT_FRACTION = 0.7


def time_cutoff(df: DataFrame, ts_col: str, fraction: float = DEFAULT_FRACTION,
                exact: bool = True) -> DataFrame:
    """One row, `cutoff_seconds` bigint: the `fraction` quantile of whole epoch
    seconds of `ts_col` (no row for an empty input).

    exact=True: distributed exact discrete quantile; exact=False: from a KLL sketch, one
    pass in bounded memory, with the rank error that `functions.kll` states.
    """
    secs = df.select(whole_seconds(ts_col).alias("_s")).filter(F.col("_s").isNotNull())
    if exact:
        q = exact_quantiles(secs, [], "_s", [fraction])
        return q.select(F.col("_s").alias("cutoff_seconds"))
    held = secs.agg(kll.sketch(F.col("_s").cast("double")).alias("sketch"))
    return (held.select(kll.quantiles("sketch", [fraction])[0].cast("long").alias("cutoff_seconds"))
            .filter(F.col("cutoff_seconds").isNotNull()))


def label_windows(df: DataFrame, ts_col: str, fraction: float = DEFAULT_FRACTION,
                  exact: bool = True, cutoff: Column | None = None,
                  label_col: str = "window") -> DataFrame:
    """Add `label_col`: 'reference' when the whole second of `ts_col` is <= the
    cutoff (ties all go to reference), 'new' otherwise, null for a null time."""
    if cutoff is None:
        cutoff = time_cutoff(df, ts_col, fraction, exact).scalar()
    secs = whole_seconds(ts_col)
    label = F.when(secs <= cutoff, F.lit(REFERENCE)).when(secs.isNotNull(), F.lit(NEW))
    return df.withColumn(label_col, label)


def window_summary(df: DataFrame, label_col: str = "window", ts_col: str | None = None,
                   sums: tuple[str, ...] = (), means: tuple[str, ...] = ()) -> DataFrame:
    """Rows, share of all rows, optional time bounds, sums and means per label."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if ts_col:
        aggs += [F.min(ts_col).alias("min_ts"), F.max(ts_col).alias("max_ts")]
    aggs += [F.sum(c).alias(f"sum_{c}") for c in sums]
    aggs += [F.avg(c).alias(f"avg_{c}") for c in means]
    per = df.groupBy(label_col).agg(*aggs)
    # one row per label (at most three): the share needs no partitioning
    return per.withColumn(
        "share", F.col("n_rows") / F.sum("n_rows").over(Window.partitionBy()))
