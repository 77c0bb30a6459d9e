"""Gates: checks that fail a job. Each has a DataFrame form (the verdict as
columns, lazy) and a raising form (the only actions here, on report-sized rows)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.rules import Rule, all_pass

# Gate limits.
MIN_ROWS = 1000
MAX_DROP_RATIO = 0.5
MAX_MAE_RATIO = 1.3
MIN_REQUEST_ROWS = 30


class DataQualityError(Exception):
    """Too few rows survive cleaning, or too many were dropped."""


class DriftAlert(Exception):
    """At least one feature drifted past the alert limit."""


class ModelDegraded(Exception):
    """The model's error on new data is too far above its training error."""


def dropped_ratio(rows_in: Column, rows_out: Column) -> Column:
    return F.when(rows_in == 0, F.lit(0.0)).otherwise(
        F.lit(1.0) - rows_out.cast("double") / rows_in.cast("double"))


def quality_counts(typed: DataFrame, rules: Sequence[Rule], key_cols: Sequence[str]
                   ) -> DataFrame:
    """(rows_in, rows_out, dropped_ratio): rows before cleaning, distinct rows that
    pass every rule (the silver row count), and 1 − out/in (0 when in = 0).

    One grouped pass: group by the de-duplication key and a pass flag, then count.
    """
    keep = all_pass(rules)
    per = typed.groupBy(*key_cols, keep.alias("_keep")).agg(F.count(F.lit(1)).alias("_n"))
    counts = per.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_in"),
                     F.count_if(F.col("_keep")).alias("rows_out"))
    return counts.select("rows_in", "rows_out",
                         dropped_ratio(F.col("rows_in"), F.col("rows_out")).alias("dropped_ratio"))


def quality_verdict(counts: DataFrame, min_rows: int = MIN_ROWS,
                    max_drop_ratio: float = MAX_DROP_RATIO) -> DataFrame:
    """Adds `too_few_rows`, `too_many_dropped`, `passed`, `dropped_ratio` rounded to 4 (half to even)."""
    few = F.col("rows_out") < min_rows
    many = F.col("dropped_ratio") > max_drop_ratio
    return counts.select(
        "rows_in", "rows_out", F.bround("dropped_ratio", 4).alias("dropped_ratio"),
        few.alias("too_few_rows"), many.alias("too_many_dropped"),
        (~few & ~many).alias("passed"))


def counted(spark: SparkSession, rows_in: int, rows_out: int) -> DataFrame:
    """The one-row frame of `quality_counts` from counts that a write has observed."""
    both = spark.range(1).select(F.lit(rows_in).cast("long").alias("rows_in"),
                                 F.lit(rows_out).cast("long").alias("rows_out"))
    return both.withColumn("dropped_ratio", dropped_ratio(F.col("rows_in"), F.col("rows_out")))


def enforce_quality(counts: DataFrame, min_rows: int = MIN_ROWS,
                    max_drop_ratio: float = MAX_DROP_RATIO) -> dict:
    """The verdict row of `quality_counts`; raises DataQualityError with it unless passed."""
    verdict = quality_verdict(counts, min_rows, max_drop_ratio).first().asDict()
    if not verdict.pop("passed"):
        failed = [k for k in ("too_few_rows", "too_many_dropped") if verdict[k]]
        raise DataQualityError(f"{', '.join(failed)}: {verdict}, limits: {min_rows} rows, "
                               f"{max_drop_ratio} dropped")
    return verdict


def raise_on_alerts(report: DataFrame, context: str = "") -> list[str]:
    """Raise DriftAlert naming the alerting features (the report is one row per
    feature, so collecting it is bounded)."""
    names = [r["feature"] for r in report.filter(F.col("status") == "alert")
             .select("feature").collect()]
    if names:
        raise DriftAlert(f"strong drift in {sorted(names)}{context}")
    return names


def performance_verdict(perf: DataFrame, max_ratio: float = MAX_MAE_RATIO) -> DataFrame:
    """Adds `degraded` = mae_ratio > max_ratio."""
    return perf.withColumn("degraded", F.coalesce(F.col("mae_ratio") > max_ratio, F.lit(False)))


def raise_if_degraded(perf: DataFrame, max_ratio: float = MAX_MAE_RATIO) -> None:
    bad = performance_verdict(perf, max_ratio).filter("degraded").limit(1).collect()
    if bad:
        raise ModelDegraded(f"mae_ratio {bad[0]['mae_ratio']:.3f} above {max_ratio}")
