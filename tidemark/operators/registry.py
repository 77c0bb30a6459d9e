"""Model versions and aliases as append-only tables.

* `model_versions(model_name, version, run_id, rmse, mae, path, created_at)`
* `model_aliases(model_name, alias, version, set_at)` — every alias move is a
  new row; the current holder of an alias is the latest row (ties: higher
  version), so nothing is ever updated in place.

All lookups are grouped aggregations with partial aggregation (`max_by`), so a
model with a third of all versions does not land whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.asof import asof_join

CHAMPION = "champion"
CHALLENGER = "challenger"


def latest_version(versions: DataFrame, run_id: str | Column | None = None) -> DataFrame:
    """(model_name, version, run_id, rmse, mae): the highest version per model.

    With `run_id`, only that run's versions count — falling back to all versions
    of a model that has none from that run.
    """
    ver = F.struct("version", "run_id", "rmse", "mae")
    if run_id is None:
        best = versions.groupBy("model_name").agg(F.max_by(ver, "version").alias("v"))
    else:
        mine = F.col("run_id") == (run_id if isinstance(run_id, Column) else F.lit(run_id))
        best = versions.groupBy("model_name").agg(
            F.max_by(F.when(mine, ver), F.when(mine, F.col("version"))).alias("m"),
            F.max_by(ver, "version").alias("a"),
        ).select("model_name", F.coalesce("m", "a").alias("v"))
    return best.select("model_name", "v.*")


def current_alias(aliases: DataFrame) -> DataFrame:
    """(model_name, alias, version, set_at): who holds each alias now."""
    return (aliases.groupBy("model_name", "alias")
            .agg(F.max_by(F.struct("version", "set_at"), F.struct("set_at", "version"))
                 .alias("c"))
            .select("model_name", "alias", "c.version", "c.set_at"))


def in_force(rows: DataFrame, aliases: DataFrame, alias: str, time_column: str,
             model_column: str = "model_name") -> DataFrame:
    """`rows` with `version` and `set_at`: who held `alias` of the row's model at the row's
    time (ties of moves: the higher version); nulls before its first move."""
    moves = aliases.filter(F.col("alias") == alias).select(
        F.col("model_name").alias(model_column), "version", "set_at")
    return asof_join(rows, moves, [model_column], time_column, "set_at", ["version", "set_at"],
                     tie=["version"])


def decide_alias(new_rmse: Column, champion_exists: Column, champion_rmse: Column) -> Column:
    """No champion → champion; champion without RMSE, or strictly better → champion;
    otherwise (ties included) → challenger."""
    return (F.when(~champion_exists, F.lit(CHAMPION))
            .when(champion_rmse.isNull(), F.lit(CHAMPION))
            .when(new_rmse < champion_rmse, F.lit(CHAMPION))
            .otherwise(F.lit(CHALLENGER)))


def promotion_decision(versions: DataFrame, aliases: DataFrame,
                       candidates: DataFrame | None = None) -> DataFrame:
    """(model_name, candidate_version, candidate_rmse, champion_version,
    champion_rmse, decision) for each model's candidate (default: its latest
    version)."""
    cand = (candidates if candidates is not None else latest_version(versions)).select(
        "model_name", F.col("version").alias("candidate_version"),
        F.col("rmse").alias("candidate_rmse"))
    champ = current_alias(aliases).filter(F.col("alias") == CHAMPION).select(
        "model_name", F.col("version").alias("champion_version"))
    champ_rmse = champ.join(
        versions.select("model_name", F.col("version").alias("champion_version"),
                        F.col("rmse").alias("champion_rmse")),
        ["model_name", "champion_version"], "left")
    joined = cand.join(champ_rmse, "model_name", "left")
    return joined.select(
        "model_name", "candidate_version", "candidate_rmse", "champion_version",
        "champion_rmse",
        decide_alias(F.col("candidate_rmse"), F.col("champion_version").isNotNull(),
                     F.col("champion_rmse")).alias("decision"))


def alias_row(spark, model_name: str, alias: str, version: int) -> DataFrame:
    """One alias move, to be appended to `model_aliases`."""
    return spark.range(1).select(
        F.lit(model_name).alias("model_name"), F.lit(alias).alias("alias"),
        F.lit(int(version)).cast("bigint").alias("version"),
        F.current_timestamp().alias("set_at"))
