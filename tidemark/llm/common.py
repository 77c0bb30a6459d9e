"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import apply_defaults
from tidemark.sources.tables import materialize, read_parquet_table

LIBRARY = str(Path(__file__).resolve().parents[2])
TRAIN_PARTS = 4  # labelled rows fall into four parts by crc32 of the id as text ...
HELD_OUT_PART = 2  # ... and this one is never learned from


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this library from where the driver did, also if that folder
    is neither their working directory nor on their path. (On a cluster the library is
    installed or shipped with the job; the folder then adds nothing.)"""
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if LIBRARY not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, LIBRARY])
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_defaults(importable(spark))
    return read_parquet_table(spark, sf_dir, name)


def utf8(text: str | Column) -> Column:
    """UTF-8 bytes of a text column; null becomes empty."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(c.cast("string"), F.lit("")).cast("binary")


def filled(text: str | Column) -> Column:
    """The text itself; null becomes empty."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(c.cast("string"), F.lit(""))


def held_out(doc_id: str | Column) -> Column:
    """True for rows whose labels must not be learned from (a null id is learned from
    like any other row outside the held-out part)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    part = F.crc32(c.cast("string").cast("binary")) % TRAIN_PARTS
    return F.coalesce(part == HELD_OUT_PART, F.lit(False))


def free_name(base: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, whatever the case of its letters."""
    taken = {c.lower() for df in frames for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def hash_of_row(df: DataFrame) -> Column:
    """A hash of all columns of a row; maps and variants, which have no hash of their own, by
    their JSON text."""
    def hashable(f) -> Column:
        c, kind = F.col(f"`{f.name}`"), f.dataType.simpleString()
        return F.to_json(F.struct(c)) if "map<" in kind or "variant" in kind else c

    return F.xxhash64(*map(hashable, df.schema.fields))


def stored(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder of `spark.checkpoint.dir` and read back:
    lineage ends there, and the data outlives any executor."""
    return materialize(df)


_SHARES = 1 << 30


def hash_share(*key: str) -> Column:
    """A number in [0, 1) that a hash of the key draws."""
    return F.pmod(F.xxhash64(*key, F.lit("share")), F.lit(_SHARES)) / _SHARES


def smallest(df: DataFrame, n: int, group: list[str], order: list[str]) -> DataFrame:
    """The `n` first rows of each group in the given order. Meant for thinned rows: each task
    keeps `n` rows of a group (window group limit) before one task ranks the group."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") <= n).drop("__rank")


def groups_for(n_bytes: int, bytes_per_group: int) -> int:
    """Number of groups so that each holds about `bytes_per_group` bytes."""
    return max(1, -(-int(n_bytes) // int(bytes_per_group)))
