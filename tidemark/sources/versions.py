"""Whole versions of a table: written beside the old one, made visible by one commit.

    <root>/data/<id>/          rows of one attempt (Parquet)
    <root>/commits/<version>.json   one commit row: version, id, rows, schema, time, note

A writer fills a folder of its own and then puts the next commit, which exists or does not:
a write that fails half-way leaves no commit, so readers keep the old rows. Two writers that
want the same number are told apart by the file system, and the later one takes the next.
Readers resolve the newest commit, or an older one by number or time, when they plan; files
of a version never change, so a running query is not disturbed by a new one. `vacuum` removes
versions beyond those to keep, and folders of attempts that never committed.

A commit needs a file system on which a rename does not replace an existing file (HDFS and
its kin; local folders, where a hard link does the same).
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMMIT = T.StructType([
    T.StructField("version", T.LongType()), T.StructField("id", T.StringType()),
    T.StructField("n_rows", T.LongType()), T.StructField("committed_at", T.DoubleType()),
    T.StructField("schema", T.StringType()), T.StructField("note", T.StringType())])
DAY = 86_400.0


class NoSuchVersion(LookupError):
    """The table has no version, or not the one asked for."""


# ---------------------------------------------------------------- files
def _path(spark: SparkSession, path: str):
    """(file system, path) of the session's Hadoop configuration."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def listed(spark: SparkSession, folder: str) -> list[tuple[str, float]]:
    """(name, seconds since its last change) of what lies in a folder; hidden files are not."""
    fs, at = _path(spark, folder)
    if not fs.exists(at):
        return []
    now = time.time()
    found = [(s.getPath().getName(), now - s.getModificationTime() / 1000)
             for s in fs.listStatus(at)]
    return sorted(x for x in found if not x[0].startswith("."))


def deleted(spark: SparkSession, path: str) -> None:
    fs, at = _path(spark, path)
    fs.delete(at, True)


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, unless it is there: of several writers exactly one gets True."""
    folder, _, name = path.rpartition("/")
    fs, at = _path(spark, path)
    if fs.exists(at):
        return False
    _, temp = _path(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    out = fs.create(temp, True)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getUri().getScheme() == "file":  # its rename would replace the target
            os.link(temp.toUri().getPath(), at.toUri().getPath())
        else:
            gateway, options = spark.sparkContext._gateway, spark._jvm.org.apache.hadoop.fs.Options
            how = gateway.new_array(options.Rename, 1)
            how[0] = options.Rename.NONE
            spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                fs.getUri(), spark._jsc.hadoopConfiguration()).rename(temp, at, how)
        return True
    except FileExistsError:
        return False
    except Exception:
        if fs.exists(at):
            return False
        raise
    finally:
        fs.delete(temp, False)


def next_free(spark: SparkSession, folder: str, first: int, text, suffix: str = "") -> int:
    """Claim the smallest free number from `first` on: `<folder>/<number><suffix>` is put with
    `text(number)`. Concurrent callers get different numbers."""
    number = first
    while not put_if_absent(spark, f"{folder}/{number:012d}{suffix}", text(number)):
        number += 1
    return number


# ---------------------------------------------------------------- versions
def commits(spark: SparkSession, root: str) -> DataFrame:
    """The commit rows (version, id, n_rows, committed_at, schema, note)."""
    folder = f"{root}/commits"
    if not listed(spark, folder):
        return spark.createDataFrame([], COMMIT)
    return spark.read.schema(COMMIT).json(folder)


def _commit(spark: SparkSession, root: str, version: int) -> dict:
    row = spark.read.schema(COMMIT).json(f"{root}/commits/{version:012d}.json").first()
    return row.asDict()


def newest(spark: SparkSession, root: str) -> int | None:
    """Number of the newest version; None before the first."""
    names = [n for n, _ in listed(spark, f"{root}/commits")]
    return int(names[-1].partition(".")[0]) if names else None


def publish(df: DataFrame, root: str, partition_by: Sequence[str] = (), note: str | None = None
            ) -> dict:
    """Write `df` as the next version of the table at `root`; the commit row. Rows are counted
    on the write itself."""
    spark = df.sparkSession
    folder, seen = uuid.uuid4().hex, Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.partitionBy(*partition_by).parquet(f"{root}/data/{folder}")
    row = {"id": folder, "n_rows": int(seen.get["rows"]), "committed_at": time.time(),
           "schema": df.schema.json(), "note": note}
    version = next_free(spark, f"{root}/commits", (newest(spark, root) or 0) + 1,
                        lambda n: json.dumps({"version": n, **row}), ".json")
    return {"version": version, **row}


def read_version(spark: SparkSession, root: str, version: int | None = None,
                 as_of: float | None = None) -> DataFrame:
    """Rows of the newest version, of version `version`, or of the newest one committed at
    `as_of` (epoch seconds) or before."""
    if as_of is not None:
        version = commits(spark, root).filter(F.col("committed_at") <= as_of).agg(
            F.max("version")).first()[0]
    elif version is None:
        version = newest(spark, root)
    if version is None or not listed(spark, f"{root}/commits/{version:012d}.json"):
        raise NoSuchVersion(f"{root}: version {version}")
    row = _commit(spark, root, version)
    schema = T.StructType.fromJson(json.loads(row["schema"]))
    try:
        return spark.read.schema(schema).parquet(f"{root}/data/{row['id']}")
    except AnalysisException as e:
        raise NoSuchVersion(f"{root}: version {version} was vacuumed") from e


def vacuum(spark: SparkSession, root: str, keep: int = 2, older_than: float = 7 * DAY) -> list[str]:
    """Remove the data of all but the `keep` newest versions, if their successors are older
    than `older_than` seconds (readers that began before have ended), and of attempts without
    a commit that have not changed for as long; the removed folders. Commit rows stay, as the
    history."""
    rows = commits(spark, root).orderBy(F.desc("version")).collect()  # a row per version
    replaced = {r["id"]: time.time() - after["committed_at"] for r, after in zip(rows[1:], rows)}
    kept = {r["id"] for r in rows[:keep]}
    gone = [n for n, age in listed(spark, f"{root}/data")
            if n not in kept and replaced.get(n, age) >= older_than]
    for name in gone:
        deleted(spark, f"{root}/data/{name}")
    return gone


def vacuum_intermediates(spark: SparkSession, older_than: float = 2 * DAY) -> list[str]:
    """Remove stored intermediates (`materialize`, pipeline stages) of the shared checkpoint
    folder that no running job can need any more: unchanged for `older_than` seconds."""
    from tidemark.session import ensure_checkpoint_dir

    folder = ensure_checkpoint_dir(spark).rstrip("/")
    gone = [n for n, age in listed(spark, folder)
            if n.startswith(("stored-", "pipeline-")) and age >= older_than]
    for name in gone:
        deleted(spark, f"{folder}/{name}")
    return gone


# ---------------------------------------------------------------- catalogue
def publish_table(df: DataFrame, name: str, root: str, partition_by: Sequence[str] = (),
                  note: str | None = None) -> dict:
    """Publish, and let the catalogue's `name` show the newest version (a view, replaced at
    once), for readers that go by name."""
    spark = df.sparkSession
    done = publish(df, root, partition_by, note)
    while True:
        shown = newest(spark, root)
        row = _commit(spark, root, shown)
        if row["n_rows"] == 0:  # a partitioned write of no rows has no file to take a schema from
            schema = T.StructType.fromJson(json.loads(row["schema"]))
            spark.createDataFrame([], schema).write.mode("append").parquet(f"{root}/data/{row['id']}")
        spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{root}/data/{row['id']}`")
        if newest(spark, root) == shown:
            return done
