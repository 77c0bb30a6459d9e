"""Silver grown batch by batch: only new rows are cleaned, only the days they touch are read.

    <root>/data/attempt=<id>/day=<date>/    rows that an attempt at a batch adds
    <root>/commits/<number>.json            one commit row per batch (or compaction)

A batch is cleaned and made distinct on its own; rows that silver has already are left out by
an anti join. Silver rows carry their time, so a duplicate lies in the same day: of silver
only the days of the batch are read (partition filters). Whether a batch is in silver is one
commit: a run that dies leaves an attempt that no reader looks at, running a batch again does
nothing, and of two runs at once one commits while the other joins again with what is new.

The window label is no stored column, as every batch moves the cutoff. It takes the rows per
day (no column is read), the day in which the quantile lies, and that day's seconds.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.exprs import whole_seconds
from tidemark.operators.timeline import DEFAULT_FRACTION, NEW, REFERENCE, label_windows
from tidemark.sources.tables import materialize
from tidemark.sources.versions import listed, put_if_absent

COMMIT = T.StructType([
    T.StructField("batch", T.LongType()), T.StructField("id", T.StringType()),
    T.StructField("n_in", T.LongType()), T.StructField("n_new", T.LongType()),
    T.StructField("replaces", T.ArrayType(T.StringType())),
    T.StructField("schema", T.StringType()), T.StructField("committed_at", T.DoubleType())])


def _commits(spark: SparkSession, root: str) -> list[dict]:
    """Commit rows in order: one per batch, so bounded by the batches since the beginning."""
    if not listed(spark, f"{root}/commits"):
        return []
    rows = spark.read.schema(COMMIT).json(f"{root}/commits").orderBy("committed_at").collect()
    return [r.asDict() for r in rows]


def _rows(spark: SparkSession, root: str, commits: list[dict]) -> DataFrame | None:
    gone = {i for c in commits for i in c["replaces"] or ()}
    live = [c["id"] for c in commits if c["id"] not in gone and c["n_new"]]
    if not commits:
        return None
    schema = T.StructType.fromJson(json.loads(commits[-1]["schema"]))
    if not live:
        return spark.createDataFrame([], schema)
    held = T.StructType([*schema.fields, T.StructField("attempt", T.StringType())])
    return (spark.read.schema(held).parquet(f"{root}/data").filter(F.col("attempt").isin(live))
            .drop("attempt"))


def read_silver(spark: SparkSession, root: str) -> DataFrame | None:
    """Rows of all committed batches, with their `day`; None before the first."""
    return _rows(spark, root, _commits(spark, root))


def watermark(spark: SparkSession, root: str) -> int | None:
    """The highest batch that silver holds."""
    return max((c["batch"] for c in _commits(spark, root)), default=None)


def unseen(rows: DataFrame, silver: DataFrame, days: list) -> DataFrame:
    """The rows that silver does not hold; of silver only the given days are read."""
    same_days = silver.filter(F.col("day").isin(days))
    return rows.join(same_days, rows.columns, "left_anti")


def _write(df: DataFrame, root: str) -> tuple[str, int]:
    attempt = f"a{uuid.uuid4().hex}"  # a letter first: never read as a number
    path = f"{root}/data/attempt={attempt}"
    # a day's new rows go to a few files, also where one day holds most of them
    df.repartition("day", F.pmod(F.xxhash64(*df.columns), F.lit(16))).write.partitionBy("day").parquet(path)
    spark = df.sparkSession
    n = spark.read.schema(df.schema).parquet(path).count()  # row counts of the footers
    return attempt, n


def _commit(spark: SparkSession, root: str, number: int, df: DataFrame, **row) -> bool:
    row |= {"schema": df.schema.json(), "committed_at": time.time()}
    return put_if_absent(spark, f"{root}/commits/{number:012d}.json", json.dumps(row))


def add_batch(cleaned: DataFrame, root: str, batch: int, time_column: str,
              n_in: int | None = None) -> dict:
    """Add the rows of a batch (typed, clean and distinct) that silver does not hold; the
    batch's commit row. A batch that is there already stays as it is."""
    spark = cleaned.sparkSession
    rows = days = None
    while True:
        commits = _commits(spark, root)
        done = [c for c in commits if c["batch"] == batch]
        if done:
            return done[0]
        if rows is None:
            rows = materialize(cleaned.withColumn("day", F.to_date(time_column)))
            # the days of one batch: bounded by the calendar, whatever the rows
            days = [r["day"] for r in rows.select("day").distinct().collect()]
        held = _rows(spark, root, commits)
        new = rows if held is None else unseen(rows, held, days)
        attempt, n_new = _write(new, root)
        row = {"batch": batch, "id": attempt, "n_in": n_in, "n_new": n_new, "replaces": []}
        if _commit(spark, root, len(commits) + 1, new, **row):
            return row


def define_view(spark: SparkSession, name: str, root: str, time_column: str,
                fraction: float = DEFAULT_FRACTION) -> None:
    """Let the catalogue's `name` show labelled silver: a view of the committed attempts and
    the cutoff as they are now, replaced at once; no row is rewritten for a new cutoff."""
    commits = _commits(spark, root)
    silver = _rows(spark, root, commits)
    gone = {i for c in commits for i in c["replaces"] or ()}
    live = ", ".join(f"'{c['id']}'" for c in commits if c["id"] not in gone and c["n_new"])
    cutoff = spark.range(1).select(cutoff_by_day(silver, time_column, fraction)).first()[0]
    columns = ", ".join(f"`{c}`" for c in silver.columns)
    spark.sql(f"""CREATE OR REPLACE VIEW {name} AS
        SELECT {columns}, CASE WHEN unix_timestamp(`{time_column}`) <= {cutoff}
                               THEN '{REFERENCE}' ELSE '{NEW}' END AS window
        FROM parquet.`{root}/data` WHERE attempt IN ({live})""")


def compact(spark: SparkSession, root: str) -> dict | None:
    """Rewrite all committed rows as one attempt, so that readers list few files; rows and
    batches stay what they are."""
    while True:
        commits = _commits(spark, root)
        if not commits:
            return None
        rows = _rows(spark, root, commits)
        attempt, n = _write(rows, root)
        row = {"batch": max(c["batch"] for c in commits), "id": attempt, "n_in": 0, "n_new": n,
               "replaces": [c["id"] for c in commits]}
        if _commit(spark, root, len(commits) + 1, rows, **row):
            return row


def cutoff_by_day(silver: DataFrame, time_column: str, fraction: float = DEFAULT_FRACTION) -> Column:
    """The exact `fraction` quantile of whole epoch seconds, as a scalar: the day in which it
    lies comes from the rows per day, its second from that day's rows alone (a day has at
    most 86,400 distinct seconds)."""
    per_day = silver.groupBy("day").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    days = per_day.select("day", "n", F.sum("n").over(upto).alias("cum"), F.greatest(
        F.lit(1).cast("long"), F.ceil(F.sum("n").over(whole) * F.lit(float(fraction)))).alias("rank"))
    found = materialize(days.filter((F.col("cum") >= F.col("rank"))
                                    & (F.col("cum") - F.col("n") < F.col("rank")))
                        .select("day", (F.col("rank") - F.col("cum") + F.col("n")).alias("rank")))
    at = found.first()
    if at is None:
        return F.lit(None).cast("long")
    seconds = silver.filter(F.col("day") == F.lit(at["day"])).groupBy(
        whole_seconds(time_column).alias("s")).agg(F.count(F.lit(1)).alias("n"))
    upto = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (seconds.withColumn("cum", F.sum("n").over(upto)).filter(F.col("cum") >= at["rank"])
            .agg(F.min("s")).scalar())


def labelled(silver: DataFrame, time_column: str, fraction: float = DEFAULT_FRACTION) -> DataFrame:
    """Silver with its window label and without the storage's `day`."""
    cutoff = cutoff_by_day(silver, time_column, fraction)
    return label_windows(silver, time_column, cutoff=cutoff).drop("day")
