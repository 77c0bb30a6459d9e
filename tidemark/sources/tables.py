"""Readers and writers. Writes are the only actions outside the gates."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.names import TableNames


def read_parquet_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """`<base_dir>/<name>.parquet` (a file or a folder of parts)."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


def ensure_namespace(spark: SparkSession, names: TableNames) -> None:
    """Idempotent `CREATE SCHEMA IF NOT EXISTS`."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {names.namespace}")


def overwrite_table(df: DataFrame, name: str, partition_by: Sequence[str] = (),
                    count_rows: bool = True) -> int | None:
    """Replace a table (data and schema). Returns the number of rows written,
    measured with an `Observation` on the write itself (no second scan)."""
    obs = Observation(f"rows_{abs(hash(name))}") if count_rows else None
    out = df.observe(obs, F.count(F.lit(1)).alias("rows")) if obs else df
    writer = out.write.mode("overwrite").option("overwriteSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return int(obs.get["rows"]) if obs else None


def append_table(df: DataFrame, name: str) -> None:
    """Append rows; columns are matched by name."""
    df.write.mode("append").saveAsTable(name)


RUN = "run_key"


def store_run(df: DataFrame, name: str, run_key: str) -> None:
    """Rows of one run of a job, in a report table partitioned by run: storing a run again
    replaces its rows and no others, so a job that is retried adds nothing twice. Columns are
    matched by name. (A run that is stored again without rows keeps those it had.)"""
    spark = df.sparkSession
    tagged = df.withColumn(RUN, F.lit(run_key))
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in tagged.schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                  f"PARTITIONED BY ({RUN})")
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        tagged.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of an intermediate that several branches of a plan read.

    The rows are written once, as Parquet, into the shared folder named by
    `spark.checkpoint.dir` (set by the cluster; only local runs get a scratch folder) and
    read back: lost executors cost nothing upstream, readers prune columns and push
    filters, and the plan below is a scan. A reliable `checkpoint()` would compute the
    rows twice (once to count them, once to write them) and keep whole rows.
    """
    from tidemark.session import ensure_checkpoint_dir

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
