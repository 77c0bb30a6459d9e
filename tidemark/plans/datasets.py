"""Product datasets built from the shared test tables.

These are what the jobs would read from tables; for the checked queries they
are derived from the raw parquet on every call so that all work grows with
the input. Where a row set is read more than once (silver: by the cutoff and by
its consumers) building it runs a job that writes it to the shared folder;
everything else is lazy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.exprs import hash_bucket, millionths, row_hash
from tidemark.operators.clean import (
    TRIP_COLUMNS,
    TRIP_FEATURES,
    TRIP_TARGET,
    clean,
    trip_spec,
)
from tidemark.operators.scoring import LinearModel
from tidemark.operators.timeline import (
    DEFAULT_FRACTION,
    NEW,
    REFERENCE,
    label_windows,
    time_cutoff,
)
from tidemark.sources.adapters import (
    LINEITEM_FEATURES,
    lineitem_drift_source,
    request_log_from_events,
    trips_from_events,
    trips_with_copies,
)
from tidemark.sources.tables import materialize, read_parquet_table

FEATURES = list(TRIP_FEATURES)
TARGET = TRIP_TARGET

# Fixed values of the checked queries: three linear fare models (coefficients
# with many digits so that rounding never meets an exact decimal tie).
LINEAR_MODELS = {
    "fare_formula": LinearModel(2.5137946, (("trip_distance", 2.1982736),
                                            ("duration_min", 0.3507319),
                                            ("pickup_hour", 0.0011842),
                                            ("pickup_dow", -0.0043117))),
    "distance_only": LinearModel(4.9021377, (("trip_distance", 2.8153391),)),
    "duration_heavy": LinearModel(1.0472913, (("trip_distance", 1.5123877),
                                              ("duration_min", 0.5061293),
                                              ("pickup_hour", 0.0518231))),
}
CHECKED_MODEL = "fare_formula"
SIMULATION = {"trip_distance": 3.0, "duration_min": 3.0}
TRAIN_BUCKETS = 8  # of 10: an 80/20 hash split
LOOKBACK_MINUTES = 1440
MIN_REQUEST_ROWS = 30
ALIAS_OF_STATUS = {"F": "champion", "O": "challenger", "P": "shadow"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet_table(spark, sf_dir, name)


def trips(spark: SparkSession, sf_dir: str, copies: bool = False) -> DataFrame:
    events = table(spark, sf_dir, "events")
    return trips_with_copies(events) if copies else trips_from_events(events)


def labelled(rows: DataFrame, time_column: str, fraction: float = DEFAULT_FRACTION,
             exact: bool = True) -> DataFrame:
    """`rows` with their window label; the cutoff is computed once (one stored row)."""
    cutoff = materialize(time_cutoff(rows, time_column, fraction, exact)).scalar()
    return label_windows(rows, time_column, cutoff=cutoff)


def build_silver(source: DataFrame, fraction: float = DEFAULT_FRACTION, exact: bool = True
                 ) -> DataFrame:
    """Source trips → typed, cleaned, de-duplicated, labelled silver.

    The distinct rows are written once (columnar); the cutoff and all consumers read them,
    the label is a projection.
    """
    spec = trip_spec()
    return labelled(materialize(clean(source, spec)), spec.time_column, fraction, exact)


def silver(spark: SparkSession, sf_dir: str, copies: bool = True) -> DataFrame:
    """Silver of the trips adapter (exact 0.7 time cutoff), see `build_silver`."""
    return build_silver(trips(spark, sf_dir, copies))


def window(df: DataFrame, label: str) -> DataFrame:
    return df.filter(F.col("window") == label)


def trip_key() -> list[Column]:
    """Row key of a silver trip: all its columns as whole numbers (silver rows are
    distinct, a time alone is not)."""
    return [F.unix_micros("pickup_ts"), *[millionths(c) for c in TRIP_COLUMNS[1:]]]


def with_split(df: DataFrame) -> DataFrame:
    """Deterministic 80/20 split on md5 of the trip key (partitioning-independent)."""
    bucket = hash_bucket(row_hash(*trip_key()), 10)
    return df.withColumn("split", F.when(bucket < TRAIN_BUCKETS, F.lit("train"))
                         .otherwise(F.lit("test")))


def signature_rows(df: DataFrame, n: int = 200) -> DataFrame:
    """The `n` rows with the smallest md5 of the trip key: the example of a signature."""
    return df.orderBy(row_hash(*trip_key())).limit(n)


def reference(spark, sf_dir):
    return window(silver(spark, sf_dir), REFERENCE)


def new(spark, sf_dir):
    return window(silver(spark, sf_dir), NEW)


def lineitem_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(lineitem_drift_source(table(spark, sf_dir, "lineitem")), "ship_ts")


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_log_from_events(table(spark, sf_dir, "events"))


def model_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry rows derived from `orders`: one version per order, the model is the
    order priority, the run metrics scale with the order price."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderpriority").alias("model_name"),
        (F.col("o_orderkey") + 1).alias("version"),
        F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("run_id"),
        (F.col("o_totalprice") / 100000.0).alias("rmse"),
        (F.col("o_totalprice") / 125000.0).alias("mae"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


def model_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alias moves derived from `orders`: status F moved `champion`, O `challenger` and P
    `shadow` to the order's version on its date."""
    alias = F.create_map(*[F.lit(x) for pair in ALIAS_OF_STATUS.items() for x in pair])
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("model_name"),
        alias[F.col("o_orderstatus")].alias("alias"),
        (F.col("o_orderkey") + 1).alias("version"),
        F.col("o_orderdate").cast("timestamp").alias("set_at"),
    )


__all__ = ["FEATURES", "LINEITEM_FEATURES", "TARGET"]
