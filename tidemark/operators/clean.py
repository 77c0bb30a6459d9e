"""Raw records → bronze → typed, cleaned, de-duplicated silver.

Every step is a lazy DataFrame → DataFrame function. The column contract is
checked on the driver against the schema only (no job is started).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.exprs import is_present, minutes_between
from tidemark.functions.rules import Rule, all_pass


class MissingColumnsError(ValueError):
    """The source lacks required columns."""


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Fail with the missing and the available column names (plan time, no job)."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumnsError(
            f"missing required columns {missing}; available columns: {df.columns}")


def add_ingest_time(df: DataFrame, column: str = "_ingested_at") -> DataFrame:
    """Bronze: faithful copy of the source plus the time of ingestion."""
    return df.withColumn(column, F.current_timestamp())


@dataclass(frozen=True)
class TypedColumn:
    """One output column of a typed projection: name, expression over the source, the source
    columns it is read from, and whether it may be NaN (doubles)."""

    name: str
    expr: Column
    sources: tuple[str, ...]
    floating: bool = True

    def unreadable(self) -> Column:
        """True where the source has every value but none could be read from them."""
        given = F.lit(True)
        for c in self.sources:
            given = given & F.col(c).isNotNull()
        return given & self.expr.isNull()


@dataclass(frozen=True)
class SilverSpec:
    """What the silver layer is: required source columns, the typed projection,
    the quality rules, and the time column used for the chronological windows."""

    required: tuple[str, ...]
    columns: tuple[TypedColumn, ...]
    rules: tuple[Rule, ...]
    time_column: str
    features: tuple[str, ...] = field(default=())
    target: str | None = None

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def presence_rules(self) -> list[Rule]:
        """One rule per projected column: value present (not null, not NaN)."""
        return [Rule(f"{c.name}_present", is_present(c.name, c.floating)) for c in self.columns]


TRIP_FEATURES = ("trip_distance", "duration_min", "pickup_hour", "pickup_dow")
TRIP_TARGET = "fare_amount"
TRIP_COLUMNS = ("pickup_ts", *TRIP_FEATURES, TRIP_TARGET)


def trip_spec() -> SilverSpec:
    """The taxi-trip silver: timestamp, four features, target. Text that cannot be read as
    its type becomes null (`try_cast`) and is rejected by the presence rules."""
    started, ended, length, price = TRIP_SOURCE = (
        "tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_distance", "fare_amount")

    def number(name: str) -> Column:
        return F.col(name).try_cast("double")

    start, end = (F.col(c).try_cast("timestamp") for c in (started, ended))
    columns = (
        TypedColumn("pickup_ts", start, (started,), floating=False),
        TypedColumn("trip_distance", number(length), (length,)),
        TypedColumn("duration_min", minutes_between(start, end), (started, ended)),
        TypedColumn("pickup_hour", F.hour(start).cast("double"), (started,)),
        TypedColumn("pickup_dow", F.dayofweek(start).cast("double"), (started,)),  # 1 = Sunday
        TypedColumn("fare_amount", number(price), (price,)),
    )
    # The cleaning limits of the product (both ends included
    # unless stated): distance [0.1, 100], duration [1, 240] min, fare (0, 300].
    rules = (
        Rule("trip_distance", F.col("trip_distance").between(0.1, 100)),
        Rule("duration_min", F.col("duration_min").between(1, 240)),
        Rule("fare_amount", (F.col("fare_amount") > 0) & (F.col("fare_amount") <= 300)),
    )
    return SilverSpec(
        required=TRIP_SOURCE,
        columns=columns,
        rules=rules,
        time_column="pickup_ts",
        features=TRIP_FEATURES,
        target=TRIP_TARGET,
    )


def typed_projection(df: DataFrame, spec: SilverSpec) -> DataFrame:
    """Select + cast + alias to exactly the spec's columns (drops all others)."""
    require_columns(df, spec.required)
    return df.select(*[c.expr.alias(c.name) for c in spec.columns])


def quality_rules(spec: SilverSpec) -> list[Rule]:
    """Presence of every column, then the value rules, in that order."""
    return [*spec.presence_rules(), *spec.rules]


def apply_rules(df: DataFrame, spec: SilverSpec) -> DataFrame:
    """Keep rows that have every column present and pass every rule.

    Presence is written as `isNotNull` (+ `~isnan`) per column rather than
    `dropna()`, because `isNotNull` is pushed to the parquet scan while
    `dropna`'s `AtLeastNNonNulls` is not.
    """
    return df.filter(all_pass(quality_rules(spec)))


def reject_counts(df: DataFrame, spec: SilverSpec) -> DataFrame:
    """(reason, n_rows): source rows by every reason that keeps them out of silver — text
    that could not be read (`<column>_unreadable`), a missing value, a broken limit. A row
    with several reasons counts for each; one pass, partial aggregation per reason."""
    require_columns(df, spec.required)
    bad_text = [F.when(c.unreadable(), F.lit(f"{c.name}_unreadable")) for c in spec.columns]
    # names that the source cannot have: typed columns may be named like source columns
    marked = df.select(F.array_compact(F.array(*bad_text)).alias("_unreadable"),
                       *[c.expr.alias(c.name) for c in spec.columns])
    broken = F.array(*[F.when(~r.passed(), F.lit(r.name)) for r in quality_rules(spec)])
    reasons = F.concat("_unreadable", F.array_compact(broken))
    return marked.select(F.explode(reasons).alias("reason")).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n_rows"))


def deduplicate(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows (over `subset` if given). Partial aggregation collapses hot
    duplicates before the shuffle."""
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def clean(df: DataFrame, spec: SilverSpec) -> DataFrame:
    """Typed projection → rules → distinct. Unlabelled silver."""
    return deduplicate(apply_rules(typed_projection(df, spec), spec))
