"""Jobs: the product's batch steps as functions over tables.

    ingest → silver → train → score → monitor      (+ request-log monitor)

Each job reads tables, builds one plan per output and writes it. Bronze, silver and
predictions are published as whole versions (`sources.versions`): a job that fails half-way
leaves the last good one. Rows of reports, runs, versions and alias moves are stored under
the key of their run, so that a retried run replaces its own rows and adds none twice. The
quality gate fires before silver is replaced; drift and error gates fire after their report
rows are stored. `run_silver_batch` grows silver batch by batch instead of cleaning all of
bronze again.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import drift as D
from tidemark.operators import gates as G
from tidemark.operators import incremental as I
from tidemark.operators import learn
from tidemark.operators import profile as P
from tidemark.operators import registry as R
from tidemark.operators import requests as Q
from tidemark.operators import scoring as S
from tidemark.operators import sketches as K
from tidemark.operators.clean import add_ingest_time, clean, trip_spec
from tidemark.operators.timeline import DEFAULT_FRACTION, NEW, REFERENCE
from tidemark.plans import datasets as ds
from tidemark.sources.names import TableNames
from tidemark.sources.tables import ensure_namespace, materialize, store_run
from tidemark.sources.versions import next_free, publish_table, vacuum


@dataclass(frozen=True)
class JobConfig:
    """Settings shared by the jobs (defaults are the product's)."""

    fraction: float = DEFAULT_FRACTION
    exact_cutoff: bool = False          # approx quantile (error 0.001) at scale
    n_bins: int = 10
    sample_size: int = P.SAMPLE_SIZE    # rows of the stored sample (drift uses all values)
    signature_size: int = 200
    engine: str = "spark"
    seed: int = learn.DEFAULT_SEED
    min_rows: int = G.MIN_ROWS
    max_drop_ratio: float = G.MAX_DROP_RATIO
    model_root: str | None = None       # default: <warehouse>/models
    keep_versions: int = 2              # of published tables, the current one included


def _exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def _warehouse(spark: SparkSession) -> str:
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def _model_root(spark: SparkSession, names: TableNames, cfg: JobConfig) -> str:
    return f"{cfg.model_root or _warehouse(spark) + '/models'}/{names.model_name}"


def published_root(spark: SparkSession, table: str) -> str:
    """Folder of a published table's versions."""
    return f"{_warehouse(spark)}/published/{table.replace('.', '/')}"


def _publish(df: DataFrame, table: str, cfg: JobConfig, partition_by: Sequence[str] = ()) -> int:
    root = published_root(df.sparkSession, table)
    done = publish_table(df, table, root, partition_by)
    vacuum(df.sparkSession, root, cfg.keep_versions)
    return done["n_rows"]


def _run_key(given: str | None, kind: str) -> str:
    """The key that a scheduler gave the run, or one of its own (such a run, if it is
    repeated, is another run)."""
    return given or f"{kind}-{uuid.uuid4().hex}"


# ------------------------------------------------------------------ ingest
def run_ingest(spark: SparkSession, names: TableNames, source: DataFrame,
               cfg: JobConfig = JobConfig()) -> int:
    """Source → bronze (copy + ingest time). Returns the rows written."""
    ensure_namespace(spark, names)
    return _publish(add_ingest_time(source), names.bronze, cfg)


# ------------------------------------------------------------------ silver
def run_silver(spark: SparkSession, names: TableNames, cfg: JobConfig = JobConfig()) -> dict:
    """Bronze → silver partitioned by window, and its daily sketches per window. The quality
    gate judges the cleaned rows before they replace the table: a bad load leaves the last
    good silver in place. Rows in and out are counted while the cleaned rows are written."""
    spec, n = trip_spec(), F.count(F.lit(1)).alias("n")
    came, left = Observation(), Observation()
    bronze = spark.table(names.bronze).observe(came, n)
    rows = materialize(clean(bronze, spec).observe(left, n))
    counts = G.counted(spark, came.get["n"], left.get["n"])
    verdict = G.enforce_quality(counts, cfg.min_rows, cfg.max_drop_ratio)
    labelled = ds.labelled(rows, spec.time_column, cfg.fraction, cfg.exact_cutoff)
    _publish(labelled, names.silver, cfg, ["window"])
    _publish(K.daily_sketches(labelled, spec.features, spec.time_column, ["window"]),
             names.silver_sketches, cfg)
    return verdict


def run_silver_batch(spark: SparkSession, names: TableNames, source: DataFrame, batch: int,
                     cfg: JobConfig = JobConfig()) -> dict:
    """Add one batch of source rows to silver and let the silver table show them. Only the
    batch is cleaned and only the days it touches are read; a batch that is there already,
    or the same rows in another batch, add nothing. The batch's commit row."""
    ensure_namespace(spark, names)
    spec, root = trip_spec(), published_root(spark, f"{names.silver}_batches")
    done = I.add_batch(clean(source, spec), root, batch, spec.time_column)
    if not I.read_silver(spark, root).isEmpty():
        I.define_view(spark, names.silver, root, spec.time_column, cfg.fraction)
    return done


def _silver_window(spark: SparkSession, names: TableNames, label: str) -> DataFrame:
    return spark.table(names.silver).filter(F.col("window") == label)


# ------------------------------------------------------------------ train
def allocate_version(spark: SparkSession, names: TableNames, cfg: JobConfig = JobConfig()) -> int:
    """A version number that no other training run has or gets: the next one whose claim this
    run could put beside the model folders."""
    last = None
    if _exists(spark, names.model_versions):
        last = spark.table(names.model_versions).filter(
            F.col("model_name") == names.model_name).agg(F.max("version")).first()[0]
    return next_free(spark, f"{_model_root(spark, names, cfg)}/claims", int(last or 0) + 1,
                     lambda n: f"{names.model_versions} {n}")


def run_train(spark: SparkSession, names: TableNames, cfg: JobConfig = JobConfig(),
              estimators: Sequence[str] = learn.ESTIMATORS) -> dict:
    """Train on the reference window; store the best model as a new version with its run
    (metrics and parameters), baseline (profile, all value counts, sample) and signature
    rows, and move an alias to it."""
    spec = trip_spec()
    features, target = list(spec.features), spec.target
    ref = _silver_window(spark, names, REFERENCE)
    results = learn.train_models(ds.with_split(ref), features, target, estimators, cfg.seed,
                                 cfg.engine)
    best = learn.best_result(results)
    first_version = not _exists(spark, names.model_versions)
    version = allocate_version(spark, names, cfg)
    run_id = _run_of(names, version)
    path = f"{_model_root(spark, names, cfg)}/v{version}"
    best.model.write().save(path)

    runs = learn.results_frame(spark, results).select("model", "rmse", "mae", "is_best")
    store_run(runs.withColumns({
        "run_id": F.lit(run_id), "engine": F.lit(cfg.engine), "best_model": F.lit(best.name),
        "silver_table": F.lit(names.silver)}), names.model_runs, run_id)

    tag = {"model_version": F.lit(version).cast("bigint")}
    signature = S.score(ds.signature_rows(ref, cfg.signature_size), best.model, features=features)
    keyed = ref.withColumns({f"_k{i}": c for i, c in enumerate(ds.trip_key())})
    keys = [c for c in keyed.columns if c.startswith("_k")]
    values = materialize(P.baseline_values(ref, features))  # the only pass over the rows
    for table, rows in (
            (names.baseline_bins, P.profile_from_counts(values, features, cfg.n_bins)),
            (names.baseline_values, values),
            (names.baseline_sample, P.sample_values(keyed, features, keys, cfg.sample_size)),
            (names.model_signatures, signature.select(*features, "prediction"))):
        store_run(rows.withColumns(tag), table, run_id)

    new_version = spark.range(1).select(
        F.lit(names.model_name).alias("model_name"), F.lit(version).cast("bigint").alias("version"),
        F.lit(run_id).alias("run_id"), F.lit(best.rmse).alias("rmse"), F.lit(best.mae).alias("mae"),
        F.lit(path).alias("path"), F.lit(best.name).alias("model"),
        F.current_timestamp().alias("created_at"))
    alias = R.CHAMPION
    if not first_version and _exists(spark, names.model_aliases):
        decision = R.promotion_decision(
            spark.table(names.model_versions).unionByName(new_version, allowMissingColumns=True),
            spark.table(names.model_aliases),
            candidates=new_version.select("model_name", "version", "rmse"))
        alias = decision.select("decision").first()[0]
    store_run(new_version, names.model_versions, run_id)
    store_run(R.alias_row(spark, names.model_name, alias, version), names.model_aliases, run_id)
    return {"version": version, "model": best.name, "rmse": best.rmse, "mae": best.mae,
            "alias": alias}


def _run_of(names: TableNames, version: int) -> str:
    """The training run of a version: the key under which its rows are stored."""
    return f"{names.model_name}-v{version}"


def alias_version(spark: SparkSession, names: TableNames, alias: str) -> dict:
    """The version carrying `alias` now, with its stored metrics and path."""
    cur = R.current_alias(spark.table(names.model_aliases)).filter(
        (F.col("model_name") == names.model_name) & (F.col("alias") == alias))
    row = (cur.join(spark.table(names.model_versions), ["model_name", "version"])
           .select("version", "rmse", "mae", "path").first())
    if row is None:
        raise LookupError(f"no version of {names.model_name} has alias {alias!r}")
    return row.asDict()


# ------------------------------------------------------------------ score
def run_score(spark: SparkSession, names: TableNames, alias: str = R.CHAMPION,
              cfg: JobConfig = JobConfig()) -> int:
    """Score the new window with the aliased version; the next version of `predictions`."""
    spec = trip_spec()
    ver = alias_version(spark, names, alias)
    model = PipelineModel.load(ver["path"])
    scored = S.score(_silver_window(spark, names, NEW), model, target=spec.target,
                     features=spec.features)
    return _publish(scored.withColumn("model_version", F.lit(ver["version"]).cast("bigint")),
                    names.predictions, cfg)


# ------------------------------------------------------------------ monitor
def _baseline(spark: SparkSession, names: TableNames, version: int
              ) -> tuple[DataFrame, DataFrame]:
    """Stored profile and value counts of a version (one partition of each table)."""
    bins, values = (spark.table(t).filter((F.col("run_key") == _run_of(names, version))
                                          & (F.col("model_version") == version))
                    for t in (names.baseline_bins, names.baseline_values))
    return bins, values


def _reported(report: DataFrame, table: str, version: int, run_key: str, fail: bool = False,
              context: str = "") -> DataFrame:
    """Stamp and store the report rows of a run, then raise on its alerts if asked to."""
    stamped = materialize(report.withColumns({
        "model_version": F.lit(int(version)).cast("bigint"),
        "checked_at": F.current_timestamp()}))
    store_run(stamped, table, run_key)
    if fail:
        G.raise_on_alerts(stamped, context)
    return stamped


def run_monitor(spark: SparkSession, names: TableNames, alias: str = R.CHAMPION,
                what_if: Mapping[str, float] | None = None, fail_on_alert: bool = False,
                fail_on_degraded: bool = False, run_key: str | None = None) -> DataFrame:
    """Drift of the new window from the aliased version's stored baseline, and its mean
    error against the training error; both are stored in their report tables, then the
    gates asked for raise. `what_if` scales columns of the new window first (such reports
    are marked as simulated)."""
    features, key = list(trip_spec().features), _run_key(run_key, "monitor")
    ver = alias_version(spark, names, alias)
    version = int(ver["version"])
    errors = spark.table(names.predictions).filter(F.col("model_version") == version)
    ratio = F.try_divide(F.col("window_mae"), F.col("train_mae"))
    perf = _reported(errors.agg(F.avg("abs_error").alias("window_mae")).withColumn(
        "train_mae", F.lit(ver["mae"])).withColumn("mae_ratio", ratio),
        names.performance_metrics, version, key)
    fresh = D.scale_columns(_silver_window(spark, names, NEW), what_if or {})
    drift = D.drift_from_baseline(fresh, features, *_baseline(spark, names, version))
    report = _reported(drift.withColumn("simulated", F.lit(bool(what_if))), names.drift_metrics,
                       version, key, fail_on_alert)
    if fail_on_degraded:
        G.raise_if_degraded(perf)
    return report


def run_sketch_monitor(spark: SparkSession, names: TableNames, from_day: str, to_day: str,
                       alias: str = R.CHAMPION) -> DataFrame:
    """Drift of a range of days (both ends included) of the new window from the reference
    window, out of stored daily sketches on the aliased version's edges: no row of silver is
    read, and every figure comes with its limits."""
    bins, _ = _baseline(spark, names, alias_version(spark, names, alias)["version"])
    days = spark.table(names.silver_sketches)
    fresh = days.filter((F.col("window") == NEW) & F.col("day").between(
        F.lit(from_day).cast("date"), F.lit(to_day).cast("date")))
    return K.sketch_drift(K.merged(days.filter(F.col("window") == REFERENCE)), K.merged(fresh),
                          P.profile_edges(bins))


def run_request_monitor(spark: SparkSession, names: TableNames, alias: str = R.CHAMPION,
                        minutes: int = 60, min_rows: int = G.MIN_REQUEST_ROWS,
                        fail_on_alert: bool = False, as_of: Column | None = None,
                        run_key: str | None = None) -> DataFrame:
    """Drift of the logged requests of the last `minutes` against the baseline; without rows
    below `min_rows` records. Requests and records that could not be read are stored by
    reason, whatever their number."""
    features, key = list(trip_spec().features), _run_key(run_key, "requests")
    version = int(alias_version(spark, names, alias)["version"])
    recent = Q.lookback(spark.table(names.payload), minutes, as_of)
    _reported(Q.reject_counts(recent, features), names.request_rejects, version, key)
    records = materialize(Q.parse_requests(recent, features))
    report = Q.request_report(records, features, *_baseline(spark, names, version), minutes,
                              min_rows)
    return _reported(report, names.endpoint_drift_metrics, version, key, fail_on_alert,
                     " in logged traffic")


def run_all(spark: SparkSession, names: TableNames, source: DataFrame,
            cfg: JobConfig = JobConfig(), estimators: Sequence[str] = learn.ESTIMATORS
            ) -> dict:
    """ingest → silver → train → score → monitor, as the scheduled job runs them."""
    out = {"bronze_rows": run_ingest(spark, names, source)}
    out["quality"] = run_silver(spark, names, cfg)
    out["train"] = run_train(spark, names, cfg, estimators)
    out["predictions"] = run_score(spark, names)
    out["drift"] = run_monitor(spark, names).collect()
    return out
