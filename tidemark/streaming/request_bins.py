"""The request-log drift check as a Structured Streaming job.

The batch monitor looks back N minutes over the request log. As a stream, the
same parse feeds windowed, additive bin counts per feature: late records are
admitted up to the watermark, each closed window is a dense histogram on the
baseline bins, and PSI per window is computed in `foreachBatch` against the
stored profile. KS needs the distribution: `start_request_sketch_stream` keeps a KLL
sketch per (window, feature) as the aggregation's state (a merge of two sketches is that of
both, so late records join it) and gives PSI and KS with their limits when a window closes.

State is bounded: one count per (window, feature, bin), or one sketch per (window, feature),
dropped once the watermark passes the window end. Records are counted as one more "feature" with
a single bin, so the traffic gate counts records as the batch monitor does, not
present values.

Each micro-batch stores its report under a key of the stream's checkpoint location and its
batch id; a batch that is retried replaces its own rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import kll
from tidemark.operators import drift as D
from tidemark.operators import profile as P
from tidemark.operators import requests as Q
from tidemark.operators import sketches as K
from tidemark.sources.tables import materialize, store_run

RECORDS = "_records"  # stands for the number of records


def windowed_bin_counts(payload_stream: DataFrame, features: Sequence[str], edges: DataFrame,
                        window: str = "60 minutes", slide: str | None = None,
                        watermark: str = "10 minutes") -> DataFrame:
    """(window, feature, bin, count) of a streaming request log on the baseline
    edges (a static table of one row per feature), and the records of each window."""
    records = Q.parse_requests(payload_stream, features).withWatermark("request_time", watermark)
    names = [*features, RECORDS]
    long = P.present(P.to_long(records.withColumn(RECORDS, F.lit(0.0)), names,
                               keep=["request_time"]))
    one_bin = edges.sparkSession.range(1).select(
        F.lit(RECORDS).alias("feature"), F.array().cast("array<double>").alias("edges"))
    binned = P.assign_bins(long, edges.select("feature", "edges").unionByName(one_bin),
                           len(names))
    win = F.window("request_time", window, slide) if slide else F.window("request_time", window)
    return binned.groupBy(win.alias("window"), "feature", "bin").agg(
        F.count(F.lit(1)).alias("count"))


def window_psi(counts: DataFrame, profile: DataFrame, features: Sequence[str]) -> DataFrame:
    """(window, feature, psi, n_rows, status) from one batch of closed windows: dense shares
    per window and feature, then PSI against the profile. `n_rows` counts records."""
    n_rows = counts.filter(F.col("feature") == RECORDS).groupBy("window").agg(
        F.sum("count").alias("n_rows"))
    each = n_rows.select("window", F.explode(F.array(*map(F.lit, features))).alias("feature"))
    grid = each.join(P.bin_grid(P.profile_edges(profile)).select("feature", "bin"), "feature")
    dense = grid.join(counts, ["window", "feature", "bin"], "left").withColumn(
        "count", F.coalesce("count", F.lit(0).cast("bigint")))
    per = Window.partitionBy("window", "feature")
    shares = dense.withColumn("actual_pct", F.try_divide(F.col("count").cast("double"),
                                                         F.sum("count").over(per)))
    out = (shares.join(profile.select("feature", "bin", "expected_pct"), ["feature", "bin"])
           .groupBy("window", "feature")
           .agg(D.psi_terms(F.col("expected_pct"), F.col("actual_pct")).alias("psi")))
    return out.join(n_rows, "window").withColumn("status", D.psi_status(F.col("psi")))


def windowed_sketches(payload_stream: DataFrame, features: Sequence[str],
                      window: str = "60 minutes", slide: str | None = None,
                      watermark: str = "10 minutes") -> DataFrame:
    """(window, feature, n, sketch) of a streaming request log, and the records of each window."""
    records = Q.parse_requests(payload_stream, features).withWatermark("request_time", watermark)
    long = P.present(P.to_long(records.withColumn(RECORDS, F.lit(0.0)), [*features, RECORDS],
                               keep=["request_time"]))
    win = F.window("request_time", window, slide) if slide else F.window("request_time", window)
    return long.groupBy(win.alias("window"), "feature").agg(
        F.count(F.lit(1)).alias("n"), kll.sketch("value").alias("sketch"))


def window_drift(closed: DataFrame, reference: DataFrame, edges: DataFrame) -> DataFrame:
    """(window, feature, psi, ks with their limits, status, n_rows) of closed windows against
    the reference's sketches (feature, n, sketch) and edges. `n_rows` counts records."""
    n_rows = closed.filter(F.col("feature") == RECORDS).select("window", F.col("n").alias("n_rows"))
    report = K.sketch_drift(reference, closed.filter(F.col("feature") != RECORDS), edges, ["window"])
    return report.join(n_rows, "window")


def store_batch(rows: DataFrame, sink_table: str, stream: str, batch_id: int) -> None:
    """Store a micro-batch's rows under a run key of their own (stream and batch): a batch that
    is run again replaces what it stored."""
    key = f"{hashlib.sha256(stream.encode()).hexdigest()[:16]}-{batch_id}"
    store_run(rows.withColumns({"stream": F.lit(stream), "batch_id": F.lit(batch_id).cast("bigint")}),
              sink_table, key)


def start_request_sketch_stream(payload_stream: DataFrame, features: Sequence[str],
                                reference: DataFrame, edges: DataFrame, sink_table: str,
                                checkpoint_location: str, window: str = "60 minutes",
                                watermark: str = "10 minutes", min_rows: int = 30,
                                trigger: dict | None = None):
    """Start the stream of PSI and KS per closed window with at least `min_rows` records.
    `reference` and `edges` are static tables of one row per feature."""
    sketches = windowed_sketches(payload_stream, features, window, None, watermark)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        report = window_drift(materialize(batch), reference, edges)
        store_batch(report.filter(F.col("n_rows") >= min_rows), sink_table, checkpoint_location,
                    batch_id)

    writer = (sketches.writeStream.outputMode("append")
              .option("checkpointLocation", checkpoint_location).foreachBatch(write_batch))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_request_drift_stream(payload_stream: DataFrame, features: Sequence[str],
                               profile: DataFrame, sink_table: str, checkpoint_location: str,
                               window: str = "60 minutes", watermark: str = "10 minutes",
                               min_rows: int = 30, trigger: dict | None = None):
    """Start the stream: append PSI rows of every closed window with at least
    `min_rows` records to `sink_table`. `checkpoint_location` must be a shared
    folder (the stream's state and progress live there)."""
    counts = windowed_bin_counts(payload_stream, features, P.profile_edges(profile),
                                 window, None, watermark)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        psi = window_psi(batch, profile, features).filter(F.col("n_rows") >= min_rows)
        store_batch(psi, sink_table, checkpoint_location, batch_id)

    writer = (counts.writeStream.outputMode("append")
              .option("checkpointLocation", checkpoint_location)
              .foreachBatch(write_batch))
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
