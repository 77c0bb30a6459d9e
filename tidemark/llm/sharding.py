"""Shards of a table by a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands at many points of a ring of 64-bit numbers (its virtual nodes); a key
stands where its hash says and belongs to the next point clockwise. A shard takes no more
rows than its capacity: n rows over s shards give every shard n div s, and the first n mod s
shards one more, so counts are at most one apart. Keys that find their shard full continue
clockwise:

* in each round every waiting key is at a point; a shard that has room takes the keys at its
  points, in ring order from zero, and among the keys of a point in the order of their
  hashes, until it is full;
* the others go on to the next point, clockwise, of a shard that has room after the round.

Only the surplus of overfull shards moves, which virtual nodes keep small; so a further shard
takes few rows besides those that it wins itself (`grown` in the tests, README).

Who goes where follows from the number of keys at each point, so the rounds are run on these
numbers alone: as many as the ring has points, whatever the table. The plan cuts the ranks of
a point's keys into runs of one shard each. Keys are ranked by a range exchange (see
`ranking`), and a run tells a key's shard and slot. Equal texts have keys of their own and
spread over the shards: together, a group that holds a third of all rows would fit in none.

Edge cases: a null or empty text has 8 bytes; null ids share one point of the ring, repeated
ids one place, and are taken in the order of size, checksum and row; fewer rows than shards
leave shards empty; an empty table has no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import filled, stored, table
from tidemark.llm.ranking import ranked

SHARDS = 24
POINTS = 256  # of the ring, per shard
ROW_BYTES = 8  # of a row besides its text


# ---------------------------------------------------------------- ring
def ring(shards: int, points: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """Places of all points in ring order, and their shards. A shard's points do not depend
    on the number of shards."""
    def place(shard: int, point: int) -> int:
        name = f"shard {shard} point {point}".encode()
        return int.from_bytes(hashlib.blake2b(name, digest_size=8).digest(), "big", signed=True)

    at = sorted((place(s, p), s) for s in range(shards) for p in range(points))
    return np.array([a for a, _ in at], np.int64), np.array([s for _, s in at], np.int64)


def hash_of(key: str | Column) -> Column:
    """Place of a key on the ring; null has one, too."""
    return F.xxhash64(F.col(key) if isinstance(key, str) else key)


def point_of(place: Column, shards: int, points: int = POINTS) -> Column:
    """Number of the point that a place belongs to: the next one clockwise."""
    def run(place: pd.Series) -> pd.Series:
        at, _ = ring(shards, points)
        return pd.Series(np.searchsorted(at, place.to_numpy()) % len(at))

    return F.pandas_udf(run, "long")(place)


def capacities(n: int, shards: int) -> list[int]:
    return [n // shards + (s < n % shards) for s in range(shards)]


def placement(keys_at: Mapping[int, int], owner: np.ndarray, shards: int
              ) -> dict[int, list[tuple[int, int, int]]]:
    """Per point the runs of its keys: (first rank, shard, slot of the first)."""
    room = capacities(sum(keys_at.values()), shards)
    used = [0] * shards
    runs: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    # waiting keys by the point they have reached: (home point, first rank, number)
    waiting = {p: [(p, 0, n)] for p, n in keys_at.items() if n}
    while waiting:
        left: dict[int, list[tuple[int, int, int]]] = {}
        for p in sorted(waiting):
            shard = int(owner[p])
            for home, first, n in waiting[p]:
                taken = min(n, room[shard] - used[shard])
                if taken:
                    runs[home].append((first, shard, used[shard]))
                    used[shard] += taken
                if taken < n:
                    left.setdefault(p, []).append((home, first + taken, n - taken))
        waiting = defaultdict(list)
        for p, parcels in left.items():
            while used[owner[p]] == room[owner[p]]:
                p = (p + 1) % len(owner)
            waiting[p] += sorted(parcels)
        for parcels in waiting.values():
            parcels.sort()
    return runs


# ---------------------------------------------------------------- table
def sharded(rows: DataFrame, key: str, order: list[str], shards: int = SHARDS,
            points: int = POINTS) -> DataFrame:
    """`rows` with `shard`, `slot` (from 0, gapless in the shard) and `displaced` (whether the
    key's own shard was full). Built by one write and a count per point of the ring."""
    spark, columns = rows.sparkSession, rows.columns
    at = rows.select(F.struct(*columns).alias("row"), hash_of(key).alias("place"), *[
        F.col(c).alias(f"order{i}") for i, c in enumerate(order)])
    at = stored(at.withColumn("point", point_of(F.col("place"), shards, points)))
    placed = ranked(at, ["point"], ["place", *[f"order{i}" for i in range(len(order))]])
    _, owner = ring(shards, points)
    counts = {r["point"]: r["n"] for r in  # at most shards * points rows, whatever the table
              at.groupBy("point").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = placement(counts, owner, shards)
    plan = spark.createDataFrame(
        [(int(p), int(owner[p]), sorted(r)) for p, r in runs.items()],
        "point long, home int, runs array<struct<first:long,shard:int,slot:long>>")
    # the plan has one row per point and its runs: bounded by the ring, so it is broadcast
    mine = F.element_at(F.filter("runs", lambda r: r["first"] <= F.col("rank")), -1)
    return placed.join(F.broadcast(plan), "point").withColumn("run", mine).select(
        "row.*", F.col("run")["shard"].alias("shard"),
        (F.col("run")["slot"] + F.col("rank") - F.col("run")["first"]).alias("slot"),
        (F.col("run")["shard"] != F.col("home")).alias("displaced"))


def document_shards(docs: DataFrame, shards: int = SHARDS, points: int = POINTS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot, displaced) of every document."""
    rows = docs.select(
        "doc_id", (F.octet_length(filled("text")).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(filled("text").cast("binary")).alias("text_crc32"))
    return sharded(rows, "doc_id", ["size", "text_crc32"], shards, points)


def op13_ring_shards(spark, sf_dir):
    """Shard and slot of every document; the shards' counts are at most one apart."""
    return document_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "displaced")


QUERIES = {"op13_ring_shards": op13_ring_shards}
ORACLE_SQL: dict[str, str] = {}
