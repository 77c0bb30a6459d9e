"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits; two documents link when their fingerprints differ in at most
`distance` (up to 3) bits. Of the two 32-bit halves, one then differs in at most one bit.
The anchors of a half are the codewords of a covering code: the perfect [31, 26] Hamming
code on 31 bits, which covers every word within radius 1, next to the one remaining bit.
Every fingerprint is replicated to all anchors within covering radius plus threshold
(1 + 1), at most 17 for each half, and is at home at the nearest. Two linked fingerprints
meet at the home anchors of the half that differs in at most one bit, where they are
compared in full.

Equal fingerprints are collapsed to their smallest document first, so a group of copies
costs one row. Anchors are processed in a stream, a group is compared block by block, and
of the links in a group only those that join two pieces leave the task. Groups beyond
`GROUP_LIMIT` members are salted: homes are dealt over several tasks, their possible
partners go to all of those.

Edge cases: null and empty texts have the fingerprint zero and link like any other;
repeated rows and ids collapse; a null id never represents a component: its rows join the
component of their fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, hash_of_row, importable, stored, table, utf8
from tidemark.llm.components import components

SHINGLE = 3
DISTANCE = 3
SEED = 42
CHUNK = 1 << 16  # shingles whose bits are counted at once
GROUP_LIMIT = 20_000  # members of an anchor that one task compares
ROWS = 1024  # of a group, compared with all others at once


# ------------------------------------------------------------ fingerprints
def fingerprint_of(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of UTF-8 text (A-Z lower-cased, ASCII white space)."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.r_[0, ends[:-shingle] + 1]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], SEED)
                       for s, e in zip(starts.tolist(), ends[shingle - 1:].tolist())], np.uint64)
    set_ = np.zeros(64, np.int64)
    for i in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[i:i + CHUNK, None].view(np.uint8), axis=1, bitorder="little")
        set_ += bits.sum(axis=0, dtype=np.int64)
    most = np.packbits(2 * set_ > len(hashes), bitorder="little")
    return int(most.view(np.uint64)[0])


def fingerprint(text: str | Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text as a signed long (null: zero)."""
    def run(texts: pd.Series) -> pd.Series:
        out = np.array([fingerprint_of(t, shingle) for t in texts], np.uint64)
        return pd.Series(out.view(np.int64))
    return F.pandas_udf(run, "long")(utf8(text))


# ------------------------------------------------------------ anchors
def _syndrome(half: np.ndarray) -> np.ndarray:
    """Exclusive or of the positions 1 to 31 of the set bits: zero for codewords."""
    out = np.zeros_like(half)
    for i in range(5):
        mask = sum(1 << p for p in range(1, 32) if p >> i & 1)
        out |= (np.bitwise_count(half & np.uint32(mask)).astype(np.uint32) & 1) << np.uint32(i)
    return out


def nearest(half: np.ndarray) -> np.ndarray:
    """The anchor within radius 1. Bit 0 is outside the code and stays as it is."""
    s = _syndrome(half)
    return half ^ np.where(s > 0, np.left_shift(np.uint32(1), s), np.uint32(0)).astype(np.uint32)


def reached(half: np.ndarray) -> np.ndarray:
    """(n, 33): home anchors of the half and of all halves one bit away (with repeats)."""
    moved = half[:, None] ^ np.r_[0, 1 << np.arange(32, dtype=np.uint64)].astype(np.uint32)
    return nearest(moved)


REPLICAS = "anchor long, home boolean, fp long"


def replicas(fingerprints: DataFrame) -> DataFrame:
    """(anchor, home, fp): each fingerprint once at every anchor that it has to meet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_ = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(all_), 4096):
                fp = all_[i:i + 4096]
                for side in (0, 1):
                    half = (fp >> np.uint64(32 * side)).astype(np.uint32)
                    anchors = np.sort(reached(half), axis=1)
                    first = np.c_[np.ones(len(fp), bool), anchors[:, 1:] != anchors[:, :-1]]
                    row, col = np.nonzero(first)
                    found = anchors[row, col]
                    yield pa.record_batch([
                        pa.array(found.astype(np.int64) + (side << 32)),
                        pa.array(found == nearest(half)[row]),
                        pa.array(fp[row].view(np.int64)),
                    ], names=["anchor", "home", "fp"])
    return fingerprints.select("fp").mapInArrow(run, REPLICAS)


# ------------------------------------------------------------ links
class Pieces:
    """Disjoint sets over the members of one group."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y


def group_links(fp: np.ndarray, home: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links (positions) between homes and members of one group that join pieces: they
    connect what all links of the group connect."""
    pieces, out = Pieces(len(fp)), []
    homes = np.flatnonzero(home)
    for i in range(0, len(homes), ROWS):
        rows = homes[i:i + ROWS]
        label = np.array([pieces.find(k) for k in range(len(fp))])
        for r in rows.tolist():
            near = np.flatnonzero(np.bitwise_count(fp ^ fp[r]) <= distance)
            # one member of each piece is enough
            _, first = np.unique(label[near], return_index=True)
            out += [(r, k) for k in near[first].tolist() if k != r and pieces.join(r, k)]
    return out


LINKS = "a long, b long"


def _compare(distance: int):
    """Rows sorted by (anchor, salt): emit joining links between fingerprints."""
    def flush(keys: np.ndarray, fp: np.ndarray, home: np.ndarray) -> Iterator[pa.RecordBatch]:
        cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        start = np.r_[0, cut]
        size = np.diff(np.r_[start, len(fp)])
        a, b = [], []
        # small groups all at once: member i with member i + d of the same group
        small = np.repeat(size <= 64, size)
        group = np.repeat(np.arange(len(size)), size)
        for d in range(1, int(min(64, size.max(initial=1)))):
            ok = small[d:] & (group[d:] == group[:-d]) & (home[d:] | home[:-d])
            i = np.flatnonzero(ok)
            i = i[np.bitwise_count(fp[i] ^ fp[i + d]) <= distance]
            a.append(fp[i])
            b.append(fp[i + d])
        for g in np.flatnonzero(size > 64).tolist():
            part = slice(start[g], start[g] + size[g])
            found = np.array(group_links(fp[part], home[part], distance), np.int64).reshape(-1, 2)
            a.append(fp[part][found[:, 0]])
            b.append(fp[part][found[:, 1]])
        if a:
            x, y = np.concatenate(a), np.concatenate(b)
            pair = np.unique(np.stack([x, y], axis=1), axis=0)
            yield pa.record_batch([pa.array(pair[:, 0].copy().view(np.int64)),
                                   pa.array(pair[:, 1].copy().view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        for batch in batches:
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            kept.append(np.stack([cols[0], cols[1].astype(np.int64),
                                  cols[2].astype(np.int64), cols[3]], axis=1))
            rows = np.concatenate(kept)
            last = rows[-1, :2]
            # all but the last group, which the next batch may go on with
            whole = int(np.flatnonzero((rows[:, :2] != last).any(axis=1)).max(initial=-1)) + 1
            if whole:
                yield from flush(rows[:whole, :2], rows[:whole, 3].copy().view(np.uint64),
                                 rows[:whole, 2].astype(bool))
            kept = [rows[whole:]]
        if kept and len(kept[0]):
            rows = kept[0]
            yield from flush(rows[:, :2], rows[:, 3].copy().view(np.uint64),
                             rows[:, 2].astype(bool))
    return run


def links(fingerprints: DataFrame, distance: int = DISTANCE, group_limit: int = GROUP_LIMIT
          ) -> DataFrame:
    """(a, b) links between distinct fingerprints that connect all that is connected."""
    if not 0 <= distance <= 3:
        raise ValueError("the two halves cover distances up to 3")
    at = replicas(fingerprints.select("fp").distinct())
    size = at.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    # a lone fingerprint has nobody to meet; a large group is dealt over several salts
    salts = F.ceil(F.col("n") / group_limit).cast("int")
    dealt = at.join(size, "anchor").withColumn("salts", salts).withColumn(
        "own", F.pmod(F.xxhash64("fp"), F.col("salts")).cast("int"))
    spread = dealt.select(
        "anchor", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "own",
        "home", "fp").select("anchor", F.col("salt").cast("long").alias("salt"),
                             (F.col("home") & (F.col("own") == F.col("salt"))).alias("home"), "fp")
    return (spread.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt")
            .mapInArrow(_compare(distance), LINKS).distinct())


def by_component(marked: DataFrame, first: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, first): `first` (fp, first) with the least value of each fingerprint's component
    in place of its own. `marked` has the fingerprints of all rows."""
    joined = components(links(marked, distance))
    of = first.join(joined, first["fp"] == joined["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    least = of.groupBy("component").agg(F.min("first").alias("least"))
    return of.join(least, "component").select("fp", F.col("least").alias("first"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """(doc_id, fp, component_id), one row per document."""
    importable(docs.sparkSession)
    marked = stored(docs.select(F.col(doc_id).alias("doc_id"),
                                fingerprint(text, shingle).alias("fp")))
    # the smallest document of each component of fingerprints
    least = by_component(marked, marked.groupBy("fp").agg(F.min("doc_id").alias("first")), distance)
    return marked.join(least, "fp").select("doc_id", "fp", F.col("first").alias("component_id"))


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """`docs` with one row of each component: that of the smallest id (rows without an id
    come last), among rows of one id that of the smallest hash of all its columns."""
    importable(docs.sparkSession)
    row = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"),
                   hash_of_row(docs).alias("hash"))
    marked = stored(docs.select(row.alias("row"), fingerprint(text, shingle).alias("fp")))
    kept = (by_component(marked, marked.groupBy("fp").agg(F.min("row").alias("first")), distance)
            .select(F.col("first.id").alias("id"), F.col("first.hash").alias("hash")).distinct())
    mark = free_name("row_hash", docs)
    hashed = docs.withColumn(mark, hash_of_row(docs))
    same = hashed[doc_id].eqNullSafe(kept["id"]) & (hashed[mark] == kept["hash"])
    return hashed.join(kept, same, "left_semi").dropDuplicates([doc_id, mark]).drop(mark)


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


QUERIES = {"op6_simhash": op6_simhash}
ORACLE_SQL: dict[str, str] = {}
