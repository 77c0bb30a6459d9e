"""Benchmark decontamination with a distributed positional inverted index.

The index is document-partitioned: each task cuts its documents into shards of bounded
size, numbers the words of a shard from zero with a gap between documents, and stores one
row per shard: its documents, and for every benchmark term in it the sorted positions at
which the term occurs (delta coded, compressed). A search reads a shard's lists and looks up
windows by the terms that the shard holds (each window is filed under the term that the
fewest windows have), so that windows of other terms cost nothing. A window whose terms are
all there starts at its rarest term in that shard; the starts that the lists of the other
terms, adjusted by their offsets, confirm are kept:

* exact phrase match: every word of the window at its own offset;
* proximity match: the first word at its place, every other word at most `slop` places
  away from its own.

The benchmark is cut into blocks of bounded size; only one block's items and terms are
broadcast at a time, and spans of several blocks are united per document.

Edge cases: a null text has no words; items without words match nothing; items with a
null id take no part; items of the same id count once; repeated documents are judged one
by one; an empty documents table gives no rows; without items nothing is hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, stored, table, utf8

WINDOW = 10
SLOP = 3
SHARD_BYTES = 8 << 20  # text per shard
BLOCK_BYTES = 16 << 20  # benchmark text per broadcast block

# every byte that is no word byte becomes a space, A-Z become a-z
_FOLD = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80
              else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """The lower-cased words of UTF-8 text (bytes from 0x80 on belong to words)."""
    return text.translate(_FOLD).split() if text else []


class Windows:
    """Distinct windows of one length as rows of term ids, with the items that hold each, found
    by the term that the fewest windows have."""

    def __init__(self, rows: np.ndarray, items: np.ndarray, n_terms: int):
        whole = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.itemsize * rows.shape[1])))
        _, first, number = np.unique(whole.ravel(), return_index=True, return_inverse=True)
        self.rows = rows[first]
        held = np.unique(np.stack([number.ravel(), items], axis=1), axis=0)
        self.items = held[:, 1]
        self.held = np.searchsorted(held[:, 0], np.arange(len(first) + 1))
        spread = np.bincount(self.rows.ravel(), minlength=n_terms)
        rarest = spread[self.rows].argmin(axis=1)
        key = self.rows[np.arange(len(first)), rarest]
        self.of_key = np.argsort(key, kind="stable").astype(np.int32)
        self.keys = np.searchsorted(key[self.of_key], np.arange(n_terms + 1))

    def possible(self, terms: np.ndarray, present: np.ndarray) -> list[int]:
        """Windows all of whose terms are among `terms`; `present` marks those."""
        begin, size = self.keys[terms], np.diff(self.keys)[terms]
        ends = np.cumsum(size)
        looked = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - (ends - size), size)
        found = self.of_key[looked]
        return found[present[self.rows[found]].all(axis=1)].tolist()


class Block:
    """Windows of some benchmark items: term ids, and the items that hold each window.
    `gap` positions between documents keep any match, exact or near, inside one document."""

    def __init__(self, items: list[tuple[str, bytes]], window: int, slop: int):
        self.slop, self.gap = slop, window + slop + 1
        self.term: dict[bytes, int] = {}
        self.names = sorted({item_id for item_id, _ in items})
        number = {item_id: i for i, item_id in enumerate(self.names)}
        found: dict[int, list[tuple[int, np.ndarray]]] = {}
        for item_id, text in items:
            ids = [self.term.setdefault(w, len(self.term)) for w in words_of(text)]
            if ids:
                length = min(window, len(ids))
                rows = np.lib.stride_tricks.sliding_window_view(np.array(ids, np.int32), length)
                found.setdefault(length, []).append((number[item_id], rows))
        self.windows = [
            Windows(np.concatenate([rows for _, rows in parts]),
                    np.repeat([i for i, _ in parts], [len(rows) for _, rows in parts]),
                    len(self.term))
            for _, parts in sorted(found.items())]

    def possible(self, terms: np.ndarray) -> Iterator[tuple[tuple[int, ...], list[str]]]:
        """(window, ids of its items) of the windows whose terms are all among `terms`."""
        present = np.zeros(len(self.term), bool)
        present[terms] = True
        for w in self.windows:
            for i in w.possible(terms, present):
                yield (tuple(w.rows[i].tolist()),
                       [self.names[k] for k in w.items[w.held[i]:w.held[i + 1]].tolist()])


# ---------------------------------------------------------------- index
INDEX = "n_docs int, docs binary, terms array<int>, postings array<binary>"


def _pack(values: np.ndarray) -> bytes:
    return zstandard.compress(np.diff(values, prepend=values.dtype.type(0)).tobytes(), 1)


def _unpack(blob: bytes, dtype=np.uint32) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(blob), dtype), dtype=dtype)


def build_index(docs: DataFrame, doc_id: str, text: str, block) -> DataFrame:
    """One stored row per shard: its documents (ids, text hashes, word counts), the terms of
    a broadcast block that it holds, and the postings of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        term = block.value.term.get
        lists: list[np.ndarray] = []
        rows: list[tuple[int | None, int]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            counts = np.array([len(x) for x in lists], np.uint32)
            taken = counts + np.uint32(block.value.gap)
            base = np.cumsum(taken, dtype=np.uint32) - taken
            known = [np.flatnonzero(x >= 0) for x in lists]
            ids = np.concatenate([x[k] for x, k in zip(lists, known)])
            at = np.concatenate([k.astype(np.uint32) + b for k, b in zip(known, base)])
            order = np.argsort(ids, kind="stable")
            ids, at = ids[order], at[order]
            cuts = np.flatnonzero(np.diff(ids)) + 1
            terms = ids[np.r_[0, cuts]] if len(ids) else ids
            parts = np.split(at, cuts) if len(ids) else []
            no_id = np.array([r[0] is None for r in rows])
            doc_ids = np.array([r[0] or 0 for r in rows], np.int64)
            hashes = np.array([r[1] for r in rows], np.int64)
            table_ = zstandard.compress(no_id.tobytes() + doc_ids.tobytes()
                                        + hashes.tobytes() + counts.tobytes(), 1)
            return pa.record_batch([
                pa.array([len(rows)], pa.int32()), pa.array([table_], pa.binary()),
                pa.array([terms], pa.list_(pa.int32())),
                pa.array([[*map(_pack, parts)]], pa.list_(pa.binary())),
            ], names=["n_docs", "docs", "terms", "postings"])

        for batch in batches:
            for key, digest, value in zip(*(c.to_pylist() for c in batch.columns)):
                found = words_of(value)
                lists.append(np.fromiter((term(w, -1) for w in found), np.int32, len(found)))
                rows.append((key, digest))
                size += len(value)
                if size >= SHARD_BYTES:
                    yield flush()
                    size = 0
                    lists.clear()
                    rows.clear()
        if rows:
            yield flush()

    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                         F.xxhash64(text).alias("text_hash"), utf8(text).alias("text"))
    return stored(source.mapInArrow(run, INDEX))


# ---------------------------------------------------------------- search
FOUND = ("doc_id long, text_hash long, n_words long, spans binary, items array<string>, "
         "near array<string>")


def _starts(window: tuple[int, ...], lists: dict[int, np.ndarray], slop: int
            ) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the proximity matches of a window, and of the exact ones among them."""
    none = np.empty(0, np.int64)
    if any(t not in lists for t in window):
        return none, none
    order = sorted(range(len(window)), key=lambda j: len(lists[window[j]]))

    def near(starts: np.ndarray, j: int, reach: int) -> np.ndarray:
        at = lists[window[j]]
        i = np.searchsorted(at, starts + (j - reach))
        return starts[(i < len(at)) & (at[np.minimum(i, len(at) - 1)] <= starts + (j + reach))]

    rarest = lists[window[order[0]]] - order[0]
    close = rarest if order[0] == 0 else np.unique(
        (rarest[:, None] + np.arange(-slop, slop + 1)).ravel())
    close = near(close, 0, 0)
    for j in order[1:]:
        if not len(close):
            return close, close
        if j:
            close = near(close, j, slop)
    exact = close
    for j in order:
        exact = near(exact, j, 0)
    return close, exact


def search(index: DataFrame, block) -> DataFrame:
    """One row per indexed document: words, merged spans of exact matches (uint32 pairs of
    word numbers, end exclusive), ids of items matched exactly, and nearly."""
    def shard(doc_table: bytes, n: int, lists: dict[int, np.ndarray]) -> pa.RecordBatch:
        raw = zstandard.decompress(doc_table)
        no_id = np.frombuffer(raw, np.bool_, n)
        doc_ids, hashes = np.frombuffer(raw, np.int64, 2 * n, n).reshape(2, n)
        counts = np.frombuffer(raw, np.uint32, n, 17 * n).astype(np.int64)
        taken = counts + block.value.gap
        ends = np.cumsum(taken)
        base = ends - taken
        hits: dict[int, list[np.ndarray]] = {}
        items: dict[int, set[str]] = {}
        almost: dict[int, set[str]] = {}
        terms = np.fromiter(lists, np.int64, len(lists))
        for window, holders in block.value.possible(terms):
            close, exact = _starts(window, lists, block.value.slop)
            for d in np.unique(np.searchsorted(ends, close, "right")).tolist():
                almost.setdefault(d, set()).update(holders)
            if len(exact):
                owner = np.searchsorted(ends, exact, "right")
                for d in np.unique(owner).tolist():
                    items.setdefault(d, set()).update(holders)
                    s = exact[owner == d] - base[d]
                    hits.setdefault(d, []).append(np.stack([s, s + len(window)]))
        spans = [merge_spans(np.concatenate(hits[d], axis=1)) if d in hits else b""
                 for d in range(n)]
        return pa.record_batch([
            pa.array(doc_ids, mask=no_id), pa.array(hashes), pa.array(counts),
            pa.array(spans, pa.binary()),
            pa.array([sorted(items.get(d, ())) for d in range(n)], pa.list_(pa.string())),
            pa.array([sorted(almost.get(d, ())) for d in range(n)], pa.list_(pa.string())),
        ], names=["doc_id", "text_hash", "n_words", "spans", "items", "near"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, docs, terms, postings in zip(*batch.columns):
                lists = {t: _unpack(p.as_buffer()).astype(np.int64)
                         for t, p in zip(terms.as_py(), postings.values)}
                yield shard(docs.as_py(), n.as_py(), lists)

    return index.mapInArrow(run, FOUND)


def merge_spans(spans: np.ndarray) -> bytes:
    """Union of [start, end) pairs (2 x n) as sorted disjoint uint32 pairs."""
    if not spans.size:
        return b""
    start, end = spans[:, np.argsort(spans[0], kind="stable")]
    reach = np.maximum.accumulate(end)
    first = np.r_[True, start[1:] > reach[:-1]]
    last = np.r_[first[1:], True]
    return np.stack([start[first], reach[last]], axis=1).astype(np.uint32).tobytes()


def _united(spans: Column) -> Column:
    def run(lists: pd.Series) -> pd.Series:
        return pd.Series([merge_spans(np.frombuffer(b"".join(x), np.uint32).astype(np.int64)
                                      .reshape(-1, 2).T) for x in lists], dtype=object)
    return F.pandas_udf(run, "binary")(spans)


def benchmark_blocks(benchmark: DataFrame, item_id: str, text: str, window: int, slop: int,
                     block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """The benchmark in blocks of about `block_bytes` of text; one is on the driver at a
    time, never the whole table."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("item"),
                            utf8(text).alias("text")).filter(F.col("item").isNotNull())
    size = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(1, -(-size // block_bytes))
    for i in range(n):
        part = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i)
        yield Block(sorted({(r[0], bytes(r[1])) for r in part.toLocalIterator()}), window, slop)


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
            item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
            slop: int = SLOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, text_hash, n_words, spans, items, near), one row per document."""
    spark = docs.sparkSession
    parts = []
    for block in benchmark_blocks(benchmark, item_id, item_text, window, slop, block_bytes):
        shared = spark.sparkContext.broadcast(block)
        parts.append(search(build_index(docs, doc_id, text, shared), shared))
    if len(parts) == 1:
        return parts[0]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    # each block has one row per document: equal rows come back as often as they came in
    return (union.groupBy("doc_id", "text_hash", "n_words")
            .agg(F.collect_list("spans").alias("spans"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))).alias("near"),
                 (F.count(F.lit(1)) / len(parts)).cast("int").alias("copies"))
            .withColumn("spans", _united("spans"))
            .select("doc_id", "text_hash", "n_words", "spans", "items", "near",
                    F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy"))


def _n_hit(spans: Column) -> Column:
    def run(blobs: pd.Series) -> pd.Series:
        out = []
        for b in blobs:
            pairs = np.frombuffer(b, np.uint32).reshape(-1, 2).astype(np.int64)
            out.append(int((pairs[:, 1] - pairs[:, 0]).sum()))
        return pd.Series(out, dtype="int64")
    return F.pandas_udf(run, "long")(spans)


def report(found: DataFrame) -> DataFrame:
    """Digest columns of `matches`."""
    return found.select(
        "doc_id", "n_words", _n_hit(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        F.size("near").cast("long").alias("n_near_items"),
    ).withColumn("contaminated", F.col("n_hit") > 0)


def clean(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text"
          ) -> DataFrame:
    """`docs` without the documents in which a window of the benchmark occurs."""
    hit = (matches(docs, benchmark, doc_id, text).filter(F.size("items") > 0)
           .select("doc_id", "text_hash").distinct())
    mark = free_name("text_hash", docs, hit)
    hashed = docs.withColumn(mark, F.xxhash64(text))
    same = hashed[doc_id].cast("long").eqNullSafe(hit["doc_id"]) & (hashed[mark] == hit["text_hash"])
    return hashed.join(hit, same, "left_anti").drop(mark)


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item (one row per document)."""
    return report(matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


QUERIES = {"op9_decontaminate": op9_decontaminate}

_WORDS = ("regexp_extract_all(translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")
ORACLE_SQL = {"op9_decontaminate": f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format(t="text")} AS w
              FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS.format(t="text")} AS w FROM benchmark
          WHERE item_id IS NOT NULL),
windows AS (SELECT DISTINCT item, w[i:i + {WINDOW - 1}] AS t
            FROM items, LATERAL (SELECT unnest(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1)) AS i)
            WHERE len(w) > 0),
words AS (SELECT rid, p, w[p] AS word, least(p - 1, {SLOP}) AS o,
                 w[greatest(p - {SLOP}, 1):p + {WINDOW - 1 + SLOP}] AS c
          FROM docs, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS p)),
starts AS (SELECT rid, p, item, t, o, c FROM words JOIN windows ON word = t[1]),
exact AS (SELECT rid, p, item, len(t) AS n FROM starts WHERE c[o + 1:o + len(t)] = t),
near AS (SELECT DISTINCT rid, item FROM starts
         WHERE len(list_filter(range(2, len(t) + 1), lambda j: NOT list_contains(
           c[greatest(o + j - {SLOP}, 1):o + j + {SLOP}], t[j]))) = 0),
hit AS (SELECT rid, count(DISTINCT q) AS n_hit
        FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM exact) GROUP BY rid),
found AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT rid, item FROM exact) GROUP BY rid),
close AS (SELECT rid, count(*) AS n_near FROM near GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_near, 0)::BIGINT AS n_near_items, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (rid) LEFT JOIN found USING (rid) LEFT JOIN close USING (rid)
"""}
