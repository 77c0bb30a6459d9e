"""How quality filters act on one another, counted on a sparse document-term matrix.

The matrix: each task cuts its documents into shards of bounded size, numbers the words of
a shard and stores one compressed sparse row (CSR) block per shard: where each document's
entries begin, their columns and counts, and the shard's words, once each, in the order of
their hashes. For the columns of the whole matrix the hashes are cut into ranges, as many as
the words need to be small groups; every shard sends each range its words there, packed. A
range's distinct words, in byte order, are a part of the dictionary; the parts follow each
other, so columns are dense. What comes back to a shard is its words' columns. Only distinct
words of shards travel, and a word of very many shards is one entry of each.

Row sums of the matrix are the documents' words, nonzero counts their distinct words; they
decide filters A and B. The other flags come with the documents: C and D from the text, E
from the least id of the documents of equal text (by sha256). Documents are then reduced to
counts per part and set of failed filters (at most 32 sets), which is all that the orders of
the filters need: a filter removes the sets that it is the first of, in that order.

Edge cases: a null text is empty; no text, no words: A fails, B does not (0 < 0); a null
language is the part '' (with documents whose language is ''); a null id has no smaller one
and no label, and is no smaller id itself; repeated rows count each, rows of one id are no
copies of each other; of several label rows of an id any 1 counts; an empty table has no
parts; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import filled, groups_for, stored, table, utf8

SHARD_BYTES = 8 << 20  # text per shard
RANGE_BYTES = 4 << 20  # words (of all shards, with repeats) per range of hashes
PIECE = 4 << 20  # of a long text, split into words at a time
LETTERS = "ABCDE"
MIN_WORDS, MIN_DISTINCT_PCT, MAX_CAPITAL_PCT = 200, 50, 3
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
MARKS = b"#$%&*|"
INSIDE = bytes(range(0x80, 0xC0))  # UTF-8 bytes that begin no character
_GAP = re.compile(rb"[ \t-\r]")


# ---------------------------------------------------------------- shards
def pack(values: np.ndarray) -> bytes:
    """Whole numbers as compressed differences."""
    return zstandard.compress(np.diff(values, prepend=values.dtype.type(0)).tobytes(), 1)


def unpack(blob: bytes, dtype) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.decompress(blob), dtype), dtype=dtype)


def words_in(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text (cut at \\x20 and \\x09-\\x0D), some megabytes at a time."""
    start = 0
    while len(text) - start > PIECE:
        gap = _GAP.search(text, start + PIECE)
        end = gap.start() if gap else len(text)
        yield text[start:end].split()
        start = end
    yield text[start:].split() if start else text.split()


class _Columns(dict):
    """Numbers words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def hash_order(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words, and the order of the words by hash, then by bytes."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    order = np.argsort(hashes, kind="stable")
    if (hashes[order][1:] == hashes[order][:-1]).any():
        order = np.array(sorted(range(len(words)), key=lambda i: (hashes[i], words[i])))
    return hashes, order


class _Shard:
    """Documents of one shard, being counted."""

    def __init__(self):
        self.number, self.rows, self.size = _Columns(), [], 0
        self.columns: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, keys: tuple, text: bytes) -> None:
        found = [np.fromiter(map(self.number.__getitem__, words), np.int32, len(words))
                 for words in words_in(text)]
        columns, counts = np.unique(np.concatenate(found), return_counts=True)
        self.columns.append(columns)
        self.counts.append(counts)
        chars = len(text.translate(None, INSIDE))
        capitals = len(text) - len(text.translate(None, CAPITALS))
        marked = len(text.translate(None, MARKS)) < len(text)
        self.rows.append((*keys, hashlib.sha256(text).digest(), chars, capitals, marked))
        self.size += len(text)

    def row(self, shard: int, schema: pa.Schema) -> pa.RecordBatch:
        words = list(self.number)
        _, order = hash_order(words)
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        lengths = np.array([*map(len, self.columns)], np.int64)
        columns = place[np.concatenate(self.columns)]
        counts = np.concatenate(self.counts).astype(np.int64)
        inside = np.lexsort((columns, np.repeat(np.arange(len(lengths)), lengths)))
        blob = b"\n".join([words[i] for i in order])  # words hold no line feed
        values = [shard, *map(list, zip(*self.rows)), pack(np.cumsum(lengths)),
                  pack(columns[inside]), pack(counts[inside]), len(blob),
                  zstandard.compress(blob, 1)]
        return pa.record_batch([pa.array([v], f.type) for v, f in zip(values, schema)],
                               schema=schema)


#: of each document, beside its keys: digest, characters, A-Z among them, whether it has marks
STATISTICS = [("copy_of", T.BinaryType()), ("n_chars", T.LongType()),
              ("n_capitals", T.LongType()), ("has_marks", T.BooleanType())]


def csr_shards(docs: DataFrame, keys: dict[str, Column], text: str = "text",
               shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Stored CSR blocks, packed, with columns of their own: (shard, `doc_...` arrays of the
    documents' keys and statistics, ends, columns, counts, n_bytes, words)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    source = docs.select(*[c.alias(f"doc_{k}") for k, c in keys.items()], utf8(text).alias("text"))
    schema = T.StructType([
        T.StructField("shard", T.LongType()),
        *[T.StructField(f.name, T.ArrayType(f.dataType)) for f in source.schema.fields[:-1]],
        *[T.StructField(f"doc_{n}", T.ArrayType(t)) for n, t in STATISTICS],
        *[T.StructField(n, T.BinaryType()) for n in ("ends", "columns", "counts")],
        T.StructField("n_bytes", T.LongType()), T.StructField("words", T.BinaryType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, now = TaskContext.get().partitionId() << 32, _Shard()
        for batch in batches:
            keys_of = zip(*(c.to_pylist() for c in batch.columns[:-1]))
            for row, value in zip(keys_of, batch.column(batch.num_columns - 1)):
                now.add(row, value.as_py())
                if now.size >= shard_bytes:
                    yield now.row(number, arrow)
                    number, now = number + 1, _Shard()
        if now.rows:
            yield now.row(number, arrow)

    return stored(source.mapInArrow(run, schema))


# ---------------------------------------------------------------- dictionary
def by_range(shards: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(part, shard, words): each shard's words, packed per range of hashes."""
    total = shards.agg(F.sum("n_bytes")).first()[0] or 0
    parts = groups_for(total, range_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, blob in zip(*(c.to_pylist() for c in batch.columns)):
                words = zstandard.decompress(blob).split(b"\n") if blob else []
                hashes, _ = hash_order(words)
                part = ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
                cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(words)]
                rows = [(int(part[a]), zstandard.compress(b"\n".join(words[a:b]), 1))
                        for a, b in zip(cuts, cuts[1:]) if a < b and words[a:b] != [b""]]
                yield pa.record_batch(
                    [pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([shard] * len(rows), pa.int64()),
                     pa.array([r[1] for r in rows], pa.binary())], names=["part", "shard", "words"])

    return shards.select("shard", "words").mapInArrow(run, "part long, shard long, words binary")


def numbered(ranges: DataFrame) -> DataFrame:
    """Stored (part, shard, n_distinct, columns): per range and shard the numbers of its words
    among the range's distinct words in byte order."""
    def run(rows: pa.Table) -> pa.Table:
        shards = rows.column("shard").to_pylist()
        lists = [zstandard.decompress(b.as_py()).split(b"\n") for b in rows.column("words")]
        number = {w: i for i, w in enumerate(sorted(set().union(*lists)))}
        columns = [pack(np.fromiter(map(number.__getitem__, x), np.int64, len(x))) for x in lists]
        return pa.table({"part": rows.column("part"), "shard": pa.array(shards, pa.int64()),
                         "n_distinct": pa.array([len(number)] * len(shards), pa.int64()),
                         "columns": pa.array(columns, pa.binary())})

    return stored(ranges.groupBy("part").applyInArrow(
        run, "part long, shard long, n_distinct long, columns binary"))


def range_offsets(numbers: DataFrame) -> DataFrame:
    """(part, first): the column of each range's first word; one row per range."""
    sizes = numbers.groupBy("part").agg(F.max("n_distinct").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))


def dictionary(ranges: DataFrame, numbers: DataFrame) -> DataFrame:
    """(word, column): every distinct word of the table and its column."""
    def run(rows: pa.Table) -> pa.Table:
        words = sorted(set().union(*(zstandard.decompress(b.as_py()).split(b"\n")
                                     for b in rows.column("words"))))
        return pa.table({"part": pa.array([rows.column("part")[0].as_py()] * len(words), pa.int64()),
                         "word": pa.array(words, pa.binary()),
                         "at": pa.array(range(len(words)), pa.int64())})

    words = ranges.groupBy("part").applyInArrow(run, "part long, word binary, at long")
    return words.join(range_offsets(numbers), "part").select(
        "word", (F.col("first") + F.col("at")).alias("column"))


# ---------------------------------------------------------------- matrix
def document_term_matrix(shards: DataFrame, numbers: DataFrame) -> DataFrame:
    """(shard, doc_... arrays, starts, columns, counts): CSR blocks of the whole matrix. The
    entries of a shard's i-th document are those from starts[i] to before starts[i + 1]."""
    told = numbers.join(range_offsets(numbers), "part").groupBy("shard").agg(F.array_sort(
        F.collect_list(F.struct("part", "first", "columns"))).alias("told"))
    named = shards.drop("n_bytes", "words").join(told, "shard", "left")
    docs = [f for f in shards.schema.fields if f.name.startswith("doc_")]
    schema = T.StructType([T.StructField("shard", T.LongType()), *docs, *[
        T.StructField(n, T.ArrayType(T.LongType())) for n in ("starts", "columns", "counts")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                told = row.column("told")[0].as_py() or []
                columns = [np.empty(0, np.int64), *(
                    unpack(t["columns"], np.int64) + t["first"] for t in told)]
                mine, counts, ends = (unpack(row.column(n)[0].as_py(), np.int64)
                                      for n in ("columns", "counts", "ends"))
                lists = [np.concatenate([[0], ends]), np.concatenate(columns)[mine], counts]
                yield pa.record_batch(
                    [row.column("shard"), *[row.column(f.name) for f in docs],
                     *[pa.array([x], pa.list_(pa.int64())) for x in lists]], names=schema.names)

    return named.mapInArrow(run, schema)


def row_statistics(matrix: DataFrame) -> DataFrame:
    """One row per document: its keys and statistics, `n_words` (row sum of the matrix) and
    `n_distinct` (nonzero count)."""
    docs = [f for f in matrix.schema.fields if f.name.startswith("doc_")]
    schema = T.StructType([
        *[T.StructField(f.name.removeprefix("doc_"), f.dataType.elementType) for f in docs],
        T.StructField("n_words", T.LongType()), T.StructField("n_distinct", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                starts, counts = (batch.column(n)[i].values.to_numpy() for n in ("starts", "counts"))
                upto = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])[starts]
                yield pa.record_batch(
                    [*[batch.column(f.name)[i].values for f in docs],
                     pa.array(np.diff(upto)), pa.array(np.diff(starts))], names=schema.names)

    return matrix.select(*[f.name for f in docs], "starts", "counts").mapInArrow(run, schema)


# ---------------------------------------------------------------- flags
def flagged(docs: DataFrame, shard_bytes: int = SHARD_BYTES, range_bytes: int = RANGE_BYTES
            ) -> DataFrame:
    """(doc_id, part, failed): per document the set of filters it fails, as bits (A = 1)."""
    shards = csr_shards(docs, {"id": F.col("doc_id").cast("long"), "part": filled("lang")},
                        shard_bytes=shard_bytes)
    rows = row_statistics(document_term_matrix(shards, numbered(by_range(shards, range_bytes))))
    rows = stored(rows.withColumnRenamed("id", "doc_id"))

    # E: only texts of several documents need their least id
    least = rows.groupBy("copy_of").agg(F.min("doc_id").alias("least"),
                                        F.max("doc_id").alias("most"))
    least = least.filter("least < most").drop("most")
    rows = rows.join(least, "copy_of", "left")
    bits = {
        "A": F.col("n_words") < MIN_WORDS,
        "B": F.col("n_distinct") * 100 < F.col("n_words") * MIN_DISTINCT_PCT,
        "C": F.col("n_capitals") * 100 > F.col("n_chars") * MAX_CAPITAL_PCT,
        "D": F.col("has_marks"),
        "E": F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False))}
    failed = sum((F.when(bits[f], F.lit(1 << i)).otherwise(0) for i, f in enumerate(LETTERS)),
                 F.lit(0))
    return rows.select("doc_id", "part", failed.alias("failed"))


# ---------------------------------------------------------------- orders
def failure_sets(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, sets): per part the documents, good and toxic ones, of each set of failed filters."""
    of_id = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")
        ).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    counted = flags.join(of_id, "doc_id", "left").groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"),
        F.count_if("toxic").alias("toxic"))
    return counted.groupBy("part").agg(
        F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("sets"))


def steps() -> Column:
    """All orders of the filters, step by step: bit of the step's filter, bits before it."""
    out = []
    for order in map("".join, permutations(LETTERS)):
        before = 0
        for i, letter in enumerate(order):
            bit = 1 << LETTERS.index(letter)
            out.append(F.struct(F.lit(order).alias("filter_order"), F.lit(i + 1).alias("step"),
                                F.lit(bit).alias("bit"), F.lit(before).alias("before")))
            before |= bit
    return F.array(*out)


def interactions(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter does at each step of each order, per part."""
    def total(when, what) -> Column:
        return F.aggregate("sets", F.lit(0).cast("long"), lambda a, s: a + F.when(
            when(s["failed"]), what(s)).otherwise(0))

    zero = F.lit(0)
    bit, before = F.col("bit"), F.col("before")

    def fails(s: Column) -> Column:
        return s.bitwiseAND(bit) != zero

    def removed(s: Column) -> Column:
        return fails(s) & (s.bitwiseAND(before) == zero)

    # a document that fails k filters is removed by each of them in 1 / k of the orders
    orders = F.lit(len(list(permutations(LETTERS))))
    return failure_sets(flags, labels).select("part", "sets", F.inline(steps())).select(
        "part", "filter_order", "step",
        total(lambda s: s.bitwiseAND(before.bitwiseOR(bit)) == zero, lambda s: s["n"]).alias("kept"),
        total(removed, lambda s: s["n"]).alias("removed"),
        total(lambda s: fails(s) & (s.bitwiseAND(before) != zero), lambda s: s["n"])
        .alias("redundant"),
        total(lambda s: s == bit, lambda s: s["n"]).alias("unique_fails"),
        total(removed, lambda s: s["good"]).alias("good_lost"),
        total(removed, lambda s: s["toxic"]).alias("toxic_lost"),
        total(fails, lambda s: s["n"] * (orders / F.bit_count(s["failed"])).cast("long"))
        .alias("shapley"))


def op12_filter_audit(spark, sf_dir):
    """Counts per part, order of the five filters and step."""
    return interactions(flagged(table(spark, sf_dir, "documents")),
                        table(spark, sf_dir, "labels"))


QUERIES = {"op12_filter_audit": op12_filter_audit}
ORACLE_SQL = {"op12_filter_audit": """
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'),
                     lambda w: w <> '') AS words
  FROM documents
),
flags AS (
  SELECT doc_id, part, len(words) AS n_words, len(list_distinct(words)) AS n_distinct,
         strlen(regexp_replace(text, '[^A-Z]', '', 'g')) AS capitals, length(text) AS n,
         regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
  FROM words
),
bits AS (
  SELECT part, (n_words < 200)::INT + 2 * (100 * n_distinct < 50 * n_words)::INT
       + 4 * (100 * capitals > 3 * n)::INT + 8 * d::INT + 16 * e::INT AS failed,
       coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM flags LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
                        FROM labels GROUP BY doc_id) USING (doc_id)
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS b),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order,
         [a.b, b.b, c.b, d.b, e.b] AS bs
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.b + b.b + c.b + d.b + e.b = 31 AND a.b | b.b | c.b | d.b | e.b = 31
),
steps AS (
  SELECT filter_order, step, bs[step] AS bit,
         coalesce(list_sum(bs[1:step - 1]), 0)::INT AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
),
sets AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (WHERE good) AS good,
         count(*) FILTER (WHERE toxic) AS toxic
  FROM bits GROUP BY ALL
),
counts AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (WHERE failed & (before | bit) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE failed & bit <> 0 AND failed & before = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE failed & bit <> 0 AND failed & before <> 0), 0)::BIGINT
      AS redundant,
    coalesce(sum(n) FILTER (WHERE failed = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (WHERE failed & bit <> 0 AND failed & before = 0), 0)::BIGINT
      AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE failed & bit <> 0 AND failed & before = 0), 0)::BIGINT
      AS toxic_lost
  FROM sets, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM counts"""}
