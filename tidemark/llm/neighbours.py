"""Nearest neighbours by a block matrix join.

Queries and candidates are cut into blocks; a tile is one block of each. Vectors are
quantised to int8 with a scale of their own, and a tile's inner products come from one
product of the int8 matrices (whole numbers below 2**24, so single precision is exact).
With x = q + r (q the quantised vector, r the rest), |<x, y> - <qx, qy>| is at most
|qx| |ry| + |rx| |y|: that bound gives every pair an interval. Per query the k-th largest
lower end is a threshold; only pairs whose upper end reaches it are recomputed in double
precision. Tiles return their k best, merged by heaps, so nothing is lost: results equal
a full search.

Vectors that are null, empty, zero, or hold null or non-finite components take no part;
vectors meet only those of their own length. Rows of one `vec_id` are never each other's
neighbours; equal rows count once, rows of one id with different vectors count each. Ties
go to the smaller id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table

K = 20
QUERY_EVERY = 20
BLOCK_BYTES = 4 << 20  # of double-precision components in a block, whatever their number
PIECE = 256  # queries of a tile handled at once
PAIRS = 1 << 16  # surviving pairs recomputed at once
ROUNDING = 1e-11  # of double-precision sums, as a share of the lengths' product
EXACT = 1 << 24  # whole numbers up to here are exact in single precision


def usable(vector: str | Column) -> Column:
    """No null, no non-finite component, not all zero, not empty."""
    v = F.col(vector) if isinstance(vector, str) else vector
    return (v.isNotNull()
            & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
            & F.exists(v, lambda x: x != 0))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scale, and upper bounds of the lengths of the quantised part and of
    the rest, for each row of a float64 matrix."""
    scale = np.abs(x).max(axis=1) / 127.0
    scale[scale == 0] = np.finfo(np.float64).tiny
    q = np.rint(x / scale[:, None]).astype(np.int8)
    part = q * scale[:, None]
    slack = 1 + 1e-9
    return q, scale, np.linalg.norm(part, axis=1) * slack, np.linalg.norm(x - part, axis=1) * slack


def exact_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise inner products in double precision, added in the order of the components."""
    out = np.zeros(len(x))
    for j in range(x.shape[1]):
        out += x[:, j] * y[:, j]
    return out


def without_copies(ids: np.ndarray, vectors: np.ndarray, most: int
                   ) -> tuple[np.ndarray, np.ndarray]:
    """Of equal vectors only the `most` smallest ids can be among the `most` best, as ties
    go to the smaller id; of a repeated id one row is enough."""
    order = np.lexsort((ids, *vectors.T))
    i, v = ids[order], vectors[order]
    new = np.r_[True, (v[1:] != v[:-1]).any(axis=1)]
    again = ~new & np.r_[False, i[1:] == i[:-1]]
    i, v, new = i[~again], v[~again], new[~again]
    start = np.flatnonzero(new)
    place = np.arange(len(i)) - np.repeat(start, np.diff(np.r_[start, len(i)]))
    return i[place < most], v[place < most]


def tile(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
         k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, candidate id, score): the k best candidates of each query in this tile."""
    ids, vectors = without_copies(ids, vectors, k + 1)  # one may be the query's own
    exact = queries.shape[1] * 127 * 127 < EXACT
    kind = np.float32 if exact else np.float64
    qx, sx, lx, rx = quantised(queries)
    qy, sy, ly, ry = quantised(vectors)
    right = qy.T.astype(kind)
    whole = ly + ry  # at least the length of y
    out = []
    for i in range(0, len(queries), PIECE):
        part = slice(i, i + PIECE)
        with np.errstate(over="ignore", invalid="ignore"):
            near = (qx[part].astype(kind) @ right) * sx[part, None] * sy
            error = lx[part, None] * ry + rx[part, None] * whole
            error += (lx + rx)[part, None] * whole * ROUNDING
            low, high = near - error, near + error
        # where lengths overflow nothing is known of the product: it is computed
        low, high = np.where(np.isnan(low), -np.inf, low), np.where(np.isnan(high), np.inf, high)
        own = query_ids[part, None] == ids
        low = np.where(own, -np.inf, low)
        if low.shape[1] > k:
            least = np.partition(low, low.shape[1] - k, axis=1)[:, -k]
        else:
            least = np.full(len(low), -np.inf)
        row, col = np.nonzero((high >= least[:, None]) & ~own)
        score = np.concatenate([np.empty(0), *(
            exact_products(queries[i + row[a:a + PAIRS]], vectors[col[a:a + PAIRS]])
            for a in range(0, len(row), PAIRS))])
        order = np.lexsort((ids[col], -score, row))
        row, col, score = row[order], col[order], score[order]
        first = np.searchsorted(row, np.arange(len(low)))
        kept = np.arange(len(row)) - first[row] < k
        out.append((query_ids[i + row[kept]], ids[col[kept]], score[kept]))
    return tuple(np.concatenate(x) for x in zip(*out))


FOUND = "query_id long, vec_id long, score double"


def tile_results(queries: DataFrame, candidates: DataFrame, blocks: tuple[int, int], k: int
                 ) -> DataFrame:
    """The k best of every query in every tile. Both sides have (id, v, size)."""
    q_blocks, c_blocks = blocks

    def run(_: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        def matrix(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
            v = t.column("v").combine_chunks()
            return (t.column("id").to_numpy(),
                    v.flatten().to_numpy(zero_copy_only=False).reshape(len(t), -1)
                    .astype(np.float64))
        if not len(left) or not len(right):
            found = ([], [], [])
        else:
            found = tile(*matrix(left), *matrix(right), k)
        return pa.table([pa.array(found[0], pa.int64()), pa.array(found[1], pa.int64()),
                         pa.array(found[2], pa.float64())], names=["query_id", "vec_id", "score"])

    def dealt(side: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        block = F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int").alias(own)
        return side.select("id", "v", "size", block,
                           F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other))
    left = dealt(queries, "qb", q_blocks, "cb", c_blocks)
    right = dealt(candidates, "cb", c_blocks, "qb", q_blocks)
    keys = ["size", "qb", "cb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, FOUND)


def merged(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the tiles' results of each query, merged."""
    def best(rows) -> list[tuple[float, int]]:
        heap: list[tuple[float, int]] = []
        for _, v, s in rows:
            if len(heap) < k:
                if (s, -v) not in heap:  # equal query rows find the same
                    heapq.heappush(heap, (s, -v))
            elif (s, -v) > heap[0] and (s, -v) not in heap:
                heapq.heapreplace(heap, (s, -v))
        return sorted(heap, reverse=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for batch in batches for r in zip(*(c.to_pylist() for c in batch.columns)))
        out: list[tuple[int, int, int, float]] = []

        def flush() -> pa.RecordBatch:
            cols = list(zip(*out)) or [()] * 4
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64())
            return pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds)],
                                   names=["query_id", "rank", "vec_id", "score"])

        for q, own in groupby(rows, itemgetter(0)):
            out += [(q, i + 1, -v, s) for i, (s, v) in enumerate(best(own))]
            if len(out) >= 50_000:
                yield flush()
                out.clear()
        yield flush()

    return (found.repartition("query_id").sortWithinPartitions("query_id")
            .mapInArrow(run, "query_id long, rank int, vec_id long, score double"))


def nearest(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id",
            vector: str = "embedding", k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The k candidates of largest inner product for every query row."""
    rows = vectors.filter(usable(vector) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("v"),
        F.size(vector).alias("size"), is_query.alias("q"))
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("q").alias("q"),
                 F.coalesce(F.max("size"), F.lit(1)).alias("size")).first()  # empty: one block
    block = max(1, block_bytes // (8 * n["size"]))
    blocks = (max(1, -(-n["q"] // block)), max(1, -(-n["n"] // block)))
    queries = rows.filter("q").drop("q")
    return merged(tile_results(queries, rows.drop("q"), blocks, k), k)


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every row whose id is divisible by 20, against all rows."""
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, F.col("vec_id") % QUERY_EVERY == 0)


QUERIES = {"op7_ann": op7_ann}
ORACLE_SQL = {"op7_ann": """
WITH good AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM good q JOIN good c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
  WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
  FROM pairs)
WHERE rank <= 20
"""}
