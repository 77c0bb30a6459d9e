import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<float>, label int"


def product(x, y):
    out = 0.0
    for a, b in zip(x, y):  # `sum` would compensate rounding
        out += float(a) * float(b)
    return out


def plain(rows, k):
    good = [(i, np.array(v, np.float32).astype(np.float64)) for i, v, _ in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = set()
    for q, x in good:
        if q % 20 == 0:
            best = {i: product(x, y) for i, y in good
                    if i != q and len(x) == len(y)}
            order = sorted(best, key=lambda i: (-best[i], i))[:k]
            out |= {(q, r + 1, i, best[i]) for r, i in enumerate(order)}
    return out


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    out = [(i, rng.normal(size=16).astype(np.float32).tolist(), 0) for i in range(300)]
    same = out[5][1]
    out += [(300 + i, same, 1) for i in range(60)]  # copies: ties
    out += [(400, None, 0), (401, [], 0), (402, [0.0] * 16, 0), (403, [None] * 16, 0),
            (404, [float("nan")] * 16, 0), (405, [float("inf")] * 16, 0), (None, same, 0),
            (420, [1.0, 2.0], 0), (421, [3.0, 1.0], 0), (440, [1e-30] * 16, 0),
            (460, [1e30] * 16, 0), out[7]]
    return out


def result(df, **kw):
    return {tuple(r) for r in N.nearest(df, F.col("vec_id") % 20 == 0, **kw).collect()}


@pytest.mark.parametrize("block_bytes", [N.BLOCK_BYTES, 37 * 8 * 16])
def test_matches_plain_version(spark, rows, block_bytes):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert result(df, block_bytes=block_bytes) == plain(rows, 20)


def test_copies_beyond_k_do_not_matter():
    ids = np.array([9, 3, 3, 7, 1, 5, 8])
    v = np.array([[1, 2], [1, 2], [1, 2], [0, 1], [1, 2], [0, 1], [1, 2]], float)
    i, w = N.without_copies(ids, v, 2)
    assert sorted(zip(i.tolist(), map(tuple, w.tolist()))) == [
        (1, (1, 2)), (3, (1, 2)), (5, (0, 1)), (7, (0, 1))]


def test_few_candidates_extra_columns_and_empty(spark):
    few = [(i, [float(i + 1), 1.0], 0) for i in range(5)]
    df = spark.createDataFrame(few, SCHEMA).withColumns(
        {c: F.lit(1) for c in ("id", "v", "size", "q", "qb", "cb")})
    assert result(df) == plain(few, 20)
    assert result(spark.createDataFrame([], SCHEMA)) == set()


def test_bounds_hold():
    rng = np.random.default_rng(5)
    x, y = rng.normal(size=(50, 33)), rng.normal(size=(60, 33))
    qx, sx, lx, rx = N.quantised(x)
    qy, sy, ly, ry = N.quantised(y)
    near = (qx.astype(int) @ qy.T.astype(int)) * sx[:, None] * sy
    assert (np.abs(near - x @ y.T) <= lx[:, None] * ry + rx[:, None] * (ly + ry)).all()


def test_products_that_overflow_are_results(spark):
    """Finite double vectors whose lengths, and products, are beyond double precision."""
    rng = np.random.default_rng(8)
    rows = [(i, (rng.random(8) * s).tolist()) for i, s in enumerate([1.0, 1e200, 1e150, 1e-200] * 20)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    want = set()
    for q, x in rows:
        if q % 20 in (0, 1):
            score = {i: product(x, y) for i, y in rows if i != q}
            best = sorted(score, key=lambda i: (-score[i], i))[:5]
            want |= {(q, r + 1, i, score[i]) for r, i in enumerate(best)}
    got = N.nearest(df, F.col("vec_id") % 20 < 2, k=5)
    assert {tuple(r) for r in got.collect()} == want
