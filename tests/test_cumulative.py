import numpy as np

from tidemark.operators.cumulative import exact_quantiles, in_pieces, running_totals, value_counts


def _disc(values, p):
    v = np.sort(np.asarray(values))
    r = max(1, int(np.ceil(len(v) * p)))
    return v[r - 1]


def test_exact_quantiles_match_discrete_definition(spark):
    rng = np.random.default_rng(7)
    data = [("a", float(x)) for x in rng.integers(0, 50, 3000)] + \
           [("b", float(x)) for x in rng.normal(size=777)]
    df = spark.createDataFrame(data, "g string, v double")
    probs = [i / 10 for i in range(1, 10)] + [0.0, 1.0]
    got = {(r["g"], r["p_index"]): r["v"]
           for r in exact_quantiles(df, ["g"], "v", probs).collect()}
    for g in ("a", "b"):
        vals = [v for k, v in data if k == g]
        for i, p in enumerate(probs):
            assert got[(g, i)] == _disc(vals, p), (g, p)


def test_global_quantile_and_partitioning_independence(spark):
    rng = np.random.default_rng(3)
    vals = [float(x) for x in rng.integers(0, 10_000, 5000)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    want = _disc(vals, 0.7)
    for parts in (1, 4, 7):
        got = exact_quantiles(df.repartition(parts), [], "v", [0.7]).first()["v"]
        assert got == want


def test_running_totals_equal_numpy_cumsum(spark):
    rng = np.random.default_rng(11)
    vals = rng.integers(0, 300, 2000)
    uniq, counts = np.unique(vals, return_counts=True)
    df = spark.createDataFrame([(float(u), int(c)) for u, c in zip(uniq, counts)],
                               "v double, n long")
    out = running_totals(df, [], "v", ["n"]).orderBy("v").collect()
    assert [r["cum_n"] for r in out] == np.cumsum(counts).tolist()
    assert {r["total_n"] for r in out} == {len(vals)}


def test_nulls_and_nans_are_ignored(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    got = exact_quantiles(df, [], "v", [0.5, 1.0]).orderBy("p").collect()
    assert [r["v"] for r in got] == [1.0, 3.0]


def test_pieces_follow_the_session_setting(spark):
    """The cut is by the number of shuffle partitions, also within one feature."""
    df = spark.range(5000).selectExpr("'x' as g", "double(id % 1000) as v")
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                          "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        for n in (3, 11):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            cut = in_pieces(value_counts(df, ["g"], "v"), ["g"], "v")
            sizes = [r["count"] for r in cut.groupBy("_piece").count().collect()]
            assert len(sizes) == n and max(sizes) < 3 * 1000 / n
            out = running_totals(cut, ["g"], "v", ["n"]).orderBy("v").collect()
            assert [r["cum_n"] for r in out] == [5 * (i + 1) for i in range(1000)]
            assert {r["total_n"] for r in out} == {5000}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
