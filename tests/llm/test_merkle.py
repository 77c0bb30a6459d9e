import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle as M

from .plain import sha


def written(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def tree(hashes):
    """(root, per leaf the (left, right) siblings of each level) of plain lists."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), list(hashes)
    while len(level) > 1:
        for i, path in enumerate(paths):
            run = at[i] // 3 * 3
            path.append(("".join(level[run:at[i]]), "".join(level[at[i] + 1:run + 3])))
            at[i] //= 3
        level = [sha("".join(level[i:i + 3])) for i in range(0, len(level), 3)]
    return level[0], paths


def plain_audit(rows):
    groups, out = {}, []
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    lower = {}
    for s in order:
        leaves = [(r, sha("".join(map(written, (r[0], r[3], r[2], r[4], r[1]))))) for r in groups[s]]
        leaves.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        lower[s] = leaves, *tree([h for _, h in leaves])
    root, tops = tree([lower[s][1] for s in order])
    for s, top in zip(order, tops):
        leaves, subroot, paths = lower[s]
        for (r, leaf), path in zip(leaves, paths):
            text = r[1]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            h = sha("".join(map(written, (r[0], r[3], r[2], r[4], text))))
            for left, right in path + top:
                h = sha(left + h + right)
            proof = sha("".join(a + b for a, b in path + top))
            out.append((r[0], leaf, subroot, root, proof, h, h == root))
    return sorted(out, key=str)


def result(df, **kw):
    return sorted(map(tuple, M.audit(df, **kw).collect()), key=str)


@pytest.fixture(scope="module")
def more(spark, rows):
    """The awkward rows, a source of one, a source that holds most, a null source, line feeds."""
    rows = [*rows, *[(100 + i, f"row\n{i}" if i % 3 else None, None, "hot", None) for i in range(95)],
            (500, "alone", "en", "", 5), (501, "a\nb", "en", None, 3), (502, "", "é", "é", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                       "n_chars long").repartition(7), rows


@pytest.mark.parametrize("levels", [2, 6])
def test_matches_plain_version(more, levels):
    """Blocks of 9 leaves (three tiers) and of 729 (one)."""
    df, rows = more
    assert result(df, levels=levels) == plain_audit(rows)


def test_odd_and_empty(odd_docs, rows, no_docs):
    named = odd_docs.withColumns({c: F.lit(0) for c in ("group", "rank", "node", "path", "leaf")})
    assert result(named) == plain_audit(rows)
    assert result(no_docs) == []


def test_heights():
    spark_heights = {1: 0, 2: 1, 3: 1, 4: 2, 9: 2, 10: 3, 27: 3, 28: 4, 3 ** 30: 30, 3 ** 30 + 1: 31}
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    got = spark.createDataFrame([(n,) for n in spark_heights], "n long").select(
        "n", M.height_of(F.col("n")).alias("h")).collect()
    assert {r["n"]: r["h"] for r in got} == spark_heights


def test_proofs_need_no_join(docs):
    """The plan of the proofs: grouping and generating only, no join below the ranks."""
    tiers = M.built(docs.select(F.lit(1).alias("g"), F.col("doc_id").alias("rank"), F.lit(4).alias(
        "height"), F.struct(F.lit("x").alias("hash")).alias("node")).filter("rank is not null")
        .dropDuplicates(["rank"]), ["g"], 2)
    tops = tiers[-1].select("g", F.array().cast(M.STEPS).alias("path"), F.lit(1).alias("top"))
    plan = M.emitted(tiers, ["g"], tops, 2)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan
