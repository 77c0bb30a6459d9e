import random

import numpy as np
from .plain import components, simhash
from pyspark.sql import functions as F

from tidemark.llm import simhash as S
from tidemark.llm.components import components as connected


def result(df):
    found = S.near_duplicates(df).select("doc_id", S.hexadecimal(F.col("fp")), "component_id")
    return sorted(map(tuple, found.collect()), key=str)


def test_matches_plain_version(docs, rows, odd_docs, no_docs):
    want = sorted(components([r[:2] for r in rows]), key=str)
    assert result(docs) == want
    assert result(odd_docs) == want
    assert result(no_docs) == []


def test_fingerprint_of_odd_texts():
    for text in ("", " \n", "a", "A b", "x y z", "Äb c  d\te", "w " * 70_000):
        assert S.fingerprint_of(text.encode()) == simhash(text)


def test_anchors_cover():
    rng = np.random.default_rng(3)
    half = rng.integers(0, 1 << 32, 500, dtype=np.uint32)
    home = S.nearest(half)
    assert (np.bitwise_count(half ^ home) <= 1).all()
    assert (S.nearest(home) == home).all()
    # whatever is one bit away finds its home among the half's anchors
    anchors = S.reached(half)
    for bit in range(32):
        assert (anchors == S.nearest(half ^ np.uint32(1 << bit))[:, None]).any(axis=1).all()
    assert max(len(set(a)) for a in anchors.tolist()) == 17


def links_of(spark, values, **kw):
    df = spark.createDataFrame([(int(np.int64(np.uint64(v))),) for v in values], "fp long")
    return connected(S.links(df.repartition(3), **kw))


def groups(pairs):
    out = {}
    for r in pairs.collect():
        out.setdefault(r["component"], set()).add(r["node"])
    return sorted(map(sorted, out.values()))


def plain_groups(values):
    values = sorted({int(np.int64(np.uint64(v))) for v in values})
    group = {v: v for v in values}

    def find(v):
        while group[v] != v:
            v = group[v]
        return v
    for i, a in enumerate(values):
        for b in values[:i]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3:
                group[find(a)] = find(b)
    out = {}
    for v in values:
        out.setdefault(find(v), []).append(v)
    return sorted(sorted(g) for g in out.values() if len(g) > 1)


def test_chains_and_crowds(spark):
    rng = random.Random(9)
    values = [rng.getrandbits(64) for _ in range(40)]
    for v in values[:10]:  # chains of up to three flipped bits
        for _ in range(6):
            v ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
            values.append(v)
    crowd = rng.getrandbits(64)  # a group that is compared block by block
    values += [crowd ^ (1 << a) ^ (1 << b) for a in range(32, 64) for b in range(32, a)]
    want = plain_groups(values)
    assert groups(links_of(spark, values)) == want
    assert groups(links_of(spark, values, group_limit=50)) == want  # salted


def test_components_of_a_path(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (100, 102), (7, 7)]
    found = connected(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == {
        **{i: 0 for i in range(61)}, **{i: 100 for i in (100, 101, 102)}}


def test_one_row_of_each(docs, rows):
    kept = S.one_of_each(docs)
    assert kept.columns == docs.columns
    want = {c for _, _, c in components([r[:2] for r in rows])}
    got = [r["doc_id"] for r in kept.collect()]
    assert sorted(got) == sorted(want)


def test_kept_rows_are_as_they_were(odd_docs, docs):
    """Columns with the names of internal ones, and a map, come back with their values."""
    named = odd_docs.withColumn("tags", F.create_map(F.lit("k"), F.col("doc_id")))
    kept = S.one_of_each(named)
    assert kept.columns == named.columns
    before = {str(r) for r in named.collect()}
    after = [str(r) for r in kept.collect()]
    assert set(after) <= before
    assert len(after) == S.one_of_each(docs).count()
    assert all(r["__hash"] == 12 and r["row_hash"] == 16 for r in kept.collect())
