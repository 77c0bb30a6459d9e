import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import sharding as S


def plain_shards(rows, shards, points):
    """Key by key: rounds in which waiting keys knock at their point's shard."""
    at, owner = S.ring(shards, points)

    def place(key):
        if key is None:
            return 42  # a null leaves the seed as it is
        return np.int64(np.uint64(xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)))

    keys = []
    for doc_id, text, *_ in rows:
        b = (text or "").encode()
        keys.append((place(doc_id), len(b) + 8, zlib.crc32(b), doc_id))
    keys.sort(key=lambda k: k[:3])
    home = [int(np.searchsorted(at, k[0])) % len(at) for k in keys]
    room = [len(rows) // shards + (s < len(rows) % shards) for s in range(shards)]
    members = [[] for _ in range(shards)]
    waiting = [(home[i], home[i], i) for i in range(len(keys))]
    while waiting:
        still = []
        for p, h, i in sorted(waiting):
            if len(members[owner[p]]) < room[owner[p]]:
                members[owner[p]].append(i)
            else:
                still.append((p, h, i))
        waiting = []
        for p, h, i in still:
            while len(members[owner[p]]) == room[owner[p]]:
                p = (p + 1) % len(at)
            waiting.append((p, h, i))
    return sorted(((keys[i][3], keys[i][1], keys[i][2], s, slot)
                   for s, m in enumerate(members) for slot, i in enumerate(m)), key=str)


def result(df, shards, points):
    out = S.document_shards(df, shards, points).drop("displaced")
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("shards,points", [(24, 256), (5, 2), (3, 1), (60, 4)])
def test_matches_plain_version(docs, rows, shards, points):
    assert result(docs, shards, points) == plain_shards(rows, shards, points)


def test_null_ids_hold_most_rows(spark, rows):
    many = [*rows, *[(None, f"text {i}", "en", "s", 0) for i in range(80)]]
    df = spark.createDataFrame(many, "doc_id long, text string, lang string, source string, "
                                     "n_chars long").repartition(4)
    assert result(df, 7, 16) == plain_shards(many, 7, 16)


def test_odd_and_empty(odd_docs, rows, no_docs):
    named = odd_docs.withColumns({c: F.lit(0) for c in ("shard", "slot", "place", "point", "size")})
    assert result(named, 24, 256) == plain_shards(rows, 24, 256)
    assert result(no_docs, 24, 256) == []


def test_few_rows_move(spark):
    """A further shard moves its own share and little more; counts stay at most one apart."""
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    was, now = (S.document_shards(df, n).select("doc_id", "shard").toPandas().set_index("doc_id").shard
                for n in (24, 25))
    for s in (was, now):
        assert s.value_counts().max() - s.value_counts().min() <= 1
    moved = was != now.loc[was.index]
    assert 0.035 < moved.mean() < 0.09
    assert (now.loc[was.index][moved] == 24).mean() > 0.5


def test_plan_is_bounded_by_the_ring():
    _, owner = S.ring(24)
    rng = np.random.default_rng(1)
    keys = dict(enumerate(rng.poisson(1_000_000, len(owner)).tolist()))
    runs = S.placement(keys, owner, 24)
    assert sum(len(r) for r in runs.values()) < 3 * len(owner)
    # every rank of every point lies in one run
    for p, n in keys.items():
        firsts = sorted(r[0] for r in runs[p])
        assert firsts[0] == 0 and firsts[-1] < n and len(set(firsts)) == len(firsts)
