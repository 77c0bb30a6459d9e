import random
import time

import numpy as np
import pytest
from .plain import benchmark_hits

from tidemark.llm import decontaminate as D


@pytest.fixture(scope="module")
def items(rows):
    rng = random.Random(4)
    texts = [r[1] for r in rows if r[1] and len(r[1].split()) > 30][:8]
    out = [(10 + i, " ".join(t.split()[5:5 + rng.randint(8, 25)])) for i, t in enumerate(texts)]
    return out + [(1, None), (2, ""), (3, "one more"), (4, "nowhere at all"), (5, "THE a."),
                  (None, texts[0]), out[0], (11, "x"), (6, texts[1] + " " + texts[2])]


@pytest.fixture(scope="module")
def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def result(df, bench, **kw):
    found = D.report(D.matches(df, bench, **kw)).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256")
    return sorted(map(tuple, found.collect()), key=str)


def test_matches_plain_version(docs, odd_docs, rows, items, bench):
    want = sorted(benchmark_hits([r[:2] for r in rows], items), key=str)
    assert sum(r[2] > 0 for r in want) > 5
    assert result(docs, bench) == want
    assert result(odd_docs, bench) == want


def test_blocks_and_small_shards(docs, rows, items, bench, monkeypatch):
    monkeypatch.setattr(D, "SHARD_BYTES", 2000)
    want = sorted(benchmark_hits([r[:2] for r in rows], items), key=str)
    assert result(docs, bench, block_bytes=400) == want


def test_empty_tables(spark, docs, no_docs, bench):
    assert result(no_docs, bench) == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r[2] == 0 for r in result(docs, none))


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha beta x y gamma delta"), (2, "alpha gamma beta delta"),
                                  (3, "alpha beta gamma delta"), (4, "alpha beta gamma"),
                                  (5, "alpha x x x x x x beta gamma delta")],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(7, "alpha beta gamma delta")], "item_id long, text string")
    found = {r["doc_id"]: (r["n_items"], r["n_near_items"]) for r in
             D.report(D.matches(docs, bench)).collect()}
    assert found == {1: (0, 1), 2: (0, 1), 3: (1, 1), 4: (0, 0), 5: (0, 0)}


def test_clean(docs, rows, items, bench):
    kept = D.clean(docs, bench)
    assert kept.columns == docs.columns
    want = [i for i, _, hit, _, _ in benchmark_hits([r[:2] for r in rows], items) if not hit]
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted(want, key=str)


def test_long_windows(docs, rows, items, bench):
    from .plain import benchmark_hits as hits
    want = sorted(hits([r[:2] for r in rows], items, 70), key=str)
    assert result(docs, bench, window=70) == want


def test_windows_are_looked_up_by_terms():
    """All windows whose terms are present, and no others; items of equal windows together."""
    rng = random.Random(8)
    items = [(str(i), " ".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(0, 9))).encode())
             for i in range(300)]
    block = D.Block([*items, items[0]], 4, 1)
    for held in ("", "a", "abc", "abcdefgh", "abcdefghijkl"):
        want = {}
        for i, text in items:
            w = tuple(text.split())
            for p in range(max(1, len(w) - 3) if w else 0):
                if all(x.decode() in held for x in w[p:p + 4]):
                    want.setdefault(tuple(block.term[x] for x in w[p:p + 4]), set()).add(i)
        terms = np.array([block.term[c.encode()] for c in held], np.int64)
        got = list(block.possible(terms))
        assert len(got) == len(want)
        assert {w: set(h) for w, h in got} == want
        assert all(h == sorted(set(h)) for _, h in got)


def test_windows_that_do_not_occur_cost_nothing():
    rng = np.random.default_rng(2)
    words = rng.integers(0, 1 << 20, 1_000_009)
    block = D.Block([("far", " ".join(f"w{x}" for x in words.tolist()).encode()),
                     ("near", b"one two three four five six seven eight nine ten")], 10, 3)
    assert sum(len(w.rows) for w in block.windows) == 1_000_001
    terms = np.array(sorted({block.term[w] for w in b"one two three four five six seven eight nine ten"
                             .split()} | set(range(0, len(block.term), 1000))), np.int64)
    start = time.process_time()
    for _ in range(20):
        assert [h for _, h in block.possible(terms)] == [["near"]]
    assert time.process_time() - start < 4
