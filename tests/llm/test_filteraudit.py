import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import filteraudit as A

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int"


def failures(rows):
    out = []
    for doc_id, text, lang, *_ in rows:
        t = text or ""
        words = WORD.findall(t)
        capitals = len(re.findall("[A-Z]", t))
        copy = doc_id is not None and any(
            r[0] is not None and r[0] < doc_id and (r[1] or "") == t for r in rows)
        failed = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                  "C": 100 * capitals > 3 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": copy}
        out.append((doc_id, lang or "", {f for f, bad in failed.items() if bad}))
    return out


def plain_audit(rows, labels):
    good = {r[0] for r in labels if r[1] == 1 and r[0] is not None}
    toxic = {r[0] for r in labels if r[2] == 1 and r[0] is not None}
    out, docs = {}, failures(rows)
    for part in {d[1] for d in docs}:
        mine = [d for d in docs if d[1] == part]
        for order in map("".join, permutations("ABCDE")):
            for i, f in enumerate(order):
                gone = [d for d in mine if d[2] & set(order[:i])]
                here = [d for d in mine if f in d[2] and not d[2] & set(order[:i])]
                out[part, order, i + 1] = [
                    len(mine) - len(gone) - len(here), len(here),
                    sum(f in d[2] for d in gone), sum(d[2] == {f} for d in mine),
                    sum(d[0] in good for d in here), sum(d[0] in toxic for d in here)]
    removed = {}
    for (part, order, step), v in out.items():
        key = part, order[step - 1]
        removed[key] = removed.get(key, 0) + v[1]
    return sorted((*k, *v, removed[k[0], k[1][k[2] - 1]]) for k, v in out.items())


@pytest.fixture(scope="module")
def case(spark, rows):
    rng = np.random.default_rng(2)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ünï", "W1", "Ärger", "# x", "a|b", " ", " "]
    extra = [(1000 + i, " ".join(rng.choice(vocabulary, int(rng.integers(0, 500)))),
              [None, "", "de", "en"][i % 4], "s", 0) for i in range(40)]
    extra += [(2000 + i, extra[5][1], "de", "s", 0) for i in range(5)]
    extra += [(3000, "A\x0bB\x0cC\rD\nE\tF\x1cG\x85H", "en", "s", 0), (3001, "SAME " * 300, None, "s", 0),
              (3002, None, None, None, None)]
    rows = [*rows, *extra]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 1040, 3)]
    labels += [(3, 1, None), (None, 1, 1), (2001, 1, 1), (2001, 1, 1), (7777, 1, 1)]
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, "
                                        "n_chars long").repartition(6),
            spark.createDataFrame(labels, LABELS), rows, labels)


def result(docs, labels, **kw):
    return sorted(map(tuple, A.interactions(A.flagged(docs, **kw), labels).collect()))


def test_matches_plain_version(case):
    docs, labels, rows, plain_labels = case
    want = plain_audit(rows, plain_labels)
    assert result(docs, labels) == want
    assert result(docs, labels, shard_bytes=700, range_bytes=900) == want  # many of both


def test_odd_and_empty(odd_docs, rows, no_docs, spark):
    none = spark.createDataFrame([], LABELS)
    named = odd_docs.withColumns({c: F.lit(0) for c in ("copy_of", "id", "part", "failed", "words")})
    assert result(named, none) == plain_audit(rows, [])
    assert result(no_docs, none) == []


def test_matrix_holds_every_word(case):
    """CSR blocks and dictionary give back each document's words and counts."""
    docs, _, rows, _ = case
    shards = A.csr_shards(docs, {"id": F.col("doc_id")}, shard_bytes=5000)
    ranges = A.by_range(shards, range_bytes=800)
    numbers = A.numbered(ranges)
    assert numbers.select("part").distinct().count() > 5
    word_of = {r["column"]: bytes(r["word"]) for r in A.dictionary(ranges, numbers).collect()}
    assert sorted(word_of) == list(range(len(word_of)))
    assert len(set(word_of.values())) == len(word_of)
    got = []
    for s in A.document_term_matrix(shards, numbers).collect():
        for i, key in enumerate(s["doc_id"]):
            cells = slice(s["starts"][i], s["starts"][i + 1])
            got.append((key, sorted((word_of[c], n) for c, n in zip(s["columns"][cells],
                                                                    s["counts"][cells]))))
    want = []
    for doc_id, text, *_ in rows:
        words = [w.encode() for w in WORD.findall(text or "")]
        want.append((doc_id, sorted((w, words.count(w)) for w in set(words))))
    assert sorted(got, key=str) == sorted(want, key=str)


def test_long_texts_are_split_whole(monkeypatch):
    monkeypatch.setattr(A, "PIECE", 7)
    for text in (b"", b"  ", b"aaaaaaaaaaaaaaaaaaaa", b"a bb  ccc\tdddd eeeee ffffff\n ggggggggg h "):
        assert [w for words in A.words_in(text) for w in words] == text.split()
