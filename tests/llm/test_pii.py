import random

import numpy as np
import pytest
from .plain import personal, sha
from pyspark.sql import functions as F

from tidemark.llm import pii
from tidemark.llm.tagger import ALPHABET, Tagger, char_ids

PIECES = ["a", "b.c", "@", "x.yz", ".", "1", "23", "255", "256", "007", " ", "-", "+", "(", ")",
          "4539578763621486", "4539 5787 6362 1486", "+1 (377) 555-0271", "10.0.0.1", "é", "\n",
          "me@mail.example.com", "1.2.3.4.5", "@@", "%"]


def test_base_spans_match_the_patterns():
    rng = random.Random(8)
    for _ in range(4000):
        text = "".join(rng.choices(PIECES, k=rng.randint(0, 14)))
        assert pii._listed(pii.base_spans(text)) == ",".join(personal(text)) or sorted(
            pii._listed(pii.base_spans(text)).split(",")) == sorted(personal(text)), text
    assert pii.base_spans("1" * 50_000 + "." + "a" * 50_000) == []


def test_gradients():
    rng = np.random.default_rng(0)
    t = Tagger(5)
    ids = rng.integers(1, ALPHABET, (3, 7)).astype(np.int16)
    ids[1, 4:] = 0
    tags = rng.integers(0, 5, (3, 7)) * (ids > 0)
    _, g = t.gradients(ids, tags)
    for name, v in t.p.items():
        flat = v.reshape(-1)
        where = rng.choice(flat.size, min(6, flat.size), replace=False)
        if name == "embed":
            where = [int(ids[0, 0]) * v.shape[1], int(ids[2, 3]) * v.shape[1] + 1]
        for j in where:
            old = flat[j]
            flat[j] = old + 1e-5
            up = t.gradients(ids, tags)[0]
            flat[j] = old - 1e-5
            down = t.gradients(ids, tags)[0]
            flat[j] = old
            assert abs((up - down) / 2e-5 - g[name].reshape(-1)[j]) < 1e-6, name


def test_windows_hold_every_signal():
    rng = random.Random(1)
    for n in (0, 1, 39, 40, 79, 80, 81, 119, 120, 121, 400):
        text = "".join(rng.choices("abc 1@", weights=[9, 9, 9, 9, 1, 1], k=n))
        starts = pii.windows_of(text)
        all_ = list(range(0, max(1, n - pii.WINDOW + pii.STRIDE), pii.STRIDE))
        want = [s for s in all_ if any(c in "1@" for c in text[s:s + pii.WINDOW])]
        assert starts == want


def test_reconciled_takes_the_best_disjoint_set():
    found = {(0, 0, 10): 0.9, (1, 8, 20): 1.0, (2, 18, 30): 0.9, (3, 40, 50): 0.8, (0, 45, 47): 0.7}
    assert sorted(pii.reconciled(found, [])) == [(0, 0, 10), (2, 18, 30), (3, 40, 50)]
    assert sorted(pii.reconciled(found, [(2, 29, 41)])) == [(0, 45, 47), (1, 8, 20)]


@pytest.fixture(scope="module")
def shared(spark):
    return pii.shared_tagger(spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
                             .filter("doc_id < 5000"))


def test_tagger_learns_the_spans(spark, shared):
    """On rows whose spans it is told nothing of, the tagger finds most of them again."""
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter(
        "doc_id >= 5000 and text rlike '[0-9@]'").select("text").collect()
    hit = total = wrong = 0
    for r in rows:
        base = pii.base_spans(r["text"])
        alone = pii.added_spans([r["text"]], [[]], shared.value)[0]
        hit += len(set(alone) & set(base))
        wrong += len(set(alone) - set(base))
        total += len(base)
    assert total > 100 and hit > 0.8 * total and wrong < 0.1 * total, (hit, wrong, total)


def test_added_spans_of_held_out_variants(spark, shared):
    """Variants of spans of documents that the tagger was not trained on: what it adds to the
    base spans is right, and it adds next to nothing to the documents as they are."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("doc_id >= 5000")
    rng = random.Random(99)
    texts, want = [], []
    for r in pii.labelled_windows(docs).filter("kind <> 'none'").distinct().collect():
        made = pii.variant_of(r["window"], np.frombuffer(r["tags"], np.uint8), rng)
        if made:
            before = "on the nation " * rng.randrange(8)
            texts.append(before + made[0] + " ing er the")
            kind, a, b = made[2]
            want.append((kind, a + len(before), b + len(before)))
    base = [pii.base_spans(t) for t in texts]
    got = pii.added_spans(texts, base, shared.value)
    def same(w, g):  # of the kind, and all but a few characters of it
        return w[0] == g[0] and min(w[2], g[2]) - max(w[1], g[1]) > 0.7 * (max(w[2], g[2]) - min(w[1], g[1]))

    right = sum(any(same(w, x) for x in g) for w, g in zip(want, got))
    exact = sum(w in g for w, g in zip(want, got))
    added = sum(map(len, got))
    assert len(texts) > 300
    assert right / len(texts) >= 0.9 and right / added >= 0.95, (right, added, len(texts))
    assert exact / len(texts) >= 0.85, (exact, len(texts))
    rows = [r["text"] for r in docs.select("text").collect()]
    base = [pii.base_spans(t) for t in rows]
    extra = sum(map(len, pii.added_spans(rows, base, shared.value)))
    assert extra <= 0.03 * sum(map(len, base)), extra


def test_what_the_patterns_do_not_cover(shared):
    for text, kind in (("or jane.doe [at] example [dot] org if you like", "email"),
                       ("the host is １０.２０.３.４ in the rack", "ip"),
                       ("call +٣٣ (٣٧٧) ٥٥٥-٠٢٧١ now", "phone")):
        assert not pii.base_spans(text)
        found = pii.added_spans([text], [[]], shared.value)[0]
        assert [pii.KINDS[k] for k, _, _ in found] == [kind], (text, found)


def test_variants_keep_their_labels():
    rng = random.Random(4)
    text = "you can write me@mail.example.com or call +1 (377) 555-0271 or 10.0.0.1 at noon"
    tags = pii.tags_of(pii.base_spans(text), 0, len(text))
    seen = set()
    for _ in range(300):
        made = pii.variant_of(text, tags, rng)
        if made:
            window, marked, (kind, a, b) = made
            assert len(window) == len(marked) <= pii.WINDOW
            assert marked[a] == 1 + 2 * kind and (marked[a + 1:b] == 2 + 2 * kind).all()
            assert not any(x < b and y > a for _, x, y in pii.base_spans(window))
            seen.add(kind)
    assert seen == {0, 1, 3}
    plain, marked, span = pii.variant_of("nothing here", np.zeros(12, np.int64), rng)
    assert span is None and not marked.any() and len(plain) == len(marked)


def test_report_and_redaction(docs, rows, no_docs, shared):
    found = docs.select("text", pii.report(F.col("text"), shared).alias("r"),
                        pii.redacted(F.col("text"), shared).alias("masked")).collect()
    assert len(found) == len(rows)
    for r in found:
        want = personal(r["text"])
        assert r["r"]["base_sha256"] == sha(",".join(want))
        assert set(want) <= set(filter(None, r["r"]["spans"].split(",")))
        assert (r["masked"] is None) == (r["text"] is None)
        assert not personal(r["masked"])
    assert any("<phone>" in (r["masked"] or "") and "<email>" in r["masked"] for r in found)
    assert no_docs.select(pii.report(F.col("text"), shared)).count() == 0
    assert pii.fit(no_docs) is None


def test_char_ids_are_within_the_alphabet():
    ids = char_ids(" ~aé٣　\x00😀")
    assert ids.min() > 0 and ids.max() < ALPHABET


class ZTagger:
    """Finds runs of `z`, `y` (of another kind) and `@`, as far as it sees them."""

    def decode(self, ids):
        tags = np.zeros(ids.shape, int)
        for row, out in zip(ids, tags):
            for j, c in enumerate(row):
                if c in (char_ids("z")[0], char_ids("@")[0]):
                    out[j] = 2 if j and out[j - 1] in (1, 2) else 1
                elif c == char_ids("y")[0]:
                    out[j] = 4 if j and out[j - 1] in (3, 4) else 3
        return tags, np.full(ids.shape, 0.99)


def test_long_spans_are_found_at_every_offset():
    for n in (1, 39, 40, 45, 60, 78, 79, 80, 81, 119, 120, 121, 160, 200):
        body = "z" * (n // 3) + "@" + "z" * (n - n // 3 - 1)
        texts = ["x" * a + body + "x" * tail for a in range(0, 121) for tail in (0, 90)]
        got = pii.added_spans(texts, [[]] * len(texts), ZTagger())
        for text, spans in zip(texts, got):
            a = len(text) - len(text.lstrip("x"))
            assert spans == [(0, a, a + n)], (n, a)
    two = "x" * 30 + "z" * 60 + "@" + "y" * 70 + "1" + "x" * 50
    assert pii.added_spans([two], [[]], ZTagger()) == [[(0, 30, 91)]]
