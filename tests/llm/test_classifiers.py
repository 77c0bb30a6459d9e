"""Quality classifier and language identification: held-out accuracy and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language, quality
from tidemark.llm.common import held_out, smallest, table

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def corpus(spark):
    return table(spark, SF, "documents")


def test_held_out_part(spark):
    import zlib
    df = spark.createDataFrame([(i,) for i in [*range(200), None]], "i long")
    for r in df.select("i", held_out("i").alias("h")).collect():
        assert r["h"] == (r["i"] is not None and zlib.crc32(str(r["i"]).encode()) % 4 == 2)


def test_quality_on_held_out_rows(spark):
    scored = quality.op10_quality(spark, SF)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = table(spark, SF, "labels")
    rows = scored.join(labels, "doc_id").filter("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in rows) / len(rows)
    poor = [r for r in rows if r["quality"] == 0]
    caught = sum(r["predicted"] == 0 for r in poor) / len(poor)
    assert right > 0.95 and caught > 0.85
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_on_held_out_rows(spark, corpus):
    judged = language.op8_language_id(spark, SF)
    rows = judged.join(corpus.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.97


def test_edge_texts(spark, docs, rows, no_docs, corpus):
    texts = spark.createDataFrame([(None,), ("",), (" 12 !",), ("the",), ("x " * 200_000,)],
                                  "text string")
    shared = spark.sparkContext.broadcast(language.learn(corpus.limit(300)))
    got = [r[0] for r in texts.select(language.judged(F.col("text"), shared)).collect()]
    assert [g["lang_pred"] for g in got[:3]] == ["und"] * 3
    assert all(g["lang_pred"] in {"en", "de", "fr", "es"} for g in got[3:])
    assert all(0 <= g["score"] <= 1 for g in got)
    nothing = spark.sparkContext.broadcast(language.learn(no_docs))
    assert {r[0]["lang_pred"] for r in
            docs.select(language.judged(F.col("text"), nothing)).collect()} == {"und"}

    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (0, None, 0), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    assert quality.fitted(spark, docs, labels) is None  # contradicting or no labels
    assert quality.accepted(docs, labels).count() == len(rows)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(40)],
                                   "doc_id long, quality int, toxic int")
    model = quality.fitted(spark, docs, labels)
    scores = [r[0] for r in texts.select(quality.score(F.col("text"), model)).collect()]
    assert len(scores) == 5 and all(0 <= s <= 1 for s in scores) and scores[0] == scores[1]
    assert no_docs.select(quality.score(F.col("text"), model)).count() == 0


def test_rows_of_the_held_out_part_teach_nothing(spark, docs):
    from pyspark.sql import functions as F
    labels = docs.select("doc_id").distinct().filter("doc_id is not null").select(
        "doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    flipped = labels.withColumn("quality", F.when(held_out("doc_id"), 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    (a, shares), (b, flipped_shares) = map(quality.training_sample, (labels, flipped))
    assert sorted(a.collect()) == sorted(b.collect()) and shares == flipped_shares
    changed = docs.withColumn("lang", F.when(held_out("doc_id"), "zz").otherwise(F.col("lang")))
    assert language.learn(docs).samples == language.learn(changed).samples


def test_smallest_of_each_group(spark):
    rows = [(g, h) for g in ("a", "b", None) for h in range(50) for _ in range(2)]
    df = spark.createDataFrame(rows, "g string, h int").repartition(5)
    got = sorted(map(tuple, smallest(df, 7, ["g"], ["h"]).collect()), key=str)
    assert got == sorted([r for g in ("a", "b", None) for r in
                          sorted((x for x in rows if x[0] == g), key=lambda x: x[1])[:7]], key=str)


def test_languages_of_long_texts_are_learned(spark):
    """Every learnable row may enter, however long; none fills the dictionary alone."""
    long = "\n".join(f"kala{i % 97} vesi lumi talvi metsä" for i in range(2_000))
    rows = ([(i, long, "fi") for i in range(40)]
            + [(100 + i, f"short words about number {i} the", "en") for i in range(40)]
            + [(1000 + i, "123" if i % 20 else "kort tekst på dansk", "da") for i in range(1000)])
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language.learn(df)
    samples = dict(model.samples)
    assert set(samples) == {"fi", "en", "da"}
    taught = df.filter(~held_out("doc_id")).groupBy("lang").count()
    n = {r["lang"]: r["count"] for r in taught.collect()}
    assert len(samples["fi"].split(b"\n")) == n["fi"]  # a piece of each
    letters = df.filter(~held_out("doc_id") & (F.col("lang") == "da") & (F.col("text") != "123"))
    assert len(samples["da"].split(b"\n")) == letters.count()
    assert all(len(s) <= language.DICTIONARY_BYTES for s in samples.values())
    assert model.judge("talvi ja lumi metsä vesi kala vesi talvi")[0] == "fi"


def test_shared_out():
    assert language.shared_out([b"a" * 50, b"b" * 3, b"c" * 40], 33) == [b"a" * 14, b"b" * 3, b"c" * 13]
    assert language.shared_out([], 9) == []


def plain_vectors(texts):
    """Vocabulary and neighbour sums, token by token."""
    tokens = [quality._TOKEN.findall(t or "") for t in texts]
    counts = {}
    for t in [t for ts in tokens for t in ts]:
        counts[t] = counts.get(t, 0) + 1
    least = max(quality.MIN_COUNT, quality.MIN_SHARE * sum(counts.values()))
    names = quality.SHAPES + sorted(t for t, n in counts.items() if n >= least)
    row = {t: i for i, t in enumerate(names)}
    index = np.zeros((len(names), quality.DIMENSIONS))
    for i, t in enumerate(names):
        places, signs = quality.index_entries(t)
        index[i, places] = signs
    sums = index.copy()
    for ts in tokens:
        ids = [row[t] if t in row else row[quality.shape(t)] for t in ts]
        for i, a in enumerate(ids):
            for j in range(max(0, i - quality.REACH), min(len(ids), i + quality.REACH + 1)):
                if i != j:
                    sums[a] += index[ids[j]]
    return row, sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)


def test_word_vectors_are_those_of_all_texts(spark, docs, rows, no_docs, monkeypatch):
    row, vectors = plain_vectors([r[1] for r in rows])
    for block in (64, 2):  # of 2: several rounds of adding
        monkeypatch.setattr(quality, "BLOCK", block)
        got_row, got = quality.word_vectors(docs)
        assert got_row == row and np.allclose(got, vectors, atol=1e-5)
    assert quality.word_vectors(no_docs)[0] == {s: i for i, s in enumerate(quality.SHAPES)}


def test_words_outside_the_sample_have_vectors(spark):
    """Statistics cover the corpus: half of its words occur in no labelled text."""
    texts = [("alpha beta gamma delta " if i % 2 else "zulu yankee xray whisky ") * 20
             for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 30), 0) for i in range(1, 60, 2)],
                                   "doc_id long, quality int, toxic int")
    model = quality.fitted(spark, docs, labels).value
    assert {"alpha", "zulu", "yankee", "xray", "whisky"} <= set(model.vocabulary)


def test_long_texts_are_read_whole(monkeypatch):
    text = "ab cd !! ab  ab " * 50 + "x" * 40
    model = quality.Model({s: i for i, s in enumerate(quality.SHAPES)},
                          np.eye(len(quality.SHAPES), 64, dtype=np.float32), np.zeros(1),
                          np.ones(1), (), 1.0)
    whole = model.pooled([text, "", " "])
    monkeypatch.setattr(quality, "PIECE", 13)
    assert [t for ts in quality.token_lists(text) for t in ts] == quality._TOKEN.findall(text)
    assert np.allclose(model.pooled([text, "", " "]), whole)
