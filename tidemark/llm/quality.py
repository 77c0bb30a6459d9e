"""Quality classifier: random-indexing word vectors, pooled per document, scored by a
two-layer network with temperature-calibrated probabilities.

* Vocabulary: tokens (words, numbers, runs of symbols) counted over all texts; those seen
  `MIN_COUNT` times and with a share of at least `MIN_SHARE` have entries of their own (so at
  most `1 / MIN_SHARE`), every other token stands for its shape (lower, Capitalised, ...).
* Random indexing: each entry has a fixed sparse index vector with entries +1 / -1 drawn from
  a hash of the token; its word vector is the sum of the index vectors of its neighbours in
  all texts, scaled to length one. Tasks add up whole numbers and send one packed block per 64
  entries; blocks are added in rounds of 64, so the result does not depend on the cut.
* A document is the mean of its tokens' word vectors, whole text, next to what a mean can't
  tell: the log of its token count, its share of distinct tokens, and of tokens that repeat
  the one before. A tanh layer and a logistic output score it; the logit is divided by a
  temperature fitted on rows that the network did not train on.

Only the network is fitted on a bounded sample of labelled rows: at most `PER_CLASS` rows of
each label, those with the smallest hashes of the id, of any length (their pooled vectors are
computed in Spark, no text reaches the driver); classes are weighted by their share among all
labelled rows outside the held-out part.

Edge cases: null and empty texts get the score of an empty document; without labelled
rows every score is 0.5; ids with contradicting labels are not learned from; repeated
rows get equal scores; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import filled, hash_share, held_out, smallest, stored, table

PER_CLASS = 2500
SPARE = 4  # times PER_CLASS ids are looked at
THRESHOLD = 0.7
MIN_COUNT = 5
MIN_SHARE = 5e-5  # of all tokens
DIMENSIONS = 64
NONZERO = 6
REACH = 2
HIDDEN = 24
EPOCHS = 80
DECAY = 1e-3
CACHED_LETTERS = 8 << 20  # of tokens without an entry, per worker
PIECE = 1 << 20  # characters of a text that are cut into tokens at a time
FLUSH = 1_000_000  # distinct tokens, or tokens, that a task adds up at a time
BLOCK = 64  # entries whose sums travel together, and blocks that are added at a time

_TOKEN = re.compile(r"\w+|[^\w\s]+")
_SPACE = re.compile(r"\s")
SHAPES = ["<lower>", "<UPPER>", "<Title>", "<MiXed>", "<digits>", "<alnum>", "<symbols>",
          *(f"<sym {c}>" for c in string.punctuation)]


def shape(token: str) -> str:
    """Stand-in of a rare token."""
    if token.isalpha():
        return ("<lower>" if token.islower() else "<UPPER>" if token.isupper() and len(token) > 1
                else "<Title>" if token[:1].isupper() and not token[1:].upper() == token[1:]
                else "<MiXed>")
    if token.isdigit():
        return "<digits>"
    if token[:1].isalnum() or token[:1] == "_":
        return "<alnum>"
    return f"<sym {token[0]}>" if token[0] in string.punctuation else "<symbols>"


def token_lists(text: str) -> Iterator[list[str]]:
    """The tokens of a text, some at a time; cut at spaces, which no token holds."""
    start = 0
    while len(text) - start > PIECE:
        gap = _SPACE.search(text, start + PIECE)
        end = gap.start() if gap else len(text)
        yield _TOKEN.findall(text, start, end)
        start = end
    yield _TOKEN.findall(text, start)


class _Entries(dict):
    """Token -> row of the vocabulary; unknown tokens go to their shape's row."""

    def __init__(self, vocabulary: dict[str, int]):
        super().__init__(vocabulary)
        self.vocabulary, self.cached = vocabulary, 0

    def __missing__(self, token: str) -> int:
        row = self.vocabulary[shape(token)]
        self.cached += len(token)
        if self.cached > CACHED_LETTERS:
            self.clear()
            self.update(self.vocabulary)
            self.cached = len(token)
        self[token] = row
        return row


# ------------------------------------------------------- corpus statistics
def token_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Stored (token, n) of all texts, of tokens seen `MIN_COUNT` times; the empty token has
    the number of all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            return pa.record_batch([pa.array(list(counts), pa.string()),
                                    pa.array(list(counts.values()), pa.int64())],
                                   names=["token", "n"])

        for batch in batches:
            for value in batch.column(0):
                for found in token_lists(value.as_py()):
                    counts.update(found)
                    counts[""] += len(found)
                if len(counts) > FLUSH:
                    yield flush()
                    counts.clear()
        yield flush()

    per_task = docs.select(filled(text).alias("t")).mapInArrow(run, "token string, n long")
    total = per_task.groupBy("token").agg(F.sum("n").alias("n"))
    return stored(total.filter((F.col("n") >= MIN_COUNT) | (F.col("token") == "")))


def vocabulary_of(counts: DataFrame) -> dict[str, int]:
    """Entry of each shape and of each token of a sufficient share; at most 1 / MIN_SHARE."""
    total = counts.filter(F.col("token") == "").agg(F.sum("n")).first()[0] or 0
    kept = counts.filter((F.col("token") != "") & (F.col("n") >= max(MIN_COUNT, MIN_SHARE * total)))
    names = SHAPES + sorted(r["token"] for r in kept.select("token").collect())
    return {t: i for i, t in enumerate(names)}


def index_entries(token: str, dimensions: int = DIMENSIONS, nonzero: int = NONZERO
                  ) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the token's fixed sparse index vector."""
    rng = np.random.default_rng(zlib.crc32(token.encode()))
    return rng.choice(dimensions, nonzero, replace=False), rng.choice([-1.0, 1.0], nonzero)


class NeighbourSums:
    """Sums of the index vectors of every entry's neighbours, of the texts added so far."""

    def __init__(self, vocabulary: dict[str, int]):
        self.row = _Entries(vocabulary).__getitem__
        pairs = [index_entries(t) for t in vocabulary]
        none = np.zeros((1, NONZERO))  # what stands between documents has no vector
        self.places = np.concatenate([[p for p, _ in pairs], none]).astype(np.int64)
        self.signs = np.concatenate([[s for _, s in pairs], none])
        self.gap = np.full(REACH, len(vocabulary))
        self.sums = np.zeros((len(vocabulary) + 1) * DIMENSIONS)
        self.waiting: list[np.ndarray] = []
        self.n = 0

    def add(self, text: str) -> None:
        for found in token_lists(text):
            self.waiting.append(np.fromiter(map(self.row, found), np.int64, len(found)))
            self.n += len(found)
        self.waiting.append(self.gap)
        if self.n > FLUSH:
            self.settle()

    def settle(self) -> None:
        ids = np.concatenate([*self.waiting, self.gap])
        for d in range(1, REACH + 1):
            here, there = (np.concatenate(x) for x in ((ids[:-d], ids[d:]), (ids[d:], ids[:-d])))
            for k in range(NONZERO):
                self.sums += np.bincount(here * DIMENSIONS + self.places[there, k],
                                         self.signs[there, k], len(self.sums))
        self.waiting, self.n = [], 0

    def result(self) -> np.ndarray:
        self.settle()
        return self.sums.reshape(-1, DIMENSIONS)[:-1].astype(np.int64)


def _blob(sums: np.ndarray) -> bytes:
    return zstandard.compress(sums.tobytes(), 1)


def _sums(blob: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(blob), np.int64).reshape(-1, DIMENSIONS)


def neighbour_sums(docs: DataFrame, shared, text: str = "text") -> DataFrame:
    """Stored (block, sums): one row per block of entries, over all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = NeighbourSums(shared.value)
        for batch in batches:
            for value in batch.column(0):
                own.add(value.as_py())
        sums = own.result()
        blocks = [(i // BLOCK, sums[i:i + BLOCK]) for i in range(0, len(sums), BLOCK)]
        blocks = [(i, _blob(b)) for i, b in blocks if b.any()]
        yield pa.record_batch([
            pa.array([TaskContext.get().partitionId()] * len(blocks), pa.int64()),
            pa.array([i for i, _ in blocks], pa.int64()),
            pa.array([b for _, b in blocks], pa.binary())], names=["part", "block", "sums"])

    def added(rows: pa.Table) -> pa.Table:
        sums = sum(_sums(b.as_py()) for b in rows.column("sums"))
        return pa.table({"part": rows.column("part").slice(0, 1),
                         "block": rows.column("block").slice(0, 1),
                         "sums": pa.array([_blob(sums)], pa.binary())})

    out = stored(docs.select(filled(text).alias("t")).mapInArrow(
        run, "part long, block long, sums binary"))
    most = out.agg(F.max("part")).first()[0] or 0
    while most > 0:  # every group has at most BLOCK rows
        out = stored(out.withColumn("part", F.floor(F.col("part") / BLOCK).cast("long"))
                     .groupBy("part", "block").applyInArrow(
            added, "part long, block long, sums binary"))
        most //= BLOCK
    return out.select("block", "sums")


def word_vectors(docs: DataFrame, text: str = "text") -> tuple[dict[str, int], np.ndarray]:
    """Vocabulary and random-indexing vectors of all texts."""
    vocabulary = vocabulary_of(token_counts(docs, text))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    vectors = np.zeros((len(vocabulary), DIMENSIONS))
    for r in neighbour_sums(docs, shared, text).collect():  # bounded by the vocabulary
        vectors[r["block"] * BLOCK:(r["block"] + 1) * BLOCK] = _sums(r["sums"])
    for i, token in enumerate(vocabulary):
        places, signs = index_entries(token)
        vectors[i, places] += signs  # a token seen without neighbours keeps its own direction
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return vocabulary, vectors.astype(np.float32)


# -------------------------------------------------------------------- model
@dataclass
class Model:
    vocabulary: dict[str, int]
    vectors: np.ndarray  # word vectors, one row per entry
    centre: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, ...]  # w1, b1, w2, b2
    temperature: float

    def entries(self) -> _Entries:
        if not hasattr(self, "_entries"):
            self._entries = _Entries(self.vocabulary)
        return self._entries

    def pooled(self, texts) -> np.ndarray:
        """Mean word vector, log token count, distinct and repeating shares of each text."""
        row = self.entries().__getitem__
        out = np.zeros((len(texts), self.vectors.shape[1] + 3), np.float64)
        for i, text in enumerate(texts):
            n, repeats, last, distinct = 0, 0, None, set()
            for found in token_lists(text):
                if not found:
                    continue
                ids = np.fromiter(map(row, found), np.int64, len(found))
                if len(ids) < len(self.vectors):
                    out[i, :-3] += self.vectors[ids].sum(axis=0)
                else:
                    out[i, :-3] += np.bincount(ids, minlength=len(self.vectors)) @ self.vectors
                n += len(found)
                repeats += (found[0] == last) + sum(map(eq, found, islice(found, 1, None)))
                last = found[-1]
                distinct.update(found)
            if n:
                out[i, :-3] /= n
                out[i, -3:] = np.log1p(n), len(distinct) / n, repeats / n
        return out

    def logits(self, features: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((features - self.centre) / self.scale @ w1 + b1) @ w2 + b2

    def score(self, texts) -> np.ndarray:
        z = self.logits(self.pooled(texts)) / self.temperature
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def _temperature(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The temperature of least weighted log loss on rows kept out of the training."""
    grid = np.exp(np.linspace(0.0, np.log(10.0), 81))  # never sharper than trained
    loss = [np.sum(weight * np.logaddexp(0, np.where(y == 1, -z, z) / t)) for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(model: Model, x: np.ndarray, y: np.ndarray, shares: tuple[float, float], seed: int = 7
        ) -> Model:
    """Train the network on pooled vectors; `shares` are the class shares (0, 1) that the
    weights restore."""
    model.centre, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    n1 = max(1.0, y.sum())
    n0 = max(1.0, len(y) - y.sum())
    weight = np.where(y == 1, shares[1] / n1, shares[0] / n0)
    weight /= weight.mean()

    rng = np.random.default_rng(seed)
    apart = rng.random(len(y)) < 0.2  # for the temperature
    if apart.all() or not apart.any():
        apart[:] = False
    train = np.flatnonzero(~apart)
    xs = (x - model.centre) / model.scale
    d = x.shape[1]
    params = [rng.normal(0, 1 / np.sqrt(d), (d, HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(())]
    first, second, step = [0.0] * 4, [0.0] * 4, 0
    for _ in range(EPOCHS):
        rng.shuffle(train)
        for batch in np.array_split(train, max(1, len(train) // 128)):
            a, t, w = xs[batch], y[batch], weight[batch]
            hidden = np.tanh(a @ params[0] + params[1])
            p = 1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3], -40, 40)))
            g = w * (p - t) / len(batch)
            back = g[:, None] * params[2] * (1 - hidden ** 2)
            grads = [a.T @ back + DECAY * params[0], back.sum(axis=0),
                     hidden.T @ g + DECAY * params[2], g.sum()]
            step += 1
            for i, grad in enumerate(grads):  # Adam
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad ** 2
                params[i] = params[i] - 0.004 * (first[i] / (1 - 0.9 ** step)) / (
                    np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
    model.layers = tuple(params)
    if apart.any():
        model.temperature = _temperature(model.logits(x[apart]), y[apart], weight[apart])
    return model


def training_sample(labels: DataFrame, doc_id: str = "doc_id", label: str = "quality",
                    per_class: int = PER_CLASS) -> tuple[DataFrame, tuple[float, float]]:
    """(id, y) of the bounded sample, and the shares of the classes 0 and 1."""
    clear = (labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y"))
             .filter(F.col("y").isin(0, 1) & F.col("id").isNotNull() & ~held_out("id"))
             .groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("top"))
             .filter(F.col("y") == F.col("top")).select("id", "y"))
    totals = {r["y"]: r["count"] for r in clear.groupBy("y").count().collect()}
    # at most per_class ids of each class: small enough to broadcast; of a frequent class only
    # ids with a small hash are ranked, several times enough
    limit = F.lit(1.0)
    for y, n in totals.items():
        limit = F.when(F.col("y") == y, F.lit(min(1.0, SPARE * per_class / n))).otherwise(limit)
    few = clear.filter(hash_share("id") < limit).withColumn("hash", F.xxhash64("id"))
    chosen = smallest(few, per_class, ["y"], ["hash", "id"]).drop("hash")
    n = max(1, sum(totals.values()))
    return chosen, (totals.get(0, 0) / n, totals.get(1, 0) / n)


def sample_features(docs: DataFrame, chosen: DataFrame, shared, doc_id: str = "doc_id",
                    text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Pooled vectors and labels of the sample's whole texts, in the order of the ids."""
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(list(shared.value.pooled(texts.to_list())))

    rows = (docs.select(F.col(doc_id).alias("id"), filled(text).alias("text"))
            .join(F.broadcast(chosen), "id").groupBy("id", "y").agg(F.min("text").alias("text"))
            .select("id", "y", F.pandas_udf(run, "array<double>")("text").alias("x"))
            .orderBy("id").collect())
    return np.array([r["x"] for r in rows]), np.array([r["y"] for r in rows], np.float64)


def score(text: Column, shared) -> Column:
    """Probability that a text is of quality 1 (`shared`: a broadcast model, or None)."""
    if shared is None:
        return F.lit(0.5)

    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(texts.to_list()))
    return F.pandas_udf(run, "double")(filled(text))


def fitted(spark: SparkSession, docs: DataFrame, labels: DataFrame):
    """A broadcast model (vocabulary and weights are bounded), or None without labels."""
    chosen, shares = training_sample(labels)
    chosen = stored(chosen)
    if docs.join(F.broadcast(chosen), docs["doc_id"] == chosen["id"], "left_semi").isEmpty():
        return None
    model = Model(*word_vectors(docs), np.zeros(1), np.ones(1), (), 1.0)
    context = spark.sparkContext
    x, y = sample_features(docs, chosen, context.broadcast(model))
    return context.broadcast(fit(model, x, y, shares))


def accepted(docs: DataFrame, labels: DataFrame, text: str = "text",
             threshold: float = THRESHOLD) -> DataFrame:
    """`docs` without those scored below the threshold (all, if nothing could be learned)."""
    model = fitted(docs.sparkSession, docs, labels)
    if model is None:
        return docs
    return docs.filter(score(F.col(text), model) >= threshold)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text of `documents`."""
    docs = table(spark, sf_dir, "documents")
    model = fitted(spark, docs, table(spark, sf_dir, "labels"))
    return (docs.select("doc_id", held_out("doc_id").alias("held_out"),
                        score(F.col("text"), model).alias("score"))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


QUERIES = {"op10_quality": op10_quality}
ORACLE_SQL: dict[str, str] = {}
