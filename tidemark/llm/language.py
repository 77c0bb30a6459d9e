"""Language identification by compression.

For each language a raw-content zstandard dictionary holds sample text of it. A text is
encoded once with every dictionary; the language whose dictionary makes it smallest wins.
A win by a narrow margin is rejected: the language is still named, `rejected` is true.
What is encoded, of texts and dictionaries alike, is the whole text's words in lower case,
a word that follows itself once: symbols, digits and repetitions tell no language.

The dictionaries are learned from a bounded sample: per language the `PER_LANGUAGE`
labelled rows with a letter and the smallest id hashes outside the held-out part, whatever
their length. Of each text the first `MAX_FIT_CHARS` characters from its first letter on are
taken, at most an equal share of `DICTIONARY_BYTES`, so that no long text fills the
dictionary alone; what short texts leave free goes to the others.

Edge cases: a null text, or one without a letter, is `und` with score 0; so is every text
if nothing could be learned. Ties go to the language with more labelled rows, then by
name. Very long texts are encoded whole. Repeated rows get equal results.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import hash_share, held_out, smallest, table

PER_LANGUAGE = 80
SPARE = 10  # times PER_LANGUAGE rows are looked at
MAX_FIT_CHARS = 5_000
DICTIONARY_BYTES = 96 << 10
LEVEL = 6
NARROW = 0.01  # margin, as a share of the second smallest size, below which to reject
SHARPNESS = 0.25  # weight of one byte in the score
UNDETERMINED = "und"
_WORD = re.compile(r"[^\W\d_]+")


def words_only(text: str) -> bytes:
    words = _WORD.findall(text.lower())
    return " ".join([w for w, before in zip(words, [None, *words]) if w != before]).encode()


@dataclass(frozen=True)
class Dictionaries:
    """Sample text by language, most frequent language first."""

    samples: tuple[tuple[str, bytes], ...]

    def compressors(self):
        import zstandard as z
        if not hasattr(self, "_made"):
            made = []
            for name, sample in self.samples:
                d = z.ZstdCompressionDict(sample, dict_type=z.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=LEVEL)
                made.append((name, z.ZstdCompressor(
                    level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False,
                    write_dict_id=False)))
            object.__setattr__(self, "_made", made)
        return self._made

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        if text is None or not self.samples or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, True
        raw = words_only(text)
        sizes = [len(c.compress(raw)) for _, c in self.compressors()]
        best = min(sizes)
        at = sizes.index(best)
        rest = sizes[:at] + sizes[at + 1:]
        margin = (min(rest) - best) / min(rest) if rest else 1.0
        score = 1.0 / sum(math.exp(-SHARPNESS * min(s - best, 400)) for s in sizes)
        return self.samples[at][0], score, margin < NARROW


def shared_out(texts: list[bytes], limit: int) -> list[bytes]:
    """The texts cut so that they and a line end after each have at most `limit` bytes: as much
    of each as of any other, unless it is shorter."""
    left, cut = limit, {}
    for k, i in enumerate(sorted(range(len(texts)), key=lambda i: len(texts[i]))):
        cut[i] = texts[i][:max(0, left // (len(texts) - k) - 1)]
        left -= len(cut[i]) + 1
    return [cut[i] for i in range(len(texts))]


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang"
          ) -> Dictionaries:
    """Dictionaries from the labelled rows outside the held-out part."""
    rows = (docs.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"),
                        F.col(text).alias("text"))
            .filter(F.col("lang").isNotNull() & ~held_out("id")))
    totals = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not totals:
        return Dictionaries(())
    # of a frequent language only ids with a small hash are ranked, several times enough
    limit = F.create_map(*[x for lang_, n in totals.items()
                           for x in (F.lit(lang_), F.lit(min(1.0, SPARE * PER_LANGUAGE / n)))])
    # only the part that is learned from moves, from the first letter on
    part = F.regexp_extract("text", rf"(?s)\p{{L}}.{{0,{MAX_FIT_CHARS - 1}}}", 0)
    learnable = rows.withColumn("text", part).filter(F.length("text") > 0)
    order = ["hash", "id", "text"]

    def best(df: DataFrame) -> list:
        return (smallest(df.withColumn("hash", F.xxhash64("id")), PER_LANGUAGE, ["lang"], order)
                .orderBy("lang", *order).collect())
    picked = best(learnable.filter(hash_share("id") < limit[F.col("lang")]))
    found = Counter(r["lang"] for r in picked)
    # rows without a letter may leave too few: such a language is ranked without thinning
    short = [x for x, n in totals.items() if found[x] < min(PER_LANGUAGE, n)
             and SPARE * PER_LANGUAGE < n]
    if short:
        picked = ([r for r in picked if r["lang"] not in short]
                  + best(learnable.filter(F.col("lang").isin(short))))
    samples = []
    for name in sorted(totals, key=lambda x: (-totals[x], x)):
        texts = [r["text"] for r in picked if r["lang"] == name]
        sample = b"\n".join(shared_out([*map(words_only, texts)], DICTIONARY_BYTES))
        if sample:
            samples.append((name, sample))
    return Dictionaries(tuple(samples))


def judged(text: Column, shared) -> Column:
    """struct<lang_pred, score, rejected> of each whole text."""
    def run(texts: pd.Series) -> pd.DataFrame:
        judge = shared.value.judge
        return pd.DataFrame([judge(t) for t in texts], columns=["lang_pred", "score", "rejected"])
    return F.pandas_udf(run, "lang_pred string, score double, rejected boolean")(
        text.cast("string"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text of `documents`."""
    docs = table(spark, sf_dir, "documents")
    shared = spark.sparkContext.broadcast(learn(docs))
    return (docs.select("doc_id", held_out("doc_id").alias("held_out"),
                        judged(F.col("text"), shared).alias("j"))
            .select("doc_id", "held_out", "j.*"))


QUERIES = {"op8_language_id": op8_language_id}
ORACLE_SQL: dict[str, str] = {}
