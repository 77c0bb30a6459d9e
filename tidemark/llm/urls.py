"""URL filter: rules first, then words.

Rules name a host and the start of a path; a rule fits its host and all subdomains, the
longest fitting rule decides. Where none fits, the host's labels are split into words by
a unigram Viterbi segmentation ("cheappills" -> "cheap", "pills"), and a multinomial
naive Bayes over the words of host and path decides.

* Unigrams: counts of the words of all pages' texts (without markup, scripts and styles), in
  any script and of any length; a word counts for its form without accents, too, as hosts are
  written so. Words of a share of at least `MIN_WORD_SHARE` are kept, so the lexicon has at
  most `2 / MIN_WORD_SHARE` entries.
* Naive Bayes: the words of host and path, and the place they lead to as one token (`com de
  <number 4>`), of all pages that a rule decides, labelled by the rule; each of `SEEDS` is a
  pseudo-count of the class block. Tokens of a share of at least `MIN_TOKEN_SHARE` are kept,
  bounded likewise; the others share the unseen token's mass.

Edge cases: a null url or one without `://` has an empty host and path, no rule, and the
verdict of the class priors; null html counts as no words; repeated pages are judged one
by one; without any rule-decided page the priors are even.
"""

from __future__ import annotations

import html as markup
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import filled, stored, table

ALLOW, BLOCK = "allow", "block"

# The rules (host and path start, verdict), and words that mark unwanted hosts.
RULES = {
    "org/": ALLOW,
    "example.org/es/": BLOCK,
    "example.org/en/1": BLOCK,
    "com/fr/": ALLOW,
    "com/de/": BLOCK,
}
SEEDS = ("adult", "bet", "bonus", "casino", "cheap", "click", "farm", "free", "gamble", "loan",
         "lottery", "pharmacy", "pills", "poker", "porn", "spam", "viagra", "winner", "xxx")

SEED_SHARE = 0.01  # pseudo-count of each seed, as a share of the block class's tokens
MIN_WORD_SHARE = 2e-6
MIN_TOKEN_SHARE = 1e-5
CACHED_LETTERS = 4 << 20  # of split labels, per worker
_WORD = re.compile(r"[^\W\d_]+|\d+")
_LETTERS = re.compile(r"[^\W\d_]+")
_HIDDEN = re.compile(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>|<[^>]*>", re.DOTALL | re.IGNORECASE)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str | Column) -> Column:
    """From after the first `://` up to `/`, `?`, `#` or the end; A-Z lower-cased."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: str | Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: str | Column) -> Column:
    u = filled(url)
    at = F.instr(u, "://")
    return F.when(at > 0, u.substr(at + 3, F.length(u))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):  # the last `when` wins
        name, start = rule.split("/", 1)
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + start)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def rule_verdict(rule: Column, rules: dict[str, str] = RULES) -> Column:
    out = F.lit(None).cast("string")
    for name, verdict in rules.items():
        out = F.when(rule == name, F.lit(verdict)).otherwise(out)
    return out


# ------------------------------------------------------------ segmentation
class Segmenter:
    """Most likely split of a label into words, by dynamic programming over unigrams.

    Known words are tried at every length the lexicon has; an unknown word's cost grows with
    its letters alone, so the best one that ends at a letter follows from a running minimum,
    whatever its length.
    """

    LETTER = math.log(10)  # what an unknown word costs with every letter

    def __init__(self, counts: dict[str, int], total: int):
        self.total = max(total, 1)
        self.cost = {w: -math.log(n / self.total) for w, n in counts.items()}
        self.lengths = sorted({len(w) for w in counts})
        self.cache: dict[str, list[str]] = {}
        self.cached = 0

    def unseen(self, length: int) -> float:
        return math.log(self.total) + length * self.LETTER

    def split(self, label: str) -> list[str]:
        if label in self.cache:
            return self.cache[label]
        best, back = [0.0], [0]
        low, at = 0.0, 0  # the cheapest start of an unknown word, its letters before it taken off
        for end in range(1, len(label) + 1):
            cost, start = low + end * self.LETTER + math.log(self.total), at
            for n in self.lengths:
                if n > end:
                    break
                known = self.cost.get(label[end - n:end])
                if known is not None and best[end - n] + known <= cost:
                    cost, start = best[end - n] + known, end - n
            best.append(cost)
            back.append(start)
            if cost - end * self.LETTER < low:
                low, at = cost - end * self.LETTER, end
        words, end = [], len(label)
        while end:
            words.append(label[back[end]:end])
            end = back[end]
        self.cached += len(label)
        if self.cached > CACHED_LETTERS:
            self.cache.clear()
            self.cached = len(label)
        self.cache[label] = words[::-1]
        return self.cache[label]


def plain(word: str) -> str:
    """The word without accents."""
    return "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))


def shown(page: str) -> str:
    """The text of a page, without markup, scripts and styles."""
    return markup.unescape(_HIDDEN.sub(" ", page))


def tokens(host: str, path: str, segmenter: Segmenter) -> list[str]:
    """Words of host and path, and the place they lead to: the host's last word with the first
    words of the path, up to two. A number stands for its first digit."""
    words: dict[str, list[str]] = {}
    for part, text in (("h", host), ("p", path)):
        words[part] = []
        for label in _WORD.findall(text.lower()):
            if label[0].isdigit():
                words[part].append(f"{part}:<number {label[0]}>")
            else:
                words[part] += [f"{part}:{w}" for w in segmenter.split(label)]
    place = [" ".join([*words["h"][-1:], *words["p"][:2]])] if words["p"] else []
    return words["h"] + words["p"] + place


@dataclass
class Model:
    segmenter: Segmenter
    log_odds: dict[str, float]  # block over allow
    unseen: float
    prior: float

    def score(self, host: str, path: str) -> float:
        """Probability of block."""
        z = self.prior + sum(self.log_odds.get(t, self.unseen)
                             for t in tokens(host, path, self.segmenter))
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))


def word_counts(text: Column, source: DataFrame) -> DataFrame:
    """(word, n) over a whole column; each task sums its own words first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                counts.update(_LETTERS.findall(shown(value).lower()))
            if len(counts) > 500_000:
                yield _counted(counts)
                counts.clear()
        yield _counted(counts)
    return (source.select(filled(text).alias("t")).mapInArrow(run, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def _counted(counts: Counter) -> pa.RecordBatch:
    for word, n in list(counts.items()):
        if not word.isascii() and (bare := plain(word)) != word and _LETTERS.fullmatch(bare):
            counts[bare] += n
    return pa.record_batch([pa.array(list(counts), pa.string()),
                            pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def segmenter(pages: DataFrame, html: str = "html") -> Segmenter:
    """Fit the unigrams on the words of all pages."""
    counts = stored(word_counts(F.col(html), pages))
    total = counts.agg(F.sum("n")).first()[0] or 0
    kept = counts.filter(F.col("n") >= F.lit(MIN_WORD_SHARE * total)).collect()
    return Segmenter({**dict.fromkeys(SEEDS, 1), **{r["word"]: r["n"] for r in kept}}, total)


def token_counts(pages: DataFrame, url: str, shared) -> DataFrame:
    """(verdict, token, n) of the pages that a rule decides; an empty token per page
    counts the pages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[tuple[str, str]] = Counter()
        for batch in batches:
            for host, path, verdict in zip(*(c.to_pylist() for c in batch.columns)):
                counts[verdict, ""] += 1
                counts.update((verdict, t) for t in tokens(host, path, shared.value))
        yield pa.record_batch([pa.array([k[0] for k in counts], pa.string()),
                               pa.array([k[1] for k in counts], pa.string()),
                               pa.array(list(counts.values()), pa.int64())],
                              names=["verdict", "token", "n"])

    ruled = (pages.select(host_of(url).alias("host"), path_of(url).alias("path"))
             .withColumn("verdict", rule_verdict(rule_of(F.col("host"), F.col("path"))))
             .filter(F.col("verdict").isNotNull()))
    return (ruled.mapInArrow(run, "verdict string, token string, n long")
            .groupBy("verdict", "token").agg(F.sum("n").alias("n")))


def learn(pages: DataFrame, url: str = "url", html: str = "html") -> Model:
    spark = pages.sparkSession
    split = segmenter(pages, html)
    counts = stored(token_counts(pages, url, spark.sparkContext.broadcast(split)))
    pages_of = {r["verdict"]: r["n"] for r in counts.filter(F.col("token") == "").collect()}
    words_of = {r["verdict"]: r["n"] for r in counts.filter(F.col("token") != "")
                .groupBy("verdict").agg(F.sum("n").alias("n")).collect()}
    least = MIN_TOKEN_SHARE * sum(words_of.values())
    kept = counts.filter((F.col("token") != "") & (F.col("n") >= F.lit(least))).collect()
    by = {ALLOW: Counter(), BLOCK: Counter()}
    for r in kept:
        by[r["verdict"]][r["token"]] = r["n"]
    for seed in SEEDS:
        by[BLOCK]["h:" + seed] += max(1.0, SEED_SHARE * words_of.get(BLOCK, 0))
    known = set(by[ALLOW]) | set(by[BLOCK])
    mass = {v: sum(by[v].values()) + len(known) + 1 for v in by}
    odds = {t: math.log((by[BLOCK][t] + 1) / mass[BLOCK])
            - math.log((by[ALLOW][t] + 1) / mass[ALLOW]) for t in known}
    prior = math.log(pages_of.get(BLOCK, 0) + 1) - math.log(pages_of.get(ALLOW, 0) + 1)
    return Model(split, odds, math.log(mass[ALLOW] / mass[BLOCK]), prior)


def scored(host: Column, path: Column, shared) -> Column:
    """Probability of block of each url."""
    def run(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        score = shared.value.score
        return pd.Series([score(h, p) for h, p in zip(hosts, paths)], dtype="float64")
    return F.pandas_udf(run, "double")(host, path)


def judge(pages: DataFrame, model: Model, url: str = "url") -> DataFrame:
    """`pages` with host, path, rule, p_block and verdict."""
    shared = pages.sparkSession.sparkContext.broadcast(model)
    out = (pages.withColumn("host", host_of(url)).withColumn("path", path_of(url))
           .withColumn("rule", rule_of(F.col("host"), F.col("path")))
           .withColumn("p_block", scored(F.col("host"), F.col("path"), shared)))
    method = F.when(F.col("p_block") > 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return out.withColumn("verdict", F.coalesce(rule_verdict(F.col("rule")), method))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url of `pages`, judged."""
    pages = table(spark, sf_dir, "pages")
    return judge(pages.select("page_id", "url"), learn(pages)).select(
        "page_id", "host", "path", "rule", "verdict", "p_block")


QUERIES = {"op3_url_filter": op3_url_filter}
ORACLE_SQL: dict[str, str] = {}
