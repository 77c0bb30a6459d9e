"""Personal data: exact patterns, and a character BiLSTM-CRF that adds to them.

Base spans come from patterns with checks (octets up to 255, Luhn, digit counts). A
tagger (`tagger.Tagger`), trained in numpy on windows whose labels are the base spans and on
variants of these spans that the patterns do not cover (`variants`: `at` and `dot` spelled
out, other separators, digits of other scripts), reads every text in overlapping windows. Each window is decoded by itself. A span that
touches an inner edge of its window is cut: it is joined with the next window's span of the
same kind that is cut where this one goes on, and so forth, until an end is seen; windows
that such a span runs into are decoded too. Of all windows' spans of a text, the set of disjoint ones with the greatest total probability is
kept, next to the base spans, which always stay.

Windows are decoded if they hold a signal: a digit of any script, an `@` (also full width), a
bracketed `at` or `dot`, the word `dot`, or `at` before a name with a dot inside; and those
that a cut span runs into. Without a signal no window is decoded, and a span must hold one: a
spelled-out address whose host has no dot is not found.

The fit uses a bounded sample: of about `FIT_DOCUMENTS` documents, chosen by a hash of the
id, for each kind, and for windows without a span, at most `PER_KIND` different windows of
`WINDOW` characters, those with the smallest hashes; each is followed by `VARIANTS` variants.

Edge cases: null and empty texts have no spans; offsets count code points; without any
labelled window only base spans are found; repeated rows get equal results.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import filled, hash_share, importable, smallest, table
from tidemark.llm.tagger import Tagger, char_ids
from tidemark.llm.variants import lookalike, varied

KINDS = ("email", "ip", "card", "phone")
WINDOW = 80
STRIDE = 40
FIT_DOCUMENTS = 50_000
PER_KIND = 350
VARIANTS = 4  # of each sampled window
STEPS = 600  # training batches
SURE = 0.95  # least mean probability of a span's tags
DECODED = 512  # windows in a batch

# The patterns. A number can only begin where no digit stands before it.
_EMAIL_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGNAL = re.compile(r"[\d@＠]|\bdot\b|[(\[{] ?(?:at|dot) ?[)\]}]|\bat [\w-]+[.．]\w", re.IGNORECASE)
_NAME_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

Span = tuple[int, int, int]  # kind, start, end


def _emails(text: str) -> Iterator[Span]:
    """From each `@` to the left as far as name characters go, to the right the host."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _NAME_CHARS:
            start -= 1
        host = _EMAIL_HOST.match(text, at + 1) if start < at else None
        if host:
            yield 0, start, host.end()
        free = host.end() if host else at + 1
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Base spans by kind, then start."""
    out: list[Span] = []
    if "@" in text:
        out += _emails(text)
    if _SIGNAL.search(text) is None:
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m.group())) <= 15:
                out.append((3, *m.span()))
    return out


# ------------------------------------------------------------ windows
def windows_of(text: str) -> list[int]:
    """Starts of the windows in which a signal begins."""
    last = max(0, (len(text) - WINDOW + STRIDE - 1) // STRIDE) * STRIDE
    starts: set[int] = set()
    for m in _SIGNAL.finditer(text):
        high = min(m.start() // STRIDE * STRIDE, last)
        starts.add(high)
        if high >= STRIDE and m.start() < high - STRIDE + WINDOW:
            starts.add(high - STRIDE)
    return sorted(starts)


def tags_of(spans: list[Span], start: int, end: int) -> np.ndarray:
    """0 outside; 1 + 2 * kind at a span's first character, one more inside."""
    out = np.zeros(end - start, np.int64)
    for kind, a, b in spans:
        x, y = max(a, start), min(b, end)
        if x < y:
            out[x - start:y - start] = 2 + 2 * kind
            if a >= start:
                out[a - start] = 1 + 2 * kind
    return out


def _padded(rows: list[np.ndarray], kind) -> np.ndarray:
    out = np.zeros((len(rows), WINDOW), kind)
    for i, r in enumerate(rows):
        out[i, :len(r)] = r
    return out


def _tag_runs(tags: np.ndarray, sure: np.ndarray) -> Iterator[tuple[int, int, int, float]]:
    """(kind, start, end, probability) of the spans in one window's tags."""
    i = 0
    while i < len(tags):
        if tags[i] == 0:
            i += 1
            continue
        kind, start = (int(tags[i]) - 1) // 2, i
        i += 1
        while i < len(tags) and tags[i] == 2 + 2 * kind:
            i += 1
        yield kind, start, i, float(sure[start:i].mean())


def reconciled(found: dict[Span, float], base: list[Span]) -> list[Span]:
    """The disjoint spans of greatest total probability that touch no base span."""
    taken = sorted((a, b) for _, a, b in base)
    starts = [a for a, _ in taken]
    reach = list(np.maximum.accumulate([b for _, b in taken])) if taken else []

    def free(s: Span) -> bool:
        i = int(np.searchsorted(starts, s[2]))  # base spans that begin before its end
        return i == 0 or reach[i - 1] <= s[1]

    spans = sorted((s for s in found if free(s)), key=lambda s: (s[2], s[1], s[0]))
    ends = [s[2] for s in spans]
    best, keep = [0.0], []
    for i, s in enumerate(spans):
        j = int(np.searchsorted(ends[:i], s[1], "right"))
        gain = best[j] + found[s]
        keep.append(j if gain > best[i] else -1)
        best.append(max(best[i], gain))
    out, i = [], len(spans)
    while i:
        if keep[i - 1] >= 0:
            out.append(spans[i - 1])
            i = keep[i - 1]
        else:
            i -= 1
    return out


Piece = tuple[int, int, int, float]  # kind, start, end, probability


def joined(runs: dict[int, list[Piece]], length: int) -> dict[Span, float]:
    """Spans of one text from the runs of its windows (by start), the cut ones joined."""
    def cut_right(p: Piece, s: int) -> bool:
        return p[2] == s + WINDOW < length

    def next_of(p: Piece, s: int) -> Piece | None:
        """The same span in the next window, where it begins before the window does."""
        q = next(iter(runs.get(s + STRIDE, [])), None)
        return q if q and q[0] == p[0] and q[1] == s + STRIDE and q[2] >= p[1] else None

    out: dict[Span, float] = {}
    for s, pieces in runs.items():
        for p in pieces:
            if p[1] == s > 0:
                continue  # it begins in an earlier window
            at, q, end = s, p, p[2]
            weight, total = p[2] - p[1], (p[2] - p[1]) * p[3]
            while q and cut_right(q, at):
                q = next_of(q, at)
                at += STRIDE
                if q:
                    end = max(end, q[2])
                    weight, total = weight + q[2] - q[1], total + (q[2] - q[1]) * q[3]
            if q:
                span, prob = (p[0], p[1], end), total / weight
                out[span] = max(prob, out.get(span, 0.0))
    return out


def added_spans(texts: list[str], base: list[list[Span]], tagger: Tagger) -> list[list[Span]]:
    """What the tagger adds to the base spans of each text."""
    where = [(i, s) for i, t in enumerate(texts) for s in windows_of(t)]
    known = set(where)
    runs: dict[int, dict[int, list[Piece]]] = {}
    while where:
        more = []  # windows that cut spans run into
        for a in range(0, len(where), DECODED):
            part = where[a:a + DECODED]
            ids = _padded([char_ids(texts[i][s:s + WINDOW]) for i, s in part], np.int16)
            tags, sure = tagger.decode(ids)
            for (i, s), row, p in zip(part, tags, sure):
                n = min(WINDOW, len(texts[i]) - s)
                found = [(kind, s + x, s + y, prob) for kind, x, y, prob in _tag_runs(row[:n], p[:n])]
                if not found:
                    continue
                runs.setdefault(i, {})[s] = found
                beside = [s - STRIDE] * (found[0][1] == s > 0)
                beside += [s + STRIDE] * (found[-1][2] == s + n < len(texts[i]))
                for w in beside:
                    if (i, w) not in known:
                        known.add((i, w))
                        more.append((i, w))
        where = more
    out = []
    for i, t in enumerate(texts):
        found = {x: prob for x, prob in joined(runs.get(i, {}), len(t)).items()
                 if prob >= SURE and _SIGNAL.search(t, x[1], x[2])}
        out.append(reconciled(found, base[i]) if found else [])
    return out


# ------------------------------------------------------------ fit
def variant_of(window: str, tags: np.ndarray, rng: random.Random
               ) -> tuple[str, np.ndarray, Span | None] | None:
    """The window with one of its whole spans rewritten, or with something that looks alike
    put in where it has no span; its tags, and the rewritten span. None if the patterns cover
    the variant after all, or it does not fit the window."""
    spans = [(k, a, b) for k, a, b, _ in _tag_runs(tags, np.ones(len(tags)))]
    whole = [s for s in spans if tags[s[1]] == 1 + 2 * s[0] and s[2] < len(window)]
    if not spans:
        at = rng.randrange(len(window) + 1)
        kind, a, b, new = None, at, at, lookalike(rng)
    elif whole:
        kind, a, b = rng.choice(whole)
        new = varied(KINDS[kind], window[a:b], rng)
    else:
        return None
    text = window[:a] + new + window[b:]
    inside = tags_of([] if kind is None else [(kind, 0, len(new))], 0, len(new))
    marked = np.concatenate([tags[:a], inside, tags[b:]])
    end = a + len(new)
    first = max(0, min(a - 5, end + 10 - WINDOW)) if len(text) > WINDOW else 0
    base = base_spans(text)
    if end - first > WINDOW or any(x < end and y > a for _, x, y in base):
        return None
    span = None if kind is None else (kind, a - first, end - first)
    return text[first:first + WINDOW], marked[first:first + WINDOW], span


def with_variants(rows: list[tuple[str, np.ndarray]], each: int = VARIANTS, seed: int = 5
                  ) -> list[tuple[str, np.ndarray]]:
    """The windows, twice, and up to `each` variants of every one."""
    rng = random.Random(seed)
    out = [*rows, *rows]
    for window, tags in rows:
        for _ in range(each):
            made = variant_of(window, tags, rng)
            if made:
                out.append(made[:2])
    return out


def labelled_windows(docs: DataFrame, text: str = "text") -> DataFrame:
    """(kind, window, tags) of all windows with a signal; kind is that of the first span that
    begins there, or 'none'."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds, windows, tags = [], [], []
            for t in batch.column(0).to_pylist():
                starts = windows_of(t)
                spans = base_spans(t) if starts else []
                for s in starts:
                    w = t[s:s + WINDOW]
                    inside = tags_of(spans, s, s + len(w))
                    begun = inside[inside % 2 == 1]
                    kinds.append(KINDS[begun[0] // 2] if len(begun) else "none")
                    windows.append(w)
                    tags.append(bytes(inside.astype(np.uint8)))
            yield pa.record_batch([pa.array(kinds, pa.string()), pa.array(windows, pa.string()),
                                   pa.array(tags, pa.binary())], names=["kind", "window", "tags"])
    return docs.select(filled(text).alias("t")).mapInArrow(
        run, "kind string, window string, tags binary")


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", per_kind: int = PER_KIND
        ) -> Tagger | None:
    """A tagger trained on the bounded sample, or None without windows."""
    few = docs.filter(hash_share(doc_id) < FIT_DOCUMENTS / max(1, docs.count()))
    hashed = labelled_windows(few, text).distinct().withColumn("hash", F.xxhash64("window"))
    order = ["hash", "window", "tags"]
    rows = smallest(hashed, per_kind, ["kind"], order).orderBy("kind", *order).collect()
    if not rows:
        return None
    return trained([(r["window"], np.frombuffer(r["tags"], np.uint8)) for r in rows])


def trained(rows: list[tuple[str, np.ndarray]], steps: int = STEPS) -> Tagger:
    """A tagger of labelled windows and their variants."""
    rows = with_variants(rows)
    tagger = Tagger(1 + 2 * len(KINDS), precision=np.float32)
    tagger.train(_padded([char_ids(w) for w, _ in rows], np.int16),
                 _padded([t for _, t in rows], np.int64), steps)
    return tagger


def shared_tagger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text"):
    """The tagger, broadcast (its size is fixed by its layers)."""
    spark = importable(docs.sparkSession)
    return spark.sparkContext.broadcast(fit(docs, doc_id, text))


# ------------------------------------------------------------ operators
def _found(texts: list[str], tagger: Tagger | None) -> tuple[list[list[Span]], list[list[Span]]]:
    base = [base_spans(t) for t in texts]
    return base, added_spans(texts, base, tagger) if tagger else [[] for _ in texts]


def _listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


REPORT = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
          "spans string, n_added long")


def report(text: Column, shared) -> Column:
    """struct: base spans by kind, their digest, all spans, number of added ones."""
    def run(texts: pd.Series) -> pd.DataFrame:
        base, more = _found(texts.to_list(), shared.value)
        rows = []
        for b, m in zip(base, more):
            n = [sum(s[0] == k for s in b) for k in range(len(KINDS))]
            rows.append((*n, hashlib.sha256(_listed(b).encode()).hexdigest(), _listed(b + m),
                         len(m)))
        return pd.DataFrame(rows, columns=["n_email", "n_ip", "n_card", "n_phone",
                                           "base_sha256", "spans", "n_added"])
    return F.pandas_udf(run, REPORT)(filled(text))


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; spans that overlap become one mark."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind]}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redacted(text: Column, shared) -> Column:
    """The texts without their personal data (null stays null)."""
    def run(texts: pd.Series) -> pd.Series:
        known = [t if t is not None else "" for t in texts]
        base, more = _found(known, shared.value)
        return pd.Series([None if t is None else redact(t, b + m) if b or m else t
                          for t, b, m in zip(texts, base, more)], dtype=object)
    return F.pandas_udf(run, "string")(text.cast("string"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of `documents`."""
    docs = table(spark, sf_dir, "documents")
    shared = shared_tagger(docs)
    return docs.select("doc_id", report(F.col("text"), shared).alias("r")).select("doc_id", "r.*")


QUERIES = {"op2_pii": op2_pii}
ORACLE_SQL: dict[str, str] = {}
