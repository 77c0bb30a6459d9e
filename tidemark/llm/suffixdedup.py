"""Removal of long byte strings that an earlier document already holds.

Every string of `width` bytes is judged: it goes if it also starts in a document of a
smaller id. Strings meet by their minimizer, the least hash among their `GRAM`-byte parts,
which equal strings share wherever they stand. Consecutive strings of one minimizer form
a run, a piece of text of `width - 1` bytes more than it has strings.

1. Documents are dealt into parts by id. Each part reports its minimizers once, with the
   number of its runs; those that no two documents share are dropped, as their strings
   can't repeat.
2. Parts meet their shared minimizers; the runs of these are ordered by deep-shallow
   sorting. Of equal runs in a part, those of the smallest document go on, the others are
   settled. So a passage that very many documents hold is sent on once for each part, not
   once for each document. Runs of a minimizer with more than `HOT_RUNS` runs (a phrase in
   ever new surroundings) go on string by string, each under its own hash, so that no
   minimizer is too much for one task.
3. Runs meet by minimizer, again ordered and settled as whole runs; where several documents
   are left for a minimizer, all strings of the runs are ordered one by one, and each that
   a smaller document has is marked.
4. Documents meet their marks; marked strings' bytes are removed.

Numbers of parts follow the size of the input, so a task's share does not grow. Blocks of
numbers and text are packed and compressed before each shuffle.

Edge cases: null text is empty text; texts shorter than `width` keep all; documents with a
null id neither lose bytes nor take any; rows of the same id are one document, whose rows
do not affect each other; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table, groups_for, utf8
from tidemark.llm.deepshallow import PAD, ranks

WIDTH = 50
GRAM = 16
KEY_BITS = 48
PIECE = 1 << 20  # bytes whose hashes are held at once
PART_BYTES = 6 << 20  # text of the documents in a part
BUCKET_BYTES = 6 << 20  # text whose minimizers fall into a bucket
STRINGS = 1 << 20  # strings sorted at once
HOT_RUNS = 200_000  # runs of one minimizer that a task takes together
_MASK = np.uint64((1 << KEY_BITS) - 1)
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


# ------------------------------------------------------------ packing
def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of one length, byte planes apart (high bytes are mostly equal), compressed."""
    planes = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T.tobytes()
              for a in arrays]
    return zstandard.compress(b"".join(planes), 1)


def _unpack(blob: bytes, *types) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    sizes = [np.dtype(t).itemsize for t in types]
    n, out, at = len(raw) // sum(sizes), [], 0
    for t, s in zip(types, sizes):
        out.append(np.ascontiguousarray(raw[at:at + n * s].reshape(s, n).T).view(t).ravel())
        at += n * s
    return out


def part_of(doc_id: np.ndarray, parts: int) -> np.ndarray:
    return (doc_id ^ (doc_id >> 17)) % parts


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> np.uint64(KEY_BITS - 32)) * np.uint64(buckets)) >> np.uint64(32)


# ------------------------------------------------------------ minimizers
def _hashes(buf: np.ndarray) -> np.ndarray:
    """Hash of the `GRAM` bytes at each position."""
    view = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))
    h = view[:len(buf) - GRAM + 1] * _A
    h += view[8:] * _B
    h ^= h >> np.uint64(32)
    h *= _C
    return h >> np.uint64(64 - KEY_BITS)


def _sliding_min(h: np.ndarray, span: int) -> np.ndarray:
    size = 1
    while size * 2 <= span:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[:len(h) - (span - size)], h[span - size:]) if span > size else h


def runs_of(text: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first, count): the runs of strings of one minimizer in a text."""
    n = len(text) - width + 1
    keys, firsts, counts = [], [], []
    for i in range(0, n, PIECE):
        least = _sliding_min(_hashes(text[i:min(n, i + PIECE) + width - 1]), width - GRAM + 1)
        first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
        # minima crowd at low values: an odd factor spreads them over all keys
        keys.append((least[first] * _A) & _MASK)
        firsts.append(first + i)
        counts.append(np.diff(np.r_[first, len(least)]))
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(keys), np.concatenate(firsts), np.concatenate(counts)


def _split(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a sorted array and where each begins (with the end appended)."""
    at = np.flatnonzero(np.r_[True, column[1:] != column[:-1]]) if len(column) else np.empty(0, int)
    return column[at], np.r_[at, len(column)]


def _by_group(column: np.ndarray, values: np.ndarray, how) -> np.ndarray:
    """`how` (a ufunc) over the values of each group of a sorted column, per element."""
    if not len(column):
        return values
    at = np.flatnonzero(np.r_[True, column[1:] != column[:-1]])
    return np.repeat(how.reduceat(values, at), np.diff(np.r_[at, len(column)]))


# ------------------------------------------------------------ 1. shared minimizers
def _report(width: int, buckets: int):
    """Of a part: for each bucket its keys, and twice the number of their runs, plus one if
    several documents of the part have the key."""
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table) -> pa.Table:
        keys, owners = [], []
        for doc, value in zip(docs.column("doc_id").to_pylist(), docs.column("text").to_pylist()):
            if doc is not None and len(value) >= width:
                k, _, _ = runs_of(np.frombuffer(value, np.uint8), width)
                keys.append(k)
                owners.append(np.full(len(k), doc, np.int64))
        bucket, blobs = np.empty(0, np.int64), []
        if keys:
            k, doc = np.concatenate(keys), np.concatenate(owners)
            order = np.argsort(k, kind="stable")
            k, doc = k[order], doc[order]
            at = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            several = np.minimum.reduceat(doc, at) != np.maximum.reduceat(doc, at)
            note = (2 * np.diff(np.r_[at, len(k)]) + several).astype(np.uint32)
            bucket, cut = _split(bucket_of(k[at], buckets))
            blobs = [_pack(np.diff(k[at[a:b]], prepend=np.uint64(0)), note[a:b])
                     for a, b in zip(cut, cut[1:])]
        return pa.table([pa.array(bucket.astype(np.int64)),
                         pa.array([key[0].as_py()] * len(blobs), pa.int64()),
                         pa.array(blobs, pa.binary())], names=["bucket", "part", "blob"])
    return run


def _shared(hot_runs: int):
    """Of a bucket: for each part its keys that several documents have, and which are hot.
    A document lies in one part, so a key of two parts has two documents."""
    def run(group: pa.Table) -> pa.Table:
        found = [_unpack(b, np.uint64, np.uint32) for b in group.column("blob").to_pylist()]
        key = np.concatenate([np.cumsum(k, dtype=np.uint64) for k, _ in found])
        note = np.concatenate([n for _, n in found]).astype(np.int64)
        part = np.repeat(group.column("part").to_numpy(), [len(k) for k, _ in found])
        order = np.argsort(key, kind="stable")
        key, note, part = key[order], note[order], part[order]
        parts = _by_group(key, np.ones(len(key), np.int64), np.add)
        several = (parts > 1) | (note & 1 == 1)
        hot = _by_group(key, note >> 1, np.add) > hot_runs
        key, hot, part = key[several], hot[several], part[several]
        order = np.lexsort((key, part))
        key, hot, part = key[order], hot[order], part[order]
        part, cut = _split(part)
        return pa.table([pa.array(part.astype(np.int64)),
                         pa.array([_pack(np.diff(key[a:b], prepend=np.uint64(0)),
                                         hot[a:b].astype(np.uint8)) for a, b in zip(cut, cut[1:])],
                                  pa.binary())], names=["part", "blob"])
    return run


# ------------------------------------------------------------ 2. and 3. runs
_RUN = (np.uint64, np.int64, np.uint32, np.uint32, np.uint32)  # key, doc, text crc, first, count
_MARK = (np.int64, np.uint32, np.uint32, np.uint32)  # doc, text crc, first, count


def _gather(buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The pieces of a buffer, one after the other."""
    out = np.empty(int(length.sum()), np.uint8)
    ends = np.cumsum(length)
    for a in range(0, len(start), 1 << 15):
        s, n = start[a:a + (1 << 15)], length[a:a + (1 << 15)]
        to = ends[a] - n[0]
        index = np.repeat(s - (ends[a:a + (1 << 15)] - n - to), n) + np.arange(n.sum())
        out[to:to + len(index)] = buf[index]
    return out


def _settled(buf: np.ndarray, start: np.ndarray, length: np.ndarray, doc: np.ndarray
             ) -> np.ndarray:
    """Which strings also stand in a smaller document, by deep-shallow sorting."""
    rank = ranks(buf, start, length)
    order = np.argsort(rank, kind="stable")
    out = np.empty(len(doc), bool)
    if len(doc):
        out[order] = doc[order] > _by_group(rank[order], doc[order], np.minimum)
    return out


def _single(buf: np.ndarray, width: int, k, doc, crc, first, count, at) -> list[np.ndarray]:
    """The strings of runs as runs of one string each, under a hash of their own."""
    owner = np.repeat(np.arange(len(count)), count)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    view = np.ndarray((len(buf) - 7,), "<u8", buf, strides=(1,))
    where = at[owner] + inside
    own = np.zeros(len(where), np.uint64)
    for d in [*range(0, width - 8, 8), width - 8]:
        own = (own ^ view[where + d]) * _A
        own ^= own >> np.uint64(29)
    return [(own * _C) >> np.uint64(64 - KEY_BITS), doc[owner], crc[owner], first[owner] + inside,
            np.ones(len(owner), np.int64), where]


def _send(width: int, buckets: int):
    """Of a part: packed runs for the buckets, and marks of what is settled here."""
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, shared: pa.Table) -> pa.Table:
        rows: list[tuple[int, bool, bytes]] = []
        if len(docs) and len(shared):
            lists = [_unpack(b, np.uint64, np.uint8) for b in shared.column("blob").to_pylist()]
            wanted = np.concatenate([np.cumsum(w, dtype=np.uint64) for w, _ in lists])
            order = np.argsort(wanted)
            wanted, hot = wanted[order], np.concatenate([h for _, h in lists])[order]
            texts, found, base = [], [], 0
            for doc, value in zip(docs.column("doc_id").to_pylist(),
                                  docs.column("text").to_pylist()):
                if doc is None or len(value) < width:
                    continue
                text = np.frombuffer(value, np.uint8)
                k, first, count = runs_of(text, width)
                at = np.minimum(np.searchsorted(wanted, k), len(wanted) - 1)
                kept = wanted[at] == k
                if kept.any():
                    n = int(kept.sum())
                    found.append((k[kept], np.full(n, doc, np.int64),
                                  np.full(n, zlib.crc32(value), np.uint32), first[kept],
                                  count[kept], first[kept] + base, hot[at[kept]] > 0))
                    texts.append(text)
                    base += len(text)
            if found:
                *runs, split = map(np.concatenate, zip(*found))
                buf = np.concatenate([*texts, np.zeros(PAD, np.uint8)])
                if split.any():
                    more = _single(buf, width, *(c[split] for c in runs))
                    runs = [np.concatenate([c[~split], m]) for c, m in zip(runs, more)]
                k, doc, crc, first, count, at = runs
                length = count + width - 1
                gone = _settled(buf, at, length, doc)
                if gone.any():
                    rows.append((int(key[0].as_py()) % buckets, True, _pack(
                        doc[gone], crc[gone], first[gone].astype(np.uint32),
                        count[gone].astype(np.uint32))))
                left = np.flatnonzero(~gone)
                left = left[np.argsort(k[left], kind="stable")]
                bucket, cut = _split(bucket_of(k[left], buckets))
                for b, x, y in zip(bucket.tolist(), cut, cut[1:]):
                    i = left[x:y]
                    head = _pack(k[i], doc[i], crc[i], first[i].astype(np.uint32),
                                 count[i].astype(np.uint32))
                    body = zstandard.compress(_gather(buf, at[i], length[i]).tobytes(), 3)
                    rows.append((b, False, len(head).to_bytes(8, "little") + head + body))
        return pa.table([pa.array([r[0] for r in rows], pa.int64()),
                         pa.array([r[1] for r in rows], pa.bool_()),
                         pa.array([r[2] for r in rows], pa.binary())],
                        names=["bucket", "settled", "blob"])
    return run


def _mark_strings(buf, at, doc, crc, first, count, width) -> list[np.ndarray]:
    """Marks of single strings: all strings of the given runs are sorted together."""
    n = int(count.sum())
    owner = np.repeat(np.arange(len(count)), count)
    inside = np.arange(n) - np.repeat(np.cumsum(count) - count, count)
    gone = np.flatnonzero(_settled(buf, at[owner] + inside, np.full(n, width), doc[owner]))
    if not len(gone):
        return []
    o, i = owner[gone], inside[gone]
    new = np.r_[True, (o[1:] != o[:-1]) | (i[1:] != i[:-1] + 1)]
    begin = np.flatnonzero(new)
    return [doc[o[begin]], crc[o[begin]], (first[o[begin]] + i[begin]).astype(np.uint32),
            np.diff(np.r_[begin, len(o)]).astype(np.uint32)]


def _mark(width: int, parts: int):
    """Of a bucket: marks of all strings that a smaller document has, packed by part."""
    def run(group: pa.Table) -> pa.Table:
        marks: list[list[np.ndarray]] = []
        heads, texts = [], []
        for settled, blob in zip(group.column("settled").to_pylist(),
                                 group.column("blob").to_pylist()):
            if settled:
                marks.append(_unpack(blob, *_MARK))
            else:
                n = int.from_bytes(blob[:8], "little")
                heads.append(_unpack(blob[8:8 + n], *_RUN))
                texts.append(np.frombuffer(zstandard.decompress(blob[8 + n:]), np.uint8))
        if heads:
            key, doc, crc, first, count = map(np.concatenate, zip(*heads))
            count = count.astype(np.int64)
            buf = np.concatenate([*texts, np.zeros(PAD, np.uint8)])
            length = count + width - 1
            at = np.cumsum(length) - length
            gone = _settled(buf, at, length, doc)
            marks.append([doc[gone], crc[gone], first[gone], count[gone].astype(np.uint32)])
            left = np.flatnonzero(~gone)
            left = left[np.argsort(key[left], kind="stable")]
            several = (_by_group(key[left], doc[left], np.minimum)
                       != _by_group(key[left], doc[left], np.maximum))
            left = left[several]
            _, cut = _split(key[left])
            total = np.r_[0, np.cumsum(count[left])]
            a = 0
            while a < len(cut) - 1:  # as many whole keys as make up STRINGS
                b = max(a + 1, int(np.searchsorted(total[cut], total[cut[a]] + STRINGS)) - 1)
                i = left[cut[a]:cut[b]]
                found = _mark_strings(buf, at[i], doc[i], crc[i], first[i], count[i], width)
                if found:
                    marks.append(found)
                a = b
        rows = []
        if marks:
            doc, crc, first, count = map(np.concatenate, zip(*marks))
            part = part_of(doc, parts)
            order = np.argsort(part, kind="stable")
            value, cut = _split(part[order])
            rows = [(int(p), _pack(*(c[order[a:b]] for c in (doc, crc, first, count))))
                    for p, a, b in zip(value, cut, cut[1:])]
        return pa.table([pa.array([r[0] for r in rows], pa.int64()),
                         pa.array([r[1] for r in rows], pa.binary())], names=["part", "blob"])
    return run


# ------------------------------------------------------------ 4. removal
KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _remove(width: int):
    def run(_: tuple[pa.Scalar, ...], docs: pa.Table, marks: pa.Table) -> pa.Table:
        found = [_unpack(b, *_MARK) for b in marks.column("blob").to_pylist()]
        by_text: dict[tuple[int, int], slice] = {}
        if found:
            doc, crc, first, count = map(np.concatenate, zip(*found))
            order = np.lexsort((first, crc, doc))
            doc, crc, first, count = (x[order].astype(np.int64) for x in (doc, crc, first, count))
            cut = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (crc[1:] != crc[:-1]), True])
            by_text = {(int(doc[a]), int(crc[a])): slice(a, b) for a, b in zip(cut, cut[1:])}
        rows = []
        for key, value in zip(docs.column("doc_id").to_pylist(), docs.column("text").to_pylist()):
            own = by_text.get((key, zlib.crc32(value)))
            if own is None:
                rows.append((key, len(value), 0, 0, value))
                continue
            begin, end = first[own], first[own] + count[own] + width - 1
            reach = np.maximum.accumulate(end)
            new = np.r_[True, begin[1:] > reach[:-1]]
            spans = list(zip(begin[new].tolist(), reach[np.r_[new[1:], True]].tolist()))
            kept = [value[a:b] for a, b in zip([0, *(s[1] for s in spans)],
                                               [*(s[0] for s in spans), len(value)])]
            rows.append((key, len(value), sum(b - a for a, b in spans), len(spans),
                         b"".join(kept)))
        cols = list(zip(*rows)) or [[]] * 5
        kinds = [pa.int64()] * 4 + [pa.binary()]
        return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)],
                        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])
    return run


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    width: int = WIDTH, hot_runs: int = HOT_RUNS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept), one row per document."""
    if width < GRAM:
        raise ValueError(f"strings have at least {GRAM} bytes")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), utf8(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = groups_for(size, PART_BYTES) | 1
    buckets = groups_for(size, BUCKET_BYTES)

    own = F.col("doc_id").bitwiseXOR(F.shiftright("doc_id", 17))
    spread = F.coalesce(own, F.xxhash64("text"))  # rows without an id go anywhere
    dealt = rows.withColumn("part", F.pmod(spread, F.lit(parts).cast("long")))
    by_part = dealt.groupBy("part")
    shared = (by_part.applyInArrow(_report(width, buckets), "bucket long, part long, blob binary")
              .groupBy("bucket").applyInArrow(_shared(hot_runs), "part long, blob binary"))
    sent = by_part.cogroup(shared.groupBy("part")).applyInArrow(
        _send(width, buckets), "bucket long, settled boolean, blob binary")
    marks = sent.groupBy("bucket").applyInArrow(_mark(width, parts), "part long, blob binary")
    return by_part.cogroup(marks.groupBy("part")).applyInArrow(_remove(width), KEPT)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of `documents` without the 50-byte strings of earlier ones."""
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op1_suffix_dedup": op1_suffix_dedup}
# hex digits stand for bytes, two each
ORACLE_SQL = {"op1_suffix_dedup": f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h
           FROM documents),
bytes AS (SELECT rid, doc_id, p, substr(h, 2 * p - 1, 2) AS byte,
                 CASE WHEN 2 * (p + {WIDTH} - 1) <= len(h) AND doc_id IS NOT NULL
                      THEN substr(h, 2 * p - 1, {2 * WIDTH}) END AS string
          FROM d, LATERAL (SELECT unnest(range(1, len(h) // 2 + 1)) AS p)),
least AS (SELECT string, min(doc_id) AS first FROM bytes WHERE string IS NOT NULL
          GROUP BY string HAVING min(doc_id) < max(doc_id)),
marked AS (SELECT rid, p, byte, max(CASE WHEN first < doc_id THEN p END) OVER (
             PARTITION BY rid ORDER BY p ROWS BETWEEN {WIDTH - 1} PRECEDING AND CURRENT ROW)
             IS NOT NULL AS gone
           FROM bytes LEFT JOIN least USING (string)),
runs AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY rid ORDER BY p), false)
           AS begins FROM marked),
kept AS (SELECT rid, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed,
                count(*) FILTER (begins) AS n_spans,
                string_agg(byte, '' ORDER BY p) FILTER (NOT gone) AS rest
         FROM runs GROUP BY rid)
SELECT doc_id, coalesce(n_bytes, 0)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(rest, ''))) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""}
