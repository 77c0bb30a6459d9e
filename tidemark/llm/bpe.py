"""BPE encoding and decoding with the merges of a public tokenizer file.

Encoding never replays the merges. A word is a string of start symbols (its bytes, the
last one marked as word end). An Aho-Corasick automaton over all tokens gives the longest
token that begins at each position; the encoder takes it, checks with a
pair-compatibility table that the merges would keep the border to the token before it,
and otherwise falls back to the next shorter token or steps back. A border that failed is
marked, so no position is tried twice and the work is linear in the word.

Decoding looks ids up in an offset table: all token strings lie in one byte string, and
`offsets[id] : offsets[id + 1]` is the token's slice.

Edge cases: null and empty text give no tokens and an empty decoded text; repeated rows
give repeated results; special-token strings inside a text become their ids.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import filled, importable, table

MAX_TOKENIZER_BYTES = 64 << 20  # a tokenizer file is broadcast; a larger one is refused
CACHED_WORDS = 400_000  # per Python worker; the cache is emptied when it is full
WORD_END = "</w>"

# The white space, and the contractions, of the tokenizer's own pattern.
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
# The same pattern for texts of the first 256 characters, where the classes are short.
LATIN_LETTERS = "a-zªµºß-öø-ÿ"
LATIN_NUMBERS = "0-9²³¹¼½¾"

# Characters newer than the tokenizer's tables, which it takes for symbols
# (ranges, both ends included), and lower case that is newer than Python's.
NEW_LETTERS = """
0558 058B-058C 088F 0C5C 0CDC 208F 209D-209F A7CE-A7CF A7D2 A7D4 A7DD A7E2 A7F1 AB6C-AB6D
107BB-107BF 10940-10959 10EC5-10EC7 10ED9-10EEE 11B0A 11DB0-11DDB 11DF1 16EA0-16EB8
16EBB-16ED3 16FF2-16FF3 187F8-187FF 18CD6-18CDA 18D09-18D20 18D80-18DF2 18E00-19191
191A0-191D2 1B123-1B128 1B168 1D6A6 1DF1F-1DF24 1DF2B-1DF81 1DF90-1DF96 1DFCD-1DFFF
1E6C0-1E6DE 1E6E0-1E6E2 1E6E4-1E6E5 1E6E7-1E6ED 1E6F0-1E6F4 1E6FE-1E6FF 2B73A-2B73F 2B81E
2CEA2-2CEAD 323B0-33479 3D000-3FC3F
"""
NEW_NUMBERS = "11DE0-11DE9 1246F 12475-1247F 12550-12686 16FF4-16FF6"
NEW_LOWER = {0x1C89: 0x1C8A, 0xA7CB: 0x0264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3,
             0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x019B,
             **{c: c + 0x20 for c in range(0x10D50, 0x10D66)},
             **{c: c + 0x1B for c in range(0x16EA0, 0x16EB9)}}


def _class_of(ranges: str) -> str:
    """Ranges of hexadecimal code points as the inside of a pattern's brackets."""
    return "".join("-".join(f"\\U{int(end, 16):08x}" for end in part.split("-"))
                   for part in ranges.split())


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies:
    printable Latin-1 bytes stand for themselves, the others for 256, 257, ... in order."""
    keep = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


@dataclass(frozen=True)
class TokenizerFile:
    """What is used of a tokenizer file: token strings by id, merges, special tokens."""

    tokens: tuple[str, ...]
    merges: tuple[tuple[str, str], ...]
    specials: tuple[tuple[str, int], ...]

    @staticmethod
    def read(path: str) -> TokenizerFile:
        with open(path, "rb") as f:
            raw = f.read(MAX_TOKENIZER_BYTES + 1)
        if len(raw) > MAX_TOKENIZER_BYTES:
            raise ValueError(f"{path} is larger than {MAX_TOKENIZER_BYTES} bytes")
        j = json.loads(raw)
        model = j["model"]
        ids = dict(model["vocab"])
        specials = tuple((t["content"], t["id"]) for t in j["added_tokens"])
        ids.update(specials)
        tokens = [""] * (max(ids.values()) + 1)
        for s, i in ids.items():
            tokens[i] = s
        merges = tuple(tuple(m.split(" ")) if isinstance(m, str) else tuple(m)
                       for m in model["merges"])
        return TokenizerFile(tuple(tokens), merges, specials)


class Codec:
    """Encoder and decoder of one tokenizer file (built once in each Python worker)."""

    def __init__(self, file: TokenizerFile):
        import ahocorasick

        self.ids = {s: i for i, s in enumerate(file.tokens) if s}
        specials = dict(file.specials)
        # a symbol is one character: the byte's own, moved up by 0x1000 at a word's end
        self.spelled: dict[int, str] = {}  # token -> its symbols
        self.rank: dict[int, int] = {}  # order in which tokens come to be
        self.parts: dict[int, tuple[int, int]] = {}  # merged token -> its two halves
        self.merged: dict[tuple[int, int], int] = {}
        for end in (False, True):
            for b in byte_symbols():
                token = self.ids.get(b + WORD_END * end)
                if token is not None:
                    self.spelled[token] = chr(ord(b) + 0x1000 * end)
                    self.rank[token] = len(self.rank)
        for left, right in file.merges:
            a, b, c = self.ids[left], self.ids[right], self.ids[left + right]
            self.merged[a, b] = c
            if c not in self.rank:
                self.rank[c] = len(self.rank)
                self.parts[c] = (a, b)
                self.spelled[c] = self.spelled[a] + self.spelled[b]
        self.by_symbols = {s: t for t, s in self.spelled.items()}
        self.automaton = ahocorasick.Automaton()
        for s, t in self.by_symbols.items():
            self.automaton.add_word(s, (len(s), t))
        self.automaton.make_automaton()
        self.compatible: dict[tuple[int, int], bool] = {}
        self.shorter: dict[int, int | None] = {}

        table_ = [s.encode() for s in file.tokens]
        self.blob = np.frombuffer(b"".join(t + b" " for t in table_), np.uint8)
        self.offsets = np.cumsum([0] + [len(t) + 1 for t in table_])
        self.symbols = byte_symbols()
        self.special_ids = specials
        self.special_pattern = re.compile("|".join(
            re.escape(s) for s in sorted(specials, key=len, reverse=True))) if specials else None
        self.latin = re.compile(
            f"{CONTRACTIONS}|[{LATIN_LETTERS}]+|[{LATIN_NUMBERS}]|"
            f"[^{WHITE_SPACE}{LATIN_LETTERS}{LATIN_NUMBERS}]+")
        import regex
        letter = rf"[\p{{L}}--[{_class_of(NEW_LETTERS)}]]"
        number = rf"[\p{{N}}--[{_class_of(NEW_NUMBERS)}]]"
        self.any_script = regex.compile(
            rf"{CONTRACTIONS}|{letter}+|{number}|[^[{WHITE_SPACE}]{letter}{number}]+", regex.V1)
        self.words = _Words(self)

    # ------------------------------------------------------------ one word
    def _keeps_border(self, left: int, right: int) -> bool:
        """Whether the merges leave the border between two adjacent tokens alone.

        Undo the later merge of the two tokens step by step: whenever the pair that then
        meets at the border could merge earlier than what was undone, they would have.
        """
        known = self.compatible.get((left, right))
        if known is not None:
            return known
        a, b, before, answer = left, right, len(self.rank), True
        while True:
            both = self.merged.get((a, b))
            if both is not None and self.rank[both] < before:
                answer = False
                break
            undo_left = a in self.parts and (b not in self.parts or self.rank[a] > self.rank[b])
            if undo_left:
                before, a = self.rank[a], self.parts[a][1]
            elif b in self.parts:
                # at equal rank the merge further left goes first
                before, b = self.rank[b] + 1, self.parts[b][0]
            else:
                break
        self.compatible[left, right] = answer
        return answer

    def _next_shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix of this one."""
        if token not in self.shorter:
            s = self.spelled[token]
            self.shorter[token] = next((self.by_symbols[s[:n]] for n in range(len(s) - 1, 0, -1)
                                        if s[:n] in self.by_symbols), None)
        return self.shorter[token]

    def encode_word(self, word: str) -> list[int]:
        spelled = "".join([self.symbols[b] for b in word.encode()])
        spelled = spelled[:-1] + chr(ord(spelled[-1]) + 0x1000)
        whole = self.by_symbols.get(spelled)
        longest: dict[int, tuple[int, int]] = {}
        for end, hit in self.automaton.iter(spelled):
            start = end - hit[0] + 1
            if start not in longest or longest[start] < hit:
                longest[start] = hit
        failed = bytearray(len(spelled) + 1)
        out: list[int] = []
        at, token = 0, whole if whole is not None else longest[0][1]
        while True:
            end = at + len(self.spelled[token])
            if not failed[end] and (not out or self._keeps_border(out[-1], token)):
                out.append(token)
                at = end
                if at == len(spelled):
                    return out
                token = longest[at][1]
                continue
            token = self._next_shorter(token)
            while token is None:  # nothing fits here: give up the token before
                failed[at] = 1
                before = out.pop()
                at -= len(self.spelled[before])
                token = self._next_shorter(before)

    # ------------------------------------------------------------ texts
    def pieces(self, text: str) -> list[str]:
        """Normalised words of a text without special tokens."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.any_script.findall(text.translate(NEW_LOWER))
        return self.latin.findall(text)

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.uint32)
        if self.special_pattern is None or "<" not in text:
            return np.frombuffer(b"".join(map(self.words.__getitem__, self.pieces(text))),
                                 np.uint32)
        out, at = [], 0
        for m in self.special_pattern.finditer(text):
            out += map(self.words.__getitem__, self.pieces(text[at:m.start()]))
            out.append(np.uint32(self.special_ids[m.group()]).tobytes())
            at = m.end()
        out += map(self.words.__getitem__, self.pieces(text[at:]))
        return np.frombuffer(b"".join(out), np.uint32)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the token strings, joined by one space (the file names no decoder)."""
        if not len(ids):
            return b""
        first = self.offsets[ids]
        lengths = self.offsets[ids + 1] - first
        ends = np.cumsum(lengths)
        where = np.repeat(first - (ends - lengths), lengths)
        where += np.arange(ends[-1])
        return self.blob[where].tobytes()[:-1]  # every slice carries its space


class _Words(dict):
    """Word -> its ids as bytes; misses are encoded."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec = codec

    def __missing__(self, word: str) -> bytes:
        out = np.array(self.codec.encode_word(word), np.uint32).tobytes()
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = out
        return out


_codecs: dict[int, Codec] = {}


def _codec_of(shared) -> Codec:
    """The worker's codec for a broadcast tokenizer file."""
    if shared.value not in _codecs:
        _codecs.clear()
        _codecs[shared.value] = Codec(shared.value)
    return _codecs[shared.value]


def share(spark: SparkSession, path: str):
    """Broadcast a tokenizer file (its size is bounded, see `TokenizerFile.read`)."""
    return importable(spark).sparkContext.broadcast(TokenizerFile.read(path))


def token_ids(text: Column, shared) -> Column:
    """array<int>: the ids of each text."""
    def run(texts: pd.Series) -> pd.Series:
        codec = _codec_of(shared)
        return pd.Series([codec.encode(t).astype(np.int32) for t in texts], dtype=object)
    return F.pandas_udf(run, "array<int>")(filled(text))


def decoded(ids: Column, shared) -> Column:
    """The text of each id list (null: empty)."""
    def run(lists: pd.Series) -> pd.Series:
        codec = _codec_of(shared)
        return pd.Series([codec.decode(np.asarray(x, np.int64)).decode() if x is not None else ""
                          for x in lists], dtype=object)
    return F.pandas_udf(run, "string")(ids)


_DECIMALS: dict[int, list[bytes]] = {}


def digest(text: Column, shared, with_ids: bool = False) -> Column:
    """struct<n_tokens, ids_sha256, decoded_sha256>: encode, then decode the ids. The ids
    leave the worker (as `token_ids`) only if asked for."""
    def run(texts: pd.Series) -> pd.DataFrame:
        codec = _codec_of(shared)
        if len(codec.offsets) not in _DECIMALS:
            _DECIMALS[len(codec.offsets)] = [b"%d" % i for i in range(len(codec.offsets))]
        decimal = _DECIMALS[len(codec.offsets)].__getitem__
        rows = []
        for t in texts:
            ids = codec.encode(t)
            rows.append((len(ids), hashlib.sha256(b" ".join(map(decimal, ids.tolist())))
                         .hexdigest(), hashlib.sha256(codec.decode(ids.astype(np.int64)))
                         .hexdigest(), ids.astype(np.int32) if with_ids else None))
        columns = ["n_tokens", "ids_sha256", "decoded_sha256", "token_ids"]
        return pd.DataFrame(rows, columns=columns)[columns[:3 + with_ids]]
    return F.pandas_udf(run, "n_tokens long, ids_sha256 string, decoded_sha256 string"
                        + ", token_ids array<int>" * with_ids)(filled(text))


def public_tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of `documents`, encoded and decoded again (one row per document)."""
    docs = table(spark, sf_dir, "documents")
    shared = share(spark, public_tokenizer())
    return (docs.select("doc_id", digest(F.col("text"), shared).alias("d"))
            .select("doc_id", "d.*"))


QUERIES = {"op5_bpe": op5_bpe}
ORACLE_SQL: dict[str, str] = {}
