import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from .plain import sha
from pyspark.sql import functions as F

from tidemark.llm import bpe


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(bpe.public_tokenizer())
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.TokenizerFile.read(bpe.public_tokenizer()))


def check(codec, library, text):
    want = library.encode(text, add_special_tokens=False).ids
    got = codec.encode(text)
    assert got.tolist() == want, repr(text)
    assert codec.decode(got.astype(np.int64)).decode() == library.decode(
        want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text(codec, library, text):
    check(codec, library, text)


def test_awkward_pieces(codec, library):
    rng = random.Random(2)
    pieces = ["th", "e", "ing", " ", "\n", "'s", "'RE", "!", "%%", "é", "ß", "İ", "ΑΣ", "中",
              "²", "½", "Ⅷ", "\x1c", "\x85", "<|startoftext|>", "<|endoftext|>", "<|", "</w>",
              "_", "́", "😀", "​", "ſ", "tion"]
    for _ in range(2000):
        check(codec, library, "".join(rng.choices(pieces, k=rng.randint(0, 12))))
    for _ in range(3000):
        check(codec, library, "".join(rng.choices("aeinorsthlc", k=rng.randint(1, 30))))
    check(codec, library, "a" * 3000 + " " + "ab" * 2000)


def test_query_columns(spark, docs, rows, no_docs, codec, library):
    shared = bpe.share(spark, bpe.public_tokenizer())
    found = docs.select("text", bpe.digest(F.col("text"), shared, with_ids=True).alias("d"))
    for r in found.collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["d"]["token_ids"] == ids and r["d"]["n_tokens"] == len(ids)
        assert r["d"]["ids_sha256"] == sha(" ".join(map(str, ids)))
        assert r["d"]["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))
    ids = docs.select("text", bpe.token_ids(F.col("text"), shared).alias("i"))
    for r in ids.withColumn("back", bpe.decoded(F.col("i"), shared)).collect():
        assert r["back"] == library.decode(r["i"], skip_special_tokens=False)
    assert no_docs.select(bpe.digest(F.col("text"), shared)).count() == 0


def test_too_large_a_file(tmp_path, monkeypatch):
    path = tmp_path / "t.json"
    path.write_text("x" * 100)
    monkeypatch.setattr(bpe, "MAX_TOKENIZER_BYTES", 50)
    with pytest.raises(ValueError):
        bpe.TokenizerFile.read(str(path))
