import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from .plain import repeats
from pyspark.sql import functions as F

from tidemark.llm.deepshallow import PAD, ranks
from tidemark.llm.suffixdedup import without_repeats


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.binary(max_size=40), st.text("ab", max_size=90).map(str.encode),
                          st.text("a\0", max_size=60).map(str.encode)), max_size=40))
def test_ranks_order_strings(strings):
    buf = np.frombuffer(b"".join(strings) + bytes(PAD), np.uint8)
    length = np.array([len(s) for s in strings], np.int64)
    rank = ranks(buf, np.cumsum(length) - length, length)
    order = sorted(range(len(strings)), key=lambda i: strings[i])
    want = {}
    for place, i in enumerate(order):
        want.setdefault(strings[i], place)
    assert rank.tolist() == [want[s] for s in strings]


def result(df, **kw):
    found = without_repeats(df, **kw).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                             F.sha2("kept", 256)).collect()
    return sorted(map(tuple, found), key=str)


def test_matches_plain_version(docs, rows):
    assert result(docs) == sorted(repeats([r[:2] for r in rows]), key=str)


def test_small_parts_give_equal_results(docs, rows, monkeypatch):
    from tidemark.llm import suffixdedup
    for name, value in (("PART_BYTES", 4000), ("BUCKET_BYTES", 3000), ("STRINGS", 100)):
        monkeypatch.setattr(suffixdedup, name, value)
    want = sorted(repeats([r[:2] for r in rows]), key=str)
    assert result(docs) == want
    # every minimizer is hot: its strings travel one by one
    by_width = sorted(repeats([r[:2] for r in rows], 20), key=str)
    assert result(docs, hot_runs=0) == want
    assert result(docs, width=20, hot_runs=0) == by_width


def test_runs_partition_the_strings(monkeypatch):
    """Every string is in one run; equal strings have equal keys; pieces don't matter."""
    from tidemark.llm import suffixdedup
    rng = np.random.default_rng(1)
    text = np.frombuffer(bytes(rng.choice(list(b"ab c"), 700)) + b"x" * 200, np.uint8)
    key, first, count = suffixdedup.runs_of(text, 50)
    assert first[0] == 0 and (first[1:] == (first + count)[:-1]).all()
    assert (first + count)[-1] == len(text) - 49
    by_string = {}
    for k, a, n in zip(key, first, count):
        for p in range(a, a + n):
            assert by_string.setdefault(text[p:p + 50].tobytes(), k) == k
    monkeypatch.setattr(suffixdedup, "PIECE", 64)
    cut = suffixdedup.runs_of(text, 50)
    assert np.repeat(cut[0], cut[2]).tolist() == np.repeat(key, count).tolist()


def test_other_widths(docs, rows):
    assert result(docs, width=20) == sorted(repeats([r[:2] for r in rows], 20), key=str)


def test_empty_and_extra_columns(no_docs, odd_docs, rows):
    assert result(no_docs) == []
    assert result(odd_docs) == sorted(repeats([r[:2] for r in rows]), key=str)
