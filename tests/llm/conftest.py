"""Small documents with the awkward cases: nulls, empties, long texts, ties, repeats."""

import random

import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    parts = ["th", "er", "on", "an", "re", "in", "ed", "nd", "ou", "at"]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n))


def make_docs():
    rng = random.Random(5)
    shared = prose(rng, 40)
    base = [prose(rng, rng.randint(5, 120)) for _ in range(25)]
    texts = [*base, None, "", " ", "a", "Ünïcödé " * 30, shared, f"{base[0]} {shared}", base[3],
             base[3], base[3], base[4] + " one more word", prose(rng, 6000), "a" * 400, "a" * 230,
             f"call +1 (377) 555-0271 or mail x.y@mail.example.com {base[5]}", base[7].upper(),
             "".join(rng.choices("ab\n", k=300)), "".join(rng.choices("ab\n", k=300))]
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows.append(rows[6])  # a repeated row
    rows.append((None, base[2], "en", None, 5))  # no id
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_docs()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCUMENTS).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENTS)


@pytest.fixture(scope="session")
def odd_docs(docs):
    """The documents with more columns, whose names operators might use themselves."""
    from pyspark.sql import functions as F
    names = ["fp", "part", "blob", "bucket", "shard", "spans", "score", "id", "a", "b", "n", "t",
             "__hash", "__text_hash", "__score", "__id", "row_hash", "Text_Hash", "hash", "first"]
    return docs.withColumns({n: F.lit(i) for i, n in enumerate(names)})
