"""Each stage of the pipeline against a plain version on its own input."""

import corpus_pipeline as C
import pytest
from .plain import benchmark_hits, components, personal, sha

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(C.STAGES):
        stage(spark, out[-1], SF).write.parquet(f"{folder}/{i}")
        out.append(spark.read.parquet(f"{folder}/{i}"))
    return [d.collect() for d in out], [d.columns for d in out]


def test_stage_order_and_columns(stages):
    _, columns = stages
    assert all(c == columns[0] for c in columns[:-1])
    assert [n for n, _ in C.STAGES] == ["quality_classifier", "near_duplicates", "decontamination",
                                        "personal_data", "encoding"]


def test_quality(spark, stages):
    data, _ = stages
    kept = {r["doc_id"] for r in data[1]}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    poor = [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in good) > 0.9 * len(good)
    assert sum(i in kept for i in poor) < 0.3 * max(1, len(poor))


def test_near_duplicates(stages):
    data, _ = stages
    found = components([(r["doc_id"], r["text"]) for r in data[1]])
    assert sorted(r["doc_id"] for r in data[2]) == sorted({c for _, _, c in found})


def test_decontamination(spark, stages):
    data, _ = stages
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    found = benchmark_hits([(r["doc_id"], r["text"]) for r in data[2]], items)
    assert sorted(r["doc_id"] for r in data[3]) == sorted(i for i, _, hit, _, _ in found if not hit)


def test_personal_data(stages):
    data, _ = stages
    before = {r["doc_id"]: r for r in data[3]}
    assert len(data[4]) == len(before)
    for r in data[4]:
        assert not personal(r["text"]) and r["n_chars"] == len(r["text"])
        if not any(c.isdigit() or c == "@" for c in before[r["doc_id"]]["text"]):
            assert r["text"] == before[r["doc_id"]]["text"]


def test_encoding(stages):
    from tokenizers import Tokenizer

    from tidemark.llm import bpe
    t = Tokenizer.from_file(bpe.public_tokenizer())
    t.no_truncation()
    data, _ = stages
    texts = {r["doc_id"]: r["text"] for r in data[4]}
    assert sorted(texts) == sorted(r["doc_id"] for r in data[5])
    for r in data[5]:
        ids = t.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["token_ids"] == ids
        assert r["decoded_sha256"] == sha(t.decode(ids, skip_special_tokens=False))


def test_run_equals_its_stages(spark, stages):
    data, _ = stages
    assert sorted(C.run(spark, SF).collect()) == sorted(data[5])


def test_empty_tables_and_extra_columns(spark, tmp_path, docs):
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for _, stage in C.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0
    odd = docs.selectExpr("*", "1 as fp", "2 as n_words", "'x' as e", "3 as part")
    for name, stage in C.STAGES[:-1]:
        got = stage(spark, odd, SF)
        assert got.columns == odd.columns, name
        assert 0 < got.count() <= odd.count()
