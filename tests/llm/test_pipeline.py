"""The pipeline's stages against brute force on a small table."""

import re

import pytest

import corpus_pipeline
from showbill.llm import bpe

EN = "this is the house that the man built with the help of his friends and the stone of the hill "


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    rows = []
    for i in range(120):
        own = " ".join(f"w{i}x{k}" for k in range(40))
        rows.append((i, f"{EN}{own} {'you blorgish fool' if i % 6 == 0 else 'you gentle friend'}", "en", f"s{i % 3}", 1))
    rows += [(200, rows[1][1].replace(" ", "\n"), "en", "s0", 1), (201, rows[2][1] + " more", "en", "s1", 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 6 == 0)) for i in range(120)], "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        seen[name] = docs
        if name != "bpe":
            assert docs.columns == columns
    ids = {n: sorted(r["doc_id"] for r in df.select("doc_id").collect()) for n, df in seen.items()}
    clean = [i for i in range(120) if i % 6] + [200, 201]
    assert ids["toxicity"] == clean
    assert ids["exact_dedup"] == [i for i in clean if i != 200]
    assert ids["near_dedup"] == [i for i in clean if i < 200]
    assert set(ids["mixing"]) <= set(ids["near_dedup"]) and ids["bpe"] == ids["mixing"]
    own = bpe.Codec(bpe.vocabulary_path())
    texts = {r["doc_id"]: r["text"] for r in seen["mixing"].collect()}
    assert {r["doc_id"]: r["n_tokens"] for r in seen["bpe"].collect()} == {i: len(own.encode(t)) for i, t in texts.items()}
    size = lambda rows: sum(len(re.findall(r"\S+", r["text"])) for r in rows)
    assert abs(size(seen["mixing"].collect()) / size(seen["near_dedup"].collect()) - 1.5) < 0.1
