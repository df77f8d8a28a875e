"""The corpus pipeline, stage by stage and as a whole."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline
from tillroll.llm import decontaminate, language

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


def test_stages_follow_each_other(spark, documents):
    docs, kept = documents, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == documents.columns
        docs = corpus_pipeline.Scratch(spark).cut(docs, name)
        kept[name] = texts(docs)
    before = texts(documents)
    assert set(kept["language_id"]) == {i for i, t in before.items() if re.search(r"[^\W\d_]", t or "")}
    for i, text in kept["line_dedup"].items():
        own = (before[i] or "").split("\n")
        assert set((text or "").split("\n")) <= set(own)
    assert len(set(kept["near_dup"].values())) == len(kept["near_dup"])
    windows = set()
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        words = decontaminate.words_of(r["text"].encode())
        windows |= {tuple(words[i : i + 10]) for i in range(max(1, len(words) - 9))}
    for text in kept["decontamination"].values():
        words = decontaminate.words_of((text or "").encode())
        assert not any(tuple(words[i : i + 10]) in windows for i in range(len(words) - 9))


def test_run_is_the_chain_of_the_stages(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.Scratch(spark).cut(stage(spark, docs, FOLDER), name)
    whole = corpus_pipeline.run(spark, FOLDER)
    key = ["doc_id", "copy", "taken", "text"]
    assert whole.columns == docs.columns
    assert sorted(map(tuple, whole.select(key).collect())) == sorted(map(tuple, docs.select(key).collect()))
    assert whole.count() > 0


def test_stages_take_awkward_documents(spark, documents):
    schema = "doc_id long, text string, lang string, source string, n_chars long, size string, a string"
    good = documents.filter("n_chars between 500 and 900").first()["text"]
    data = [
        (1, good, "en", "s", 1, "x", "x"), (2, good, None, None, None, None, None), (None, good, "en", "s", 1, "x", "x"),
        (3, None, "en", "s", 1, "x", "x"), (4, "", "en", "s", 1, "x", "x"), (4, "", "en", "s", 1, "x", "x"),
        (5, "123 !?", "en", "s", 1, "x", "x"), (6, good + " more", "en", "s", 1, "x", "x"),
    ]
    for rows in (data, []):
        frame = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, frame, FOLDER).count()
    kept = corpus_pipeline.language_id(spark, spark.createDataFrame(data, schema), FOLDER).collect()
    assert [r["doc_id"] for r in kept] == [1, 2, None, 6]
    assert language.UNKNOWN == "und"
