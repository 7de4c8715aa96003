"""Filtering operators and pipeline stages leave the caller's columns as they are, whatever their names."""

from __future__ import annotations

import pytest

import corpus_pipeline
from daytally.llm import decontam, exact_dedup, language_id, near_dup
from daytally.llm.ship import ship
from tests.conftest import SF001

NAMES = ["score", "lang_pred", "_sha", "_chars", "_copies", "_words", "_hits", "_items", "_runs", "row", "id", "sha", "chars",
         "keep_id", "keep_rows", "text_sha256", "_gone", "bits", "key", "mine", "own", "doc.id"]
TEXTS = ["the cat sat on the mat and the dog ran off", "the cat  sat on the mat and the dog ran off", "le chien dort sous la table",
         None, "", "123", "der Hund schläft unter dem Tisch und der Kater"]


@pytest.fixture(scope="module")
def docs(spark):
    ship(spark)
    rows = [(i, t, "en", *(f"{n} {i}" for n in NAMES)) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, " + ", ".join(f"`{n}` string" for n in NAMES))


def kept(df, docs):
    assert df.columns == docs.columns
    rows = df.collect()
    for r in rows:
        assert [r[n] for n in NAMES] == [f"{n} {r.doc_id}" for n in NAMES] and r.text == TEXTS[r.doc_id]
    return sorted(r.doc_id for r in rows)


def test_exact_dedup(docs):
    assert kept(exact_dedup.keep_rows(docs), docs) in ([1, 2, 3, 5, 6], [1, 2, 4, 5, 6])


def test_decontamination(spark, docs):
    items = spark.createDataFrame([("a", "le chien dort"), ("b", "nothing of this")], "item_id string, text string")
    for block in (1, 200_000):
        assert kept(decontam.clean_rows(docs, items, block_windows=block), docs) == [0, 1, 3, 4, 5, 6]
    found = decontam.contamination(docs, items, block_windows=1).collect()
    assert sorted((r.doc_id, r.n_hit) for r in found) == [(0, 0), (1, 0), (2, 3), (3, 0), (4, 0), (5, 0), (6, 0)]


def test_near_dup(docs):
    assert kept(near_dup.keep_rows(docs), docs) == [0, 2, 3, 4, 5, 6]


def test_language_id(docs):
    assert kept(language_id.keep_rows(docs, language_id.train(docs)), docs) == [0, 1, 2, 6]
    assert kept(language_id.keep_rows(docs, None), docs) == [0, 1, 2, 6]


def test_pipeline_stages(spark, docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert kept(stage(spark, docs, SF001), docs)
