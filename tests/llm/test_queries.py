"""The registered llm queries on the small tables, against SQL, brute force, round trips and held-out labels."""

from __future__ import annotations

import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest

import corpus_pipeline
from daytally.llm import oracle, queries
from tests.conftest import SF001, SF01
from tests.llm import brute


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def docs(duck):
    return duck.execute("SELECT doc_id, text FROM documents").fetchall()


def frame(spark, name, sf=SF001):
    return queries.queries()[name](spark, sf).toPandas()


def plain(x):
    """A value without pandas's kinds of missing numbers and whole floats."""
    if x is None or pd.isna(x):
        return None
    return int(x) if isinstance(x, float) and x.is_integer() else x


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_sql_oracles(spark, duck, name):
    got = frame(spark, name)
    want = duck.execute(oracle.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cols = sorted(got.columns)
    rows = [sorted((tuple(plain(x) for x in r) for r in f[cols].itertuples(index=False)), key=str) for f in (got, want)]
    assert rows[0] == rows[1]


def test_exact_dedup_brute(spark, docs):
    got = frame(spark, "op3_exact_dedup")
    rows = got[["doc_id", "keep_id", "group_size", "kept", "text_sha256"]].itertuples(index=False, name=None)
    assert sorted(rows, key=str) == brute.exact(docs)


def test_decontamination_brute(spark, duck, docs):
    want = brute.contamination(docs, duck.execute("SELECT item_id, text FROM benchmark").fetchall())
    got = frame(spark, "op9_decontamination")
    assert len(got) == len(docs) and got.contaminated.sum() > 0
    for r in got.itertuples():
        words, hit, items = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (
            words, hit, len(items), brute.sha(",".join(items)), hit > 0)


def test_near_dup_brute(spark, docs):
    want = brute.near(docs, 2)
    got = frame(spark, "op10_minhash_near_dup")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == want
    assert (got.kept == (got.doc_id == got.component_id)).all()


def test_near_dup_brute_on_more_documents(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF01}/documents.parquet'").fetchall()
    got = frame(spark, "op10_minhash_near_dup", SF01)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.itertuples()} == brute.near(rows, 2)


def test_suffix_dedup_brute(spark, docs):
    got = frame(spark, "op7_suffix_dedup")
    rows = got[["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]].itertuples(index=False, name=None)
    want = brute.repeats(docs)
    assert sum(r[2] for r in want) > 0
    assert sorted(rows) == sorted(want)


def test_pii_base_brute(spark, docs):
    texts = dict(docs)
    got = frame(spark, "op5_pii")
    found = 0
    for r in got.itertuples():
        base = brute.personal(texts[r.doc_id])
        found += len(base)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == brute.sha(joined)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, _, _ in base)
                                                            for x in ("email", "ip", "card", "phone")]
        spans = [s for s in r.spans.split(",") if s]
        assert set(joined.split(",")) - {""} <= set(spans)
        added = [s for s in spans if s not in joined.split(",")]
        for s in added:  # the method adds secrets, and only what is one
            kind, a, b = s.split(":")
            part = texts[r.doc_id][int(a) : int(b)]
            assert kind == "secret" and any(w in part for w in ("password=", "token = ", "AKIA")), part
    assert found > 0


def test_pii_finds_the_planted_secrets(spark):
    import re

    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF01}/documents.parquet'").fetchall()
    spans = {r.doc_id: r.spans for r in frame(spark, "op5_pii", SF01).itertuples()}
    planted = [(d, m.start()) for d, t in docs for m in re.finditer(r"password=[0-9a-f]{18}|AKIA[A-Z0-9]{16}|token = \"", t)]
    assert planted
    for d, at in planted:
        assert f"secret:{at}:" in spans[d]


def test_packing_round_trip(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = frame(spark, "op2_best_fit_packing")
    pieces = defaultdict(list)
    for r in got.itertuples():
        pieces[r.doc_id].append(r)
    assert len(pieces) == len(docs)
    for doc_id, text in docs:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        rows = sorted(pieces[doc_id], key=lambda r: r.piece)
        assert [r.piece for r in rows] == list(range(len(rows)))
        at = 0
        for r in rows:
            assert r.start == at and (r.length == 2048 or r.piece == 0)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    ordered = got.sort_values(["sequence_id", "offset"])
    ends = ordered.groupby("sequence_id").length.cumsum()
    assert (ends - ordered.length == ordered.offset).all() and ends.max() <= 2048
    least = -(-got.length.sum() // 2048)
    assert got.sequence_id.nunique() <= least * 1.02 + 2


def test_language_id_on_held_out_rows(spark, duck):
    langs = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    got = frame(spark, "op1_language_id")
    assert all(h == brute.held(d, 5, 0) for d, h in zip(got.doc_id, got.held_out, strict=True))
    held = got[got.held_out]
    assert (held.lang_pred == held.doc_id.map(langs)).mean() >= 0.95
    assert got.score.between(0, 1).all()


def test_toxicity_on_held_out_rows(spark):
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{SF01}/labels.parquet'").fetchall())
    got = frame(spark, "op8_toxicity", SF01)
    assert all(h == brute.held(d, 4, 2) for d, h in zip(got.doc_id, got.held_out, strict=True))
    held = got[got.held_out & got.doc_id.isin(labels)]
    truth = held.doc_id.map(labels)
    assert (held.predicted == truth).mean() >= 0.9
    assert held[truth == 1].score.mean() > 10 * held[truth == 0].score.mean()


def test_quality_ranks_good_documents_first(spark):
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF01}/labels.parquet'").fetchall())
    got = frame(spark, "op6_quality", SF01)
    assert len(got) == 1000 and got.score.between(0, 1).all()
    known = got[got.doc_id.isin(labels)]
    truth = known.doc_id.map(labels)
    assert (known.kept == (truth == 1)).mean() >= 0.95


def test_pipeline_against_its_stages_by_brute_force(spark, duck, docs):
    got = corpus_pipeline.run(spark, SF001).toPandas()
    left = {d: t for d, t in docs if any(c.isalpha() for c in t or "")}
    left = {r[0]: left[r[0]] for r in brute.exact(left.items()) if r[3]}
    components = brute.near(left.items(), 5)
    left = {d: t for d, t in left.items() if components[d][1] == d}
    hits = brute.contamination(left.items(), duck.execute("SELECT item_id, text FROM benchmark").fetchall())
    left = {d: t for d, t in left.items() if not hits[d][1]}
    assert 0 < len(left) < len(docs)
    assert set(got.doc_id) == set(left)
    assert got.groupby("sequence_id").length.sum().max() <= 2048


def test_pipeline_stages_keep_the_columns(spark):
    docs = queries.table(spark, SF001, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF001).columns == docs.columns
