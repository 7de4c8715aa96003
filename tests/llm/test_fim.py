"""Fill-in-the-middle against a plain version, and texts rebuilt exactly."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from daytally.llm import fim, queries
from tests.conftest import SF001
from tests.llm import brute

MARKED = ["<P", "<S>", "x<M>y", "<", "P>", "<<S", "<P<P"]


def made(spark, rows, **options):
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string, form string, output int, digest int, a int")
    got = fim.transform(docs, **options)
    return got.withColumn("restored", fim.restore(F.col("output"), F.col("form"), options.get("marks", fim.MARKS))).collect()


def wide(rows):
    return [(d, t, "x", "y", 1, 2, 3) for d, t in rows]


def test_query_against_plain_version(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.queries()["op11_fill_in_middle"](spark, SF001).collect()}
    assert len(got) == len(docs) and {r.form for r in got.values()} == {"plain", "psm", "spm"}
    for doc_id, text in docs:
        n, form, prefix, middle, output = brute.middle_filled(doc_id, text)
        r = got[doc_id]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert (r.output_sha256, r.restored_sha256) == (brute.sha(output), brute.sha(text or ""))


def test_random_texts_and_defined_cases(spark):
    rnd = random.Random(3)
    pool = ["a", "$1", "\\", "é", "\U0001f600", "\n", "\r\n", "\u0085", " ", "\x00", " ", "日", "é", *MARKED]
    rows = [(i, "".join(rnd.choice(pool) for _ in range(rnd.randrange(12)))) for i in range(600)]
    rows += [(i, "".join(rnd.choice(pool[:12]) for _ in range(rnd.randrange(900, 3200)))) for i in range(600, 640)]
    rows += [(700, None), (701, ""), (None, "no id at all"), (702, "repeated"), (702, "repeated")]
    got = made(spark, wide(rows))
    assert len(got) == len(rows)
    want = sorted((str((d, *brute.middle_filled(d, t), t or "")) for d, t in rows))
    assert sorted(str((r.doc_id, r.n, r.form, r.prefix_units, r.middle_units, r.output, r.restored)) for r in got) == want
    assert made(spark, []) == []


def test_very_long_text(spark):
    text = "é\U0001f600x\n" * 500_000
    (r,) = made(spark, wide([(5, text)]))
    assert (r.n, r.form, r.prefix_units, r.middle_units, r.output) == brute.middle_filled(5, text) and r.restored == text


def test_other_units_and_marks(spark):
    rows = [(i, "one two  three four\nfive six"[: i + 3]) for i in range(24)] + [(99, " leads with space")]
    for r in made(spark, wide(rows), unit=r"\S+\s*", marks=("$p\\", "[s]", "(m)"), plain_from=100):
        text = dict(rows)[r.doc_id]
        assert r.restored == text
        assert r.n == (0 if text.startswith(" ") else len(text.split()))
        if r.form != "plain":
            first = {"psm": "$p\\", "spm": "[s]"}[r.form]
            assert r.output.startswith(first) and sorted(r.output) == sorted(text + "$p\\[s](m)")
    for bad in (("<P>", "<P>", "<M>"), ("", "a", "b"), ("aba", "x", "y"), ("ab", "bc", "x"), ("a", "cad", "x")):
        with pytest.raises(ValueError):
            fim.transform(spark.createDataFrame([], "doc_id long, text string"), marks=bad)
