"""Spelling variants against a plain version."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from daytally.llm import queries, spelling
from tests.conftest import SF001, SF01
from tests.llm import brute


def rows_of(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=str)


def test_query_against_plain_version(spark):
    for folder in (SF001, SF01):
        docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
        counts = {w: n for w, n in brute.corpus_words(docs).items() if len(w) >= 6 and n >= 5}
        got = rows_of(queries.queries()["op12_spelling_variants"](spark, folder))
        assert got == brute.spelling(counts)
    assert len(got) > 1000 and sum(r[1] is not None for r in got) > 100


def test_random_words(spark):
    rnd = random.Random(8)
    for letters, n in (("ab", 120), ("abcdef", 300), ("aé\U0001f600", 150)):
        words = {"".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 9))): rnd.choice([1, 2, 5, 9, 30, 160, 900])
                 for _ in range(n)}
        df = spark.createDataFrame([(w, k, "x", True) for w, k in words.items()], "word string, n long, best string, first boolean")
        assert rows_of(spelling.variants(df)) == brute.spelling(words)


def test_one_range_of_many_words(spark):
    """Words that differ at one place only: every one is near all others, and no pair is made."""
    words = {"hot" + chr(0x4E00 + i) + "spot": 10 + i for i in range(3000)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r.word: r for r in spelling.variants(df).collect()}
    assert {r.n_near for r in got.values()} == {2999}
    top = "hot" + chr(0x4E00 + 2999) + "spot"
    assert all(r.form == (top if r.n * 5 <= 3009 else None) for w, r in got.items())


def test_chain_of_forms_and_ties(spark):
    words = {"abcdefg": 1, "abcdef": 5, "abcdee": 25, "abcdxe": 125, "abcyxe": 625, "abc": 5, "abd": 25, "abe": 25}
    got = {r.word: r for r in spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")).collect()}
    assert got["abcdefg"].root == "abcyxe" and got["abcdefg"].form == "abcdef" and got["abcyxe"].form is None
    assert got["abc"].form == "abd" and got["abc"].n_near == 2 and got["abd"].root == "abd"


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (3, "Straße STRASSE Élan élan Àé×÷ 123"), (None, "straße"), (4, "straße straße"), (4, "straße straße")]
    docs = spark.createDataFrame([(d, t, "i", "r") for d, t in rows], "doc_id long, text string, id string, run string")
    runs = spelling.lowered_runs(docs).collect()
    assert Counter(r.run for r in runs) == {"straße": 6, "strasse": 1, "Élan": 1, "élan": 1, "Àé×÷": 1}
    every = spelling.misspelt(F.col("id"), F.col("run"), 2)
    got = spelling.lowered_runs(docs).select(every.alias("word")).collect()
    assert Counter(r.word for r in got) == brute.corpus_words(rows, 2)
    none = spelling.counted(spelling.lowered_runs(docs.limit(0)).select(F.col("run").alias("word")))
    assert spelling.variants(none).count() == 0
