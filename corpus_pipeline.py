"""The corpus pipeline: language id, exact dedup, near dedup, decontamination, packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; its result
is written as Parquet and reread as the next one's docs.  All but the last return the columns
of ``documents``; the last returns the packed pieces.  The last cannot be expressed in SQL, nor
can language id and near dedup, so ``ORACLE_SQL`` is None and the tests hold ``run`` against a
brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daytally.llm import decontam, exact_dedup, language_id, near_dup, packing
from daytally.llm.queries import table, vocabulary
from daytally.llm.scratch import cut, temporary
from daytally.llm.ship import ship

ORACLE_SQL: str | None = None

LANGUAGES: tuple[str, ...] | None = None
"""The languages that the first stage lets pass; None: all that the corpus's own labels name."""


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents stay whose text the model gives one of ``LANGUAGES``; texts without a letter have none and go.

    The model learns from the rows with a language label; their columns stay as they are.  Without
    a row to learn from no language is known, and every text with a letter stays.
    """
    ship(spark)
    return language_id.keep_rows(docs, language_id.train(docs), LANGUAGES)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    ship(spark)
    return exact_dedup.keep_rows(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8) stays."""
    ship(spark)
    return near_dup.keep_rows(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontam.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents' pieces with their place in the packed sequences."""
    ship(spark)
    return packing.pack(docs, **vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written to the shared folder.

    The tables that a stage cuts on its way are deleted once its result is written.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with temporary(spark):
            docs = cut(stage(spark, docs, sf_dir), name, keep=True)
    return docs
