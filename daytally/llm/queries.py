"""The llm operators bound to the provided tables: one query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.llm import (byte_bpe, decontam, exact_dedup, fim, language_id, near_dup, packing, pii, quality, spelling,
                          suffix_dedup, toxicity, url_filter)
from daytally.llm.ship import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> dict[str, str]:
    """The public byte-level BPE vocabulary's file, and the same vocabulary as byte ranks."""
    import public_tokenizers as tokenizers

    return {"path": tokenizers.path("byte_bpe_50k.json"), "ranks_path": tokenizers.path("byte_bpe_50k.tiktoken"),
            "pattern": tokenizers.PATTERN}


def joined_sha256(parts: Column) -> Column:
    """Lower-case hex of the parts joined by commas."""
    return F.sha2(F.array_join(parts, ",").cast("binary"), 256)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = language_id.held_out("doc_id", 5, 0)
    model = language_id.train(docs.filter(~held))
    rows = docs.select("doc_id", held.alias("held_out"), "text")
    return language_id.identify(rows, model).drop("text")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), **vocabulary())


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts, F.sha2(pii.joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        pii.joined(F.col("spans")).alias("spans"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_text=True)
    # What remains, as text: a character that a cut has divided reads as U+FFFD.
    kept = F.make_valid_utf8(F.col("kept").cast("string")).alias("kept_text")
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", kept)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(~language_id.held_out("doc_id", 4, 2)))
    rows = docs.select("doc_id", language_id.held_out("doc_id", 4, 2).alias("held_out"), "text")
    return toxicity.score(rows, model).drop("text").withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                        joined_sha256(F.col("item_ids")).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op10_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim.transform(table(spark, sf_dir, "documents"))
    restored = fim.restore(F.col("output"), F.col("form"))
    return cut.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"),
                      F.col("middle_units").alias("middle_chars"),
                      F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                      F.sha2(restored.cast("binary"), 256).alias("restored_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = spelling.lowered_runs(table(spark, sf_dir, "documents"))
    words = runs.select(spelling.misspelt(F.col("id"), F.col("run"), 199).alias("word"))
    return spelling.variants(spelling.counted(words))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as tokenizers

    own = {"path": tokenizers.path("byte_bpe_multi_50k.tiktoken"), "pattern": tokenizers.PATTERN}
    rows = byte_bpe.decode(byte_bpe.encode(table(spark, sf_dir, "documents"), **own), **own)
    return rows.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_language_id, op2_best_fit_packing, op3_exact_dedup, op4_url_filter, op5_pii, op6_quality, op7_suffix_dedup,
        op8_toxicity, op9_decontamination, op10_minhash_near_dup, op11_fill_in_middle, op12_spelling_variants, op13_byte_bpe)}
