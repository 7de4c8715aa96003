"""Spelling variants of a corpus's words, by permuterm rotations.

Two words are near if they differ by exactly one inserted, deleted or replaced code point.  A word's
form is its most frequent near word, if that is at least ``RATIO`` times as frequent as the word.

1. Words are counted over all documents (partial counts leave the tasks, so a frequent word is
   one row per task), and words that are too short or too rare go.
2. Every word is marked with a terminator and rotated.  A rotation that ends with the code point to be
   edited has, as its prefix without that code point, the rest of the word read around the terminator.
   Words of one length that share this prefix differ by a replacement there; a word one shorter whose whole
   rotation equals the prefix differs by that deletion (or insertion, from its side).
3. Rotations are dealt and sorted by prefix, and each prefix's range is scanned once: a member's near
   words there are the others, and only their number and the best of them are emitted, never a pair.
   A deletion inside a run of equal code points counts at the run's first place only, so that a
   pair of words meets in one range exactly.
4. A word's ranges are added up; forms lead from word to word by ever larger counts, and roots are found
   by doubling the steps, in as many rounds as the logarithm of the longest chain.

A range's size is bounded by the alphabet; a longer one would still only be sorted and spilled.  All
steps are built-in functions; nothing is gathered on the driver or broadcast by hint.

Defined cases: a null text has no words; a null id has an empty decimal form; rows that repeat count
each; a tie in count takes the smallest word in code-point order; other columns take no part; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from daytally.llm.scratch import cut

WORD = "[A-Za-zÀ-ÿ]+"
END = "$"
"""The terminator: a code point that no word holds."""
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lowered_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", pattern: str = WORD) -> DataFrame:
    """(id, run): every maximal run of the pattern, A-Z lower-cased; one row per occurrence."""
    runs = F.regexp_extract_all(F.translate(F.col(text_col), _UPPER, _LOWER), F.lit(pattern), F.lit(0))
    return docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))


def misspelt(id_: Column, run: Column, every: int) -> Column:
    """``run``, without one code point where ``every`` divides the crc32 of ``<id>:<run>``."""
    number = F.crc32(F.concat(id_, F.lit(":"), run).cast("binary"))
    at = F.pmod(number, F.length(run)).cast("int")
    rest = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(number % every == 0, rest).otherwise(run)


def counted(words: DataFrame, word_col: str = "word", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of at least ``min_length`` code points and ``min_count`` occurrences."""
    return (words.select(F.col(word_col).alias("word")).filter(F.length("word") >= min_length)
            .groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count))


def rotations(words: DataFrame) -> DataFrame:
    """(prefix, word, n, whole, first) of all rotations of the marked words.

    ``whole``: the rotation itself.  Otherwise the rotation without its last code point, the edited one;
    ``first``: that code point differs from the one before it in the word.
    """
    size, word = F.length("word"), F.col("word")
    # At place k the rotation starts behind the first k code points: word[k:] END word[:k].
    turned = F.concat(F.substring(word, F.col("k") + 1, size), F.lit(END), F.substring(word, F.lit(1), F.col("k")))
    last, before = F.substring(word, F.col("k"), F.lit(1)), F.substring(word, F.col("k") - 1, F.lit(1))
    each = words.select("word", "n", F.explode(F.sequence(F.lit(0), size)).alias("k"))
    both = each.select(
        "word", "n", turned.alias("turned"), F.col("k"),
        ((F.col("k") == 1) | (last != before)).alias("first"),
        F.explode(F.when(F.col("k") > 0, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))).alias("whole"))
    # Both kinds of row share the sort key: a rotation, and a rotation but for its last code point.
    prefix = F.when(F.col("whole"), F.col("turned")).otherwise(F.expr("substring(turned, 1, length(turned) - 1)"))
    return both.select(prefix.alias("prefix"), "word", "n", "whole", (F.col("first") & ~F.col("whole")).alias("first"))


def neighbours(words: DataFrame) -> DataFrame:
    """(word, n_near, best) of the words (word, n) with a near word; best: struct (less = -n, word)."""
    me = F.struct((-F.col("n")).alias("less"), F.col("word"))
    span = W.partitionBy("prefix")
    # The range in order: rotations with the code point edited away, most frequent first, then the shorter word.
    ordered = (span.orderBy("whole", F.col("n").desc(), "word")
               .rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    ranges = rotations(words).select(
        "word", "whole", "first", me.alias("me"),
        F.count_if(~F.col("whole")).over(span).alias("long"),
        F.count_if("first").over(span).alias("edits"),
        F.max(F.when(F.col("whole"), me)).over(span).alias("short"),
        F.min(F.when(F.col("first"), me)).over(span).alias("best_edit"),
        F.first(F.when(~F.col("whole"), me)).over(ordered).alias("one"),
        F.nth_value(F.when(~F.col("whole"), me), 2).over(ordered).alias("two"))
    other = F.when(F.col("one") == F.col("me"), F.col("two")).otherwise(F.col("one"))
    shorter = F.when(F.col("first"), F.col("short"))
    found = ranges.select(
        "word",
        F.when(F.col("whole"), F.col("edits"))
        .otherwise(F.col("long") - 1 + F.col("first").cast("int") * F.col("short").isNotNull().cast("int")).alias("near"),
        F.when(F.col("whole"), F.col("best_edit")).otherwise(F.least(other, shorter)).alias("best"))
    return found.filter("near > 0").groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form (columns word, form): the last of the chain of forms."""
    links = cut(forms.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = cut(links.join(ahead, "root", "left")
                      .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        links = stepped.select("word", "root")
        if stepped.filter("moved").isEmpty():
            return links


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per word (columns word, n): word, form, root, n, n_near, form_n."""
    words = cut(words.select("word", "n"), "words")
    best = F.col("best")
    fits = -best["less"] >= ratio * F.col("n")
    known = cut(words.join(neighbours(words), "word", "left")
                .select("word", F.when(fits, best["word"]).alias("form"), "n",
                        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                        F.when(fits, -best["less"]).alias("form_n")), "variants")
    return (known.join(roots(known), "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
