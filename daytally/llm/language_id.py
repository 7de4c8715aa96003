"""Language identification with a presence string kernel.

The blended-spectrum presence kernel of two texts counts the distinct character n-grams, of all
lengths 1 to ``MAX_N`` together, that occur in both, divided by the root of the product of their
numbers of distinct n-grams.  n-grams are those of the lower-cased letters with single spaces
between words, hashed to ``DIM`` presence bits.

Training takes a bounded sample (about ``TRAIN_ROWS`` labelled rows, an equal share of every language,
by a hash of text and label).  Equal texts of a language are one row of it, however many copies there
are: the shares are of distinct texts, and copies are joined on the executors before anything is sent.  ``LANDMARKS``
rows of the sample are Nyström landmarks, and one kernel ridge regression per language (one against
the rest) is solved on the landmark kernel.  The presence bits of the sample are computed on the
executors; the driver solves one system of the landmarks' size.

Scoring covers every whole text: presence rows of a batch times the landmarks (a batched matrix
product) give the kernel block, times the coefficients the scores.  Only the text is read.

Defined cases: a null text or one without a letter is ``und`` with score 0; ties take the first
language in sort order; rows with a null label are never trained on but are scored; without any
labelled row every text is ``und``.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.llm import bytes_np as B
from daytally.llm import chars

DIM = 1 << 14
MAX_N = 4
TRAIN_ROWS = 2400
LANDMARKS = 320
RIDGE = 1e-3
SHARPNESS = 6.0
UNKNOWN = "und"


def presence(column: pa.Array, limit: int = 1 << 20, rows: int = 256) -> Iterator[np.ndarray]:
    """Presence bits (rows x DIM, uint8) of successive groups of texts."""
    for group in text_groups(column, limit, rows):
        points, offsets = chars.code_points(group)
        low, doc = chars.letter_runs(points, offsets)
        bits = np.zeros((len(group), DIM), dtype=np.uint8)
        flat = bits.reshape(-1)
        for n in range(1, MAX_N + 1):
            value, of = chars.ngrams(low, doc, n)
            flat[of * DIM + (value >> np.uint64(64 - 14)).astype(np.int64)] = 1
        # A text without a letter is one run of spaces.
        letters = np.bincount(doc[low != 0x20], minlength=len(group)) > 0
        bits[~letters] = 0
        yield bits


def text_groups(column: pa.Array, limit: int, rows: int) -> Iterator[pa.Array]:
    """The column in slices of at most ``rows`` texts and about ``limit`` bytes (a longer text stands alone)."""
    _, offsets = B.text_bytes(column)
    for i, j in B.chunks(offsets, limit):
        for a in range(i, j, rows):
            yield column.slice(a, min(rows, j - a))


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray
    """Packed presence bits of the landmarks."""
    weights: np.ndarray
    """Landmarks x languages, scaled by the landmarks' norms."""

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    def __init__(self, model: Model):
        self.languages, self.weights = model.languages, model.weights.astype(np.float32)
        self.landmarks = np.unpackbits(model.landmarks, axis=1).astype(np.float32).T.copy()

    def __call__(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        names: list[str] = []
        scores = []
        for bits in presence(column):
            block = bits.astype(np.float32)
            size = block.sum(axis=1)
            # Columns of absent n-grams add nothing: two dense products per group of texts.
            kernel = block @ self.landmarks
            raw = (kernel @ self.weights) / np.sqrt(np.maximum(size, 1))[:, None]
            odds = np.exp(SHARPNESS * (raw - raw.max(axis=1, keepdims=True)))
            share = odds / odds.sum(axis=1, keepdims=True)
            best = raw.argmax(axis=1)
            known = size > 0
            names += [self.languages[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
            scores.append(np.where(known, share[np.arange(len(best)), best], 0.0).astype(np.float64))
        return names, np.concatenate(scores) if scores else np.zeros(0)


def _sample(rows: DataFrame, limit: int) -> DataFrame:
    """About ``limit`` distinct (text, label) rows, an equal share of each language, by hash order.

    A language's rows are counted by their hashes in a fixed-size sketch per task; a language with no
    more distinct texts than its share is taken whole.
    """
    rows = rows.select("text", "label", F.xxhash64("label", "text").alias("key"))
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.approx_count_distinct("key", 0.02).alias("n")).collect()}
    if not sizes:
        return rows.select("text", "label").limit(0)
    share = limit / len(sizes)
    rate = F.create_map(*(F.lit(x) for label, n in sorted(sizes.items())
                          for x in (label, 1.0 if n <= 1.2 * share else share / n)))
    drawn = rows.filter(F.pmod("key", F.lit(1 << 30)) / float(1 << 30) < rate[F.col("label")])
    return drawn.groupBy("label", "key").agg(F.min("text").alias("text")).select("text", "label")


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "lang", rows: int = TRAIN_ROWS,
          landmarks: int = LANDMARKS) -> Model | None:
    """Fit on a bounded sample of the labelled rows; None if there are none."""
    chosen = _sample(labelled.select(F.col(text_col).alias("text"), F.col(label_col).alias("label"))
                     .filter("label IS NOT NULL AND text IS NOT NULL"), rows)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [row.tobytes() for bits in presence(batch.column(0)) for row in np.packbits(bits, axis=1)]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column(1)], ["bits", "label"])

    drawn = [(bytes(r["bits"]), r["label"]) for r in
             chosen.select("text", "label").mapInArrow(features, "bits binary, label string").distinct().collect()]
    # The order of arrival differs between runs; the bits themselves give a fixed one.
    drawn = sorted(((B.mix(np.frombuffer(b, np.uint64)).sum(), b, lang) for b, lang in drawn if any(b)),
                   key=lambda x: (int(x[0]), x[1], x[2]))
    if not drawn:
        return None
    names = sorted({lang for _, _, lang in drawn})
    packed = np.frombuffer(b"".join(b for _, b, _ in drawn), np.uint8).reshape(len(drawn), -1)
    target = np.array([names.index(lang) for _, _, lang in drawn])
    each = math.ceil(landmarks / len(names))
    marks = np.concatenate([np.flatnonzero(target == k)[:each] for k in range(len(names))])
    norm = np.sqrt(np.bitwise_count(packed).sum(axis=1, dtype=np.int64).astype(np.float64))
    of_marks = (np.unpackbits(packed[marks], axis=1).astype(np.float32) / norm[marks, None].astype(np.float32)).T
    # A block of rows is unpacked at a time: the driver holds the bits and the kernel's values.
    k_nm = np.concatenate([np.unpackbits(packed[i : i + 256], axis=1).astype(np.float32) @ of_marks
                           for i in range(0, len(packed), 256)]).astype(np.float64) / norm[:, None]
    k_mm = k_nm[marks]
    y = np.where(target[:, None] == np.arange(len(names)), 1.0, -1.0)
    # Languages weigh alike whatever their share of the sample.
    weight = 1.0 / np.maximum(np.bincount(target, minlength=len(names)), 1)[target]
    weight *= len(target) / weight.sum()
    system = k_nm.T @ (k_nm * weight[:, None]) + RIDGE * len(target) * (k_mm + 1e-6 * np.eye(len(marks)))
    alpha = np.linalg.lstsq(system, k_nm.T @ (y * weight[:, None]), rcond=None)[0]
    return Model(names, packed[marks], alpha / norm[marks][:, None])


def identify(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``."""
    names = [c for c in docs.columns if c not in ("lang_pred", "score")]
    docs = docs.select(*names)
    place = names.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer() if shared.value else None
        for batch in batches:
            if scorer:
                langs, scores = scorer(batch.column(place))
            else:
                langs, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                [*names, "lang_pred", "score"])

    return docs.mapInArrow(predict, T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()),
                                                  T.StructField("score", T.DoubleType())]))


def keep_rows(docs: DataFrame, model: Model | None, languages: Iterable[str] | None = None,
              text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, unchanged, whose text the model gives one of ``languages`` (default: any it has learned).

    Texts without a letter go.  Without a model no language is known, and every text with a letter stays.
    """
    if model is None:
        return with_letters(docs, text_col)
    place, wanted = docs.columns.index(text_col), set(model.languages if languages is None else languages) - {UNKNOWN}
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer()
        for batch in batches:
            langs = scorer(pc.struct_field(batch.column(0), place))[0]
            yield batch.filter(pa.array([lang in wanted for lang in langs], pa.bool_()))

    rows = nested(docs)
    return rows.mapInArrow(keep, rows.schema).select("row.*")


def nested(docs: DataFrame) -> DataFrame:
    """Each row as one struct column, ``row``: no name of the caller's meets one of the operator's."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def with_letters(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows whose text has a letter: those that any model gives a language."""
    place = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros(0, bool)]
            for group in text_groups(pc.struct_field(batch.column(0), place), 1 << 20, 4096):
                points, offsets = chars.code_points(group)
                doc = np.repeat(np.arange(len(group)), np.diff(offsets))
                found.append(np.bincount(doc[chars.letters()[points] != 0x20], minlength=len(group)) > 0)
            yield batch.filter(pa.array(np.concatenate(found)))

    rows = nested(docs)
    return rows.mapInArrow(keep, rows.schema).select("row.*")


def held_out(id_col: str, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text falls on ``part`` of ``parts`` (a null id counts as an empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part
