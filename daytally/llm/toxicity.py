"""Toxicity scores from a linear classifier over character n-grams with naive Bayes scaling.

Features are the presence of character n-grams (``MIN_N`` to ``MAX_N`` lower-cased letters, with a
space at each word edge), hashed to ``DIM``.  Two passes over a bounded labelled sample fit it:

1. document counts of every n-gram per label give the log-count ratios
   r = log((p / |p|) / (q / |q|)); the ``FEATURES`` n-grams whose ratio is largest against its standard
   error are kept;
2. the sample's presence rows, scaled by r, train a logistic regression.

The sample takes at most about ``TRAIN_ROWS`` labelled rows, half of each label where there are
enough, by a hash of id and label; weights restore the labels' true shares.  Counting and the
presence rows are computed on the executors, and the features are chosen there too; the driver sees the
``FEATURES`` chosen sums and packed bits only.  No n-gram is too rare to count.
Scoring reads every whole text and nothing but the text.

Defined cases: null and empty texts have no n-gram and get the intercept's score; null labels and
null ids are never trained on; a document with several label rows counts once per row; without
labelled rows of both kinds every text scores the share of label 1 (0 without labels).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.llm import bytes_np as B
from daytally.llm import chars
from daytally.llm.language_id import text_groups
from daytally.llm.linear import fit_logistic_bits, sigmoid
from daytally.llm.scratch import cut

DIM_BITS = 20
DIM = 1 << DIM_BITS
MIN_N, MAX_N = 4, 8
TRAIN_ROWS = 16_000
FEATURES = 2048
RIDGE = 0.1
_GRAM = np.uint64(0x1FFFFFB)


def grams(column: pa.Array, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, feature) pairs of a group of texts; ``wanted`` maps a hash to a feature or -1."""
    points, offsets = chars.code_points(column)
    low, doc = chars.letter_runs(points, offsets)
    docs, features = [], []
    value = low.astype(np.uint64)
    for n in range(2, MAX_N + 1):
        if len(low) < n:
            break
        value = value[:-1] * _GRAM + low[n - 1 :]
        if n < MIN_N:
            continue
        found = wanted[(B.mix(value + np.uint64(n << 56)) >> np.uint64(64 - DIM_BITS)).astype(np.int64)]
        some = np.flatnonzero(found >= 0)
        some = some[doc[some] == doc[some + n - 1]]
        docs.append(doc[some])
        features.append(found[some])
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.unique(np.concatenate(docs) * DIM + np.concatenate(features))
    return pairs // DIM, pairs % DIM


@dataclass
class Model:
    wanted: np.ndarray
    """Feature number of each hash, or -1 (int16)."""
    weights: np.ndarray
    intercept: float

    def score(self, column: pa.Array) -> np.ndarray:
        out = []
        for group in text_groups(column, 1 << 20, 4096):
            doc, feature = grams(group, self.wanted)
            out.append(sigmoid(self.intercept + np.bincount(doc, self.weights[feature], minlength=len(group))))
        return np.concatenate(out) if out else np.zeros(0)


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, rows: int, id_col: str = "doc_id",
                    text_col: str = "text") -> tuple[DataFrame, dict[int, float]]:
    """(text, label) of a bounded sample, and each label's sampling rate.

    The sampled label rows, at most about ``rows``, are small enough to broadcast, so the
    documents are read once and not shuffled.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label")).filter(
        "_id IS NOT NULL AND label IN (0, 1)")
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    small = min(sizes.values(), default=0)
    share = {k: min(n, max(rows // 2, rows - small)) for k, n in sizes.items()}
    rates = {k: share[k] / sizes[k] for k in sizes}
    draw = F.pmod(F.xxhash64("_id", "label"), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.filter(draw <= F.when(F.col("label") == 1, rates.get(1, 0.0)).otherwise(rates.get(0, 0.0)))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(chosen), "_id").select("text", "label"), rates


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", rows: int = TRAIN_ROWS,
          features: int = FEATURES, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on a bounded sample of the labelled documents."""
    sample, rates = labelled_sample(docs, labels, label_col, rows, id_col, text_col)
    every = np.arange(DIM, dtype=np.int32)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((2, DIM), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            label = np.asarray(batch.column(1).to_pylist(), dtype=np.int64)
            at = 0
            for group in text_groups(batch.column(0), 1 << 20, 4096):
                doc, feature = grams(group, every)
                mine = label[at : at + len(group)]
                at += len(group)
                for k in (0, 1):
                    total[k] += np.bincount(feature[mine[doc] == k], minlength=DIM)
                    seen[k] += int((mine == k).sum())
        some = np.flatnonzero(total.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0][some]), pa.array(total[1][some])],
                                         ["feature", "q", "p"])
        yield pa.RecordBatch.from_arrays([pa.array([-1]), pa.array(seen[:1]), pa.array(seen[1:])],
                                         ["feature", "q", "p"])

    sums = cut(sample.mapInArrow(count, "feature long, q long, p long")
               .groupBy("feature").agg(F.sum("q").alias("q"), F.sum("p").alias("p")), "grams")
    seen = sums.filter("feature < 0").select("q", "p").first()
    n_q, n_p = (int(seen["q"]), int(seen["p"])) if seen else (0, 0)
    none = Model(np.full(DIM, -1, np.int16), np.zeros(1), -40.0)
    if not n_q or not n_p:
        share = n_p / max(1, n_q + n_p)
        none.intercept = float(np.log((share + 1e-17) / (1 - share + 1e-17)))
        return none
    sums = sums.filter("feature >= 0")
    # The norms cover every n-gram of the sample, the kept ones and the others.
    norm = sums.agg(F.sum("q").alias("q"), F.sum("p").alias("p"), F.count("*").alias("n")).first()
    if not norm["n"]:
        none.intercept = float(np.log(n_p / n_q))
        return none
    # How far the share of documents differs, in standard errors of the difference.
    both = (F.col("p") + F.col("q")) / (n_p + n_q)
    far = (F.col("p") / n_p - F.col("q") / n_q) / F.sqrt(F.greatest(both * (1 - both), F.lit(1e-9)) * (1 / n_p + 1 / n_q))
    top = sums.orderBy(F.abs(far).desc(), "feature").limit(features).toArrow().to_pandas().sort_values("feature")
    chosen, q, p = top.feature.to_numpy(), top.q.to_numpy(float), top.p.to_numpy(float)
    ratio = (np.log((p + 0.5) / (norm["p"] + 0.5 * norm["n"])) - np.log((q + 0.5) / (norm["q"] + 0.5 * norm["n"])))
    wanted = np.full(DIM, -1, np.int16)
    wanted[chosen] = np.arange(len(chosen))
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for group in text_groups(batch.column(0), 1 << 20, 4096):
                doc, feature = grams(group, shared.value)
                bits = np.zeros((len(group), len(chosen)), np.uint8)
                bits[doc, feature] = 1
                packed += [row.tobytes() for row in np.packbits(bits, axis=1)]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column(1)], ["bits", "label"])

    # Equal rows are one row with a count; the order is that of the bits.
    drawn = (sample.mapInArrow(presence, "bits binary, label int")
             .groupBy("bits", "label").agg(F.count("*").alias("n")).orderBy("bits", "label").toArrow())
    y = drawn.column("label").to_numpy().astype(float)
    bits = np.frombuffer(b"".join(drawn.column("bits").to_pylist()), np.uint8).reshape(len(y), -1)
    weight = drawn.column("n").to_numpy().astype(float) / np.where(y == 1, rates[1], rates[0])
    beta = fit_logistic_bits(bits, ratio, y, weight * (len(y) / weight.sum()), RIDGE)
    return Model(wanted, beta[:-1] * ratio, float(beta[-1]))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier)."""
    names = [c for c in docs.columns if c != "score"]
    docs = docs.select(*names)
    place = names.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.score(batch.column(place)))],
                                             [*names, "score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType())]))
