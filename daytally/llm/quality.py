"""Quality scores by co-training a text view and a metadata view.

The text view sees the text alone: shares of character classes, word and line repetition, lengths
and hashed byte-pair frequencies.  The metadata view sees source, language and length class, never
the text.  Each is a ridge logistic regression.

Training uses at most about ``TRAIN_ROWS`` labelled rows, by a hash of the id, which weigh as much as
all labelled rows, and every document without a label (the pool).  A fifth of the labelled rows is kept
for calibration.  In each of ``ROUNDS`` rounds both classifiers score the whole pool, and what one view
is sure of (calibrated probability beyond ``SURE`` for either label, keeping the labels' shares) joins
the other view's training rows as a pseudo-label.  The surest come first, by counts per bin of log-odds
over the whole pool; rows of the bin that the quota cuts share what is left of it as their weight.
Last, each view's log-odds are calibrated and the two are combined by a logistic regression on the
calibration rows.  All documents are scored with the combination.

Features are computed on the executors, the pool's once into a table in the shared folder.  The metadata
view has a bounded number of different rows (``CODES``), so it is fitted on their counts; the text view is
fitted by Newton steps whose gradient and curvature are summed over the pool on the executors.  The
driver sees the labelled sample's feature rows and those sums.

Defined cases: null and empty texts have all-zero text features, null metadata has its own class; null
labels and ids are never trained on; with no labelled rows, or of one kind only, every document gets the
share of good labels (0.5 without labels).
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.llm import bytes_np as B
from daytally.llm.linear import fit_logistic, sigmoid
from daytally.llm.scratch import cut

TRAIN_ROWS = 8_000
ROUNDS = 3
SURE = 0.95
RIDGE = 1.0

_CLASSES = 9
_CLASS = np.full(256, 8, np.uint8)  # other signs
_CLASS[0x61:0x7B] = 0
_CLASS[0x41:0x5B] = 1
_CLASS[0x30:0x3A] = 2
_CLASS[[0x20, 0x09]] = 3
_CLASS[[0x0A, 0x0B, 0x0C, 0x0D]] = 4
_CLASS[[ord(c) for c in ".,;:!?"]] = 5
_CLASS[[ord(c) for c in "'\"()-"]] = 6
_CLASS[0x80:] = 7
PAIRS = 128
TEXT_DIM = _CLASSES + PAIRS + 8
SOURCES, LANGS, SIZES = 64, 16, 24
META_DIM = SOURCES + LANGS + SIZES
CODES = SOURCES * LANGS * SIZES
# Bins of log-odds beyond ``SURE``, for each label.
BINS, BIN = 2048, 1 / 64


def _distinct(doc: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, most frequent value's count) per document."""
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    fresh = np.ones(len(doc), dtype=bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(fresh)
    counts = np.diff(np.append(first, len(doc)))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, doc[first], counts)
    return np.bincount(doc[first], minlength=n), most


def text_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """TEXT_DIM numbers of each text of a chunk."""
    n = len(offsets) - 1
    size = np.diff(offsets)
    out = np.zeros((n, TEXT_DIM), np.float32)
    if len(data):
        doc = np.repeat(np.arange(n), size)
        shares = np.bincount(doc * _CLASSES + _CLASS[data], minlength=n * _CLASSES).reshape(n, _CLASSES)
        pair = ((B.LOWER[data[:-1]].astype(np.int64) * 31 + B.LOWER[data[1:]]) * 2654435761 >> 20) % PAIRS
        inside = doc[1:] == doc[:-1]
        pairs = np.bincount(doc[:-1][inside] * PAIRS + pair[inside], minlength=n * PAIRS).reshape(n, PAIRS)
        length = np.maximum(size, 1)[:, None]
        out[:, :_CLASSES] = shares / length
        out[:, _CLASSES : _CLASSES + PAIRS] = np.sqrt(pairs / length)
        at = _CLASSES + PAIRS
        prefix = B.prefix_hash(B.LOWER[data])
        for k, separator in enumerate((B.SPACE, _LINE)):
            start, end, of = B.words(data, offsets, separator)
            count = np.bincount(of, minlength=n)
            distinct, most = _distinct(of, B.window_hash(prefix, start, end), n)
            total = np.maximum(count, 1)
            out[:, at + 3 * k] = distinct / total
            out[:, at + 3 * k + 1] = most / total
            out[:, at + 3 * k + 2] = np.log1p(size / total)
        out[:, at + 6] = np.log1p(size) / 10
        out[:, at + 7] = size > 0
    return out


_LINE = np.zeros(256, dtype=bool)
_LINE[[0x0A, 0x0D]] = True


def meta_features(sources: list, langs: list, sizes: list) -> np.ndarray:
    """One-hot source, language and length class of each row."""
    out = np.zeros((len(sources), META_DIM), np.float32)
    rows = np.arange(len(sources))

    def place(value: object, parts: int) -> int:
        return 0 if value is None else 1 + zlib.crc32(str(value).encode()) % (parts - 1)

    out[rows, [place(s, SOURCES) for s in sources]] = 1
    out[rows, [SOURCES + place(x, LANGS) for x in langs]] = 1
    out[rows, [SOURCES + LANGS + (0 if s is None else 1 + min(SIZES - 2, max(0, int(s)).bit_length()))
               for s in sizes]] = 1
    return out


def meta_codes(m: np.ndarray) -> np.ndarray:
    """One number for each one-hot row of source, language and length class."""
    source, lang, length = np.split(m, [SOURCES, SOURCES + LANGS], axis=1)
    return (source.argmax(axis=1) * LANGS + lang.argmax(axis=1)) * SIZES + length.argmax(axis=1)


def meta_rows(codes: np.ndarray) -> np.ndarray:
    """The one-hot rows of such numbers."""
    out = np.zeros((len(codes), META_DIM))
    rows = np.arange(len(codes))
    out[rows, codes // (LANGS * SIZES)] = 1
    out[rows, SOURCES + codes // SIZES % LANGS] = 1
    out[rows, SOURCES + LANGS + codes % SIZES] = 1
    return out


@dataclass
class View:
    """A classifier of one view: standardised features, coefficients, calibration."""

    mean: np.ndarray
    scale: np.ndarray
    beta: np.ndarray
    calibration: np.ndarray

    def logit(self, x: np.ndarray) -> np.ndarray:
        raw = ((x - self.mean) / self.scale) @ self.beta[:-1] + self.beta[-1]
        return raw * self.calibration[0] + self.calibration[1]


@dataclass
class Model:
    text: View | None
    meta: View | None
    weights: np.ndarray
    base: float

    def scores(self, x: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probability by text, by metadata, and of both combined."""
        if self.text is None or self.meta is None:
            flat = np.full(len(x), self.base)
            return flat, flat, flat
        t, s = self.text.logit(x), self.meta.logit(m)
        return sigmoid(t), sigmoid(s), sigmoid(np.stack([t, s], axis=1) @ self.weights[:2] + self.weights[2])


def _calibrated(mean: np.ndarray, scale: np.ndarray, beta: np.ndarray, held_x: np.ndarray, held_y: np.ndarray) -> View:
    # The order of sums differs between runs in the last digits; rounded, the model does not.
    view = View(mean.round(9), scale.round(9), beta.round(6), np.array([1.0, 0.0]))
    # Platt scaling on rows that the classifier has not seen.
    raw = view.logit(held_x)
    view.calibration = fit_logistic(raw[:, None], held_y, ridge=1e-2)
    if view.calibration[0] < 0:  # a view no better than chance says the base rate
        share = np.clip(held_y.mean(), 1e-3, 1 - 1e-3)
        view.calibration = np.array([0.0, np.log(share / (1 - share))])
    return view


def _fit_rows(x: np.ndarray, y: np.ndarray, weight: np.ndarray, held_x: np.ndarray, held_y: np.ndarray) -> View:
    mean = np.average(x, axis=0, weights=weight)
    scale = np.maximum(np.sqrt(np.average((x - mean) ** 2, axis=0, weights=weight)), 1e-3)
    return _calibrated(mean, scale, fit_logistic((x - mean) / scale, y, weight, ridge=RIDGE), held_x, held_y)


_UPPER = np.triu_indices(TEXT_DIM + 1)


def _sums(x: np.ndarray, y: np.ndarray, weight: np.ndarray, line: np.ndarray) -> np.ndarray:
    """Gradient, curvature (upper half) and moments of weighted rows at the raw coefficients ``line``."""
    x = np.hstack([x, np.ones((len(x), 1))]).astype(np.float64)
    p = sigmoid(x @ line)
    curve = (x * (weight * np.maximum(p * (1 - p), 1e-5))[:, None]).T @ x
    return np.concatenate([x.T @ (weight * (p - y)), x.T @ weight, (x * x).T @ weight, curve[_UPPER]])


def _fit_sums(sums: Callable[[np.ndarray], np.ndarray], line: np.ndarray, held_x: np.ndarray, held_y: np.ndarray,
              steps: int = 25) -> View:
    """The fit of ``_fit_rows`` from ``sums`` of all rows at given raw coefficients, beginning at ``line``."""
    d = TEXT_DIM
    penalty = np.full(d + 1, RIDGE)
    penalty[-1] = 1e-3
    for _ in range(steps):
        slope, first, second, upper = np.split(sums(line), [d + 1, 2 * d + 2, 3 * d + 3])
        mean = first[:d] / first[d]
        scale = np.maximum(np.sqrt(np.maximum(second[:d] / first[d] - mean**2, 0)), 1e-3)
        curve = np.zeros((d + 1, d + 1))
        curve[_UPPER] = upper
        curve = curve + np.triu(curve, 1).T
        # Raw rows times ``to`` are the standardised ones.
        to = np.diag(np.append(1 / scale, 1.0))
        to[d, :d] = -mean / scale
        beta = np.linalg.solve(to, line)
        step = np.linalg.solve(to.T @ curve @ to + np.diag(penalty), to.T @ slope + penalty * beta)
        beta -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-9))
        line = to @ beta
        if np.abs(step).max() < 1e-3:
            break
    return _calibrated(mean, scale, beta, held_x, held_y)


def _line(view: View) -> np.ndarray:
    """A view's coefficients for raw features, before calibration."""
    raw = view.beta[:-1] / view.scale
    return np.append(raw, view.beta[-1] - view.mean @ raw)


def _bins(z: np.ndarray) -> np.ndarray:
    """Calibrated log-odds as a bin: 1 to BINS where label 1 is sure, -1 to -BINS where label 0 is, else 0."""
    least = np.log(SURE / (1 - SURE))
    bins = np.clip((np.abs(z) - least) / BIN, 0, BINS - 1).astype(np.int64) + 1
    return np.where(np.abs(z) >= least, np.where(z > 0, bins, -bins), 0)


def _weights(counts: np.ndarray, share: float, most: int) -> np.ndarray:
    """Weight (0 to 1) of a row of each bin (at bin + BINS), in the labels' shares, given the pool's rows per bin."""
    sides = counts[BINS + 1 :][::-1], counts[:BINS]  # surest first
    n = min(sides[0].sum() / max(share, 1e-6), sides[1].sum() / max(1 - share, 1e-6), most)
    good, bad = (np.clip((round(n * part) - (np.cumsum(side) - side)) / np.maximum(side, 1), 0, 1)
                 for side, part in zip(sides, (share, 1 - share), strict=True))
    return np.concatenate([bad, [0.0], good[::-1]])


PARTS = 64
_PACKED = "part long, keys binary, values binary"


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct keys, sums of their values)."""
    keys, place = np.unique(np.concatenate([k for k, _ in parts] or [np.zeros(0, np.int64)]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([v for _, v in parts] or [np.zeros(0)]), minlength=len(keys))


def _packed(part: int, keys: np.ndarray, values: np.ndarray) -> pa.Table:
    return pa.table({"part": pa.array([part], pa.int64()), "keys": pa.array([keys.astype("<i8").tobytes()], pa.binary()),
                     "values": pa.array([values.astype("<f8").tobytes()], pa.binary())})


def _unpacked(table: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(np.frombuffer(k, "<i8"), np.frombuffer(v, "<f8"))
            for k, v in zip(table.column("keys").to_pylist(), table.column("values").to_pylist(), strict=True)]


def _merged(table: pa.Table) -> pa.Table:
    return _packed(table.column("part")[0].as_py(), *_added(_unpacked(table)))


class Pool:
    """All documents without a label: ``x`` (text features, float32) and ``code`` (metadata)."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        found = rows.groupBy("code").agg(F.count("*").alias("n")).toArrow().to_pandas().sort_values("code")
        self.codes, self.n = found["code"].to_numpy(np.int64), found["n"].to_numpy(np.int64)
        self.size = int(self.n.sum())

    def _sum(self, run: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple:
        """Sums by key over the pool, of the (keys, values) that ``run`` gives for a batch's (x, code)."""
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, values = np.zeros(0, np.int64), np.zeros(0)
            for batch in batches:
                x = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<f4").reshape(-1, TEXT_DIM)
                keys, values = _added([(keys, values), run(x, batch.column(1).to_numpy())])
            yield from _packed(TaskContext.get().partitionId() % PARTS, keys, values).to_batches()

        # One row a task; the executors add them up to PARTS rows for the driver.
        got = (self.rows.select("x", "code").mapInArrow(task, _PACKED)
               .groupBy("part").applyInArrow(_merged, _PACKED).toArrow())
        return _added(_unpacked(got))

    def by_meta(self, view: View, share: float, most: int) -> np.ndarray:
        """Signed weight of a row of each metadata code, by what the metadata view is sure of."""
        bins = _bins(view.logit(meta_rows(self.codes)))
        counts = np.bincount(bins + BINS, self.n, minlength=2 * BINS + 1)
        signed = np.zeros(CODES)
        signed[self.codes] = np.sign(bins) * _weights(counts, share, most)[bins + BINS]
        return signed

    def by_text(self, view: View, share: float, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(code, label, weight) of the rows that the text view is sure of, summed by code and label."""
        def count(x: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            return _bins(view.logit(x)), np.ones(len(x))

        bins, n = self._sum(count)
        counts = np.zeros(2 * BINS + 1)
        counts[bins + BINS] = n
        weights = _weights(counts, share, most)
        part = weights * ((weights > 0) & (weights < 1))

        def chosen(x: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = _bins(view.logit(x))
            w = weights[at + BINS]
            some = w > 0
            return (code[some] * 4 + (at[some] > 0) * 2 + (w[some] < 1)), np.ones(some.sum())

        key, n = self._sum(chosen)
        label = key // 2 % 2
        # At most one bin of a label is taken in part.
        share_of = np.where(label == 1, part[BINS + 1 :].max(), part[:BINS].max())
        return key // 4, label.astype(float), n * np.where(key % 2, share_of, 1.0)

    def sums(self, signed: np.ndarray, line: np.ndarray) -> np.ndarray:
        """``_sums`` over the rows whose code has a weight; its sign is the pseudo-label."""
        size = len(_UPPER[0]) + 3 * (TEXT_DIM + 1)

        def run(x: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            w = signed[code]
            some = w != 0
            return np.arange(size), _sums(x[some], (w[some] > 0).astype(float), np.abs(w[some]), line)

        key, value = self._sum(run)
        out = np.zeros(size)
        out[key] = value
        return out


def co_train(x: np.ndarray, m: np.ndarray, y: np.ndarray, each: float, pool: Pool | None) -> Model:
    """Both views from labelled rows (x, m, y), each standing for ``each`` rows, and a pool without labels."""
    held = np.arange(len(y)) % 5 == 0
    share = y.mean()
    held_y = y[held]
    if share in (0.0, 1.0) or len(np.unique(held_y)) < 2 or len(np.unique(y[~held])) < 2:
        return Model(None, None, np.zeros(3), float(share))
    weight = np.full((~held).sum(), each)
    text = _fit_rows(x[~held], y[~held], weight, x[held], held_y)
    meta = _fit_rows(m[~held], y[~held], weight, m[held], held_y)
    for step in range(ROUNDS if pool and pool.size else 0):
        quota = max(1, pool.size // (2 * ROUNDS)) * (step + 1)
        code, label, n = pool.by_text(text, share, quota)
        signed = pool.by_meta(meta, share, quota)
        meta = _fit_rows(np.vstack([m[~held], meta_rows(code)]), np.concatenate([y[~held], label]),
                         np.concatenate([weight, n]), m[held], held_y)
        if signed.any():
            text = _fit_sums(lambda line, s=signed: _sums(x[~held], y[~held], weight, line) + pool.sums(s, line),
                             _line(text), x[held], held_y)
        else:
            text = _fit_rows(x[~held], y[~held], weight, x[held], held_y)
    both = np.stack([text.logit(x[held]), meta.logit(m[held])], axis=1)
    return Model(text, meta, fit_logistic(both, held_y, ridge=1e-2), float(share))


def _draw(name: str) -> Column:
    return F.pmod(F.xxhash64("_id", F.lit(name)), F.lit(1 << 30)) / float(1 << 30)


def _feature_rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Text and metadata features of a batch whose first columns are text, source, lang, n_chars."""
    data, offsets = B.text_bytes(batch.column(0))
    x = [text_features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in B.chunks(offsets)]
    m = meta_features(*(batch.column(k).to_pylist() for k in (1, 2, 3)))
    return (np.concatenate(x) if x else np.zeros((0, TEXT_DIM), np.float32)), m


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", rows: int = TRAIN_ROWS) -> Model:
    """Fit on a bounded sample of the labelled documents and on all others."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("double").alias("label")).filter(
        "_id IS NOT NULL AND label IN (0, 1)")
    rate = min(1.0, rows / max(1, known.count()))
    chosen = known.filter(_draw("train") <= rate)
    every = docs.select(F.col(text_col).alias("text"), F.col("source").cast("string").alias("source"),
                        F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"),
                        F.col(id_col).alias("_id"))
    # The sample is bounded by its parameter, so the label rows can be broadcast and documents stay in place.
    labelled = every.join(F.broadcast(chosen), "_id").select("text", "source", "lang", "n_chars", "_id", "label")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, m = _feature_rows(batch)
            packed = [np.concatenate([a, b]).astype("<f4").tobytes() for a, b in zip(x, m, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(packed, pa.binary()), batch.column(5)], ["row", "label"])

    rows_ = labelled.mapInArrow(features, "row binary, label double").toArrow().to_pandas()
    if not len(rows_):
        return Model(None, None, np.zeros(3), 0.5)
    rows_["row"] = rows_["row"].map(bytes)
    # A fixed order that does not depend on arrival.
    rows_["order"] = rows_["row"].map(zlib.crc32)
    rows_ = rows_.sort_values(["order", "row", "label"])
    both = np.frombuffer(b"".join(rows_["row"]), "<f4").reshape(len(rows_), TEXT_DIM + META_DIM)
    x, m = both[:, :TEXT_DIM].astype(np.float64), both[:, TEXT_DIM:].astype(np.float64)

    def pooled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, m = _feature_rows(batch)
            yield pa.RecordBatch.from_arrays(
                [batch.column(4), pa.array([row.tobytes() for row in x.astype("<f4")], pa.binary()),
                 pa.array(meta_codes(m), pa.int64())], ["_id", "x", "code"])

    # Feature rows, not texts, meet the labelled ids.
    some = (every.mapInArrow(pooled, T.StructType([every.schema["_id"], T.StructField("x", T.BinaryType()),
                                                   T.StructField("code", T.LongType())]))
            .join(known.select("_id").distinct(), "_id", "left_anti").select("x", "code"))
    return co_train(x, m, rows_["label"].to_numpy(), 1 / rate, Pool(cut(some, "quality_pool")))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = 0.5) -> DataFrame:
    """doc_id, text_score, meta_score, score and kept (score at least ``threshold``) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(text_col).alias("text"), F.col("source").cast("string").alias("source"),
                       F.col("lang").cast("string").alias("lang"), F.col("n_chars").cast("long").alias("n_chars"),
                       F.col(id_col).alias("doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t, s, both = shared.value.scores(*_feature_rows(batch))
            yield pa.RecordBatch.from_arrays([batch.column(4), pa.array(t), pa.array(s), pa.array(both)],
                                             ["doc_id", "text_score", "meta_score", "score"])

    return (rows.mapInArrow(run, T.StructType([rows.schema["doc_id"], *(
        T.StructField(c, T.DoubleType()) for c in ("text_score", "meta_score", "score"))]))
        .withColumn("kept", F.col("score") >= threshold))
