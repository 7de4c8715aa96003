"""Benchmark decontamination by a prefix-filtered set join.

A window is ``WINDOW`` consecutive words of a benchmark item, or a whole shorter item.  A
document contains a window if it holds those words in a row.  The join is a containment join of
shingle sets at threshold 1, so the necessary prefix of a window is its rarest shingle:

1. Items become distinct windows with their shingles (``SHINGLE`` words, fewer in shorter windows).
2. One pass over all documents counts every benchmark shingle in the corpus; shingles are
   ordered by that count and each window keeps its rarest one, with its position.
3. A second pass joins each document's shingles with those prefix shingles.  The length and
   positional bounds (the window must fit between the document's first and last word at that
   place) prune pairs, word hashes prune more, and the words' bytes decide.

The window index is broadcast; its size is bounded by ``block_windows``.  A larger benchmark is
taken in blocks of that size, each against all documents, and the blocks' hits are merged by
document.  Documents are never shuffled for a benchmark of one block.

Words are maximal runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased.
Defined cases: a null or wordless text has no words, a null or wordless item no window; an item
with a null id marks words but is not listed; repeated items count once; repeated documents are
judged row by row; an empty benchmark hits nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.llm import bytes_np as B

WINDOW = 10
SHINGLE = 3
BLOCK_WINDOWS = 200_000
"""Distinct windows in one broadcast index (about 100 bytes each)."""

_STEP = np.uint64(0x9FB21C651E98DF25)


def shingle_hashes(hashes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words of one document, and the index of its first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = hashes[:n].copy()
    for k in range(1, size):
        value = value * _STEP + hashes[k : k + n]
    at = np.flatnonzero(doc[:n] == doc[size - 1 : size - 1 + n])
    return B.mix(value[at] + np.uint64(size)), at


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(lower-cased bytes, start, end, document, hash) of the words."""
    lower = B.LOWER[data]
    start, end, doc = B.words(lower, offsets, B.ASCII_OTHER)
    return lower, start, end, doc, B.window_hash(B.prefix_hash(lower), start, end)


@dataclass
class Lookup:
    """Membership and position of 64-bit hashes in a sorted array, behind a bit table on their top bits."""

    keys: np.ndarray

    def __post_init__(self) -> None:
        self.shift = np.uint64(64 - 22)
        self.table = np.zeros(1 << 22, dtype=bool)
        self.table[self.keys >> self.shift] = True

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(indexes into values, indexes into keys) of the members."""
        some = np.flatnonzero(self.table[values >> self.shift])
        where = np.searchsorted(self.keys, values[some])
        where[where == len(self.keys)] = 0
        hit = self.keys[where] == values[some] if len(self.keys) else np.zeros(len(some), bool)
        return some[hit], where[hit]


class Windows:
    """The distinct windows of a block of items, with their shingles."""

    def __init__(self, texts: list[bytes], items: list[list[str]]):
        self.texts, self.items = texts, items
        data = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
        offsets = np.concatenate([[0], ends]).astype(np.int64)
        if texts:
            offsets[-1] -= 1
        _, _, _, doc, hashes = words_of(data, offsets)
        self.hashes, self.first = hashes, np.searchsorted(doc, np.arange(len(texts)))
        self.size = np.bincount(doc, minlength=len(texts))
        self.shingles: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for k in range(1, SHINGLE + 1):
            mine = self.size >= k if k == SHINGLE else self.size == k
            value, at = shingle_hashes(hashes, doc, k)
            of = mine[doc[at]] if len(at) else np.zeros(0, bool)
            if of.any():
                window = doc[at[of]]
                self.shingles[k] = value[of], window, at[of] - self.first[window]

    def vocabulary(self) -> dict[int, np.ndarray]:
        return {k: np.unique(v[0]) for k, v in self.shingles.items()}

    def prefixes(self, counts: dict[int, int]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """By shingle size: distinct prefix shingles, list bounds, windows, positions in the window."""
        out = {}
        for k, (value, window, offset) in self.shingles.items():
            count = np.array([counts.get(int(v), 0) for v in value], dtype=np.int64)
            order = np.lexsort((offset, value, count, window))
            rarest = order[np.concatenate([[True], window[order][1:] != window[order][:-1]])]
            rarest = rarest[np.argsort(value[rarest], kind="stable")]
            keys, bounds = np.unique(value[rarest], return_index=True)
            out[k] = keys, np.append(bounds, len(rarest)), window[rarest], offset[rarest]
        return out


WINDOW_ROWS = T.StructType([T.StructField("words", T.BinaryType()), T.StructField("item", T.StringType())])


def windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """One row per window and item; the window's words joined by a space."""

    def cut_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets = B.text_bytes(batch.column(1))
            out_words, out_items = [], []
            for i in range(len(ids)):
                lower, start, end, _, _ = words_of(data[offsets[i] : offsets[i + 1]],
                                                   np.array([0, offsets[i + 1] - offsets[i]]))
                parts = [lower[a:b].tobytes() for a, b in zip(start, end, strict=True)]
                for at in range(max(1, len(parts) - size + 1) if parts else 0):
                    out_words.append(b" ".join(parts[at : at + size]))
                    out_items.append(ids[i])
            yield pa.RecordBatch.from_arrays([pa.array(out_words, pa.binary()), pa.array(out_items, pa.string())],
                                             ["words", "item"])

    return items.select(F.col(id_col).cast("string").alias("item"),
                        F.col(text_col).alias("text")).mapInArrow(cut_items, WINDOW_ROWS).distinct()


def blocks(items: DataFrame, id_col: str, text_col: str, block_windows: int) -> Iterator[Windows]:
    """The benchmark's windows in blocks of a bounded size; equal windows share a block."""
    rows = windows(items, id_col, text_col)
    n = max(1, math.ceil(rows.count() / block_windows))
    for k in range(n):
        part = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("words"), F.lit(n)) == k)
        by: dict[bytes, list[str]] = {}
        for row in part.toLocalIterator():
            by.setdefault(bytes(row["words"]), []).append(row["item"])
        texts = sorted(by)
        yield Windows(texts, [sorted(i for i in by[t] if i is not None) for t in texts])


def shingle_counts(docs: DataFrame, block: Windows, text_col: str = "text") -> dict[int, int]:
    """Occurrences of the block's shingles in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(block.vocabulary())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookups = {k: Lookup(v) for k, v in shared.value.items()}
        total = {k: np.zeros(len(v), np.int64) for k, v in shared.value.items()}
        for batch in batches:
            data, offsets = B.text_bytes(batch.column(0))
            for i, j in B.chunks(offsets):
                part = offsets[i : j + 1] - offsets[i]
                _, _, _, doc, hashes = words_of(data[offsets[i] : offsets[j]], part)
                for k, lookup in lookups.items():
                    _, where = lookup.find(shingle_hashes(hashes, doc, k)[0])
                    total[k] += np.bincount(where, minlength=len(total[k]))
        for k, keys in shared.value.items():
            some = total[k] > 0
            yield pa.RecordBatch.from_arrays([pa.array(keys[some].view(np.int64)), pa.array(total[k][some])],
                                             ["shingle", "n"])

    rows = docs.select(text_col).mapInArrow(count, "shingle long, n long")
    return {r["shingle"] & (2**64 - 1): r["n"]
            for r in rows.groupBy("shingle").agg(F.sum("n").alias("n")).toLocalIterator()}


_RUN = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))
FOUND = [T.StructField("_words", T.LongType()), T.StructField("_hits", T.LongType()),
         T.StructField("_runs", _RUN), T.StructField("_items", T.ArrayType(T.StringType()))]
_ARROW_RUN = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


class Matcher:
    """Finds a block's windows in a chunk of documents."""

    def __init__(self, block: Windows, prefixes: dict):
        self.block, self.prefixes = block, prefixes
        self.lookups = {k: Lookup(v[0]) for k, v in prefixes.items()}

    def candidates(self, hashes: np.ndarray, doc: np.ndarray, first: np.ndarray,
                   last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, window) of the pairs that share a prefix shingle and fit in the document."""
        at_all, window_all = [], []
        for k, lookup in self.lookups.items():
            _, bounds, window, offset = self.prefixes[k]
            value, at = shingle_hashes(hashes, doc, k)
            some, where = lookup.find(value)
            if not len(some):
                continue
            n = bounds[where + 1] - bounds[where]
            pos = np.repeat(bounds[where], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            word = np.repeat(at[some], n)
            begin, w = word - offset[pos], window[pos]
            fits = (begin >= first[doc[word]]) & (begin + self.block.size[w] <= last[doc[word]])
            at_all.append(begin[fits])
            window_all.append(w[fits])
        if not at_all:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(at_all), np.concatenate(window_all)

    def verified(self, at: np.ndarray, window: np.ndarray, hashes: np.ndarray, lower: np.ndarray,
                 start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The candidates whose words are the window's words."""
        size = self.block.size[window]
        for k in range(WINDOW):
            inside = np.flatnonzero(size > k)
            same = hashes[at[inside] + k] == self.block.hashes[self.block.first[window[inside]] + k]
            keep = np.ones(len(at), bool)
            keep[inside[~same]] = False
            at, window, size = at[keep], window[keep], size[keep]
        ok = [b" ".join(lower[a:b].tobytes() for a, b in zip(start[i : i + n], end[i : i + n], strict=True))
              == self.block.texts[w] for i, w, n in zip(at, window, size, strict=True)]
        ok = np.array(ok, dtype=bool)
        return at[ok], window[ok]

    def judge(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, list, list]]:
        """(words, hit words, hit runs, items) of each document of a chunk."""
        lower, start, end, doc, hashes = words_of(data, offsets)
        ids = np.arange(len(offsets) - 1)
        first, last = np.searchsorted(doc, ids), np.searchsorted(doc, ids, side="right")
        at, window = self.verified(*self.candidates(hashes, doc, first, last), hashes, lower, start, end)
        out = [(int(b - a), 0, [], []) for a, b in zip(first, last, strict=True)]
        if not len(at):
            return out
        edge = np.zeros(len(start) + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + self.block.size[window], -1)
        hit = np.cumsum(edge[:-1]) > 0
        order = np.argsort(doc[at], kind="stable")
        at, window = at[order], window[order]
        touched, bounds = np.unique(doc[at], return_index=True)
        for d, a, b in zip(touched, bounds, [*bounds[1:], len(at)], strict=True):
            mine = np.concatenate([[0], hit[first[d] : last[d]].view(np.int8), [0]])
            edges = np.flatnonzero(np.diff(mine))
            runs = [{"first": int(x), "last": int(y)} for x, y in edges.reshape(-1, 2)]
            items = sorted({i for w in window[a:b] for i in self.block.items[w]})
            out[d] = int(last[d] - first[d]), int(mine.sum()), runs, items
        return out


def annotate(docs: DataFrame, block: Windows, text_col: str = "text") -> DataFrame:
    """(row, _words, _hits, _runs, _items): ``row`` is the row of ``docs`` as a struct, so that no name clashes;
    ``_runs`` are word indexes, end exclusive."""
    counts = shingle_counts(docs, block, text_col)
    shared = docs.sparkSession.sparkContext.broadcast((block, block.prefixes(counts)))
    place = docs.columns.index(text_col)
    docs = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(*shared.value)
        for batch in batches:
            data, offsets = B.text_bytes(pc.struct_field(batch.column(0), place))
            found: list[tuple] = []
            for i, j in B.chunks(offsets):
                found += matcher.judge(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            columns = [pa.array([f[k] for f in found], kind) for k, kind in
                       enumerate([pa.int64(), pa.int64(), _ARROW_RUN, pa.list_(pa.string())])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], ["row", *(f.name for f in FOUND)])

    return docs.mapInArrow(find, T.StructType([*docs.schema.fields, *FOUND]))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text",
                  block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, runs (of hit words), item_ids (sorted)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    parts = [annotate(rows, block, "text") for block in blocks(items, item_col, item_text_col, block_windows)]
    if len(parts) == 1:
        return parts[0].select("row.doc_id", F.col("_words").alias("n_words"), F.col("_hits").alias("n_hit"),
                               F.col("_runs").alias("runs"), F.col("_items").alias("item_ids"))
    skinny = [p.select("row.doc_id", F.sha2("row.text", 256).alias("sha"), *(f.name for f in FOUND)) for p in parts]
    every = skinny[0]
    for p in skinny[1:]:
        every = every.unionByName(p)
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    merged = F.aggregate(
        F.array_sort(F.flatten(F.collect_list("_runs"))), zero,
        lambda acc, run: F.struct(
            (acc["n"] + F.greatest(F.lit(0), run["last"] - F.greatest(acc["end"], run["first"]))).alias("n"),
            F.greatest(acc["end"], run["last"]).alias("end")),
        lambda acc: acc["n"])
    return (every.groupBy("doc_id", "sha")
            .agg(F.max("_words").alias("n_words"), merged.alias("n_hit"),
                 F.array_sort(F.flatten(F.collect_list("_runs"))).alias("runs"),
                 F.array_sort(F.array_distinct(F.flatten(F.collect_list("_items")))).alias("item_ids"),
                 (F.count("*") / len(parts)).cast("int").alias("rows"))
            # Rows that repeat both id and text were grouped: give each its own result row again.
            .select("doc_id", "n_words", "n_hit", "runs", "item_ids",
                    F.explode(F.sequence(F.lit(1), "rows")).alias("copy"))
            .drop("copy"))


def clean_rows(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """The rows of ``docs`` in which no window occurs."""
    for block in blocks(items, item_col, item_text_col, block_windows):
        docs = annotate(docs, block, text_col).filter("_hits = 0").select("row.*")
    return docs
