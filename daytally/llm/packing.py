"""Bounded-space online best-fit packing of documents into fixed-length token sequences.

Every input task tokenises its rows and packs them in groups of ``open_bins`` pieces
(longer ones of a group first): at most ``open_bins`` sequences are open, kept in stacks keyed by free space with one bit per free
space that occurs.  A piece goes to the open sequence with the least sufficient free space
(lowest set bit at or above its length); if none fits, a new one opens, and at the limit the
fullest (lowest set bit of all) closes first.  No shuffle is needed, memory per task is the
bitset, the stacks and one batch of texts, and a lost task is repeated alone.

A document is its token ids followed by ``end_id``.  One longer than ``length`` is cut from its
end into pieces of exactly ``length``; only the first piece may be shorter.

Defined cases: null and empty texts are documents of one token (``end_id``); a null id and
repeated rows are packed like any other row; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LENGTH = 2048
OPEN_BINS = 1024


class BestFit:
    """Open sequences by free space; ``place`` returns (sequence, offset)."""

    def __init__(self, length: int = LENGTH, open_bins: int = OPEN_BINS):
        self.length, self.open_bins = length, open_bins
        self.bits, self.opened, self.next = 0, 0, 0
        self.stacks: list[list[int]] = [[] for _ in range(length + 1)]

    def _pop(self, free: int) -> int:
        bin_ = self.stacks[free].pop()
        if not self.stacks[free]:
            self.bits &= ~(1 << free)
        self.opened -= 1
        return bin_

    def _push(self, free: int, bin_: int) -> None:
        if free:
            self.stacks[free].append(bin_)
            self.bits |= 1 << free
            self.opened += 1

    def place(self, size: int) -> tuple[int, int]:
        fitting = self.bits >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            bin_ = self._pop(free)
        else:
            if self.opened >= self.open_bins:
                self._pop((self.bits & -self.bits).bit_length() - 1)
            free, bin_ = self.length, self.next
            self.next += 1
        self._push(free - size, bin_)
        return bin_, self.length - free


def cuts(size: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces, in order."""
    first = size % length or min(size, length)
    return [(0, first), *((at, length) for at in range(first, size, length))]


# The two libraries cut text into words alike as long as every character is in these blocks, whose letters and
# digits have not changed since before either was made, and no special token's string occurs.
_OTHER = re.compile("[^\\x00-ɏ‐-‧]|<\\|endoftext\\|>")
# The faster library's pattern walks back over a run of white space and overflows its stack at about a million.
_BLANKS = 10_000
_BLANK_RUN = re.compile(rf"(?<!\s)\s{{{_BLANKS}}}")


class Encoder:
    """Token ids as the ``tokenizers`` file gives them.

    Where ``ranks_path`` names the same vocabulary as byte ranks, texts of common Latin
    characters take the faster library over those ranks (equal ids, tested); all others, and texts
    with a run of ``_BLANKS`` white-space characters, go through ``tokenizers`` itself.
    """

    def __init__(self, path: str, ranks_path: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.slow, self.fast = Tokenizer.from_file(path), None
        if ranks_path:
            import base64

            import tiktoken

            with open(ranks_path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and not _OTHER.search(text) and not (
                len(text) >= _BLANKS and _BLANK_RUN.search(text)):
            return np.array(self.fast.encode_ordinary(text), dtype="<u4")
        return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, ranks_path: str | None, pattern: str | None) -> Encoder:
    """One encoder per worker process and vocabulary."""
    key = (path, ranks_path, pattern)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType())])
_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                    ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def pack(docs: DataFrame, path: str, ranks_path: str | None = None, pattern: str | None = None,
         id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, open_bins: int = OPEN_BINS,
         end_id: int = 0, with_ids: bool = False) -> DataFrame:
    """One row per piece with its sequence and offset; ``with_ids`` adds the token ids."""
    schema = T.StructType([*PIECES.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]) if with_ids else PIECES
    arrow = _ARROW.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else _ARROW

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, bins = encoder(path, ranks_path, pattern), BestFit(length, open_bins)
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            pieces: list[tuple] = []
            for i, doc_id in enumerate(ids):
                tokens = encode(texts[i].as_py() or "")
                tokens = np.append(tokens, np.uint32(end_id)).astype("<u4")
                for piece, (start, size) in enumerate(cuts(len(tokens), length)):
                    part = tokens[start : start + size]
                    pieces.append((doc_id, piece, start, size, zlib.crc32(part.tobytes()),
                                   part.astype(np.int32) if with_ids else None))
            # The order of arrival is free: within as many pieces as may be open, longer ones first leave less unused.
            for at in range(0, len(pieces), open_bins):
                rows = []
                for doc_id, piece, start, size, crc, part in sorted(pieces[at : at + open_bins], key=lambda p: -p[3]):
                    bin_, offset = bins.place(size)
                    row = (doc_id, piece, start, size, crc, base + bin_, offset)
                    rows.append((*row, part) if with_ids else row)
                yield _batch(rows, arrow)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                                      schema=schema)
