"""Exact deduplication with Patricia-trie owners.

Texts are equal when identical after white space (``[\\x20\\x09-\\x0D]``) is deleted.  The
owner of a group is the row with the most code points in the original text, then the
smallest id.

1. Every input task inserts its normalised texts into a compressed radix trie and emits one
   row per distinct text, so a group of any size leaves a task as a single row.
2. Those rows are dealt by (length, content hash) and sorted.  Each partition inserts the full
   byte strings, under their length and hash, into a trie whose terminal nodes hold the
   owner.  When the trie passes ``budget`` bytes, the subtrees that the sorted input has left
   behind are complete: they are spilled as finished rows and freed.  Equality is decided by
   the bytes, never by the hash.
3. Owners (one row per distinct text) are joined back to the documents; a large group is on
   the side that Spark can split.

Defined cases: a null text is empty, and all empty texts form one group.  A null id sorts after
every id.  Rows that repeat both id and length are the same document and share its flags
(``keep_rows`` removes the repeats).  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.llm import bytes_np as B

TRIE_BYTES = 32 << 20
"""Label bytes that a task's trie may hold before it spills."""


class Owner:
    """What a terminal node stores: the owning row and the group's size."""

    __slots__ = ("chars", "id", "id_rows", "key", "rows", "sha")

    def __init__(self, key: bytes, sha: str, chars: int, id_: int | None, id_rows: int, rows: int):
        self.key, self.sha, self.chars, self.id, self.id_rows, self.rows = key, sha, chars, id_, id_rows, rows

    def take(self, other: Owner) -> None:
        """Join two parts of one group."""
        mine, theirs = self._rank(), other._rank()
        if theirs < mine:
            self.chars, self.id, self.id_rows = other.chars, other.id, other.id_rows
        elif theirs == mine:
            self.id_rows += other.id_rows
        self.rows += other.rows

    def _rank(self) -> tuple:
        return (-self.chars, self.id is None, self.id or 0)


class Node:
    __slots__ = ("children", "label", "owner")

    def __init__(self, label: bytes, owner: Owner | None = None):
        self.label, self.owner = label, owner
        self.children: dict[int, Node] = {}


class PatriciaTrie:
    """A radix trie over byte strings with one labelled edge per branching."""

    def __init__(self) -> None:
        self.root, self.size = Node(b""), 0

    def insert(self, key: bytes, owner: Owner) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                node.children[key[at]] = Node(key[at:], owner)
                self.size += len(key) - at
                return
            label = child.label
            if key.startswith(label, at):
                node, at = child, at + len(label)
                continue
            same = _common(label, key, at)
            fork = Node(label[:same])
            child.label = label[same:]
            fork.children[child.label[0]] = child
            node.children[key[at]] = fork
            node, at = fork, at + same
        if node.owner is None:
            node.owner = owner
        else:
            node.owner.take(owner)

    def spill(self, before: bytes | None = None) -> Iterator[Owner]:
        """Remove and yield whole subtrees: all, or those that sort before the path of ``before``."""
        if before is None:
            yield from _owners(self.root)
            self.root, self.size = Node(b""), 0
            return
        node, at, held = self.root, 0, 0
        while node is not None:
            edge = before[at] if at < len(before) else -1
            for first in [c for c in node.children if c < edge]:
                yield from _owners(node.children.pop(first))
            node = node.children.get(edge)
            if node is not None:
                at += len(node.label)
                held += len(node.label)
        self.size = held


def _common(label: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of ``label`` and ``key[at:]``, by halving."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if label[low:mid] == key[at + low : at + mid]:
            low = mid
        else:
            high = mid - 1
    return low


def _owners(node: Node) -> Iterator[Owner]:
    stack = [node]
    while stack:
        node = stack.pop()
        if node.owner is not None:
            yield node.owner
        stack.extend(node.children.values())


def _normalised(column: pa.Array) -> Iterator[tuple[bytes, int, str]]:
    """(normalised bytes, code points of the original, sha256) of each text."""
    data, offsets = B.text_bytes(column)
    for i in range(len(offsets) - 1):
        raw = data[offsets[i] : offsets[i + 1]]
        text = raw[~B.SPACE[raw]].tobytes()
        yield text, int(np.count_nonzero((raw & 0xC0) != 0x80)), hashlib.sha256(text).hexdigest()


def _trie_key(text: bytes, sha: str) -> bytes:
    return len(text).to_bytes(8, "big") + bytes.fromhex(sha[:16]) + text


PARTS = T.StructType([
    T.StructField("size", T.LongType()), T.StructField("content_hash", T.StringType()),
    T.StructField("norm", T.BinaryType()), T.StructField("sha", T.StringType()),
    T.StructField("chars", T.LongType()), T.StructField("id", T.LongType()),
    T.StructField("id_rows", T.LongType()), T.StructField("rows", T.LongType())])
OWNERS = T.StructType([
    T.StructField("sha", T.StringType()), T.StructField("keep_chars", T.LongType()),
    T.StructField("keep_id", T.LongType()), T.StructField("keep_rows", T.LongType()),
    T.StructField("group_size", T.LongType())])


def _parts(owners: Iterator[Owner]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("size", pa.int64()), ("content_hash", pa.string()), ("norm", pa.binary()),
                        ("sha", pa.string()), ("chars", pa.int64()), ("id", pa.int64()),
                        ("id_rows", pa.int64()), ("rows", pa.int64())])
    for group in _grouped(owners):
        yield pa.RecordBatch.from_pylist(
            [{"size": len(o.key), "content_hash": o.sha[:16], "norm": o.key, "sha": o.sha, "chars": o.chars,
              "id": o.id, "id_rows": o.id_rows, "rows": o.rows} for o in group], schema)


def _finished(owners: Iterator[Owner]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("sha", pa.string()), ("keep_chars", pa.int64()), ("keep_id", pa.int64()),
                        ("keep_rows", pa.int64()), ("group_size", pa.int64())])
    for group in _grouped(owners):
        yield pa.RecordBatch.from_pylist(
            [{"sha": o.sha, "keep_chars": o.chars, "keep_id": o.id, "keep_rows": o.id_rows, "group_size": o.rows}
             for o in group], schema)


def _grouped(owners: Iterator[Owner], rows: int = 2000, limit: int = 4 << 20) -> Iterator[list[Owner]]:
    group, held = [], 0
    for owner in owners:
        group.append(owner)
        held += len(owner.key)
        if len(group) >= rows or held >= limit:
            yield group
            group, held = [], 0
    if group:
        yield group


def owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct normalised text: its sha256, owner and group size."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie()
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for id_, (text, chars, sha) in zip(ids, _normalised(batch.column(1)), strict=True):
                trie.insert(_trie_key(text, sha), Owner(text, sha, chars, id_, 1, 1))
                if trie.size > budget:
                    yield from _parts(trie.spill())
        yield from _parts(trie.spill())

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie()
        for batch in batches:
            for row in batch.to_pylist():
                key = _trie_key(row["norm"], row["sha"])
                trie.insert(key, Owner(b"", row["sha"], row["chars"], row["id"], row["id_rows"], row["rows"]))
                if trie.size > budget:
                    yield from _finished(trie.spill(before=key))
        yield from _finished(trie.spill())

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return (rows.mapInArrow(local, PARTS)
            .repartition("size", "content_hash")
            .sortWithinPartitions("size", "content_hash", "norm")
            .mapInArrow(settle, OWNERS))


def fingerprints(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``_sha`` (of the normalised text) and ``_chars`` (code points of the original)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            facts = [(sha, chars) for _, chars, sha in _normalised(batch.column(batch.schema.names.index(text_col)))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in facts], pa.string()),
                 pa.array([f[1] for f in facts], pa.int64())], [*batch.schema.names, "_sha", "_chars"])

    schema = T.StructType([*docs.schema.fields, T.StructField("_sha", T.StringType()),
                           T.StructField("_chars", T.LongType())])
    return docs.mapInArrow(add, schema)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    mine = fingerprints(named).select("doc_id", "_sha", "_chars")
    own = owners(named, "doc_id", "text").withColumnRenamed("sha", "_sha")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_chars") == F.col("keep_chars"))
    return mine.join(own, "_sha").select("doc_id", "keep_id", "group_size", kept.alias("kept"),
                                         F.col("_sha").alias("text_sha256"))


def keep_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all their columns (whatever their names)."""
    nested = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                         F.col(id_col).cast("long").alias("id"))
    place = docs.columns.index(text_col)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            facts = [(sha, chars) for _, chars, sha in _normalised(pc.struct_field(batch.column(0), place))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([f[0] for f in facts], pa.string()),
                                              pa.array([f[1] for f in facts], pa.int64())], ["row", "id", "sha", "chars"])

    rows = nested.mapInArrow(add, T.StructType([*nested.schema.fields, T.StructField("sha", T.StringType()),
                                                T.StructField("chars", T.LongType())])).alias("mine")
    own = owners(docs, id_col, text_col).alias("own")
    same = ((F.col("mine.sha") == F.col("own.sha")) & (F.col("mine.chars") == F.col("own.keep_chars"))
            & F.col("mine.id").eqNullSafe(F.col("own.keep_id")))
    kept = rows.join(own, same).select("row", "id", "mine.sha", "keep_rows")
    single = kept.filter("keep_rows = 1").select("row")
    # Rows that repeat an owner's id and length: one of them stays.
    repeated = kept.filter("keep_rows > 1").dropDuplicates(["id", "sha"]).select("row")
    return single.unionByName(repeated).select("row.*")
