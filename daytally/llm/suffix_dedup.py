"""Removal of repeated byte strings with suffix arrays.

Every byte covered by a ``LENGTH``-byte string that also starts anywhere else, in the same or another
document, is removed; strings are judged on the input.

1. Each window of ``LENGTH`` bytes has a core: the ``CORE``-byte string in it with the least hash (the
   rightmost of equals).  Equal windows have equal cores at equal places, and neighbouring windows
   mostly share a core, so one row per core stands for a run of windows.  Cores that
   occur once are done; what remains are runs of windows that may repeat.
2. A core all of whose runs have the same bytes (by digest) repeats as a whole: those runs are one snippet
   with many places. The other runs' bytes are sent, equal snippets of a task once with a count, dealt by
   core, so all equal windows meet in one partition.
3. A partition cuts its snippets into shards of about ``SHARD_BYTES``; each shard gets a suffix array
   (Larsson-Sadakane) and common prefixes (Kasai).  A window repeats if it shares
   ``LENGTH`` bytes with a neighbour in the suffix array, or if its snippet stands for several places.
   Where a core's snippets lie in several shards, each shard's windows of that core are looked up in
   the others' suffix arrays by binary search.
4. A core with more than ``HOT`` different snippets would fill a partition; its windows are instead
   counted by a 128-bit digest across all partitions.
5. The repeated runs go back to their documents, where the covered bytes are cut out.

Defined cases: a null text is empty; texts shorter than ``LENGTH`` lose nothing; rows that repeat both
id and text are two documents and repeat each other; a null id is a document like any other.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.llm import bytes_np as B
from daytally.llm import suffix_array as S
from daytally.llm.scratch import cut

LENGTH = 400
CORE = 160
SHARD_BYTES = 1 << 20
CHUNK_BYTES = 1 << 18
HOT = 2048
HOT_BROADCAST = 100_000
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values (block-wise running minima from both sides)."""
    n = len(values) - width + 1
    blocks = np.full(-(-len(values) // width) * width, _MOST, dtype=np.uint64)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def runs(data: np.ndarray, offsets: np.ndarray, length: int, core: int) -> tuple[np.ndarray, ...]:
    """(document, first window, last window, core hash) of the runs of windows with one core."""
    empty = np.zeros(0, np.int64)
    width = length - core + 1
    if len(data) < length:
        return empty, empty, empty, empty
    prefix = B.prefix_hash(data)
    at = np.arange(len(data) - core + 1)
    hashes = B.window_hash(prefix, at, at + core)
    least = sliding_min(hashes, width)
    # Windows that cross a document's end do not count.
    sizes = np.diff(offsets)
    starts = np.maximum(sizes - length + 1, 0)
    window = np.repeat(offsets[:-1] - (np.cumsum(starts) - starts), starts) + np.arange(starts.sum())
    if not len(window):
        return empty, empty, empty, empty
    doc = np.repeat(np.arange(len(sizes)), starts)
    least = least[window]
    entered = hashes[window + width - 1] == least
    opens = np.ones(len(window), dtype=bool)
    opens[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1])
    place = np.where(entered, window + width - 1, -1)
    # The least value came from inside the window: look for its last place there.
    search = np.flatnonzero(opens & ~entered)
    for k in range(0, len(search), 4096):
        part = search[k : k + 4096]
        inside = hashes[window[part][:, None] + np.arange(width - 1, -1, -1)] == least[part][:, None]
        place[part] = window[part] + width - 1 - inside.argmax(axis=1)
    change = np.flatnonzero(opens | entered)
    last = np.append(change[1:], len(window)) - 1
    return doc[change], window[change], window[last], hashes[place[change]].view(np.int64)


def text_runs(data: np.ndarray, offsets: np.ndarray, length: int, core: int,
              limit: int = 4 << 20) -> tuple[np.ndarray, ...]:
    """``runs``; a text beyond ``limit`` bytes is taken in overlapping parts, which only splits runs."""
    if len(data) <= limit or len(offsets) != 2:
        return runs(data, offsets, length, core)
    parts = []
    for at in range(0, len(data) - length + 1, limit):
        part = data[at : at + limit + length - 1]
        doc, first, last, key = runs(part, np.array([0, len(part)]), length, core)
        parts.append((doc, first + at, last + at, key))
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _row_id(ids: pa.Array, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A 64-bit name for each row, from id and text."""
    return np.array([xxhash.xxh3_64_intdigest(data[a:b].tobytes(), seed=zlib.crc32(str(i).encode()))
                     for i, a, b in zip(ids.to_pylist(), offsets[:-1], offsets[1:], strict=True)],
                    dtype=np.uint64).view(np.int64)


def core_rows(docs: DataFrame, length: int, core: int) -> DataFrame:
    """(row, core, digest) for every run of windows; the digest is that of the run's bytes."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = B.text_bytes(batch.column(1))
            for i, j in B.chunks(offsets, CHUNK_BYTES):
                part, ends = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                doc, first, last, key = text_runs(part, ends, length, core)
                name = _row_id(batch.column(0).slice(i, j - i), part, ends)
                view = memoryview(part)
                digest = np.array([xxhash.xxh3_64_intdigest(view[x : y + length])
                                   for x, y in zip(first.tolist(), last.tolist(), strict=True)], dtype=np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(name[doc]), pa.array(key), pa.array(digest.view(np.int64))],
                                                 ["row", "core", "digest"])

    return docs.mapInArrow(find, "row long, core long, digest long")


SNIPPETS = T.StructType([
    T.StructField("core", T.LongType()), T.StructField("a", T.LongType()), T.StructField("b", T.LongType()),
    T.StructField("row", T.LongType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("n", T.LongType()), T.StructField("bytes", T.BinaryType())])
_SNIPPET_NAMES = SNIPPETS.names


def snippets(docs: DataFrame, length: int, core: int) -> DataFrame:
    """The runs whose core repeats (columns doc_id, text, row, cores, mixed).

    Three kinds of rows: ``row, start, end`` is a repeated span (runs of a core all of whose
    runs have equal bytes); ``core, a, b, row, start`` is a place of a run to be judged;
    ``core, a, b, n, bytes`` is such a run's snippet with its number of places in the task.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int, int], list] = {}
        size = 0
        for batch in batches:
            data, offsets = B.text_bytes(batch.column(1))
            rows, cores, mixed = batch.column(2).to_numpy(), batch.column(3), batch.column(4)
            for i, j in B.chunks(offsets, CHUNK_BYTES):
                part = data[offsets[i] : offsets[j]]
                doc, first, last, key = text_runs(part, offsets[i : j + 1] - offsets[i], length, core)
                bounds = np.searchsorted(doc, np.arange(j - i + 1))
                spans: list[tuple] = []
                places: list[tuple] = []
                for d in range(j - i):
                    mine = slice(bounds[d], bounds[d + 1])
                    base = int(offsets[i + d] - offsets[i])
                    name = int(rows[i + d])
                    alike = np.flatnonzero(np.isin(key[mine], cores[i + d].values.to_numpy())) + bounds[d]
                    cover = _cover(first[alike] - base, last[alike] - base + length)
                    spans += [(name, int(x), int(y)) for x, y in cover]
                    for k in np.flatnonzero(np.isin(key[mine], mixed[i + d].values.to_numpy())) + bounds[d]:
                        text = part[first[k] : last[k] + length].tobytes()
                        digest = xxhash.xxh3_128_intdigest(text)
                        run = (int(key[k]), (digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63))
                        places.append((*run, name, int(first[k]) - base))
                        if run in held:
                            held[run][0] += 1
                        else:
                            held[run] = [1, text]
                            size += len(text)
                yield _rows({"row": 0, "start": 1, "end": 2}, spans)
                yield _rows({"core": 0, "a": 1, "b": 2, "row": 3, "start": 4}, places)
                if size > SHARD_BYTES * 8:
                    yield from _texts(held)
                    held, size = {}, 0
        yield from _texts(held)

    return docs.mapInArrow(find, SNIPPETS)


def _rows(place: dict[str, int], rows: list[tuple]) -> pa.RecordBatch:
    """Tuples as a batch of SNIPPETS rows; columns without a place are null."""
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(place)
    kinds = {name: pa.binary() if name == "bytes" else pa.int64() for name in _SNIPPET_NAMES}
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[place[name]], kind) if name in place else pa.nulls(len(rows), kind)
         for name, kind in kinds.items()], _SNIPPET_NAMES)


def _texts(held: dict) -> Iterator[pa.RecordBatch]:
    every = [(*name, n, text) for name, (n, text) in held.items()]
    for at in range(0, len(every), 4096):
        yield _rows({"core": 0, "a": 1, "b": 2, "n": 3, "bytes": 4}, every[at : at + 4096])


FOUND = "core long, a long, b long, runs array<struct<first:int,last:int>>"
_FOUND = pa.schema([("core", pa.int64()), ("a", pa.int64()), ("b", pa.int64()),
                    ("runs", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))])


class Piece:
    """A distinct snippet in a shard and which of its windows are known to repeat."""

    __slots__ = ("hit", "n", "name", "text")

    def __init__(self, name: tuple[int, int, int], n: int, text: bytes, length: int):
        self.name, self.n, self.text = name, n, text
        self.hit = np.zeros(len(text) - length + 1, dtype=bool)


def settle(pieces: list[Piece], length: int) -> S.Shard:
    """Mark the windows that repeat within a shard; returns it for later look-ups."""
    shard = S.Shard([p.text for p in pieces], length)
    hit = S.repeated(shard)
    for p, at in zip(pieces, shard.first, strict=True):
        p.hit |= hit[at : at + len(p.hit)]
    return shard


def merge(old: tuple[S.Shard, list[Piece]], new: tuple[S.Shard, list[Piece]], core: int, length: int) -> None:
    """Mark the windows of ``core`` that repeat across two shards, by binary search both ways."""
    for (shard, _), (_, pieces) in ((old, new), (new, old)):
        for p in pieces:
            if p.name[0] == core and not p.hit.all():
                open_ = np.flatnonzero(~p.hit)
                text = np.frombuffer(p.text, np.uint8)
                p.hit[open_] |= S.found_in(shard, np.lib.stride_tricks.sliding_window_view(text, length)[open_])


def _found(pieces: list[Piece]) -> Iterator[pa.RecordBatch]:
    out = []
    for p in pieces:
        if p.n > 1:
            edges = [[0, len(p.hit)]]
        else:
            edges = np.flatnonzero(np.diff(np.concatenate([[0], p.hit.view(np.int8), [0]]))).reshape(-1, 2)
        if len(edges):
            out.append({"core": p.name[0], "a": p.name[1], "b": p.name[2],
                        "runs": [{"first": int(x), "last": int(y) - 1} for x, y in edges]})
    if out:
        yield pa.RecordBatch.from_pylist(out, _FOUND)


def shard_runs(texts: DataFrame, length: int, shard_bytes: int) -> DataFrame:
    """Repeated runs of windows of each snippet, by suffix arrays over shards of a partition."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Closed shards that still hold the current core, the open shard, and the current core's pieces.
        kept: list[tuple[S.Shard, list[Piece]]] = []
        shard: list[Piece] = []
        group: list[Piece] = []
        held = 0

        def close(pieces: list[Piece], core: int | None) -> Iterator[pa.RecordBatch]:
            """Settle a full shard; keep it while ``core`` goes on, else hand out its pieces."""
            nonlocal kept
            built = (settle(pieces, length), pieces)
            for earlier in kept:
                merge(earlier, built, earlier[1][-1].name[0], length)
            if core is not None and pieces[-1].name[0] == core:
                for k in kept:
                    if k[1][-1].name[0] != core:
                        yield from _found(k[1])
                kept = [*(k for k in kept if k[1][-1].name[0] == core), built]
            else:
                for k in kept:
                    yield from _found(k[1])
                kept = []
                yield from _found(pieces)

        def finish_group(group: list[Piece]) -> Iterator[pa.RecordBatch]:
            """A core with one snippet needs no suffix array: its places are all alike."""
            nonlocal shard, held
            if len(group) == 1:
                yield from _found(group)
                return
            for p in group:
                shard.append(p)
                held += len(p.text)
                if held >= shard_bytes:
                    full, shard, held = shard, [], 0
                    yield from close(full, p.name[0] if p is not group[-1] else None)

        for batch in batches:
            for core, a, b, n, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                name = (core, a, b)
                if group and group[-1].name == name:
                    group[-1].n += n
                    continue
                if group and group[-1].name[0] != core:
                    yield from finish_group(group)
                    group = []
                group.append(Piece(name, n, text, length))
        if group:
            yield from finish_group(group)
        if shard:
            yield from close(shard, None)
        for k in kept:
            yield from _found(k[1])

    return (texts.select("core", "a", "b", "n", "bytes").repartition("core")
            .sortWithinPartitions("core", "a", "b").mapInArrow(work, FOUND))


def counted_runs(texts: DataFrame, length: int) -> DataFrame:
    """The same for cores with very many snippets: windows counted by digest over all partitions."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for core, a, b, n, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                digests = [xxhash.xxh3_128_digest(text[k : k + length]) for k in range(len(text) - length + 1)]
                m = len(digests)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digests, pa.binary()), *(pa.array(np.full(m, x)) for x in (core, a, b)),
                     pa.array(np.arange(m, dtype=np.int32)), pa.array(np.full(m, n))],
                    ["digest", "core", "a", "b", "at", "n"])

    each = texts.select("core", "a", "b", "n", "bytes").mapInArrow(
        windows, "digest binary, core long, a long, b long, at int, n long")
    many = cut(each.groupBy("digest").agg(F.sum("n").alias("total")).filter("total > 1").select("digest"), "many")
    return (each.join(many, "digest").select("core", "a", "b", "at").distinct()
            .groupBy("core", "a", "b")
            .agg(F.collect_list(F.struct(F.col("at").alias("first"), F.col("at").alias("last"))).alias("runs")))


RESULT = [T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
          T.StructField("n_spans", T.LongType()), T.StructField("kept_sha256", T.StringType()),
          T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.LongType()),
                                                             T.StructField("end", T.LongType())])))]


def _cover(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Maximal runs (start, end) of the union of the spans."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.ones(len(starts), dtype=bool)
    fresh[1:] = starts[1:] > ends[:-1]
    first = np.flatnonzero(fresh)
    return np.stack([starts[first], ends[np.append(first[1:], len(starts)) - 1]], axis=1)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   core: int = CORE, shard_bytes: int = SHARD_BYTES, hot: int = HOT,
                   with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (byte spans).

    ``with_text`` adds ``kept`` (the remaining bytes; a cut may fall inside a character).
    """
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = B.text_bytes(batch.column(1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_row_id(batch.column(0), data, offsets))],
                                             ["doc_id", "text", "row"])

    rows = plain.mapInArrow(named, T.StructType([*plain.schema.fields, T.StructField("row", T.LongType())]))
    runs_ = cut(core_rows(plain, length, core), "cores")
    # Written first: a join straight on the aggregate's partitions could not split those of a hot core.
    repeated = cut(runs_.groupBy("core").agg(F.count("*").alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"))
                   .filter("n > 1").select("core", (F.col("low") != F.col("high")).alias("mixed")), "repeated")
    wanted = (runs_.select("row", "core").join(repeated, "core").groupBy("row")
              .agg(F.collect_set(F.when(~F.col("mixed"), F.col("core"))).alias("cores"),
                   F.collect_set(F.when(F.col("mixed"), F.col("core"))).alias("mixed")))
    found = cut(snippets(rows.join(wanted, "row").select("doc_id", "text", "row", "cores", "mixed"), length, core),
                "snippets")
    texts, places = found.filter("bytes IS NOT NULL"), found.filter("bytes IS NULL AND core IS NOT NULL")
    big = cut(texts.select("core", "a", "b").distinct().groupBy("core").agg(F.count("*").alias("n"))
              .filter(F.col("n") > hot).select("core"), "hot")
    # A hot core has over ``hot`` snippets, so these are few; they are broadcast only if they really are.
    n_big = big.count()
    if n_big == 0:
        done = shard_runs(texts, length, shard_bytes)
    else:
        big = F.broadcast(big) if n_big <= HOT_BROADCAST else big
        done = (shard_runs(texts.join(big, "core", "left_anti"), length, shard_bytes)
                .unionByName(counted_runs(texts.join(big, "core", "left_semi"), length)))
    judged = (places.select("core", "a", "b", "row", "start").join(done, ["core", "a", "b"])
              .select("row", F.explode("runs").alias("run"), "start")
              .select("row", (F.col("start") + F.col("run.first")).alias("start"),
                      (F.col("start") + F.col("run.last") + length).alias("end")))
    spans = (judged.unionByName(found.filter("core IS NULL").select("row", "start", "end"))
             .groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("spans")))
    joined = rows.join(spans, "row", "left").select("doc_id", "text", "spans")

    def erase(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = B.text_bytes(batch.column(1))
            out, kept = [], []
            for d in range(batch.num_rows):
                text = data[offsets[d] : offsets[d + 1]]
                some = batch.column(2)[d]
                starts = ends = np.zeros(0, np.int64)
                if some.is_valid:
                    starts, ends = some.values.field(0).to_numpy(), some.values.field(1).to_numpy()
                cover = _cover(starts, ends)
                keep = np.ones(len(text), dtype=bool)
                for x, y in cover:
                    keep[x:y] = False
                rest = text[keep].tobytes()
                kept.append(rest)
                out.append({"n_bytes": len(text), "n_removed": len(text) - len(rest), "n_spans": len(cover),
                            "kept_sha256": hashlib.sha256(rest).hexdigest(),
                            "removed": [{"start": int(x), "end": int(y)} for x, y in cover]})
            facts = pa.RecordBatch.from_pylist(out, pa.schema([
                ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                ("kept_sha256", pa.string()),
                ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))]))
            extra = [pa.array(kept, pa.binary())] if with_text else []
            yield pa.RecordBatch.from_arrays([batch.column(0), *facts.columns, *extra],
                                             ["doc_id", *facts.schema.names, *["kept"][: len(extra)]])

    schema = T.StructType([joined.schema["doc_id"], *RESULT,
                           *([T.StructField("kept", T.BinaryType())] if with_text else [])])
    return joined.mapInArrow(erase, schema)
