"""Byte-level BPE encoding and decoding with the tokenizers library.

A vocabulary is a file of byte strings and ranks.  Every byte has a character of its own (the printable
ones stand for themselves, the others for 256 onwards), so that a token's bytes are a string and
the library's BPE model works on it.  An Arrow batch of texts is cut into the pattern's
matches; the distinct ones that the task has not met are encoded in one call and remembered (at most
``KNOWN`` of them at a time).  The library's splitter cuts, in windows of ``WINDOW`` characters; texts of
common Latin characters are cut by the ``regex`` library, which is faster and finds the same matches.

Merges.  A rank belongs to a token, while the library ranks pairs, so every way to put a token together
from two others is given to it, in the order of the tokens' ranks.  The two orders can differ only if two
places of a match could become one token by different pairs at once; such a token has at least three
bytes and stands at two places, so matches with a repeated run of three bytes (few, and each
encoded once) are merged rank by rank, leftmost first.

Decoding goes back from a token's characters to its bytes by the reversed table and joins
them; a character whose bytes lie in several tokens is whole again in the joined bytes.  Bytes that are no
whole character (ids cut inside one) become U+FFFD in the decoded text, or wait for the next ids in
``decode_chunks``.  Offsets are the code points that a token's bytes touch: tokens that share a
character have the same one.

No shuffle: a row depends on its text alone, and a lost task is repeated alone.  Defined cases: a null
text is empty and has no ids; null ids decode to nothing; an id outside the vocabulary raises; a
null document id and repeated rows are rows like any other; other columns take no part in encoding and pass
through decoding; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import codecs
import heapq
import re
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.llm import bytes_np as B

WINDOW = 4096
EDGE = 8
"""Matches at a window's end that are cut again in the next one: what lies behind it could change them."""
OTHER = "[^\\x00-\u024F\u2010-\u2027]"
"""Characters beyond those whose letters, digits and spaces every engine has always known alike."""
KNOWN = 200_000
KNOWN_LENGTH = 256
"""Longer matches are encoded where they stand and not remembered."""


def byte_characters() -> list[str]:
    """The character of each byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    table = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(others)}
    return [table[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def repeats(piece: bytes) -> bool:
    """Whether some run of three bytes stands at two places."""
    n = len(piece) - 2
    return n > 1 and len({piece[i : i + 3] for i in range(n)}) < n


class Codec:
    """Encodes and decodes with one vocabulary and pattern."""

    def __init__(self, path: str, pattern: str):
        import regex
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        self.ranks = ranks = read_ranks(path)
        character = byte_characters()
        name = {rank: "".join(character[b] for b in token) for token, rank in ranks.items()}
        pairs = sorted((rank, ranks[token[:i]], ranks[token[i:]]) for token, rank in ranks.items()
                       for i in range(1, len(token)) if token[:i] in ranks and token[i:] in ranks)
        model = models.BPE(vocab={text: rank for rank, text in name.items()},
                           merges=[(name[a], name[b]) for _, a, b in pairs], ignore_merges=True)
        self.model = Tokenizer(model)
        self.model.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.splitter = pre_tokenizers.Split(Regex(pattern), "isolated")
        self.plain, self.other = regex.compile(pattern), re.compile(OTHER)
        self.known: dict[str, bytes] = {}
        # Back from characters to bytes.
        byte = {c: b for b, c in enumerate(character)}
        tokens = {i: bytes(byte[c] for c in text) for text, i in self.model.get_vocab().items()}
        self.size = np.zeros(max(tokens) + 1, np.int64)
        for i, token in tokens.items():
            self.size[i] = len(token)
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokens[i] for i in sorted(tokens)), np.uint8)
        self.longest = int(self.size.max())

    def pieces(self, text: str) -> Iterator[str]:
        """The pattern's matches."""
        if not self.other.search(text):
            return (m[0] for m in self.plain.finditer(text))
        return self.split(text)

    def split(self, text: str) -> Iterator[str]:
        """The pattern's matches by the library's splitter, in windows."""
        at, width = 0, WINDOW
        while at < len(text):
            found = [piece for piece, _ in self.splitter.pre_tokenize_str(text[at : at + width])]
            if at + width < len(text):
                found = found[:-EDGE]
                if not found:  # a few matches fill the window
                    width *= 2
                    continue
            yield from found
            at += sum(map(len, found))
            width = WINDOW

    def merged(self, piece: bytes) -> list[int]:
        """Ids of one match: the pair that makes the token of least rank is joined, the leftmost of equals."""
        if piece in self.ranks:
            return [self.ranks[piece]]
        n = len(piece)
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int]] = []

        def offer(at: int) -> None:
            """The pair of the part that starts at ``at`` and the next one."""
            if end[at] < n:
                last = end[end[at]]
                rank = self.ranks.get(piece[at:last]) if last - at <= self.longest else None
                if rank is not None:
                    heapq.heappush(heap, (rank, at, last))

        for at in range(n):
            offer(at)
        while heap:
            _, at, last = heapq.heappop(heap)
            middle = end[at]
            if not middle or middle >= last or end[middle] != last:
                continue  # one of the two parts has been joined meanwhile
            end[at], end[middle] = last, 0
            if last < n:
                before[last] = at
            offer(at)
            if before[at] >= 0:
                offer(before[at])
        out, at = [], 0
        while at < n:
            out.append(self.ranks[piece[at : end[at]]])
            at = end[at]
        return out

    def learn(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Ids of distinct matches, as little-endian bytes."""
        out, plain = {}, []
        for piece in pieces:
            raw = piece.encode()
            if repeats(raw):
                out[piece] = packed(self.merged(raw))
            else:
                plain.append(piece)
        for piece, found in zip(plain, self.model.encode_batch_fast(plain, add_special_tokens=False), strict=True):
            out[piece] = packed(found.ids)
        return out

    def encode(self, texts: list[str], limit: int = 1 << 20) -> Iterator[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        first = 0
        while first < len(texts):
            last, held = first, 0
            while last < len(texts) and (last == first or held + len(texts[last]) <= limit):
                held += len(texts[last])
                last += 1
            if held > limit:
                yield self._long(texts[first])
            else:
                cut = [list(self.pieces(t)) for t in texts[first:last]]
                known = self._with({p for c in cut for p in c})
                yield from (b"".join([known[p] for p in c]) for c in cut)
            first = last

    def _with(self, pieces: set[str]) -> dict[str, bytes]:
        """A table that holds these matches."""
        if len(self.known) > KNOWN:
            self.known = {}
        fresh = [p for p in pieces if p not in self.known]
        found = self.learn(fresh)
        if any(len(p) > KNOWN_LENGTH for p in fresh):
            self.known |= {p: ids for p, ids in found.items() if len(p) <= KNOWN_LENGTH}
            return self.known | found
        self.known |= found
        return self.known

    def _long(self, text: str) -> bytes:
        """A long text, some thousand matches at a time."""
        out, held = bytearray(), []
        for piece in self.pieces(text):
            held.append(piece)
            if len(held) == 10_000:
                known = self._with(set(held))
                out += b"".join([known[p] for p in held])
                held = []
        known = self._with(set(held))
        return bytes(out + b"".join([known[p] for p in held]))

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The joined bytes of the tokens."""
        ids = ids.astype(np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size) or not self.size[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        size = self.size[ids]
        total = int(size.sum())
        at = np.repeat(self.start[ids] - (np.cumsum(size) - size), size) + np.arange(total)
        return self.bytes[at]

    def offsets(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, end) of each token in code points of the decoded text."""
        last = np.cumsum(self.size[ids.astype(np.int64)])
        raw = self.decode(ids)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        return character[last - self.size[ids.astype(np.int64)]], character[last - 1] + 1

    def decode_chunks(self, chunks: Iterable[np.ndarray]) -> Iterator[str]:
        """Text of successive chunks of ids; a character split between two comes with the later one."""
        text = codecs.getincrementaldecoder("utf-8")("replace")
        for ids in chunks:
            yield text.decode(self.decode(ids).tobytes())
        if rest := text.decode(b"", final=True):
            yield rest


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """One codec per worker process, vocabulary and pattern."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           with_offsets: bool = False) -> DataFrame:
    """One row per document: doc_id, ids (little-endian unsigned 32-bit integers, see ``id_array``).

    ``with_offsets`` adds ``starts`` and ``ends``, the tokens' places in code points.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    extra = ["starts", "ends"] if with_offsets else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            _, at = B.text_bytes(batch.column(1))
            for i, j in B.chunks(at):
                ids = list(own.encode([t or "" for t in batch.column(1).slice(i, j - i).to_pylist()]))
                columns = [batch.column(0).slice(i, j - i), pa.array(ids, pa.binary())]
                if with_offsets:
                    places = [own.offsets(np.frombuffer(x, "<u4")) for x in ids]
                    columns += [pa.array([p[k] for p in places], pa.list_(pa.int64())) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", *extra])

    return rows.mapInArrow(run, T.StructType([
        rows.schema["doc_id"], T.StructField("ids", T.BinaryType()),
        *(T.StructField(x, T.ArrayType(T.LongType())) for x in extra)]))


def decode(rows: DataFrame, path: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded",
           text: bool = False) -> DataFrame:
    """``rows`` with ``bytes_col`` (the tokens' bytes; a column of that name is replaced), and with
    ``text`` as a string in which bytes of no whole character are U+FFFD."""
    names = [c for c in rows.columns if c != bytes_col]
    rows = rows.select(*names)
    place, kind = names.index(ids_col), pa.string() if text else pa.binary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            size = np.array([len(x) if x is not None else 0 for x in batch.column(place).to_pylist()], np.int64)
            at = np.concatenate([[0], np.cumsum(size)])
            for i, j in B.chunks(at):
                found = [None if x is None else own.decode(np.frombuffer(x, "<u4")).tobytes()
                         for x in batch.column(place).slice(i, j - i).to_pylist()]
                if text:
                    found = [None if x is None else x.decode("utf-8", "replace") for x in found]
                yield pa.RecordBatch.from_arrays([*batch.slice(i, j - i).columns, pa.array(found, kind)],
                                                 [*names, bytes_col])

    return rows.mapInArrow(run, T.StructType([
        *rows.schema.fields, T.StructField(bytes_col, T.StringType() if text else T.BinaryType())]))


def id_array(ids: bytes | None) -> np.ndarray:
    """The ids of a row of ``encode``."""
    return np.frombuffer(ids or b"", "<u4")
