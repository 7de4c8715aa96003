"""Near-duplicate detection: MinHash bands propose, odd sketches estimate, full sets decide.

A document's set holds its distinct shingles of ``SHINGLE`` words.  Documents are linked when
the Jaccard similarity of their sets is at least ``PERCENT`` / 100; groups are the connected
components of the links.

1. Equal sets collapse to one class (grouped by a 128-bit set hash, pre-aggregated), so copies
   never meet one by one.
2. A class has ``BANDS`` x ``ROWS`` MinHash samples.  At a similarity of 0.8 two classes share no band
   with probability (1 - 0.8^5)^40 = 1.3e-7.
3. The samples are folded into an odd sketch: ``BITS`` bits, each sample flips one.  The popcount of
   the XOR of two sketches estimates the size of the sets' symmetric difference; pairs beyond
   ``MAX_ODD`` differing bits (5 standard deviations below 0.8) are dropped before the sets are read.
4. Pairs that remain, and keep the length bound, are confirmed on the full sets.

No band bucket emits all its pairs.  In a star round every class is compared with one head: the class
among its buckets' heads that shares most bands with others (mostly the original of the copies).
The confirmed links give components, and a bucket that lies in one component is done.  What that
leaves, buckets with several components, is finished exactly: members outside the bucket's largest
component meet the members of the other components, in the least bucket of a pair only.  Where up to
``MEET`` members are outside, no member meets more than those.  Members of other buckets do not meet there,
as a large family of texts somewhat below the threshold would cost its square: they are joined on the
rarest shingles of their full sets (prefix-filtered, with length and positional bounds), which every linked
pair shares.  In both joins a key's members are dealt over parts of about ``PART``, each of which meets all
the members outside the largest component, so a hot key is spread over many tasks.  Only pairs that a second
odd sketch, of the whole sets, allows (its differing bits never exceed the sets' differing shingles) are
confirmed.  So any two linked classes that share a band end in one component.

Defined cases: a text with fewer words than a shingle has its whole word sequence as its one
shingle; without words (null, empty) the set is empty and linked with nothing; a null id names
no component, takes no part in links and is kept; rows that repeat an id are one document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daytally.llm import bytes_np as B
from daytally.llm.components import components
from daytally.llm.scratch import cut

SHINGLE, PERCENT = 5, 80
BANDS, ROWS = 40, 5
BITS, MAX_ODD = 512, 119
FULL_BITS = 2048
MEET, PART = 64, 1024
_LONGS = BITS // 64

_rng = np.random.Generator(np.random.PCG64(20240229))
_MULTIPLY = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_FLIP = _rng.integers(0, 1 << 32, BANDS * ROWS, dtype=np.uint32)
_BAND = _rng.integers(0, 1 << 63, BANDS, dtype=np.uint64) | np.uint64(1)
_STEP = np.uint64(0x9FB21C651E98DF25)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each document of a chunk."""
    lower = B.LOWER[data]
    start, end, doc = B.words(lower, offsets, B.SPACE)
    hashes = B.window_hash(B.prefix_hash(lower), start, end)
    ids = np.arange(len(offsets) - 1)
    first, last = np.searchsorted(doc, ids), np.searchsorted(doc, ids, side="right")
    n = max(0, len(hashes) - size + 1)
    value = hashes[:n].copy()
    for k in range(1, size):
        value = value * _STEP + hashes[k : k + n]
    value = B.mix(value + np.uint64(size))
    out = []
    for a, b in zip(first, last, strict=True):
        if b - a >= size:
            out.append(np.unique(value[a : b - size + 1]))
        elif b > a:
            whole = hashes[a : a + 1]
            for k in range(a + 1, b):
                whole = whole * _STEP + hashes[k : k + 1]
            out.append(B.mix(whole + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def samples(shingles: np.ndarray) -> np.ndarray:
    """The MinHash samples of a set that is not empty."""
    low = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(_MULTIPLY), 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(low), 512):
        part = low[at : at + 512, None] * _MULTIPLY
        part ^= _FLIP
        np.minimum(best, part.min(axis=0), out=best)
    return best


def odd_sketch(best: np.ndarray) -> np.ndarray:
    """The samples of each row folded into parity bitmaps (rows x _LONGS int64)."""
    place = B.mix(best.astype(np.uint64) + (np.arange(best.shape[1], dtype=np.uint64) << np.uint64(32)))
    flat = (place >> np.uint64(64 - 9)).astype(np.int64) + np.arange(len(best))[:, None] * BITS
    odd = (np.bincount(flat.ravel(), minlength=len(best) * BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).reshape(len(best), _LONGS)


def band_keys(best: np.ndarray) -> np.ndarray:
    """One key per band (rows x BANDS int64); keys of different bands differ."""
    rows = best.reshape(len(best), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(_BAND, rows.shape[:2]).copy()
    for k in range(ROWS):
        key = B.mix(key ^ rows[:, :, k]) * _STEP
    return B.mix(key).view(np.int64)


SIGNATURE = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("set_a", T.LongType()),
    T.StructField("set_b", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType())),
    *(T.StructField(f"s{k}", T.LongType()) for k in range(_LONGS))])


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """Set size, set hash, band keys and odd sketch of each document (columns doc_id, text)."""
    names = SIGNATURE.names

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            data, offsets = B.text_bytes(batch.column(1))
            for i, j in B.chunks(offsets):
                sets = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size)
                best = np.stack([samples(s) if len(s) else np.zeros(len(_MULTIPLY), np.uint32) for s in sets])
                keys = band_keys(best)
                bands = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel()))
                a = np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
                b = np.array([B.mix(s ^ _STEP).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
                sketch = odd_sketch(best)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(np.array([len(s) for s in sets], dtype=np.int64)),
                     pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), bands,
                     *(pa.array(np.ascontiguousarray(sketch[:, k])) for k in range(_LONGS))], names)

    return docs.mapInArrow(sign, SIGNATURE)


def full_sets(docs: DataFrame, size: int) -> DataFrame:
    """(node, shingles, odd) of each document (columns node, text): the set and its own odd sketch."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = FULL_BITS // 64
        for batch in batches:
            data, offsets = B.text_bytes(batch.column(1))
            for i, j in B.chunks(offsets):
                sets = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], size)
                ends = np.cumsum([0, *(len(s) for s in sets)]).astype(np.int32)
                every = np.concatenate(sets)
                row = np.repeat(np.arange(len(sets)), np.diff(ends))
                bit = (B.mix(every ^ _STEP) >> np.uint64(64 - 11)).astype(np.int64)
                odd = (np.bincount(row * FULL_BITS + bit, minlength=len(sets) * FULL_BITS) & 1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(every.view(np.int64))),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * longs),
                                              pa.array(np.packbits(odd).view(np.int64)))],
                    ["node", "shingles", "odd"])

    return docs.mapInArrow(build, "node long, shingles array<long>, odd array<long>")


def _near(a: str, b: str, percent: int) -> Column:
    """The length bound and the odd-sketch estimate for a pair of sketch rows."""
    odd = sum((F.bit_count(F.col(f"{a}.s{k}").bitwiseXOR(F.col(f"{b}.s{k}"))) for k in range(_LONGS)), F.lit(0))
    small, large = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    return (small * 100 >= large * percent) & (odd <= MAX_ODD)


def _near_full(a: str, b: str, percent: int) -> Column:
    """Whether the odd sketches of the whole sets allow a link.

    At the threshold the sets differ in ``most`` shingles.  No more bits than that can differ, and
    since several fall on one bit in large sets, the expected count plus six standard deviations
    bounds them too.
    """
    odd = sum((F.bit_count(F.col(f"{a}.o{k}").bitwiseXOR(F.col(f"{b}.o{k}"))) for k in range(FULL_BITS // 64)), F.lit(0))
    most = F.floor((F.col(f"{a}.n") + F.col(f"{b}.n")) * (100 - percent) / (100.0 + percent))
    share = most / FULL_BITS
    spread = F.sqrt(FULL_BITS / 4 * (1 - F.exp(-4 * share) * (1 + 4 * share)) + 1)
    return odd <= F.least(most.cast("double"), FULL_BITS / 2 * (1 - F.exp(-2 * share)) + 6 * spread)


def _main(rows: DataFrame, key: str) -> DataFrame:
    """The largest component of each group, its number of members and of those outside that component."""
    sizes = rows.groupBy(key, "component").agg(F.count("*").alias("size"))
    return sizes.groupBy(key).agg(F.max_by("component", F.struct("size", "component")).alias("main"),
                                  F.sum("size").alias("members"), (F.sum("size") - F.max("size")).alias("outside"))


def _meet(rows: DataFrame, key: str, condition: Column) -> DataFrame:
    """The pairs (a, b) of one group, of two components, that meet ``condition`` on ``x`` and ``y``; each once.

    ``rows`` has the columns of ``_main``.  ``y`` holds a group's rows, dealt over parts; ``x`` the rows outside its
    largest component, once for each part.
    """
    parts = F.ceil(F.col("members") / PART)
    x = (rows.filter("component <> main")
         .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).alias("x"))
    y = rows.withColumn("part", F.pmod(F.xxhash64("node"), parts)).alias("y")
    same = (F.col(f"x.{key}") == F.col(f"y.{key}")) & (F.col("x.part") == F.col("y.part"))
    once = (F.col("y.component") == F.col("y.main")) | (F.col("x.node") < F.col("y.node"))
    return (x.join(y, same & (F.col("x.component") != F.col("y.component")) & once & condition)
            .select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")))


class Linker:
    """Finds the links between classes, round by round."""

    def __init__(self, docs: DataFrame, size: int, percent: int):
        self.percent = percent
        docs = docs.filter("doc_id IS NOT NULL")
        self.sign = cut(signatures(docs, size), "signatures")
        # One class per distinct set; its node is its least document.
        sketch = [f"s{k}" for k in range(_LONGS)]
        keys = ["n", "set_a", "set_b"]
        # Equal sets have equal signatures, so any row of the class gives them.
        classes = (self.sign.filter("n > 0").groupBy(*keys)
                   .agg(F.min("doc_id").alias("node"), *(F.first(c).alias(c) for c in ["bands", *sketch])))
        self.classes = cut(classes, "classes")
        self.sketches = self.classes.select("node", "n", *sketch)
        member = self.classes.select("node", F.explode("bands").alias("bucket"))
        shared = member.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
        placed = cut(member.join(shared, "bucket"), "placed")
        # The original of many copies shares more bands with them than they share with each other.
        weight = placed.groupBy("node").agg(F.sum("size").alias("weight"))
        self.buckets = cut(placed.drop("size").join(weight, "node"), "buckets")
        active = self.buckets.select("node").distinct()
        self.sets = cut(full_sets(docs.join(active, docs["doc_id"] == active["node"]).select("node", "text"), size),
                        "sets")

    def proposed(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that the length bound and the sketches leave."""
        a, b = self.sketches.alias("x"), self.sketches.alias("y")
        return (pairs.join(a, F.col("a") == F.col("x.node")).join(b, F.col("b") == F.col("y.node"))
                .filter(_near("x", "y", self.percent)).select("a", "b"))

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The pairs that are linked, by their full sets."""
        one = self.sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
        two = self.sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
        both = F.size(F.array_intersect("sa", "sb"))
        union = F.size("sa") + F.size("sb") - both
        linked = pairs.join(one, "a").join(two, "b").filter(both * 100 >= union * self.percent)
        return linked.select("a", "b").distinct()  # an id with several texts has several sets

    def labelled(self, links: DataFrame) -> DataFrame:
        """The members of buckets that lie in several components, with their component."""
        part = components(links)
        every = (self.buckets.join(part, "node", "left")
                 .withColumn("component", F.coalesce("component", "node")))
        mixed = (every.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                 .filter("low < high").select("bucket"))
        return every.join(mixed, "bucket")

    def star(self, members: DataFrame) -> DataFrame:
        """Each member with the weightiest head of its buckets that lies in another component."""
        rank = F.struct("weight", (-F.col("node")).alias("first"))
        head = (members.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("node")).alias("first"), "component"))
                                              .alias("head")))
        return (members.join(head, "bucket").filter(F.col("component") != F.col("head.component"))
                .filter(rank < F.struct("head.weight", "head.first"))
                .groupBy("node").agg(F.max(F.struct("head.weight", "head.first")).alias("head"))
                .select((-F.col("head.first")).alias("a"), F.col("node").alias("b")))

    def rest(self, members: DataFrame) -> DataFrame:
        """Members outside their group's largest component, with the other components' members.

        With up to ``MEET`` of them in a bucket they meet there, a pair in the least of its shared buckets only.
        The members of other buckets meet where they share a prefix shingle instead.
        """
        known = members.join(_main(members, "bucket"), "bucket")
        fine = self.sets.select("node", *(F.get("odd", F.lit(k)).alias(f"o{k}") for k in range(FULL_BITS // 64)))
        nodes = members.select("node").distinct()
        facts = (self.classes.select("node", "n", "bands", *(f"s{k}" for k in range(_LONGS)))
                 .join(nodes, "node").join(fine, "node"))
        near = _near("x", "y", self.percent) & _near_full("x", "y", self.percent)
        first = F.col("x.bucket") == F.array_min(F.array_intersect("x.bands", "y.bands"))
        small = _meet(known.filter(F.col("outside") <= MEET).join(facts, "node"), "bucket", near & first)
        pairs = self.sharing(known.filter(F.col("outside") > MEET).select("node", "component").distinct())
        light = facts.drop("bands")
        large = (pairs.join(light.alias("x"), F.col("a") == F.col("x.node"))
                 .join(light.alias("y"), F.col("b") == F.col("y.node")).filter(near).select("a", "b"))
        return small.unionByName(large).distinct()

    def prefixes(self, nodes: DataFrame) -> DataFrame:
        """(node, component, n, shingle, place): the rarest shingles of each set, rarest first.

        Shingles are ordered by the number of the given nodes' sets that hold them, then by value.  Two sets of
        at least the similarity share ``percent`` / 100 of the larger one, so one of the first
        n - ceil(n * percent / 100) + 1 of each is the same.
        """
        every = (nodes.join(self.sets, "node")
                 .select("node", "component", F.size("shingles").alias("n"), F.xxhash64("shingles").alias("set"),
                         F.explode("shingles").alias("shingle")))
        often = every.groupBy("shingle").agg(F.count("*").alias("often"))
        order = Window.partitionBy("node", "n", "set").orderBy("often", "shingle")
        return (every.join(often, "shingle").withColumn("place", F.row_number().over(order))
                .filter(f"place <= n - (n * {self.percent} + 99) div 100 + 1")
                .select("node", "component", "n", "shingle", "place"))

    def sharing(self, nodes: DataFrame) -> DataFrame:
        """The pairs (a, b) of different components that share a prefix shingle and keep two bounds.

        The length bound, and the positional one: where two sets first agree, all that follows in both
        must be enough for the similarity.
        """
        prefix = cut(self.prefixes(nodes), "prefixes")
        rows = prefix.join(_main(prefix, "shingle").filter("outside > 0"), "shingle")
        small, large = F.least("x.n", "y.n"), F.greatest("x.n", "y.n")
        left = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")) + 1
        bound = ((small * 100 >= large * self.percent)
                 & (left * (100 + self.percent) >= (F.col("x.n") + F.col("y.n")) * self.percent))
        return _meet(rows, "shingle", bound).distinct()

    def links(self) -> DataFrame:
        """Links enough to connect all classes that belong together."""
        alone = self.buckets.withColumn("component", F.col("node"))
        found = cut(self.confirmed(cut(self.proposed(self.star(alone)), "pairs")), "found")
        mixed = cut(self.labelled(found), "members")
        return found.unionByName(cut(self.confirmed(cut(self.rest(mixed), "pairs")), "found"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    linker = Linker(rows, size, percent)
    part = components(linker.links())
    classes = (linker.classes.select("n", "set_a", "set_b", "node").join(part, "node", "left")
               .select("n", "set_a", "set_b", F.coalesce("component", "node").alias("component_id")))
    known = (linker.sign.select("doc_id", "n", "set_a", "set_b").join(classes, ["n", "set_a", "set_b"], "left")
             .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")))
    nameless = (signatures(rows.filter("doc_id IS NULL"), size)
                .select("doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id")))
    return (known.unionByName(nameless)
            .select("*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def keep_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
              percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group, with all columns."""
    flags = near_duplicates(docs, id_col, text_col, size, percent)
    gone = flags.filter("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[id_col].cast("long") == gone["_gone"], "left_anti")
