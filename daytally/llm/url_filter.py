"""URL rules by a Bloom filter cascade: exact membership without joins.

A url's candidate keys are the (host suffix, path prefix) strings whose lengths some rule has.
The cascade answers, for every key that occurs in the corpus, whether it is a rule's key: level 0
is a Bloom filter of the listed keys, level 1 one of the corpus's other keys that pass
level 0, level 2 one of the listed keys that pass level 1, and so on until no key is misjudged.
A key is listed if the first level that it fails has an odd number (a key that passes all is
decided by the last level's side).  Over the complete key universe of the corpus this is exact, so
pages are judged where they are read: no join, no shuffle.

Building: the distinct candidate keys of all pages are marked as listed or not (once, by a join
over distinct keys), each level's keys are hashed on the executors, and its bits are joined by
``bit_or`` per 64-bit word.  Level 0 has a false positive rate of about listed / universe, the
others one half, so all levels together take a few bits per listed key.  If the listed keys that
occur pass ``MAX_LISTED`` (the broadcast bound), pages are judged by a join over distinct urls.

Rules: host and path; a rule fits its host and all subdomains if the url's path starts with the
rule's path.  The longest fitting rule (host and path together, then the longer host) decides;
where none fits the verdict is ``default``.

Defined cases: a null url or one without ``://`` has an empty host and path and fits no rule; a null
rule host or path is empty, and an empty host fits no url; of rules with equal keys, block wins;
repeated pages are judged row by row; without rules or pages the cascade has no levels and lists nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.llm.scratch import cut

MAX_LISTED = 20_000_000
"""Listed keys in one broadcast cascade (about 3 bytes each)."""
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def candidate_keys(host_: str, path_: str, shapes: dict[int, list[int]]) -> list[str]:
    """The keys that could be a rule's, best first; ``shapes`` has rule host lengths with their path lengths."""
    found = []
    for size, paths in shapes.items():
        at = len(host_) - size
        if at == 0 or at > 0 and host_[at - 1] == ".":
            found += [(size + p, size, host_[at:] + path_[:p]) for p in paths if p <= len(path_)]
    return [key for _, _, key in sorted(found, key=lambda k: (-k[0], -k[1]))]


def _hashes(keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    both = [xxhash.xxh3_128_intdigest(k.encode()) for k in keys]
    return (np.array([h >> 64 for h in both], dtype=np.uint64),
            np.array([h & (1 << 64) - 1 for h in both], dtype=np.uint64) | np.uint64(1))


@dataclass
class Level:
    bits: int
    hashes: int
    number: int
    words: np.ndarray | None = None

    def places(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Bit places of keys (keys x hashes); each level draws its own."""
        seed = np.uint64((self.number * 0x9E3779B97F4A7C15 + 1) & (1 << 64) - 1)
        a = (a ^ seed) * np.uint64(0xD6E8FEB86659FD93)
        a ^= a >> np.uint64(32)
        steps = np.arange(self.hashes, dtype=np.uint64)
        mixed = (a[:, None] + steps * b[:, None]) * np.uint64(0xBF58476D1CE4E5B9)
        return ((mixed ^ (mixed >> np.uint64(31))) % np.uint64(self.bits)).astype(np.int64)

    def has(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        at = self.places(a, b)
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1)


@dataclass
class Cascade:
    levels: list[Level]

    def listed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Exact for every key of the universe it was built over."""
        out = np.zeros(len(a), dtype=bool)
        live = np.arange(len(a))
        for level in self.levels:
            passed = level.has(a[live], b[live])
            # A key of the other side is stopped here; one that passes belongs to this side unless a later level stops it.
            live = live[passed]
            out[live] = level.number % 2 == 0
        return out

    def passed(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        ok = np.ones(len(a), dtype=bool)
        for level in self.levels:
            ok &= level.has(a, b)
        return ok


def build(universe: DataFrame) -> Cascade:
    """A cascade over ``universe``: distinct keys (columns key, listed)."""
    spark = universe.sparkSession

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = _hashes(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)),
                                              batch.column(1)], ["a", "b", "listed"])

    keys = cut(universe.select("key", "listed").mapInArrow(hashed, "a long, b long, listed boolean"), "keys")
    total = {r["listed"]: r["n"] for r in keys.groupBy("listed").agg(F.count("*").alias("n")).collect()}
    listed, other = total.get(True, 0), total.get(False, 0)
    levels: list[Level] = []
    left = keys.filter("listed")
    n = listed
    while n:
        number = len(levels)
        rate = min(0.5, max(listed, 1) / max(1.0, 1.5 * other)) if number == 0 else 0.5
        hashes = max(1, round(-math.log2(rate)))
        level = Level(max(64, math.ceil(1.4427 * hashes * n / 64) * 64), hashes, number)
        level.words = _filled(left, level)
        levels.append(level)
        # The next level's keys: those of the other side that pass all levels so far.
        side = number % 2 == 1
        shared = spark.sparkContext.broadcast(Cascade(list(levels)))

        def misjudged(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a = batch.column(0).to_numpy().view(np.uint64)
                b = batch.column(1).to_numpy().view(np.uint64)
                yield batch.filter(pa.array(shared.value.passed(a, b)))

        left = keys.filter(F.col("listed") == F.lit(side)).mapInArrow(misjudged, keys.schema)
        n = left.count()
    return Cascade(levels)


def _filled(keys: DataFrame, level: Level) -> np.ndarray:
    """The level's words: bits set on the executors, joined by word."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = level.places(batch.column(0).to_numpy().view(np.uint64),
                              batch.column(1).to_numpy().view(np.uint64)).ravel()
            mask = np.uint64(1) << (at & 63).astype(np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array(mask.view(np.int64))], ["word", "mask"])

    rows = keys.mapInArrow(bits, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask"))
    words = np.zeros(level.bits // 64, dtype=np.uint64)
    for row in rows.toLocalIterator():
        words[row["word"]] = row["mask"] & (1 << 64) - 1
    return words


def _shapes(rules: DataFrame) -> dict[int, list[int]]:
    """Rule host lengths with their path lengths (bounded by the longest host and path of the rules)."""
    rows = rules.select(F.length("host").alias("h"), F.length("path").alias("p")).distinct().collect()
    out: dict[int, list[int]] = {}
    for r in rows:
        out.setdefault(r["h"], []).append(r["p"])
    return {h: sorted(p, reverse=True) for h, p in sorted(out.items(), reverse=True)}


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = "allow", max_listed: int = MAX_LISTED) -> DataFrame:
    """page_id, host, path, rule and verdict of every page; ``rules`` has host, path and action (allow or block)."""
    spark = pages.sparkSession
    rules = (rules.select(F.coalesce("host", F.lit("")).alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                          (F.col("action") == "block").alias("block"))
             .filter("host <> ''"))
    named = rules.groupBy(F.concat("host", "path").alias("key")).agg(F.max("block").alias("block"))
    shapes = _shapes(rules)
    places = pages.select(F.col(id_col).alias("page_id"), host(F.col(url_col)).alias("host"),
                          path(F.col(url_col)).alias("path"))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {k for h, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                     for k in candidate_keys(h, p, shapes)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["key"])

    universe = cut(places.select("host", "path").mapInArrow(keys, "key string").distinct()
                   .join(named, "key", "left")
                   .select("key", F.col("block").isNotNull().alias("listed"), "block"), "universe")
    if universe.filter("listed").count() > max_listed:
        return _judge_by_join(places, universe, shapes, default)
    # One cascade for the rules' keys among the corpus's, one for the blocking ones among those.
    shared = spark.sparkContext.broadcast((
        build(universe), build(universe.filter("listed").select("key", F.col("block").alias("listed")))))

    def decide(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rule_of, blocks = shared.value
        for rows in batches:
            found = [candidate_keys(h, p, shapes) for h, p in zip(rows["host"], rows["path"], strict=True)]
            flat = [k for ks in found for k in ks]
            a, b = _hashes(flat)
            listed, block = rule_of.listed(a, b), blocks.listed(a, b)
            rule, verdict, at = [], [], 0
            for ks in found:
                first = next((k for k in range(at, at + len(ks)) if listed[k]), None)
                rule.append(None if first is None else flat[first])
                verdict.append(default if first is None else "block" if block[first] else "allow")
                at += len(ks)
            yield rows.assign(rule=rule, verdict=verdict)

    fields = f"page_id {places.schema['page_id'].dataType.simpleString()}, host string, path string, rule string, verdict string"
    return places.mapInPandas(decide, fields)


def _judge_by_join(places: DataFrame, universe: DataFrame, shapes: dict[int, list[int]], default: str) -> DataFrame:
    """The same by joins over distinct (host, path), for lists beyond the broadcast bound."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(h, p, k, n) for h, p in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                   for n, k in enumerate(candidate_keys(h, p, shapes))]
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.string()] * 3 + [pa.int32()], strict=True)],
                ["host", "path", "key", "place"])

    each = places.select("host", "path").distinct().mapInArrow(keys, "host string, path string, key string, place int")
    best = (each.join(universe.filter("listed"), "key").groupBy("host", "path")
            .agg(F.min_by(F.struct("key", "block"), "place").alias("best")))
    return (places.join(best, ["host", "path"], "left")
            .select("page_id", "host", "path", F.col("best.key").alias("rule"),
                    F.when(F.col("best").isNull(), default).when(F.col("best.block"), "block").otherwise("allow")
                    .alias("verdict")))
