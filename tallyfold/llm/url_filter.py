"""URL verdicts from path rules and a list of blocked domains held as a Bloom filter cascade.

A URL's keys are its host and the host's parent domains, as far as they have no
more labels than the longest listed key (no other can be listed), so that the work
is in proportion to the URL. The cascade answers for
every key of the corpus whether it is listed, exactly and without a join: level 0
is a Bloom filter of the listed keys, level 1 one of the corpus's other keys that
level 0 takes for listed, level 2 one of the listed keys that level 1 takes for
others, and so on until a level has no false positive. A key is looked up level
by level; the first level that lacks it, or the last one, gives the answer.

Each level is built by Spark: tasks turn keys into (word, bits) and Spark unites
the bits. Keys of the corpus are reduced to distinct ones first, by a hash
aggregation that combines on the map side. Only the filters' words reach the
driver and the executors; their bits are at most ``MAX_BITS`` in total, about 190
million listed keys, and a longer list is refused with a ValueError.

Path rules are few and become column expressions. Of the rules that fit, the
longest decides (ties: the longer host); the list decides where none fits.

Defined cases: the host is what stands between the first ``://`` and the next
``/``, ``?``, ``#`` or end, with A-Z in lower case, the path what follows up to
``?``, ``#`` or end; both are empty without ``://`` or for a null URL, which is
allowed; repeated rows are judged alike; result columns replace input columns of
the same name; empty labels of a host (``a..b``) form keys like any other; a host may
have any number of labels and characters.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyfold.llm.common import stored

MAX_BITS = 1 << 33
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@dataclass
class Level:
    bits: int
    hashes: int
    number: int
    words: np.ndarray

    def places(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """(key, hash function) places of keys with two 64-bit hashes each."""
        a = _mix(first.view(np.uint64) + _U(self.number * 0x9E3779B97F4A7C15 % (1 << 64)))
        b = _mix(second.view(np.uint64) ^ a) | _U(1)
        return (a[:, None] + b[:, None] * np.arange(self.hashes, dtype=np.uint64)) % _U(self.bits)

    def has(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        at = self.places(first, second)
        return ((self.words[(at >> _U(6)).astype(np.int64)] >> (at & _U(63))) & _U(1)).all(axis=1)


def level_size(n: int, rate: float) -> tuple[int, int]:
    """Bits and hash functions for n keys and a rate of false positives."""
    bits = max(64, math.ceil(max(n, 1) * -math.log(rate) / math.log(2) ** 2))
    return -(-bits // 64) * 64, max(1, round(-math.log2(rate)))


class Cascade:
    """Exact membership for the keys that it was built over."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def listed(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        out = np.zeros(len(first), bool)
        left = np.arange(len(first))
        for number, level in enumerate(self.levels):
            hit = level.has(first[left], second[left])
            out[left[~hit]] = number % 2 == 1
            left = left[hit]
        out[left] = len(self.levels) % 2 == 1
        return out


def hashed(key: Column) -> Column:
    """The two hashes of a key that the filters work on."""
    return F.struct(F.xxhash64(key).alias("first"), F.xxhash64(F.lit("second"), key).alias("second"))


def build_cascade(keys: DataFrame) -> Cascade:
    """From distinct (key, listed) rows of the corpus's keys and all listed keys."""
    keys = stored(keys.select(hashed(F.col("key")).alias("h"), "listed").select("h.first", "h.second", "listed"), "url-keys")
    counts = {r[0]: r[1] for r in keys.groupBy("listed").agg(F.count("*")).collect()}
    sides = {side: keys.where(F.col("listed") == side).select("first", "second") for side in (True, False)}
    n, levels, used = {s: counts.get(s, 0) for s in sides}, [], 0
    side = True
    while not levels or n[side]:
        # the first level lets about as many others pass as there are listed keys, later ones half
        rate = min(0.5, max(1e-6, 0.7 * n[True] / max(n[False], 1))) if not levels else 0.5
        bits, hashes = level_size(n[side], rate)
        used += bits
        if used > MAX_BITS:
            raise ValueError("the list is longer than the filters may be")
        level = Level(bits, hashes, len(levels), np.zeros(0, np.uint64))
        level.words = _filled(sides[side], level)
        levels.append(level)
        side = not side
        sides[side] = stored(_hits(sides[side], level), "url-hits")
        n[side] = sides[side].count()
    return Cascade(levels)


def _filled(keys: DataFrame, level: Level) -> np.ndarray:
    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = level.places(batch.column(0).to_numpy(), batch.column(1).to_numpy()).reshape(-1)
            word, bit = (at >> _U(6)).astype(np.int64), _U(1) << (at & _U(63))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit.view(np.int64))], names=["word", "bits"])

    found = keys.mapInArrow(bits, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(level.bits // 64, np.uint64)
    words[found.column(0).to_numpy()] = found.column(1).to_numpy().view(np.uint64)
    return words


def _hits(keys: DataFrame, level: Level) -> DataFrame:
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def hit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.has(batch.column(0).to_numpy(), batch.column(1).to_numpy())))

    return keys.mapInArrow(hit, "first long, second long")


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def domains_of(host: Column, most: int) -> Column:
    """The host and its parent domains, as far as they have ``most`` labels or fewer."""
    every = F.split(host, r"\.", -1)
    parts = F.slice(every, F.greatest(F.lit(1), F.size(every) - most + 1), F.lit(most))
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]], blocked: DataFrame, url_col: str = "url") -> DataFrame:
    """The pages with host, path, rule and verdict ("allow" or "block").

    ``rules`` are (host, path, verdict); ``blocked`` has a column ``key`` of
    listed domains, each of which covers its subdomains.
    """
    listed = blocked.select("key", F.lit(True).alias("listed")).where("key is not null")
    most = listed.agg(F.max(F.size(F.split("key", r"\.", -1)))).first()[0] or 1
    hosts = pages.select(host_of(F.col(url_col)).alias("host")).distinct()
    corpus = hosts.select(F.explode(domains_of(F.col("host"), most)).alias("key")).distinct().withColumn("listed", F.lit(False))
    cascade = build_cascade(corpus.unionByName(listed).groupBy("key").agg(F.max("listed").alias("listed")))
    shared = pages.sparkSession.sparkContext.broadcast(cascade)

    @F.arrow_udf("boolean")
    def on_list(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for first, second in batches:
            hit = shared.value.listed(first.flatten().to_numpy(zero_copy_only=False), second.flatten().to_numpy(zero_copy_only=False))
            row = np.repeat(np.arange(len(first)), first.value_lengths().to_numpy(zero_copy_only=False))
            yield pa.array(np.bincount(row[hit], minlength=len(first)) > 0)

    host, path = F.col("host"), F.col("path")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), len(r[0]))):  # the longest last, so that it is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    judged = pages.withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col))})
    keys = domains_of(host, most)
    judged = judged.withColumn("__listed", on_list(F.transform(keys, lambda k: F.xxhash64(k)), F.transform(keys, lambda k: F.xxhash64(F.lit("second"), k))))
    judged = judged.withColumns({"rule": rule, "verdict": F.coalesce(verdict, F.when(F.col("__listed"), "block").otherwise("allow"))})
    return judged.drop("__listed")
