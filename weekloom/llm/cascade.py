"""URL filter by a Bloom filter cascade: exact membership without a join.

Keys are the addresses of all pages (the universe), some of them listed. Level 1 is a Bloom
filter of the listed keys. Level 2 holds the unlisted keys that level 1 lets through, level 3
the listed ones that level 2 lets through, and so on until none is left over. A key's level
of first absence then tells exactly whether it is listed, for every key of the universe.

The universe is one table of distinct keys in the shared folder; levels are built by counting
bits there, and only the filters themselves reach the driver. Their size is known before they
are built, about 1.44 log2(keys / listed) bits for each listed key, and a cascade over
``MAX_BYTES`` is refused. Pages are read once more and judged where they are; a host or an
address with a third of all pages is no heavier than another.

Rules (host, path, verdict) come first: a rule fits its host and all subdomains if the path
starts with the rule's; the longest wins. Rules are code-sized literals.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored

MAX_BYTES = 64 << 20
FIRST_RATE = math.sqrt(0.5)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to /, ? or #; A-Z in lower case; else empty."""
    at = F.instr(url, "://")
    rest = url.substr(at + 3, F.length(url))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(at > 0, host).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ? or #; else empty."""
    at = F.instr(url, "://")
    rest = url.substr(at + 3, F.length(url))
    return F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise(F.lit(""))


def in_domain(host: Column, domain: str) -> Column:
    return (host == domain) | host.endswith(f".{domain}")


Rule = tuple[str, str, str]


def longest_rule(rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule as text, verdict) of the longest rule that fits ``host`` and ``path``; else NULL."""
    name = verdict = F.lit(None).cast("string")
    for domain, path, decision in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = in_domain(F.col("host"), domain) & F.col("path").startswith(path)
        name = F.when(fits, F.lit(domain + path)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def both_hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit(1)).alias("h2")]


def places(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
    """Bit numbers of each key in a level's filter, one row a key."""
    a = h1.view(np.uint64) ^ np.uint64((level * 0x9E3779B97F4A7C15) & (2**64 - 1))
    a ^= a >> np.uint64(31)
    a *= np.uint64(0xBF58476D1CE4E5B9)
    a ^= a >> np.uint64(29)
    b = h2.view(np.uint64) * np.uint64(2 * level + 1) | np.uint64(1)
    steps = np.arange(hashes, dtype=np.uint64)
    return (a[:, None] + steps * b[:, None]) % np.uint64(bits)


class Cascade:
    """Filters by level; ``listed`` tells membership for keys of the universe."""

    def __init__(self) -> None:
        self.levels: list[tuple[np.ndarray, int, int]] = []

    def depth(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Levels that let each key through before one stops it."""
        out = np.zeros(len(h1), np.int32)
        rest = np.arange(len(h1))
        for level, (filter_, bits, hashes) in enumerate(self.levels):
            at = places(h1[rest], h2[rest], level, bits, hashes)
            there = (filter_[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)
            rest = rest[there.all(axis=1)]
            out[rest] = level + 1
        return out

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Stopped by an even number of levels' filters: unlisted; by an odd one: listed."""
        return self.depth(h1, h2) % 2 == 1

    @property
    def nbytes(self) -> int:
        return sum(f.nbytes for f, _, _ in self.levels)


def _size(members: int, others: int, level: int) -> tuple[int, int]:
    """Bits and number of hashes: few false positives at first, then one in two."""
    rate = min(0.5, FIRST_RATE * members / max(others, 1)) if level == 0 else 0.5
    hashes = max(1, round(-math.log2(rate)))
    return max(64, -(-int(1.4427 * hashes * members) // 64) * 64), hashes


def build(keys: DataFrame, max_bytes: int = MAX_BYTES) -> Cascade:
    """``keys``: h1, h2, listed; each key of the universe once."""
    spark, cascade = keys.sparkSession, Cascade()
    keys = stored(keys, "keys")
    left = keys
    while True:
        level = len(cascade.levels)
        wanted = F.col("listed") if level % 2 == 0 else ~F.col("listed")
        n, others = left.agg(F.count_if(wanted), F.count_if(~wanted)).first()
        if not n:
            return cascade
        bits, hashes = _size(n, others, level)
        if cascade.nbytes + bits // 8 > max_bytes:
            raise ValueError(f"the cascade needs more than {max_bytes} bytes")

        def set_bits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                at = np.unique(places(b["h1"].to_numpy(), b["h2"].to_numpy(), level, bits, hashes))
                word = (at >> np.uint64(6)).astype(np.int64)
                bit = np.uint64(1) << (at & np.uint64(63))
                words, begin = np.unique(word, return_index=True)
                if len(words):
                    yield pd.DataFrame({"word": words, "bits": np.bitwise_or.reduceat(bit, begin).view(np.int64)})

        members = left.where(wanted).select("h1", "h2")
        merged = members.mapInPandas(set_bits, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
        made = merged.toPandas()  # the filter: at most bits / 64 rows
        filter_ = np.zeros(bits // 64, np.uint64)
        filter_[made["word"].to_numpy(np.int64)] = made["bits"].to_numpy(np.int64).view(np.uint64)
        cascade.levels.append((filter_, bits, hashes))
        sent = spark.sparkContext.broadcast(cascade)
        # Left over: keys that every filter so far lets through.
        left = keys.where(_depth(sent)("h1", "h2") == len(cascade.levels))


def _depth(sent):
    @F.pandas_udf("int")
    def depth(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(sent.value.depth(h1.to_numpy(), h2.to_numpy()))

    return depth


def judge(
    pages: DataFrame, rules: Sequence[Rule], is_listed: Callable[[Column], Column], url: str = "url",
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """Every row with host, path, rule, listed and verdict.

    The universe are the distinct addresses, host and path in one. ``is_listed`` tells of each
    whether the cascade is to encode it as listed; pages are then judged by the filters alone.

    ``verdict`` is the rule's, else block for a listed address and allow for any other. A NULL
    url, or one without ``://``, has an empty host and path and is under no rule.
    Repeated rows give equal rows, a table without rows gives none. Input columns of these names
    give way.
    """
    pages = pages.drop("host", "path", "rule", "listed", "verdict", "by_rule")
    link = F.coalesce(F.col(url).cast("string"), F.lit(""))
    found = pages.withColumns({"host": host_of(link), "path": path_of(link)})
    bad = F.coalesce(is_listed(F.col("__key")), F.lit(False))
    universe = found.select(F.concat("host", "path").alias("__key")).distinct()
    cascade = build(universe.select(*both_hashes(F.col("__key")), bad.alias("listed")), max_bytes)
    sent = pages.sparkSession.sparkContext.broadcast(cascade)

    @F.pandas_udf("boolean")
    def listed(h1: pd.Series, h2: pd.Series) -> pd.Series:
        return pd.Series(sent.value.listed(h1.to_numpy(), h2.to_numpy()))

    name, verdict = longest_rule(rules)
    judged = found.withColumns({"rule": name, "listed": listed(*both_hashes(F.concat("host", "path"))), "by_rule": verdict})
    fallback = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return judged.withColumn("verdict", F.coalesce("by_rule", fallback)).drop("by_rule")
