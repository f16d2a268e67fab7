"""SimHash fingerprints, and near-duplicate groups found by anchor-point covering.

Fingerprint: A-Z in lower case; the hashes (XXH64, seed 42) of all runs of ``shingle``
words, repeats included; a bit is 1 if it is set in over half of them. A text with fewer
words has one run, the whole sequence; one without words has fingerprint zero.

Search. Two fingerprints link at ``threshold`` or fewer differing bits. The 64 bits are cut
into ``blocks``; in at least one block linked fingerprints differ in at most t = threshold //
blocks bits. Each block has a covering code: a Hamming code on its first 15 bits, all values
of the others, covering radius 1. Its code words are the anchors. A fingerprint is at home at
its nearest anchor and visits every anchor within 1 + t bits, so it meets the home of every
fingerprint within t bits. Fingerprints are compared per anchor, homes with visitors.

Groups. Equal fingerprints are one before anything is compared. An anchor with more homes
than ``chunk`` is dealt to several tasks, each holding a part of the homes while the visitors
stream by; no task holds all of an anchor. From each part come at most as many links as
fingerprints (a spanning forest), never all pairs.

Tables. ``doc_id`` names a document; rows without one get a fingerprint, but no component,
and link nothing. Rows with equal ids are one node. NULL counts as an empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .components import components
from .text import pieces, raw_texts

SEED = 42
HAMMING = 15
CHUNK = 2048
ROWS = 1 << 20


def fingerprint(text: bytes, shingle: int = 4) -> int:
    words = text.lower().split()
    if not words:
        return 0
    plain = b" ".join(words)
    if len(words) <= shingle:
        return int(_majority(np.array([xxhash.xxh64_intdigest(plain, SEED)], np.uint64)))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    stops = (ends[shingle - 1 :] - 1).tolist()
    starts = np.concatenate([[0], ends[:-shingle]]).tolist()
    digest = xxhash.xxh64_intdigest
    h = [digest(plain[a:b], SEED) for a, b in zip(starts, stops)]
    return int(_majority(np.array(h, np.uint64)))


def _majority(h: np.ndarray) -> np.uint64:
    """Bit set if it is in over half of the hashes; counts a slice of them at a time."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 8192):
        bits = np.unpackbits(h[i : i + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0]


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            fp = np.array([fingerprint(t, shingle) for t in raw_texts(batch)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return given.mapInArrow(rows, "doc_id bigint, fp bigint")


def cuts(blocks: int) -> list[tuple[int, int]]:
    """First bit and width of each block; none is narrower than the code."""
    if not 2 <= blocks <= 64 // HAMMING:
        raise ValueError(f"2 to {64 // HAMMING} blocks; the code covers {HAMMING} bits of each")
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def syndromes() -> np.ndarray:
    """For each 15-bit value the place of the one bit that leads to a code word; 0 for none.

    The parity check column of bit i is i + 1, so the syndrome names the bit to flip.
    """
    values = np.arange(1 << HAMMING)
    out = np.zeros(1 << HAMMING, np.int64)
    for bit in range(HAMMING):
        out ^= np.where(values >> bit & 1, bit + 1, 0)
    return out


def anchors(fp: np.ndarray, first: int, width: int, reach: int):
    """(row, anchor) for every anchor within ``reach`` bits, and each row's home anchor."""
    low = (1 << HAMMING) - 1
    code = syndromes()
    part = ((fp >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.int64)
    flip = code[part & low]
    home = part ^ np.where(flip > 0, 1 << np.maximum(flip - 1, 0), 0)
    masks = [0]
    for _ in range(reach):
        masks = sorted({m | 1 << b for m in masks for b in range(width)} | set(masks))
    rows, found = [], []
    for m in masks:
        other = part ^ m
        at = np.flatnonzero(code[other & low] == 0)
        rows.append(at)
        found.append(other[at])
    return np.concatenate(rows), np.concatenate(found), home


def _spread(threshold: int, blocks: int):
    """Rows (anchor, fp, node, home) of each fingerprint: one home and its visits a block."""
    t = threshold // blocks

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 8192):
                piece = batch.slice(start, 8192)
                fp = piece.column("fp").to_numpy().view(np.uint64)
                node = piece.column("node").to_numpy()
                for block, (first, width) in enumerate(cuts(blocks)):
                    row, anchor, home = anchors(fp, first, width, 1 + t)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor * blocks + block), pa.array(fp[row].view(np.int64)),
                         pa.array(node[row]), pa.array(home[row] == anchor)],
                        names=["anchor", "fp", "node", "home"],
                    )

    return rows


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that join anything new, of the given ones."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while (y := up.get(x, x)) != x:
            up[x] = up.get(y, y)
            x = y
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = root(x), root(y)
        if p != q:
            up[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _compare(threshold: int):
    """Links within each (anchor, part); rows come sorted by it, homes first.

    Only the homes of the part at hand and one batch are held.
    """

    def links(key, homes, visitors):
        """Vectorized over all groups of a batch: every visitor with the homes of its group."""
        hk, hf, hn = homes
        vk, vf, vn = visitors
        lo, hi = np.searchsorted(hk, vk, "left"), np.searchsorted(hk, vk, "right")
        count = hi - lo
        edges = []
        ends = np.cumsum(count)
        start = 0
        while start < len(vk):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + ROWS, "right")))
            c = count[start:stop]
            v = np.repeat(np.arange(start, stop), c)
            h = np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c) + np.repeat(lo[start:stop], c)
            near = (np.bitwise_count(vf[v] ^ hf[h]) <= threshold) & (vn[v] != hn[h])
            if near.any():
                a, b = np.maximum(vn[v[near]], hn[h[near]]), np.minimum(vn[v[near]], hn[h[near]])
                edges += _forest(a, b)
            start = stop
        return edges

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None  # homes of the last group seen, which may go on
        for batch in batches:
            key = np.stack([longs_(batch, "anchor"), longs_(batch, "part")])
            change = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            group = np.zeros(batch.num_rows, np.int64)
            group[change] = 1
            group = np.cumsum(group) + 1
            fp = batch.column("fp").to_numpy().view(np.uint64)
            node, home = longs_(batch, "node"), batch.column("home").to_numpy(zero_copy_only=False)
            hg, hf, hn = group[home], fp[home], node[home]
            if kept is not None and len(group) and kept[0] == tuple(key[:, 0]):
                hg = np.concatenate([np.ones(len(kept[1]), np.int64), hg])
                hf, hn = np.concatenate([kept[1], hf]), np.concatenate([kept[2], hn])
            if len(group):
                edges = links(None, (hg, hf, hn), (group, fp, node))
                last = hg == group[-1]
                kept = (tuple(key[:, -1]), hf[last], hn[last])
                if edges:
                    a, b = np.array(edges, np.int64).T
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return rows


def longs_(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).to_numpy(zero_copy_only=False)


def links(distinct: DataFrame, threshold: int = 4, blocks: int = 3, chunk: int = CHUNK) -> DataFrame:
    """(a, b): links that connect all fingerprints of (fp, node) within the threshold."""
    cuts(blocks)  # refuses a wrong number here, not in a task
    spread = distinct.mapInArrow(
        _spread(threshold, blocks), "anchor bigint, fp bigint, node bigint, home boolean"
    )
    homes = spread.where("home").groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    parts = F.ceil(F.col("n") / F.lit(chunk)).cast("int").alias("parts")
    large = homes.where(F.col("n") > chunk).select("anchor", parts)
    # Of a large anchor visitors go to all parts, each home is at home in one.
    own = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = spread.join(large, "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1))).select(
        "anchor", "fp", "node",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.col("home"), own.alias("own"),
    )
    dealt = dealt.select("anchor", "part", "fp", "node", (F.col("home") & (F.col("own") == F.col("part"))).alias("home"))
    ordered = dealt.repartition("anchor", "part").sortWithinPartitions("anchor", "part", F.desc("home"))
    return ordered.mapInArrow(_compare(threshold), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, shingle: int = 4, threshold: int = 4, blocks: int = 3, chunk: int = CHUNK
) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the least doc_id reachable over links."""
    prints = stored(fingerprints(docs, shingle), "fingerprints")
    named = prints.where("doc_id IS NOT NULL")
    distinct = stored(named.groupBy("fp").agg(F.min("doc_id").alias("node")), "distinct")
    # Copies of a fingerprint hang on its least id, as do rows that share an id.
    found = links(distinct, threshold, blocks, chunk)
    shared = named.groupBy("doc_id").agg(F.min("fp").alias("least"), F.max("fp").alias("most"))
    shared = shared.where("least <> most").select("doc_id")
    across = named.join(shared, "doc_id").join(distinct, "fp").select(
        F.col("doc_id").alias("a"), F.col("node").alias("b")
    )
    groups = components(found.union(across))
    placed = distinct.join(groups, distinct.node == groups.node, "left").select(
        "fp", F.coalesce("component", distinct.node).alias("component_id")
    )
    return prints.join(placed, "fp", "left").select(
        "doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")
    )


def first_of_groups(docs: DataFrame, **options) -> DataFrame:
    """The row of least doc_id of each group, unchanged; rows without an id stay.

    Of rows that share that id the one with the least hash of its text stays (of equal texts the
    first by its columns as JSON), so the result does not depend on how the rows lie.
    """
    groups = near_duplicates(docs, **options).where("doc_id IS NOT NULL")
    groups = stored(groups.select("doc_id", "component_id"), "groups")
    first = groups.where("doc_id = component_id").select("doc_id")
    twice = first.groupBy("doc_id").count().where("count > 1").select("doc_id")
    key = F.col("doc_id").cast("bigint")
    keep = first.distinct().withColumnRenamed("doc_id", "__first").hint("shuffle_hash")
    kept = docs.join(keep, key == F.col("__first"), "left_semi").unionByName(docs.where(key.isNull()))
    if twice.isEmpty():
        return kept
    twice = twice.withColumnRenamed("doc_id", "__twice")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    order = F.struct(F.xxhash64(F.coalesce("text", F.lit(""))), F.to_json(whole))
    one = kept.join(twice, key == F.col("__twice"), "left_semi").groupBy(key).agg(F.min_by(whole, order).alias("__row"))
    one = one.select("__row.*")
    return kept.join(twice, key == F.col("__twice"), "left_anti").unionByName(one)
