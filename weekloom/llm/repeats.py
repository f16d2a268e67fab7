"""Substring dedup by level-wise doubling.

A window is ``words`` consecutive words of one document. It is removed where the same word
sequence also starts earlier, in a document of smaller id or further up in the same one.

Levels. Runs of ``base`` words are looked at first; only windows whose runs repeat are
extended to twice that length, and so on up to ``words``, until the length is reached or no
candidate survives. Below the last level a window is represented by its minimizer, the
least-hashed run in it: equal windows have equal minimizers, so none is lost, and only about
one place in six moves. At the last level each surviving window moves under a 96-bit hash.

Hot passages. Within a piece of input a repeated run is known to repeat without any shuffle,
so only its first place is sent; a passage that stands in a third of all documents costs one
row a piece, and the rest stays with its document. No group is cut or capped.

Tables. ``doc_id`` names a document. Rows that repeat both id and text are the same document
and get the same result. Rows without an id take no part and keep all words. NULL and empty
texts have no words. Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from .text import (
    covered, inside, lists, longs, mixed, owners, pieces, raw_texts, runs, sampled, signed,
    sliding, word_hashes,
)

SECOND = np.uint64(0xD6E8FEB86659FD93)
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)


def levels(words: int, base: int) -> list[int]:
    """base, twice base, ... words."""
    out = [base]
    while out[-1] < words:
        out.append(out[-1] * 2)
    if out[-1] != words:
        raise ValueError(f"{words} is not {base} doubled some times")
    return out


def _alive(batch, h, owner, firsts, words, length):
    """Windows whose minimizer of ``length`` words was found to repeat."""
    g, _, least = sampled(h, owner, words, length)
    hit = np.zeros(len(h) + 1, bool)
    at = batch.column("at")
    sizes = np.diff(at.offsets.to_numpy())
    hit[np.repeat(firsts, sizes) + at.flatten().to_numpy()] = True
    repeated = np.where(hit[: len(g)], g, _NEVER)
    best = sliding(repeated, words - length + 1, np.minimum)
    return (best == least) & (least > 0)


def _packed(ids: np.ndarray, owner: np.ndarray, at: np.ndarray):
    """Places grouped by document: ids, places, offsets. ``owner`` ascends."""
    docs, begin = np.unique(owner, return_index=True)
    return ids[docs], at, np.append(begin, len(at))


def _places(words: int, length: int, before: int | None):
    """Rows for one level: the first place of each run in a piece, and all its later places.

    A row with ``more`` holds places known to repeat; its key is its document's, so that
    these rows spread evenly.
    """
    last = length == words

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            ids = longs(batch, "__doc")
            copies = longs(batch, "__row") if "__row" in batch.schema.names else None
            h, counts = word_hashes([t.split() for t in raw_texts(batch)])
            if len(h) < words:
                continue
            owner = owners(counts)
            firsts = np.cumsum(counts) - counts
            alive = None if before is None else _alive(batch, h, owner, firsts, words, before)
            if last:
                whole = inside(owner, words)
                at = np.flatnonzero(whole if alive is None else whole & alive)
                key = runs(h, words)[at]
                other = runs(mixed(h ^ SECOND), words)[at]
            else:
                g, chosen, _ = sampled(h, owner, words, length, alive)
                at = np.flatnonzero(chosen)
                key, other = g[at], np.zeros(len(at), np.uint64)
            if not len(at):
                continue
            doc = owner[at]
            place = at - firsts[doc]
            # By id and place, so that the first of each run is its earliest here.
            rank = np.arange(len(ids)) * 0 if copies is None else copies
            order = np.lexsort((place, rank[doc], ids[doc], other, key))
            k, o = key[order], other[order]
            new = np.ones(len(order), bool)
            new[1:] = (k[1:] != k[:-1]) | (o[1:] != o[:-1])
            if last:  # a row that repeats its document is not an earlier start
                same = np.zeros(len(order), bool)
                d, r, p = ids[doc[order]], rank[doc[order]], place[order]
                group = np.cumsum(new) - 1
                head = np.flatnonzero(new)
                same = (d == d[head][group]) & (r == r[head][group]) & (p == p[head][group])
            head = order[new]
            times = np.diff(np.append(np.flatnonzero(new), len(order)))
            later = np.sort(order[~new & ~same] if last else order[~new])
            # In the order of the text: ids and places then compress well on their way.
            by_place = np.argsort(head)
            head, times = head[by_place], times[by_place]
            extra = other[head].view(np.uint32)[::2].view(np.int32) if last else times.astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(key[head])), pa.array(extra), pa.array(ids[doc[head]]),
                 pa.array(place[head].astype(np.int32)), pa.nulls(len(head), pa.list_(pa.int32())),
                 *([] if copies is None else [pa.array(copies[doc[head]])])],
                names=NAMES if copies is None else [*NAMES, "__row"],
            )
            if len(later):
                text, places, offsets = _packed(np.arange(len(ids)), doc[later], place[later].astype(np.int32))
                own = ids[text]
                salt = signed(mixed(own.astype(np.uint64) ^ SECOND))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(salt), pa.array(np.full(len(own), 2, np.int32)), pa.array(own),
                     pa.nulls(len(own), pa.int32()), lists(places, offsets),
                     *([] if copies is None else [pa.array(copies[text])])],
                    names=NAMES if copies is None else [*NAMES, "__row"],
                )

    return rows


# ``extra``: how often the run stands in the piece; at the last level more bits of its hash.
NAMES = ["key", "extra", "__doc", "start", "more"]
PLACES = "key bigint, extra int, __doc bigint, start int, more array<int>"


def _own(frame: DataFrame) -> list[str]:
    """What tells a text apart: its id, and a hash of it where rows share ids."""
    return ["__doc", "__row"] if "__row" in frame.columns else ["__doc"]


def _gathered(found: DataFrame) -> DataFrame:
    """One row per document with all its places."""
    one = F.when(F.col("start").isNotNull(), F.array("start")).otherwise(F.col("more"))
    return found.groupBy(*_own(found)).agg(F.flatten(F.collect_list(one)).alias("at"))


def _keyed(docs: DataFrame, shared: bool) -> DataFrame:
    """Documents with an id, under ``__doc``; every level and the end read them in this one
    form, so they are shuffled once. With ``shared`` ids also a hash of the text, ``__row``."""
    docs = docs.withColumn("__doc", F.col("doc_id").cast("bigint")).where("__doc IS NOT NULL")
    return docs.withColumn("__row", F.xxhash64(F.coalesce("text", F.lit("")))) if shared else docs


def shares_ids(docs: DataFrame) -> bool:
    """Whether an id stands for several texts: one count over ids and hashes, combined before the shuffle."""
    text = F.xxhash64(F.coalesce("text", F.lit("")))
    ends = _keyed(docs, False).groupBy("__doc").agg(F.min(text).alias("a"), F.max(text).alias("b"))
    return not ends.where("a <> b").isEmpty()


def repeated_windows(docs: DataFrame, words: int = 20, base: int | None = None, shared: bool = False) -> DataFrame:
    """(__doc, at): the starts of all windows whose words also start earlier."""
    base = base or (words // 2 if words % 2 == 0 else words)
    texts = _keyed(docs, shared)
    schema = f"{PLACES}, __row bigint" if shared else PLACES
    before, left = None, texts
    for length in levels(words, base):
        rows = left.mapInArrow(_places(words, length, before), schema)
        if length < words:
            times = F.sum("extra").over(W.partitionBy("key"))
            found = rows.withColumn("n", times).where("n > 1 OR more IS NOT NULL")
            left = texts.join(_gathered(found).hint("shuffle_hash"), _own(texts))
            before = length
    # Rows of one place have one rank: only a truly earlier start makes it greater than 1.
    place = [*_own(rows), "start"]
    rank = F.rank().over(W.partitionBy("key", "extra").orderBy(*place))
    return _gathered(rows.withColumn("rank", rank).where("more IS NOT NULL OR rank > 1"))


def without_repeats(docs: DataFrame, words: int = 20, base: int | None = None) -> DataFrame:
    """Every row with its words, the removed spans and the text that is left.

    Columns: the input's own, then n_words, n_removed, removed (array of the removed word
    ranges as [from, to) pairs, flat) and kept_text (kept words joined by one space). Input
    columns of these names, or named at, __doc or __row, give way.

    Ids are whole numbers. Rows that share an id are texts of their own, earlier by a hash of the
    text; equal rows are one text and each keep what it keeps. Rows without an id are left whole.
    A NULL text has no words; a table without rows gives none.
    """
    made = {"n_words": LongType(), "n_removed": LongType(), "removed": ArrayType(IntegerType()), "kept_text": StringType()}
    docs = docs.drop(*made, "at", "__doc", "__row")
    columns = docs.columns
    given = docs if dict(docs.dtypes)["text"] == "string" else docs.withColumn("text", F.col("text").cast("string"))
    shared = shares_ids(given)
    found = repeated_windows(given, words, base, shared).hint("shuffle_hash")
    joined = _keyed(given, shared).join(found, _own(found), "left").select(*columns, "at")
    alone = given.where(F.col("doc_id").cast("bigint").isNull()).withColumn("at", F.lit(None).cast("array<int>"))
    schema = StructType(list(given.schema.fields))
    for name, kind in made.items():
        schema = schema.add(name, kind)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            total, gone, spans, kept = [], [], [], []
            for text, at in zip(raw_texts(batch), batch.column("at")):
                all_words = text.split()
                n = len(all_words)
                edges: list[int] = []
                if at.is_valid:
                    mask = covered(at.values.to_numpy(), words, n)
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask, [0]]))).tolist()
                    all_words = [w for w, m in zip(all_words, mask.tolist()) if not m]
                total.append(n)
                gone.append(n - len(all_words))
                spans.append(edges)
                kept.append(b" ".join(all_words))
            arrays = [pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                      pa.array(spans, pa.list_(pa.int32())), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), *arrays], names=[*columns, *made]
            )

    return joined.unionByName(alone).mapInArrow(cut, schema)
