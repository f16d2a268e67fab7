"""Benchmark decontamination: size-partitioned MinHash containment search, then exact proof.

A test item is found in a document if at least ``threshold`` of its distinct shingles
(``shingle`` words; all words of a shorter item) stand there. Every letter is lower-cased on its
own, as SQL's lower() does, ASCII punctuation parts words, white space is dropped.

Size partitions. Documents fall into classes by their number of distinct shingles, a factor
of two each. A class has its own signature: one permutation, hashed into at least four bins
for each shingle of its largest document, the least hash of each bin kept. The signature of
an item is made once for every class. So the chance that a shared shingle shows in both
signatures is about nine in ten in the longest documents as in the shortest, where a fixed
number of hashes would lose a short item in a long text. Items of few shingles, whose
misses could add up, ask for every shingle in a second, dense signature of the same classes.

Any match of signatures makes a candidate; candidates are then compared shingle by shingle,
as text, so the result is exact for what is found.

The items' signatures are sent to all tasks. Their size is counted first, and an item table
beyond ``MAX_ITEM_BYTES`` is refused rather than sent. Documents are never moved.

Rows with NULL or wordless text match nothing; ids and copies are reported as they come.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .text import inside, owners, pieces, raw_texts, runs, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
# Bins are a power of two, so a shingle's bin is the head of its hash: 2 ** BINS for each shingle.
BINS = 2
# An item with this many shingles misses all bins with a chance of 0.12 ** (0.8 * 16) < 1e-11.
FEW = 16
MAX_ITEM_BYTES = 64 << 20

# ASCII punctuation parts words.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else 32 if (c < 128 and not chr(c).isalnum()) else c for c in range(256)
)


def lower(text: bytes) -> bytes:
    """Each character in lower case. Python has two mappings that are not one to one: İ, and Σ at a word's end."""
    if text.isascii():
        return text.lower()
    plain = text.decode(errors="surrogateescape").replace("\u0130", "i").replace("\u03a3", "\u03c3")
    return plain.lower().encode(errors="surrogateescape")


def plain_words(text: bytes) -> list[bytes]:
    return lower(text).translate(_TABLE).split()


def size_class(n: int) -> int:
    return max(0, int(n - 1).bit_length())


def signature(hashes: np.ndarray, level: int) -> np.ndarray:
    """Least hash of each bin that holds one; ``hashes`` sorted and distinct."""
    bins = hashes >> np.uint64(64 - BINS - level)
    first = np.ones(len(hashes), bool)
    first[1:] = bins[1:] != bins[:-1]
    return hashes[first]


class Items:
    """The test items: their shingles as text, and their hashes by length of run."""

    def __init__(self, rows: list[tuple[int, bytes]], shingle: int) -> None:
        self.ids: list = []
        self.shingles: list[frozenset[bytes]] = []
        self.hashes: list[np.ndarray] = []
        self.signatures: dict[tuple[int, int], frozenset[int]] = {}
        lengths: dict[int, list[int]] = {}
        for item, text in rows:
            words = plain_words(text)
            if not words:
                continue
            n = min(shingle, len(words))
            lengths.setdefault(n, []).append(len(self.ids))
            self.ids.append(item)
            self.shingles.append(frozenset(b" ".join(words[k : k + n]) for k in range(len(words) - n + 1)))
            self.hashes.append(np.unique(runs(word_hashes([words])[0], n)))
        # For each run length: all hashes, sorted, and the item each belongs to.
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n, members in lengths.items():
            values = np.concatenate([self.hashes[i] for i in members])
            own = np.concatenate([np.full(len(self.hashes[i]), i) for i in members])
            order = np.argsort(values, kind="stable")
            self.tables[n] = values[order], own[order]

    def asks(self, item: int, level: int, value: int, least: bool) -> bool:
        """Whether the item's signature for this size class holds the value."""
        if len(self.hashes[item]) < FEW:
            return True
        if (item, level) not in self.signatures:
            self.signatures[item, level] = frozenset(signature(self.hashes[item], level).tolist())
        return least and value in self.signatures[item, level]


def candidates(known: Items, length: int, values: np.ndarray, own: np.ndarray, n: int) -> set:
    """(row, item) pairs whose signatures match. ``values`` are run hashes, ``own`` their rows."""
    order = np.lexsort((values, own))
    values, own = values[order], own[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (own[1:] != own[:-1])
    values, own = values[new], own[new]
    level = np.array([size_class(c) for c in np.bincount(own, minlength=n)], np.uint64)[own]
    bins = values >> (np.uint64(64 - BINS) - level)
    least = np.ones(len(values), bool)
    least[1:] = (bins[1:] != bins[:-1]) | (own[1:] != own[:-1])
    table, who = known.tables[length]
    at = np.searchsorted(table, values, "left")
    hit = np.flatnonzero(table[np.minimum(at, len(table) - 1)] == values)
    out = set()
    to = np.searchsorted(table, values[hit], "right")
    for i, a, b in zip(hit.tolist(), at[hit].tolist(), to.tolist()):
        for item in who[a:b].tolist():
            if known.asks(item, int(level[i]), int(values[i]), bool(least[i])):
                out.add((int(own[i]), item))
    return out


def in_piece(known: Items, batch: pa.RecordBatch, threshold: float) -> list[tuple]:
    """(row, item id, shared, all, share) of every item found in the rows of a batch."""
    texts = [plain_words(t) for t in raw_texts(batch)]
    h, counts = word_hashes(texts)
    owner = owners(counts)
    found = []
    for length in known.tables:
        whole = inside(owner, length)
        if not whole.any():
            continue
        pairs = candidates(known, length, runs(h, length)[whole], owner[: len(whole)][whole], len(texts))
        row, there = None, set()
        for d, c in sorted(pairs):
            if d != row:
                row = d
                there = {b" ".join(texts[d][k : k + length]) for k in range(len(texts[d]) - length + 1)}
            n, every = len(known.shingles[c] & there), len(known.shingles[c])
            if n >= threshold * every:
                found.append((d, known.ids[c], n, every, n / every))
    return found


def _sent(items: DataFrame, item_key: str):
    """The items, to all tasks, after their size was counted."""
    given = items.select(F.col(item_key).alias("i"), F.col("text").cast("string").alias("t")).where("t IS NOT NULL")
    size = given.agg(F.sum(F.octet_length("t")).alias("b")).first()["b"] or 0
    if size > MAX_ITEM_BYTES:
        raise ValueError(f"{size} bytes of items; at most {MAX_ITEM_BYTES} are sent to all tasks")
    return items.sparkSession.sparkContext.broadcast([(r["i"], r["t"].encode()) for r in given.collect()])


def contained(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE,
    doc_key: str = "doc_id", item_key: str = "item_id",
) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles, containment) of every item found in a document."""
    sent = _sent(items, item_key)
    kinds = docs.schema[doc_key].dataType, items.schema[item_key].dataType
    item_kind = to_arrow_type(kinds[1])
    names = [doc_key, item_key, "n_shared", "n_shingles", "containment"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Items(sent.value, shingle)
        for batch in pieces(batches):
            if found := in_piece(known, batch, threshold):
                d, item, n, every, part = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("k").take(pa.array(d)), pa.array(item, item_kind),
                     pa.array(n, pa.int64()), pa.array(every, pa.int64()), pa.array(part)],
                    names=names,
                )

    types = [kinds[0].simpleString(), kinds[1].simpleString(), "bigint", "bigint", "double"]
    texts = docs.select(F.col(doc_key).alias("k"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(search, ", ".join(f"`{n}` {t}" for n, t in zip(names, types)))


def without_items(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shingle: int = SHINGLE,
    item_key: str = "item_id",
) -> DataFrame:
    """The rows in which no item was found, unchanged. Nothing is shuffled."""
    sent = _sent(items, item_key)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Items(sent.value, shingle)
        for batch in pieces(batches):
            clean = np.ones(batch.num_rows, bool)
            clean[[f[0] for f in in_piece(known, batch, threshold)]] = False
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(keep, docs.schema)
