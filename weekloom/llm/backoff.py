"""Stupid-backoff scores of documents under a bigram model of the whole corpus.

The vocabulary is open: every word of every document counts. Score of a word after another:
c(ab) / c(a) if the pair also stands in another document, otherwise ``alpha`` c(b) / N; the first
word of a document scores c(b) / N. Counts are those of all documents, none is cut off: a pair
that no other document has is unseen to a model that leaves the scored document out. A document's score is the sum of log10 over its words.

Relational form. Each document's pairs are exploded and meet the table of pair counts on the
pair; scores are summed per document. Pairs and counts are partitioned by hash, so
counting and joining share one exchange, in which a document's pairs for one partition travel
as one row.

Frequent and other words. The counts of the ``size`` most frequent words are a table of fixed
size that is sent to all tasks. A pair with another word goes where that word is counted (the
second of two), so its counts meet it there too; only a pair of two such words that was seen
needs the first one's count joined from the distributed table of word counts. Such a word
holds less than one part in ``size`` of all words, so no key is hot. ``size`` changes what
moves, never a score.

Frequent pairs. A pair counted more than N / ``dense`` times consists of two words of such
counts, of which there are at most ``dense``. The counts of all pairs of the ``dense`` most
frequent words fit a small square, which is sent to all tasks; these pairs are scored where
they stand and never move. So no pair that moves holds more than one part in ``dense``.

Words and pairs are told apart by 63 bits of a hash. Word and pair counts grow with the corpus
and stay distributed.

Tables. NULL and empty texts have no words and score 0 with a NULL mean. Rows that share a
doc_id are one document made of their texts; a NULL id is an id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.prep import order_statistics
from ..session import stored
from .text import lists, mixed, owners, pieces, raw_texts, signed, word_hashes

_TOP = np.uint64(1 << 63)

FREQUENT = 65_535
DENSE = 256
ALPHA = 0.4


@dataclass
class Frequent:
    """Hashes of the most frequent words in ascending order with their ids 1, 2, ... by falling
    count, and their counts by id."""

    hashes: np.ndarray
    ids: np.ndarray
    counts: np.ndarray
    total: int

    def of(self, h: np.ndarray) -> np.ndarray:
        """Ids of words; 0 for a word that is not in the table."""
        if not len(self.hashes):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.ids[at], 0)


def _words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, the top bit set (negative as a long, unlike ids), and words a text."""
    h, counts = word_hashes([t.split() for t in raw_texts(batch)])
    return h | _TOP, counts


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, n): how often each word stands in all documents, by its hash."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, limit=16 << 20):
            words, n = np.unique(_words(batch)[0], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(words)), pa.array(n)], names=["h", "n"])

    return docs.select(F.col("text").cast("string").alias("text")).mapInArrow(rows, "h bigint, n bigint").groupBy(
        "h"
    ).agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, size: int = FREQUENT) -> Frequent:
    if not 1 <= size <= FREQUENT:
        raise ValueError(f"the table holds 1 to {FREQUENT} words")
    known, total = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
    if known > size:  # words above the count at that rank; words of that very count stay out
        cut = order_statistics(counts, "n", [known - size])[0].value
        counts = counts.where(F.col("n") > cut)
    top = counts.toPandas().sort_values(["n", "h"], ascending=[False, True])  # at most ``size`` rows
    h = top["h"].to_numpy(np.int64).view(np.uint64)
    n = top["n"].to_numpy(np.int64)
    order = np.argsort(h)
    return Frequent(h[order], order + 1, np.concatenate([[0], n]), int(total or 0))


def _pairs(batch: pa.RecordBatch, words: Frequent):
    """Ids and hashes of all words, words a text, places of each pair's first word, their texts."""
    h, counts = _words(batch)
    owner = owners(counts)
    at = np.flatnonzero(owner[1:] == owner[:-1])
    return words.of(h), h, counts, at, owner[at]


def _near(a: np.ndarray, b: np.ndarray, dense: int) -> np.ndarray:
    return (a > 0) & (b > 0) & (a < dense) & (b < dense)


NO_ID = -(2**63)


def square(docs: DataFrame, words: Frequent, dense: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all pairs of the words with ids below ``dense``, and whether two documents have them."""
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(dense * dense, np.int64)
        least, most = np.full(len(n), 2**63 - 1), np.full(len(n), -(2**63))
        for batch in pieces(batches):
            ids, _, _, at, owner = _pairs(batch, sent.value)
            doc = pc.fill_null(batch.column("doc_id"), NO_ID).to_numpy()
            a, b = ids[at], ids[at + 1]
            hot = _near(a, b, dense)
            pair, doc = a[hot] * dense + b[hot], doc[owner[hot]]
            n += np.bincount(pair, minlength=dense * dense)
            np.minimum.at(least, pair, doc)
            np.maximum.at(most, pair, doc)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (at, n[at], least[at], most[at])], names=["pair", "n", "least", "most"])

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = given.mapInArrow(rows, "pair bigint, n bigint, least bigint, most bigint")
    counted = counted.groupBy("pair").agg(F.sum("n").alias("n"), (F.min("least") != F.max("most")).alias("shared"))
    made = counted.toPandas()  # at most dense ** 2 rows
    out, shared = np.zeros(dense * dense, np.int64), np.zeros(dense * dense, bool)
    at = made["pair"].to_numpy(np.int64)
    out[at], shared[at] = made["n"].to_numpy(np.int64), made["shared"].to_numpy(bool)
    return out, shared


def bucket_names(spark: SparkSession) -> np.ndarray:
    """For each shuffle partition a number that hashes into it, so that buckets spread evenly."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = spark.range(0, parts * 24, 1, 1).select(
        F.col("id").cast("int").alias("id"), F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts)).alias("p")
    )
    return np.array([r[0] for r in placed.groupBy("p").agg(F.min("id")).select("min(id)").collect()], np.int32)


def score(
    docs: DataFrame, size: int = FREQUENT, alpha: float = ALPHA, dense: int = DENSE
) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score)."""
    spark = docs.sparkSession
    every = stored(word_counts(docs), "words")
    words = frequent(every, size)
    hot = square(docs, words, dense)
    buckets = bucket_names(spark)
    log_one = np.log10(np.maximum(words.counts, 1))
    log_total = float(np.log10(max(words.total, 1)))
    back = float(np.log10(alpha))
    sent = spark.sparkContext.broadcast((words, hot))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, (hot, shared) = sent.value
        for batch in pieces(batches):
            ids, h, counts, at, owner = _pairs(batch, words)
            doc = batch.column("doc_id")
            a, b = ids[at], ids[at + 1]
            base = np.zeros(len(counts))
            full = np.flatnonzero(counts > 0)
            begin = (np.cumsum(counts) - counts)[full]
            base[full] = np.where(ids[begin] > 0, log_one[ids[begin]] - log_total, 0.0)
            near = _near(a, b, dense)
            x, y = a[near], b[near]
            n, seen = hot[x * dense + y], shared[x * dense + y]
            base += np.bincount(
                owner[near],
                np.where(seen, np.log10(np.maximum(n, 1)) - log_one[x], back + log_one[y] - log_total),
                len(counts),
            )
            yield _rows(buckets[np.arange(len(counts)) % len(buckets)], doc, base=pa.array(base), n=pa.array(counts))
            # Pairs of two words of the table: in lists, one for each document and bucket.
            known = ~near & (a > 0) & (b > 0)
            pair = (a[known] << 16 | b[known]).astype(np.uint32)
            to = (mixed(pair.astype(np.uint64)) % np.uint64(len(buckets))).astype(np.int64)
            group = owner[known] * len(buckets) + to
            order = np.argsort(group, kind="stable")
            group = group[order]
            if len(group):
                head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
                where = group[head]
                yield _rows(
                    buckets[where % len(buckets)], doc.take(pa.array(where // len(buckets))),
                    pairs=lists(pair[order].view(np.int32), np.append(head, len(group))),
                )
            # Pairs with another word, and first words that are not in the table.
            rare = np.flatnonzero((a == 0) | (b == 0))
            first = begin[ids[begin] == 0]
            name = np.where(ids > 0, ids, signed(h))
            if len(rare):
                i = at[rare]
                by = np.where(b[rare] == 0, h[i + 1], h[i])
                to = buckets[(mixed(by) % np.uint64(len(buckets))).astype(np.int64)]
                yield _rows(to, doc.take(pa.array(owner[rare])), a=pa.array(name[i]), b=pa.array(name[i + 1]))
            if len(first):
                to = buckets[(mixed(h[first]) % np.uint64(len(buckets))).astype(np.int64)]
                yield _rows(to, doc.take(pa.array(full[ids[begin] == 0])), b=pa.array(name[first]))

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    packed = given.mapInArrow(rows, ", ".join(f"{k} {v}" for k, v in ROW.items())).repartition("bucket")
    pairs = packed.select("bucket", "doc_id", "base", "n", "a", "b", F.explode_outer("pairs").alias("pair"))
    # What a row is counted under: a pair of two words of the table (a number from 0), or else the
    # word that is not in the table (a negative number), the second of two. Each place of
    # such a word has one row that ends in it, so those rows are the word's count.
    pair = F.col("pair").cast("bigint").bitwiseAND(0xFFFFFFFF)
    under = F.coalesce(pair, F.when(F.col("b") < 0, F.col("b")).otherwise(F.col("a")))
    # The tables of counts and the exploded pairs meet where both are, in one partition.
    one_pair = W.partitionBy("word", "bucket", "a", "b")
    doc = F.coalesce("doc_id", F.expr("CAST(-9223372036854775808 AS BIGINT)"))
    counted = pairs.withColumn("word", under).drop("pair").withColumns({
        "c": F.count("word").over(one_pair), "shared": F.min(doc).over(one_pair) != F.max(doc).over(one_pair),
    }).withColumn("alone", F.count(F.when(F.col("b") < 0, 1)).over(W.partitionBy("word", "bucket")))
    begins = F.col("b").isNotNull() & F.col("a").isNull()
    seen = F.col("shared") & ~begins & F.col("word").isNotNull()
    # The one word whose count the score needs: the first if the pair was seen, else the second.
    first, second = F.shiftrightunsigned("word", 16), F.col("word").bitwiseAND(0xFFFF)
    counted = counted.withColumns({
        "look": F.when(seen, F.coalesce("a", first)).otherwise(F.coalesce("b", second)),
        "known": F.when(F.col("base").isNotNull(), F.col("base")).when(seen, F.log10("c")).otherwise(
            F.when(begins, 0.0).otherwise(back) - F.lit(log_total)
        ),
        "sign": F.when(seen, -1).otherwise(1),
    })
    table = spark.createDataFrame(pd.DataFrame({"id": np.arange(len(log_one), dtype=np.int64), "one": log_one}))
    here = F.col("look") == F.col("word")
    count = F.when(here, F.log10("alone")).otherwise(F.coalesce("one", F.lit(0.0)))
    value = F.col("known") + F.col("sign") * count
    # ``size`` bounds what is broadcast. Summing needs no exchange: buckets are in place.
    sums = (
        counted.join(F.broadcast(table), F.col("look") == F.col("id"), "left")
        .select("bucket", "doc_id", "n", value.alias("value"), F.when((F.col("look") < 0) & ~here, F.col("look")).alias("look"), "sign")
        .groupBy("bucket", "doc_id", "look")
        .agg(F.sum("n").alias("n"), F.sum("value").alias("value"), F.sum("sign").alias("times"))
        .drop("bucket")
    )
    sums = stored(sums, "sums")
    rest = sums.where("look IS NOT NULL").join(every.withColumnRenamed("n", "count"), F.col("look") == F.col("h"))
    rest = rest.select("doc_id", "n", (F.col("value") + F.col("times") * F.log10("count")).alias("value"))
    return (
        sums.where("look IS NULL").select("doc_id", "n", "value").unionByName(rest)
        .groupBy("doc_id")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_words"), F.sum("value").alias("log_score"))
        .withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
    )


# A document's own row has base and n; other rows hold a list of pairs, one pair, or a first word.
ROW = {
    "bucket": "int", "doc_id": "bigint", "pairs": "array<int>", "a": "bigint", "b": "bigint",
    "base": "double", "n": "bigint",
}
_EMPTY = {"pairs": pa.list_(pa.int32()), "base": pa.float64()}


def _rows(bucket: np.ndarray, doc: pa.Array, **columns: pa.Array) -> pa.RecordBatch:
    given = {"bucket": pa.array(bucket), "doc_id": doc, **columns}
    return pa.RecordBatch.from_arrays(
        [given[c] if c in given else pa.nulls(len(bucket), _EMPTY.get(c, pa.int64())) for c in ROW], names=list(ROW)
    )
