"""How the sources of a language differ in their words: audit on collapsed duplicate texts.

Identical texts of a language are one: a text is told by two 64-bit hashes, counted for each
source with partial sums, shuffled once and tokenized once, and its words count as often as it
occurs in each source. Terms in enough documents of the language are kept: the counts of a term
in all sources are one row for each piece of texts, so one shuffle tells which terms are kept
and adds up their counts. A source gives every kept term a smoothed share in billionths, and two
sources are as far apart as the sum of the differences of their shares.

Pairs are evaluated on counted terms only. Terms are dealt to buckets by hash and sources to
blocks, so a task sees the counts of few terms in two blocks of sources: it fills one small
matrix with the shares of absent terms and adds up the differences there, and what a task sends
on is one partial sum a pair. Terms that none of its sources has add the difference of the two
absent shares, times their number.

All numbers are whole. Groups are not collected: a hot source is spread over the buckets of its
terms, a hot text over the partial counts, and the top terms of a group over partial top lists.
A term's rows, one for each piece of texts that has it, meet in one task, as a window that spills.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stored
from .text import owners, pieces

SCALE = 1_000_000_000
SMOOTH = 5
BLOCK = 512  # sources whose pairs one task evaluates
TERMS = 4096  # terms of one bucket, on average
MIN_BUCKETS = 32
CELLS = 1 << 20
COUNT_BYTES = 16 << 20  # text, for each of its sources, whose terms are counted together: the more, the fewer rows are shuffled

# Bytes to 0x40, 0x5B to 0x60 and 0x7B to 0x7F end a term; A-Z becomes lower case.
_PLAIN = bytes(
    c + 32 if 0x41 <= c <= 0x5A else 0x20 if c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F else c for c in range(256)
)


def terms_of(texts: pa.Array) -> pa.ListArray:
    """The terms of each text, as a list; all texts of the array at once."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return pa.array([], pa.list_(pa.large_string()))
    _, offsets, data = texts.buffers()
    plain = pa.py_buffer((data.to_pybytes() if data else b"").translate(_PLAIN))
    same = pa.Array.from_buffers(pa.large_string(), len(texts), [None, offsets, plain], offset=texts.offset)
    return pc.ascii_split_whitespace(same)


def collapsed(docs: DataFrame) -> DataFrame:
    """(lang, text, sources, copies): each text of a language once, with its count in each source."""
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    one = ["lang", "h1", "h2"]
    named = named.select("*", F.xxhash64(F.lit(1), "text").alias("h1"), F.xxhash64(F.lit(2), "text").alias("h2"))
    copies = named.groupBy(*one, "source").agg(F.count(F.lit(1)).alias("n"))
    # At most one entry a source.
    by_text = copies.groupBy(*one).agg(F.collect_list(F.struct("source", "n")).alias("c"))
    texts = named.groupBy(*one).agg(F.first("text").alias("text"))
    return texts.join(by_text, one).select("lang", "text", F.col("c.source").alias("sources"), F.col("c.n").alias("copies"))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, term, docs, sources, counts): a row for each term of a language in a piece of texts.

    Every text weighs as its copies. ``docs`` is over all sources, ``counts`` has one for each of ``sources``.
    """
    for batch in pieces(batches, limit=COUNT_BYTES, times="sources"):
        lists = terms_of(batch.column("text"))
        row = owners(np.diff(lists.offsets.to_numpy()))
        flat = lists.flatten()
        there = pc.not_equal(flat, "")
        row, coded = row[there.to_numpy(zero_copy_only=False)], flat.filter(there).dictionary_encode()
        if not len(coded):
            continue
        size = len(coded.dictionary)
        pair, n = np.unique(row * size + coded.indices.to_numpy(), return_counts=True)
        row, term = pair // size, pair % size
        sources, copies = batch.column("sources"), batch.column("copies")
        begin = sources.offsets.to_numpy()
        first = begin[0]
        source = sources.flatten().dictionary_encode()
        lang = batch.column("lang").dictionary_encode()
        weight = copies.flatten().to_numpy()
        # One line for each (text, term, source of the text).
        each = np.diff(begin)[row]
        at = np.repeat(begin[row] - first - np.concatenate([[0], np.cumsum(each)[:-1]]), each) + np.arange(each.sum())
        line = np.repeat(np.arange(len(row)), each)
        width = len(source.dictionary)
        word = lang.indices.to_numpy()[row[line]].astype(np.int64) * size + term[line]
        key, where = np.unique(word * width + source.indices.to_numpy()[at], return_inverse=True)
        docs, total = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        np.add.at(docs, where, weight[at])
        np.add.at(total, where, weight[at] * n[line])
        # Keys of one word follow each other.
        word, start = np.unique(key // width, return_index=True)
        offsets = pa.array(np.concatenate([start, [len(key)]]), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                lang.dictionary.take(pa.array(word // size)).cast(pa.string()),
                coded.dictionary.take(pa.array(word % size)).cast(pa.string()),
                pa.array(np.add.reduceat(docs, start)),
                pa.ListArray.from_arrays(offsets, source.dictionary.take(pa.array(key % width)).cast(pa.string())),
                pa.ListArray.from_arrays(offsets, pa.array(total)),
            ],
            ["lang", "term", "docs", "sources", "counts"],
        )


def kept_counts(docs: DataFrame, min_docs: int) -> DataFrame:
    """(lang, source, term, n, n_lang): counts of the terms in at least ``min_docs`` documents of the language.

    Counts are shuffled once, by term and language: the same partitions tell which terms are
    kept and add up the counts of those alone. Terms come first, as sorting by them is cheaper.
    """
    found = collapsed(docs).mapInArrow(
        _count, "lang string, term string, docs bigint, sources array<string>, counts array<bigint>"
    )
    kept = found.withColumn("docs", F.sum("docs").over(W.partitionBy("term", "lang"))).where(F.col("docs") >= min_docs)
    each = kept.select("lang", "term", F.inline(F.arrays_zip("sources", "counts")).alias("source", "n"))
    counts = each.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"))
    return counts.select("lang", "source", "term", "n", F.sum("n").over(W.partitionBy("term", "lang")).alias("n_lang"))


def _share_of(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + SMOOTH) / (total + SMOOTH * terms)), whole and exact."""
    above = (count + SMOOTH).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    below = (total + F.lit(SMOOTH) * terms).cast("decimal(20,0)")
    return F.lit(1).cast("bigint") + F.call_function("div", above, below)


def _differences(group: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial sums of every pair of one source of the left block and one of the right.

    Rows without a term name the sources of both blocks and their absent share.
    """
    table = pa.Table.from_batches(list(group))
    lang = table.column("lang")[0].as_py()
    named = table.filter(pc.is_null(table.column("term"))).sort_by("source")
    sources, block = named.column("source").to_pylist(), named.column("block").to_numpy()
    absent = named.column("share").to_numpy()
    number = {s: i for i, s in enumerate(sources)}
    left, right = table.column("left")[0].as_py(), table.column("right")[0].as_py()
    counted = table.filter(pc.is_valid(table.column("term")))
    sums, seen = np.zeros((len(sources), len(sources)), np.int64), 0
    if counted.num_rows:
        coded = counted.column("term").combine_chunks().dictionary_encode()
        seen = len(coded.dictionary)
        named_by = counted.column("source").combine_chunks().dictionary_encode()
        number_of = np.array([number[s] for s in named_by.dictionary.to_pylist()])
        row, term = number_of[named_by.indices.to_numpy()], coded.indices.to_numpy()
        share = counted.column("share").to_numpy()
        width = max(1, CELLS // len(sources))
        order = np.argsort(term, kind="stable")
        row, term, share = row[order], term[order], share[order]
        for start in range(0, seen, width):
            stop = min(seen, start + width)
            a, b = np.searchsorted(term, [start, stop])
            cells = np.repeat(absent[:, None], stop - start, axis=1)
            cells[row[a:b], term[a:b] - start] = share[a:b]
            for i in range(len(sources)):
                sums[i, i + 1 :] += np.abs(cells[i + 1 :] - cells[i]).sum(axis=1)
    i, j = np.triu_indices(len(sources), 1)
    wanted = ((block[i] == left) & (block[j] == right)) | ((block[i] == right) & (block[j] == left))
    i, j = i[wanted], j[wanted]
    yield pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(i), pa.string()), pa.array([sources[x] for x in i], pa.string()),
         pa.array([sources[x] for x in j], pa.string()), pa.array(sums[i, j]), pa.array(np.full(len(i), seen, np.int64)),
         pa.array(np.abs(absent[i] - absent[j]))],
        ["lang", "a", "b", "value", "seen", "apart"],
    )


def audit(docs: DataFrame, min_docs: int = 30, top: int = 50, block: int = BLOCK, terms: int = TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): how far the sources of each language are apart.

    Part ``pair``: every other source of the language with the summed difference of shares.
    Part ``term``: the ``top`` terms whose share in the source is most above that in the language.
    NULL lang, source and text are empty; a source without terms has a row for each other
    source, a language without kept terms has the value 0, a language of one source no pair.
    Repeated rows count as often as they stand. A table without rows gives none. Other columns
    of ``docs`` are not read.
    """
    every = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    entries = stored(kept_counts(docs, min_docs), "kept-counts")
    kept = entries.groupBy("lang", "term").agg(F.sum("n").alias("n_lang"))
    langs = stored(
        kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n_lang").alias("total_lang")), "languages"
    )
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = every.join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    sized = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias("blocks"))
    groups = groups.join(sized, "lang").withColumns({
        "total": F.coalesce("total", F.lit(0)),
        "terms": F.coalesce("terms", F.lit(0)),
        "block": F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int"),
    })
    most = langs.agg(F.max("terms")).first()[0] or 0
    buckets = max(MIN_BUCKETS, -(-most // terms))
    # A row of a group for each bucket: the terms of a hot source meet it in many tasks.
    dealt = stored(groups.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))), "groups")

    bucket = F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")
    shares = entries.withColumn("bucket", bucket).join(dealt, ["lang", "source", "bucket"])
    of_lang = _share_of(F.col("n_lang"), F.col("total_lang"), F.col("terms"))
    found = shares.withColumns({"share": _share_of(F.col("n"), F.col("total"), F.col("terms")), "share_lang": of_lang})

    by_value = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = F.row_number().over(by_value)
    above = found.where(F.col("share") > F.col("share_lang")).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        (F.col("share") - F.col("share_lang")).alias("value"),
    )
    above = above.withColumn("rank", ranked).where(F.col("rank") <= top)

    own = ["lang", "source", "bucket", "block", "blocks", "term", "share"]
    no_share = F.when(F.col("terms") > 0, _share_of(F.lit(0), F.col("total"), F.col("terms"))).otherwise(F.lit(0))
    names = dealt.select("lang", "source", "bucket", "block", "blocks", F.lit(None).cast("string").alias("term"), no_share.alias("share"))
    rows = names.unionByName(found.select(*own))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = rows.withColumn("other", other).select(
        "lang", "source", "bucket", "block", "term", "share",
        F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"),
    )
    partial = paired.groupBy("lang", "left", "right", "bucket").applyInArrow(
        _differences, "lang string, a string, b string, value bigint, seen bigint, apart bigint"
    )
    summed = partial.groupBy("lang", "a", "b").agg(
        F.sum("value").alias("value"), F.sum("seen").alias("seen"), F.max("apart").alias("apart")
    )
    summed = summed.join(langs.select("lang", "terms"), "lang", "left")
    rest = (F.coalesce("terms", F.lit(0)) - F.col("seen")) * F.col("apart")
    summed = stored(summed.select("lang", "a", "b", (F.col("value") + rest).alias("value")), "pairs")
    both = summed.unionByName(summed.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    pairs = both.select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"), "value")
    return pairs.withColumn("rank", ranked).unionByName(above)
