"""Nearest neighbours by an inverted multi-index, for the inner product.

Vectors are cut into two halves, each with its own codebook of centroids; a pair of centroids is
a cell, and every vector is listed in the cell of its nearest pair. A query orders each codebook
by distance and walks the pairs by summed distance with a heap until the cells hold ``share`` of
all vectors. Entries of these cells, and no others, are reranked by the inner product of the
original vectors in double precision. This is so for tables of every size; recall is measured
against brute force in the tests and stated in the README.

Codebooks grow with the cube root of the table up to ``MAX_CODES`` and are fitted on a sample of
at most ``SAMPLE`` vectors; the index holds every vector. The sizes of the cells, at most
MAX_CODES ** 2 numbers, are all that is sent to the tasks beside the codebooks. Neighbouring
cells make one of about ``TILES`` tiles of equal size; a larger cell, such as one with many
copies of a vector, is dealt in parts to several tiles. Queries are dealt to blocks of about
``BLOCK`` and go to each tile that holds some of their cells, with one bit a cell. A task holds
the queries of one block and streams the entries of one tile past them, cell by cell, so its
memory grows with neither; entries go to every block. It sends on the best of each query, a
number of rows in proportion to the queries. Work grows with queries times share: it is a search
of the stated part of the table for each query, not of a number of entries fixed for all tables.

Vectors that are NULL, zero, of another length than most, or that hold a NULL or a number
that is not finite take no part, nor do rows without an id. Rows that share an id count once.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stored

MIN_CODES, MAX_CODES = 16, 128
SAMPLE = 16_384
SHARE = 0.5
TILES = 16
BLOCK = 4_096
QUERIES = 256
HELD = 200_000  # candidates kept before they are cut down to the best


def valid(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, v): one row for each id with a usable vector."""
    v = F.col(column).cast("array<double>")
    usable = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(key).cast("bigint").alias("id"), v.alias("v"))
    return rows.where(F.col("id").isNotNull() & usable & F.exists("v", lambda x: x != 0))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def kmeans(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Centroids; started on rows spread over the sample, empty ones stay where they are."""
    k = min(k, len(rows))
    centres = rows[np.linspace(0, len(rows) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        near = nearest(rows, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        n = np.bincount(near, minlength=k)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * rows @ centres.T).argmin(axis=1)


def codes_for(total: int) -> int:
    """Centroids of a codebook: the power of two nearest to 8 times the cube root, within bounds."""
    return int(np.clip(2 ** round(np.log2(8 * max(total, 1) ** (1 / 3))), MIN_CODES, MAX_CODES))


def tiled(sizes: np.ndarray, chunk: int) -> tuple[np.ndarray, np.ndarray]:
    """Each cell's first tile and how many tiles it has; small neighbouring cells share one.

    Tiles of large cells come last, so a tile's cells are neighbours among the small ones.
    """
    parts = np.maximum(1, -(-sizes // chunk))
    small = parts == 1
    before = np.cumsum(np.where(small, sizes, 0)) - np.where(small, sizes, 0)
    tile = before // chunk
    own = tile.max(initial=-1) + 1 + np.cumsum(np.where(small, 0, parts)) - np.where(small, 0, parts)
    return np.where(small, tile, own).astype(np.int32), parts.astype(np.int32)


def walk(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of places in two ascending lists, by ascending sum."""
    heap, seen = [(first[0] + second[0], 0, 0)], {(0, 0)}
    while heap:
        _, i, j = heapq.heappop(heap)
        yield i, j
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(first) and b < len(second) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (first[a] + second[b], a, b))


def cells_for(query: np.ndarray, books, sizes: np.ndarray, wanted: int) -> list[int]:
    """Cells in order of summed distance until they hold ``wanted`` vectors."""
    half = books[0].shape[1]
    near = [-(books[0] @ query[:half]), -(books[1] @ query[half:])]
    order = [np.argsort(d, kind="stable") for d in near]
    out, held = [], 0
    for i, j in walk(near[0][order[0]], near[1][order[1]]):
        cell = int(order[0][i]) * len(books[1]) + int(order[1][j])
        if sizes[cell]:
            out.append(cell)
            held += int(sizes[cell])
            if held >= wanted:
                break
    return out


class Best:
    """The ``k`` best answers of each query so far, and the score below which none can come in."""

    def __init__(self, queries: int, k: int):
        self.k, self.floor = k, np.full(queries, -np.inf)
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        self.held.append((query, ids, scores))
        self.size += len(query)
        if self.size > HELD + 2 * self.k * len(self.floor):
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keep the best, ties by smaller id."""
        if not self.held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        query, ids, scores = (np.concatenate(c) for c in zip(*self.held))
        order = np.lexsort((ids, -scores, query))
        query, ids, scores = query[order], ids[order], scores[order]
        n = np.bincount(query, minlength=len(self.floor))
        place = np.arange(len(query)) - np.repeat(np.cumsum(n) - n, n)
        last = place == self.k - 1
        self.floor[query[last]] = scores[last]
        keep = place < self.k
        self.held = [(query[keep], ids[keep], scores[keep])]
        self.size = int(keep.sum())
        return self.held[0]


def _rerank(k: int, lows: np.ndarray):
    """Best ``k`` of each query of a (tile, block). Rows come by these, queries before entries.

    ``lows``: each tile's first cell, from which the bits of ``cells`` count.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, names, vectors, wants, found = None, [], [], [], None

        def answers() -> Iterator[pa.RecordBatch]:
            if found is not None:
                query, ids, scores = found.cut()
                if len(query):
                    yield pa.RecordBatch.from_arrays([pa.array(names[query]), pa.array(ids), pa.array(scores)], names=["query_id", "vec_id", "score"])

        for batch in batches:
            if not batch.num_rows:
                continue
            tile, block = batch.column("tile").to_numpy(), batch.column("block").to_numpy()
            ids, cell = batch.column("id").to_numpy(), batch.column("cell").to_numpy()
            every = matrix(batch.column("v"))
            edge = np.flatnonzero((tile[1:] != tile[:-1]) | (block[1:] != block[:-1])) + 1
            for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(tile)]):
                if (tile[a], block[a]) != key:
                    yield from answers()
                    key, names, vectors, wants, found = (tile[a], block[a]), [], [], [], None
                asks = a + int(np.searchsorted(cell[a:b], 0))  # queries have the cell -1
                if asks > a:
                    names.append(ids[a:asks])
                    vectors.append(every[a:asks])
                    wants += [np.unpackbits(np.frombuffer(w, np.uint8)) for w in batch.column("cells").slice(a, asks - a).to_pylist()]
                if asks == b or not len(wants):
                    continue
                if found is None:
                    names, vectors, want = np.concatenate(names), np.concatenate(vectors), np.stack(wants).astype(bool)
                    found = Best(len(names), k)
                inner = np.flatnonzero(cell[asks + 1 : b] != cell[asks : b - 1]) + asks + 1
                for c, d in zip([asks, *inner.tolist()], [*inner.tolist(), b]):
                    who = np.flatnonzero(want[:, cell[c] - lows[key[0]]])
                    for i in range(0, len(who), QUERIES):
                        some = who[i : i + QUERIES]
                        rough = vectors[some] @ every[c:d].T
                        # The product may round otherwise than the exact measure: look a little lower.
                        near = rough >= (found.floor[some] - 1e-9 * (1 + np.abs(rough).max()))[:, None]
                        q, e = np.nonzero(near & (names[some][:, None] != ids[None, c:d]))
                        if len(q):
                            exact = (every[c + e] * vectors[some[q]]).sum(axis=1)
                            found.add(some[q], ids[c + e], exact)
        yield from answers()

    return rows


def search(
    vectors: DataFrame, is_query: Column, k: int = 20, codes: int | None = None, share: float = SHARE,
    tiles: int = TILES, block: int = BLOCK, key: str = "vec_id", column: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its ``k`` nearest found, itself left out.

    ``is_query`` is a condition on the id column. ``codes`` is by default :func:`codes_for` the
    table. A query reads at least k + 1 entries, so it gets ``k`` answers if there are so many.
    Ids are whole numbers; ties go to the smaller one. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = valid(vectors, key, column)
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if common is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.where(F.size("v") == common["n"]).groupBy("id").agg(F.min("v").alias("v"))
    rows = stored(rows, "vectors")
    total = rows.count()
    draw = F.pmod(F.xxhash64("id", F.lit("codebook")), F.lit(1 << 30))
    wide = int(min(1.0, 1.1 * SAMPLE / total) * (1 << 30))
    sample = rows.where(draw < wide).select("v", draw.alias("draw")).toPandas()
    sample = np.stack(sample.sort_values("draw")["v"].head(SAMPLE).to_numpy()) if len(sample) else np.zeros((1, common["n"]))
    half = -(-common["n"] // 2)
    codes = codes or codes_for(total)
    books = kmeans(sample[:, :half], codes), kmeans(sample[:, half:], codes)
    sent = spark.sparkContext.broadcast(books)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = sent.value
        for batch in batches:
            if batch.num_rows:
                v = matrix(batch.column("v"))
                cell = nearest(v[:, :half], one) * len(two) + nearest(v[:, half:], two)
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), batch.column("id"), batch.column("v")], names=["cell", "id", "v"])

    index = stored(rows.mapInArrow(place, "cell int, id bigint, v array<double>"), "index")
    counted = index.groupBy("cell").count().collect()  # at most codes ** 2 rows
    sizes = np.zeros(len(books[0]) * len(books[1]), np.int64)
    for r in counted:
        sizes[r["cell"]] = r["count"]
    first, parts = tiled(sizes, -(-total // tiles))
    last = first + parts - 1
    numbers = np.arange(int(last.max()) + 1)
    lows = np.array([np.flatnonzero((first <= t) & (t <= last))[0] for t in numbers])
    highs = np.array([np.flatnonzero((first <= t) & (t <= last))[-1] for t in numbers])
    wanted = max(k + 1, int(np.ceil(share * total)))
    plan = spark.sparkContext.broadcast((books, sizes, first, parts, lows, highs))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books, sizes, first, parts, lows, highs = plan.value
        for batch in batches:
            for start in range(0, batch.num_rows, QUERIES):
                piece = batch.slice(start, QUERIES)
                row, tile, bits = [], [], []
                for i, q in enumerate(matrix(piece.column("v"))):
                    cells = np.array(cells_for(q, books, sizes, wanted))
                    chosen = np.zeros(len(sizes), bool)
                    chosen[cells] = True
                    n = parts[cells]
                    every = np.repeat(first[cells], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    for t in np.unique(every).tolist():
                        row.append(i)
                        tile.append(t)
                        bits.append(np.packbits(chosen[lows[t] : highs[t] + 1]).tobytes())
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tile, pa.int32()), pa.array(bits, pa.binary()), piece.column("id").take(take), piece.column("v").take(take)],
                    names=["tile", "cells", "id", "v"],
                )

    queries = stored(rows.withColumnRenamed("id", key).where(is_query).withColumnRenamed(key, "id"), "queries")
    blocks = max(1, -(-queries.count() // block))
    asked = queries.mapInArrow(ask, "tile int, cells binary, id bigint, v array<double>").select(
        "tile", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.lit(-1).alias("cell"), "cells", "id", "v"
    )
    where = pd.DataFrame({"cell": np.arange(len(parts), dtype=np.int32), "first": first, "parts": parts})
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    entries = index.join(F.broadcast(spark.createDataFrame(where)), "cell").select(
        (F.col("first") + part).alias("tile"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "cell",
        F.lit(None).cast("binary").alias("cells"), "id", "v",
    )
    dealt = asked.unionByName(entries).repartition("tile", "block").sortWithinPartitions("tile", "block", "cell")
    found = dealt.mapInArrow(_rerank(k, lows), "query_id bigint, vec_id bigint, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
