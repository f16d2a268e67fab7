"""K-d tree sharding with DataFrame functions only.

Documents are points with a weight (the bytes they take). A node is split along its widest
dimension, widths measured against those of all points, at a weighted median; a node meant
for an odd number of leaves is split in proportion. Splitting goes on until every leaf is one
shard of the target bytes. All nodes of a depth are split in the same jobs.

Median. Points have a total order along each dimension: the dimension, then a hash of the
text, then the id, then a row number. The cut is found by counting weights in up to 4,096 slots a node (sums
combined before the shuffle), then again inside the slot that holds the median, until the
rest is under a ten-thousandth of a shard or a single value. No sort, no sample; what comes
back to the driver is one row a node. A value that holds a third of all rows is cut by the
hash, and copies of one text by their ids, so leaves stay even.

Equal texts follow each other in every order used here; a group is divided only where a cut
falls into it.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stored

SLOTS = 4096
BLOCKS = 64
OVERHEAD = 8
MAX_LEAVES = 4096
# Keys lie within 62 bits on either side, so that differences fit a long; NULL is the least.
NEVER, MOST = -(2**62), 2**62 - 1


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint") + OVERHEAD


def as_number(df: DataFrame, column: str) -> Column:
    """An order-preserving long: numbers as they are, text by its first six bytes."""
    kind, c = dict(df.dtypes)[column], F.col(column)
    if kind == "string":
        head = F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0")
        return clipped(F.conv(head, 16, 10))
    if kind in ("double", "float") or kind.startswith("decimal"):
        c = c.cast("double")
        return clipped(F.when(~F.isnan(c) & (F.abs(c) < 1e15), F.floor(c * 1000)))
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return clipped(F.unix_seconds(c.cast("timestamp")))
    return clipped(c)


Cut = tuple[int, int, int, int, int]  # dimension (-1: none), value, hash, id, row


def clipped(x: Column) -> Column:
    return F.coalesce(F.greatest(F.least(x.cast("bigint"), F.lit(MOST)), F.lit(NEVER)), F.lit(NEVER))


def rows_of(spark: SparkSession, rows: dict[int, tuple], names: tuple[str, ...]) -> DataFrame:
    """A few rows, one a node, for a broadcast: there are fewer nodes than leaves."""
    made = [
        F.struct(F.lit(n).alias("node"), *[F.lit(x).cast("bigint").alias(c) for x, c in zip(row, names)])
        for n, row in rows.items()
    ]
    return F.broadcast(spark.range(1).select(F.inline(F.array(*made))))


def value_of(dims: int, dim: Column) -> Column:
    return F.coalesce(*[F.when(dim == d, F.col(f"d{d}")) for d in range(dims)], F.lit(0))


def descend(points: DataFrame, cuts: dict[int, Cut], dims: int) -> DataFrame:
    """Every point one depth down; right of a cut lie a greater value, or hash, or id, or row."""
    names = ("dim", "key", "c_tie", "c_id", "c_row")
    found = points.join(rows_of(points.sparkSession, cuts, names), "node")
    value = value_of(dims, F.col("dim"))
    copy = (F.col("id") == F.col("c_id")) & (F.col("row") > F.col("c_row"))
    later = (F.col("tie") > F.col("c_tie")) | ((F.col("tie") == F.col("c_tie")) & ((F.col("id") > F.col("c_id")) | copy))
    right = (F.col("dim") >= 0) & ((value > F.col("key")) | ((value == F.col("key")) & later))
    return found.withColumn("node", F.col("node") * 2 + right.cast("int")).select(*points.columns)


def _leaves(shards: int) -> list[list[int]]:
    """Leaves under each node of each depth, until all nodes have one (or none)."""
    depths = [[shards]]
    while max(depths[-1]) > 1:
        depths.append([x for n in depths[-1] for x in ((n // 2, n - n // 2) if n > 1 else (n, 0))])
    return depths


def build(points: DataFrame, dims: int, shards: int, slots: int = SLOTS) -> DataFrame:
    """``points`` (id, tie, row, weight, d0.. and others) with ``node``, the leaf of each.

    The table of points is written anew at each depth, a few numbers a document.
    """
    if not 1 <= shards <= MAX_LEAVES:
        raise ValueError(f"between 1 and {MAX_LEAVES} shards")
    spans = [F.struct(F.min(f"d{d}").alias("lo"), F.max(f"d{d}").alias("hi")).alias(f"s{d}") for d in range(dims)]
    whole = points.agg(F.sum("weight").alias("w"), *spans).first()
    room = max(0, int((whole["w"] or 0) / shards / 10_000))
    widths = [max(1, (whole[f"s{d}"]["hi"] or 0) - (whole[f"s{d}"]["lo"] or 0)) for d in range(dims)]
    points = points.withColumn("node", F.lit(0))
    for leaves in _leaves(shards)[:-1]:
        boxes = points.groupBy("node").agg(
            F.sum("weight").alias("w"),
            F.min("tie").alias("tie_lo"), F.max("tie").alias("tie_hi"),
            F.min("id").alias("id_lo"), F.max("id").alias("id_hi"),
            F.min("row").alias("row_lo"), F.max("row").alias("row_hi"), *spans,
        ).collect()  # one row a node
        nodes = {}
        for box in boxes:
            n = leaves[box["node"]]
            if n > 1:
                sizes = [(box[f"s{d}"]["hi"] - box[f"s{d}"]["lo"]) / widths[d] for d in range(dims)]
                dim = sizes.index(max(sizes))
                nodes[box["node"]] = _Cut(
                    dim, box["w"] * (n // 2) / n, (box[f"s{dim}"]["lo"], box[f"s{dim}"]["hi"]),
                    (box["tie_lo"], box["tie_hi"]), (box["id_lo"], box["id_hi"]), (box["row_lo"], box["row_hi"]),
                )
        _search(points, nodes, dims, room, slots)
        cuts = {i: nodes[i].keys() if i in nodes else (-1, 0, 0, 0, 0) for i in range(len(leaves))}
        points = stored(descend(points, cuts, dims), "points")
    return points


STAGES = ("value", "tie", "ident", "row")


@dataclass
class _Cut:
    """A cut being narrowed down: fixed keys so far, and the range of the next one."""

    dim: int
    target: float  # weight that should lie left of the cut
    value: tuple[int, int]
    tie: tuple[int, int]
    ident: tuple[int, int]
    row: tuple[int, int]
    stage: int = 0
    left: float = 0.0  # weight left of the current range
    done: bool = False

    def range(self) -> tuple[int, int]:
        return getattr(self, STAGES[self.stage])

    def narrow(self, lo: int, hi: int) -> None:
        setattr(self, STAGES[self.stage], (lo, hi))
        if lo == hi:
            if self.stage < len(STAGES) - 1:
                self.stage += 1
            else:
                self.done = True

    def keys(self) -> Cut:
        ends = [getattr(self, name)[1] if i <= self.stage else MOST for i, name in enumerate(STAGES)]
        return self.dim, *ends

    def close_before(self, lo: int) -> None:
        """End with everything below ``lo`` of the current stage on the left."""
        setattr(self, STAGES[self.stage], (lo - 1, lo - 1))
        self.done = True


def _search(points: DataFrame, nodes: dict[int, _Cut], dims: int, room: int, slots: int) -> None:
    while open_ := {i: c for i, c in nodes.items() if not c.done}:
        names = ("dim", "stage", "at_value", "at_tie", "at_id", "from_", "to_", "step", "goal")
        rows = {
            i: (c.dim, c.stage, c.value[1], c.tie[1], c.ident[1], *c.range(), _step(c, slots), math.ceil(c.target - c.left))
            for i, c in open_.items()
        }
        at = points.join(rows_of(points.sparkSession, rows, names), "node")
        value, stage = value_of(dims, F.col("dim")), F.col("stage")
        key = F.when(stage == 0, value).when(stage == 1, F.col("tie")).when(stage == 2, F.col("id")).otherwise(F.col("row"))
        fixed = ((stage < 1) | (value == F.col("at_value"))) & ((stage < 2) | (F.col("tie") == F.col("at_tie")))
        fixed = fixed & ((stage < 3) | (F.col("id") == F.col("at_id")))
        at = at.where(fixed).select("node", "weight", "goal", "step", "from_", "to_", key.alias("key"))
        sums = (
            at.where("key BETWEEN from_ AND to_")
            .groupBy("node", "goal", F.expr("(key - from_) DIV step").alias("slot"))
            .agg(F.sum("weight").alias("w"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        )
        # At most `slots` rows in each of these windows.
        running = F.sum("w").over(W.partitionBy("node").orderBy("slot"))
        first = sums.withColumn("upto", running).where("upto >= goal").groupBy("node").agg(
            F.min_by(F.struct("w", "lo", "hi", "upto"), "slot").alias("s")
        )
        found = {r["node"]: r["s"] for r in first.collect()}  # one row a node
        for i, cut in open_.items():
            s = found.get(i)
            if s is None:  # rounding at the far end: everything is left
                cut.done = True
                continue
            before = cut.left + s["upto"] - s["w"]
            if s["w"] <= room:
                cut.narrow(s["hi"], s["hi"])
                cut.done = True
                continue
            if s["lo"] == s["hi"] and cut.stage == len(STAGES) - 1:
                # A single point: on the side that leaves the smaller error.
                if cut.target - before < before + s["w"] - cut.target:
                    cut.close_before(s["lo"])
                else:
                    cut.narrow(s["hi"], s["hi"])
                cut.done = True
                continue
            cut.left = before
            cut.narrow(s["lo"], s["hi"])


def _step(cut: _Cut, slots: int) -> int:
    lo, hi = cut.range()
    return max(1, -(-(hi - lo + 1) // slots))


def shard(
    docs: DataFrame, shards: int, dimensions: tuple[str, ...] = ("n_chars", "lang"), blocks: int = BLOCKS
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row.

    NULL in a dimension is the least value, NULL text an empty one, a NULL id the least id.
    Rows that share an id and a text are told apart by a number each row gets in the one stored
    table that all cuts read, so copies of a row are divided as evenly as others.
    ``slot`` numbers a shard's rows from 0 without gaps: rows are numbered in blocks, and the
    blocks' counts are added up, so no task orders a whole shard.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    points = stored(
        docs.select(
            F.col("doc_id"),
            clipped(F.col("doc_id")).alias("id"),
            F.shiftrightunsigned(F.xxhash64(text), 2).alias("tie"),
            size_of().alias("weight"),
            F.crc32(text).alias("text_crc32"),
            F.monotonically_increasing_id().alias("row"),
            *[as_number(docs, d).alias(f"d{i}") for i, d in enumerate(dimensions)],
        ),
        "points",
    )
    depths = _leaves(shards)
    # Leaves left to right are the shards.
    order, number = [], 0
    for n in depths[-1]:
        order.append(number if n else -1)
        number += n
    leaf = F.element_at(F.array(*[F.lit(x) for x in order]), (F.col("node") + 1).cast("int"))
    block = F.pmod(F.xxhash64("id", "tie"), F.lit(blocks)).cast("int")
    placed = build(points, len(dimensions), shards).select("doc_id", "id", "tie", F.col("weight").alias("size"), "text_crc32", leaf.alias("shard"), block.alias("block"))
    counts = placed.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    # At most `blocks` rows in each of these windows.
    offsets = counts.select(
        "shard", "block", (F.sum("n").over(W.partitionBy("shard").orderBy("block")) - F.col("n")).alias("offset")
    )
    rank = F.row_number().over(W.partitionBy("shard", "block").orderBy("id", "tie"))
    return placed.withColumn("rank", rank).join(offsets, ["shard", "block"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("offset") + F.col("rank") - 1).alias("slot")
    )
