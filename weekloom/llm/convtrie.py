"""The prefix trie of conversations, with subtree totals by parallel tree contraction.

A node is a distinct sequence of first turns. A turn at place i is hashed together with i, and a
prefix is the XOR of its turns' hashes (two of 64 bits): a set of placed turns is a sequence. So
prefixes come from a running XOR, which is cut into chunks and carried over for long
conversations, and a parent is the node's own hash without its last turn. Texts are dropped as
soon as they are hashed and measured.

Totals over subtrees are contracted in rounds of joins until no node is left. A round takes the
leaves off, each adding its total to its parent (rake), and splices nodes with one child out of
the chains between their parent and that child (compress): the parent takes their weight over,
the child hangs on the parent. No two neighbours are spliced in one round: a node needs a one and
its child a zero, in turn a bit of the depth, which halves a chain, or a hashed coin, which
thins out any other one. Then the rounds are undone from the last to the first: a raked node's
total is what it had, a spliced one's is its weight and the total of the child it was spliced
onto. Rounds grow with the logarithm of the nodes, not with the depth; a node with a third of
all nodes as children is met by sums combined before the shuffle.

Each round is two tables in the shared folder and one more when it is undone, so a lost executor
costs no earlier round, and no plan reads more than the tables of one round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.windows import positions
from ..session import stored

CHUNK = 65_536  # turns of a conversation that one task chains
IDS = 4096  # ids joined to one text
SHARES = 4096
FAMILY, HEADS = 5, 9  # conversations of one family share up to HEADS - 1 first turns
NODE = ["n1", "n2"]


def head_of(conv: Column) -> Column:
    """How many first turns a conversation takes over from the first one of its family."""
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def placed(turns: DataFrame, max_group_rows: int = 2_000_000) -> DataFrame:
    """(conv_id, pos, c1, c2, bytes): every turn at its place from 1, hashed and measured.

    Order is turn (NULL first), then a hash of role and text. Rows without conv_id are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    slim = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("c1"),
        F.xxhash64(F.lit(2), role, text).alias("c2"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    slim = stored(slim, "turns")
    out = positions(slim, ["conv_id"], ["turn", "c1", "c2"], "pos", max_group_rows)
    return stored(out.select("conv_id", "pos", "c1", "c2", "bytes"), "placed")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations, and (conv_id, length) of all, the turnless too."""
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    convs = turns.groupBy("conv_id").agg(F.max("pos").alias("own")).withColumns(
        {"head": head_of(F.col("conv_id")).cast("bigint"), "base": base}
    )
    first = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("first"))
    taken = F.least("head", F.coalesce("first", F.lit(0)))
    convs = stored(convs.join(first, "base", "left").withColumn("taken", taken), "conversations")
    # Own turns after the head; a row for each chunk of a conversation spreads a long one.
    chunks = F.explode(F.sequence(F.lit(0), F.call_function("div", F.col("own"), F.lit(CHUNK))))
    spread = convs.select("conv_id", "head", "taken", chunks.alias("chunk"))
    own = turns.withColumn("chunk", F.call_function("div", F.col("pos"), F.lit(CHUNK))).join(spread, ["conv_id", "chunk"]).where("pos > head")
    own = own.select("conv_id", (F.col("pos") - F.col("head") + F.col("taken")).alias("pos"), "c1", "c2", "bytes")
    heads = turns.where((F.col("pos") < HEADS) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "base")
    heads = heads.join(convs.select("conv_id", "base", "head"), "base").where("pos <= head")
    length = F.col("taken") + F.greatest(F.col("own") - F.col("head"), F.lit(0))
    return own.unionByName(heads.select("conv_id", "pos", "c1", "c2", "bytes")), convs.select("conv_id", length.alias("length"))


def prefixes(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, pos, n1, n2, p1, p2, bytes): the node each turn leads to, and the one before."""
    z = turns.withColumns({
        "z1": F.xxhash64(F.lit(3), "c1", "c2", "pos"), "z2": F.xxhash64(F.lit(4), "c1", "c2", "pos"),
        "part": F.call_function("div", F.col("pos") - 1, F.lit(chunk)),
    })
    run = W.partitionBy("conv_id", "part").orderBy("pos").rowsBetween(W.unboundedPreceding, W.currentRow)
    within = z.withColumns({f"x{i}": F.bit_xor(f"z{i}").over(run) for i in (1, 2)})
    # Only conversations of several chunks have anything to carry; one row a chunk.
    totals = z.groupBy("conv_id", "part").agg(*[F.bit_xor(f"z{i}").alias(f"t{i}") for i in (1, 2)])
    before = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    carried = totals.select("conv_id", "part", *[F.coalesce(F.bit_xor(f"t{i}").over(before), F.lit(0)).alias(f"o{i}") for i in (1, 2)])
    met = within.join(carried, ["conv_id", "part"])
    n = [F.col(f"x{i}").bitwiseXOR(F.col(f"o{i}")) for i in (1, 2)]
    return met.select(
        "conv_id", "pos", n[0].alias("n1"), n[1].alias("n2"),
        n[0].bitwiseXOR(F.col("z1")).alias("p1"), n[1].bitwiseXOR(F.col("z2")).alias("p2"), "bytes",
    )


def _children(tree: DataFrame) -> DataFrame:
    """By parent: the number of children and, where it is one, that child."""
    return tree.where(F.col("p1").isNotNull()).groupBy(F.col("p1").alias("n1"), F.col("p2").alias("n2")).agg(
        F.count(F.lit(1)).alias("children"), F.max("n1").alias("u1"), F.max("n2").alias("u2"), F.max("depth").alias("u_depth")
    )


def subtree_totals(nodes: DataFrame, weights: list[str], checks: list[int] | None = None) -> DataFrame:
    """(n1, n2, weights…): the sum of each weight over every node's subtree.

    ``nodes``: n1, n2, p1, p2 (NULL for the root), depth and the weights, whole numbers.
    """
    tree, rounds = nodes.select(*NODE, "p1", "p2", "depth", *weights), []
    while True:
        turn = len(rounds)

        def bit(one: Column, two: Column, depth: Column) -> Column:
            if turn % 2:
                return F.xxhash64(F.lit(turn), one, two) % 2 != 0
            return F.shiftright(depth, turn // 2 % 16) % 2 != 0

        lone = F.col("children") == 1
        spliced = lone & F.col("p1").isNotNull() & bit(F.col("n1"), F.col("n2"), F.col("depth"))
        spliced = spliced & ~bit(F.col("u1"), F.col("u2"), F.col("u_depth"))
        state = tree.join(_children(tree), NODE, "left").withColumn(
            "kind", F.when(F.col("children").isNull(), "leaf").when(spliced, "spliced").otherwise("stays")
        )
        state = stored(state, "contraction")
        rounds.append(state)
        leaves, chains = state.where("kind = 'leaf'"), state.where("kind = 'spliced'")
        # The child of a spliced node hangs on that node's parent.
        moved = chains.select(F.col("u1").alias("n1"), F.col("u2").alias("n2"), F.col("p1").alias("q1"), F.col("p2").alias("q2"))
        rest = state.where("kind <> 'spliced'").join(moved, NODE, "left").withColumns(
            {"p1": F.coalesce("q1", "p1"), "p2": F.coalesce("q2", "p2")}
        )
        given = rest.where("kind = 'leaf' AND p1 IS NOT NULL").select(
            F.col("p1").alias("n1"), F.col("p2").alias("n2"), *weights
        ).unionByName(chains.select(F.col("p1").alias("n1"), F.col("p2").alias("n2"), *weights))
        given = given.groupBy(*NODE).agg(*[F.sum(w).alias(f"more_{w}") for w in weights])
        left = rest.where("kind = 'stays'").join(given, NODE, "left").select(
            *NODE, "p1", "p2", "depth", *[(F.col(w) + F.coalesce(f"more_{w}", F.lit(0))).alias(w) for w in weights]
        )
        tree = stored(left, "tree")
        if checks is not None:
            checks.append(state.count())
        if tree.isEmpty():
            break
    # Undo: what a spliced node hung on is known by then, from this round's leaves or a later round.
    # All that is known is one table again after each round, so plans don't grow with the rounds;
    # it is no larger than the tree was before that round.
    known = None
    for state in reversed(rounds):
        done = state.where("kind = 'leaf'").select(*NODE, *weights)
        known = done if known is None else known.unionByName(done)
        chains = state.where("kind = 'spliced'")
        below = known.select(F.col("n1").alias("u1"), F.col("n2").alias("u2"), *[F.col(w).alias(f"below_{w}") for w in weights])
        totals = chains.join(below, ["u1", "u2"]).select(*NODE, *[(F.col(w) + F.col(f"below_{w}")).alias(w) for w in weights])
        known = stored(known.unionByName(totals), "expanded")
    return known


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's ids: rows come sorted by node and then by block of ids."""
    schema = pa.schema([("n1", pa.int64()), ("n2", pa.int64()), ("ends_sha256", pa.string())])
    node, state = None, None
    for batch in batches:
        out = []
        for n1, n2, text in zip(*(batch.column(c).to_pylist() for c in ("n1", "n2", "ids"))):
            if node != (n1, n2):
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = (n1, n2), hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
    if node is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip((*node, state.hexdigest()), schema)], schema=schema
        )


def end_digests(ends: DataFrame) -> DataFrame:
    """(n1, n2, ends_sha256) of (n1, n2, conv_id): ids ascending, joined by commas.

    Ids are joined in blocks of ``IDS`` first; the digest then reads a node's blocks in order
    and keeps only its state.
    """
    block = F.col("conv_id") - F.pmod("conv_id", F.lit(IDS))
    joined = ends.groupBy(*NODE, block.alias("block")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )
    parts = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = joined.repartition(parts, *NODE).sortWithinPartitions(*NODE, "block")
    return ordered.mapInArrow(_digests, "n1 bigint, n2 bigint, ends_sha256 string")


def trie(turns: DataFrame, max_group_rows: int = 2_000_000, chunk: int = CHUNK) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Conversations are rebuilt first (:func:`rebuilt`). NULL role and text are empty; turns of
    one number are ordered by a hash of role and text, so repeated rows are turns of their own;
    rows without conv_id are left out, and a conversation left without turns is a member of the
    root. A table without rows has no node. Other columns are not read.
    """
    own = placed(turns, max_group_rows)
    every, convs = rebuilt(own)
    convs = stored(convs, "lengths")
    steps = stored(prefixes(every, chunk), "prefixes")
    zero = F.lit(0).cast("bigint")
    inner = steps.groupBy(*NODE, F.col("pos").alias("depth")).agg(
        F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("bytes").alias("bytes"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"),
    )
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").select(
        zero.alias("n1"), zero.alias("n2"), zero.alias("depth"), "n_convs", "conv_id", zero.alias("bytes"),
        F.lit(None).cast("bigint").alias("p1"), F.lit(None).cast("bigint").alias("p2"),
    )
    nodes = stored(inner.unionByName(root), "nodes")
    count = _children(nodes).select(*NODE, "children")
    nodes = stored(nodes.join(count, NODE, "left").fillna(0, ["children"]), "counted")
    weighted = nodes.withColumns({
        "n_leaves": F.when(F.col("children") == 0, 1).otherwise(0).cast("bigint"),
        "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes"),
    })
    totals = subtree_totals(weighted, ["n_leaves", "saved_tokens"])

    # Parents of more than 1/SHARES of all nodes are few and go to every task; others have few children.
    heavy = -(-nodes.count() // SHARES)
    parents = nodes.select(
        F.col("n1").alias("p1"), F.col("n2").alias("p2"), F.col("conv_id").alias("parent_conv_id"), "children"
    )
    slim = nodes.select(*NODE, "p1", "p2")
    hot = F.broadcast(parents.where(F.col("children") > heavy).drop("children"))
    marked = slim.join(hot, ["p1", "p2"], "left")
    cold = parents.where(F.col("children") <= heavy).drop("children")
    met = marked.where("parent_conv_id IS NULL AND p1 IS NOT NULL").drop("parent_conv_id").join(cold, ["p1", "p2"])
    found = marked.where("parent_conv_id IS NOT NULL").unionByName(met).select(*NODE, "parent_conv_id")

    last = steps.join(convs.select("conv_id", F.col("length").alias("pos")), ["conv_id", "pos"]).select(*NODE, "conv_id")
    turnless = convs.where("length = 0").select(zero.alias("n1"), zero.alias("n2"), "conv_id")
    ends = end_digests(last.unionByName(turnless))
    out = nodes.join(totals, NODE).join(found, NODE, "left").join(ends, NODE, "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.col("children").alias("n_children"), "n_leaves",
        "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
    )
