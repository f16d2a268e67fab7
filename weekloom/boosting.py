"""Boosted regression trees over more rows than executors can cache.

Spark's GBTRegressor caches its binned rows as objects, several times the size of the table; once
they spill, each of its passes reads them back from disk as objects. Here the bins are one byte a
feature in a stored table, and each level of a tree is one pass that adds up a histogram per
open node. The algorithm is Spark's own: its candidate thresholds (from the rows that it would
sample), variance gains, stop rules, pruning, residuals and weights. Sums are added in another order.
The result is an ordinary GBTRegressionModel.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import stored

# Up to so many training rows Spark's own learner keeps its objects in memory.
CACHED_ROWS = 5_000_000
# Cells (node, feature, bin) of one pass; more open nodes take more passes.
PASS_CELLS = 1 << 18
# Parameters that are followed here; with any other one Spark's learner is used at every size. The
# tolerance means nothing without a validation column.
PARAMS = {"maxIter", "maxDepth", "maxBins", "minInstancesPerNode", "minInfoGain", "stepSize", "seed", "validationTol"}
# Bytes of blocks that one batch brings to a task, and rows that a task takes at a time.
BATCH_BYTES = 32 << 20
PIECE_ROWS = 1 << 15
EPSILON = float(np.finfo(np.float64).eps)


def impurity(n, s, q):
    """Variance from count, sum and sum of squares; 0 without rows."""
    n = np.asarray(n, dtype=np.float64)
    safe = np.where(n == 0, 1.0, n)
    return np.where(n == 0, 0.0, (q - s * s / safe) / safe)


@dataclass
class Node:
    """A leaf, until ``split`` gives it a feature and the last bin of its left side."""

    n: float = 0.0
    s: float = 0.0
    q: float = 0.0
    depth: int = 0
    feature: int = -1
    bin: int = 0
    gain: float = 0.0
    impurity: float = -1.0
    left: "Node | None" = None
    right: "Node | None" = None

    @property
    def value(self) -> float:
        return float(self.s / self.n) if self.n else 0.0

    def plain(self, number: dict[int, int] | None = None):
        """For tasks: (feature, bin, left, right), at a leaf its value, or its place among the open nodes."""
        if self.left is None:
            return self.value if number is None else number.get(id(self), -1)
        return self.feature, self.bin, self.left.plain(number), self.right.plain(number)


def fit(rows: DataFrame, columns: Sequence[str], label: str, learner: GBTRegressor, n: int) -> GBTRegressionModel:
    """The model that ``learner`` would fit to the ``n`` rows, double ``columns`` and a double ``label``."""
    rows = rows.select(*columns, label)
    learner._transfer_params_to_java()
    thresholds = _thresholds(rows, columns, label, learner, n)
    binned, kind = _binned(rows, columns, label, thresholds)
    trees: list[Node] = []
    for _ in range(learner.getMaxIter()):
        done = [(1.0 if i == 0 else learner.getStepSize(), t.plain()) for i, t in enumerate(trees)]
        trees.append(_tree(binned, kind, thresholds, done, learner))
    return _model(learner, trees, thresholds)


def _jvm(df: DataFrame):
    return df.sparkSession.sparkContext._jvm


def _module(package, name: str):
    return getattr(getattr(package, f"{name}$"), "MODULE$")


def _thresholds(rows: DataFrame, columns: Sequence[str], label: str, learner: GBTRegressor, n: int) -> list[list[float]]:
    """Spark's candidate splits of each column, in order.

    Rows are drawn as Spark draws them, by the same seed from the same partitions, but before they
    are made into vectors: the others are only read.
    """
    jvm, spark = _jvm(rows), rows.sparkSession
    ml = jvm.org.apache.spark.ml
    wanted = max(learner.getMaxBins() ** 2, 10_000)
    drawn = rows
    if wanted < n:
        seed = jvm.org.apache.spark.util.random.XORShiftRandom(learner.getSeed()).nextInt()
        all_rows = rows._jdf.queryExecution().toRdd()
        some = all_rows.sample(False, wanted / n, seed)
        drawn = DataFrame(spark._jsparkSession.internalCreateDataFrame(some, rows._jdf.schema(), False), spark)
    vectors = VectorAssembler(inputCols=list(columns), outputCol="features").transform(drawn)
    learner_java = learner._java_obj
    vectors = vectors.select("features", F.col(label).alias(learner.getLabelCol()))
    instances = _module(ml.util, "DatasetUtils").extractInstances(learner_java, vectors._jdf, getattr(jvm.scala, "None$").__getattr__("MODULE$"))
    regression = _module(jvm.org.apache.spark.mllib.tree.configuration, "Algo").Regression()
    no_categories = _module(jvm.scala.collection.immutable, "Map").empty()
    strategy = learner_java.getOldBoostingStrategy(no_categories, regression).treeStrategy()
    # As Spark's own, but of the drawn rows: it then takes them all, and zeros count as they would.
    most = min(n, wanted)
    bins = min(learner.getMaxBins(), n)
    sizes = spark.sparkContext._gateway.new_array(jvm.int, len(columns))
    for i in range(len(columns)):
        sizes[i] = bins
    metadata = ml.tree.impl.DecisionTreeMetadata(
        len(columns), most, float(most), 0, bins, no_categories,
        _module(jvm.scala.collection.immutable, "Set").empty(), sizes,
        _module(jvm.org.apache.spark.mllib.tree.impurity, "Variance"), strategy.quantileCalculationStrategy(),
        learner.getMaxDepth(), learner.getMinInstancesPerNode(), 0.0, learner.getMinInfoGain(), 1, len(columns),
    )
    found = _module(ml.tree.impl, "RandomForest").findSplits(instances, metadata, learner.getSeed())
    return [[split.threshold() for split in splits] for splits in found]


def _binned(rows: DataFrame, columns: Sequence[str], label: str, thresholds: list[list[float]]) -> tuple[DataFrame, str]:
    """The rows as bins, with their label; stored.

    A stored row is a block of rows, so that moving them to a task costs no work a row. Blocks are as
    small as a batch of them has to be.
    """
    kind = "uint8" if max(map(len, thresholds)) < 256 else "uint16"
    edges = [np.array(t, dtype=np.float64) for t in thresholds]
    names = list(columns)
    a_row = len(names) * np.dtype(kind).itemsize + 8
    a_batch = int(rows.sparkSession.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    block = max(1, BATCH_BYTES // (a_row * (a_batch if a_batch > 0 else 10_000)))

    def blocks(made: np.ndarray) -> pa.Array:
        starts = np.append(np.arange(0, len(made), block), len(made)) * made[:1].nbytes
        buffers = [None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(made)]
        return pa.Array.from_buffers(pa.binary(), len(starts) - 1, buffers)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            goal = batch.column(label)
            y = np.ascontiguousarray(goal.to_numpy(zero_copy_only=False), dtype=np.float64)
            if goal.null_count or np.isnan(y).any():
                raise ValueError("Labels MUST NOT be Null or NaN")
            made = np.empty((batch.num_rows, len(names)), dtype=kind)
            for i, name in enumerate(names):
                given = batch.column(name)
                x = given.to_numpy(zero_copy_only=False)
                if given.null_count or not np.isfinite(x).all():
                    raise ValueError(f"Vector values MUST NOT be NaN or Infinity: {name}")
                made[:, i] = np.searchsorted(edges[i], x, "left")
            yield pa.RecordBatch.from_arrays([blocks(made), blocks(y)], names=["bins", "y"])

    return stored(rows.mapInArrow(bins, "bins binary, y binary"), "binned"), kind


def _tree(binned: DataFrame, kind: str, thresholds, done, learner: GBTRegressor) -> Node:
    root = Node()
    open_ = [root]
    widest = max(map(len, thresholds)) + 1
    at_once = max(1, PASS_CELLS // (len(thresholds) * widest))
    while open_:
        grown: list[Node] = []
        for start in range(0, len(open_), at_once):
            some = open_[start : start + at_once]
            sums = _histograms(binned, kind, len(thresholds), widest, done, root, some)
            for node, cells in zip(some, sums):
                grown += _split(node, cells, thresholds, learner)
        open_ = grown
    return root


def _histograms(binned: DataFrame, kind: str, width: int, widest: int, done, root: Node, nodes: list[Node]) -> np.ndarray:
    """Count, sum and sum of squares of the residuals by open node, feature and bin: one pass."""
    growing = root.plain({id(node): i for i, node in enumerate(nodes)})
    counted = binned.mapInArrow(_adder(kind, width, widest, done, growing, len(nodes)), "cell bigint, n double, s double, q double")
    total = counted.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("n", "s", "q")]).toArrow()
    out = np.zeros((3, width * len(nodes) * widest))
    cell = total.column("cell").to_numpy()
    for i, c in enumerate(("n", "s", "q")):
        out[i][cell] = total.column(c).to_numpy()
    return out.reshape(3, width, len(nodes), widest).transpose(2, 0, 1, 3)


def _adder(kind: str, width: int, widest: int, done, growing, count: int) -> Callable:
    """Everything a task calls is inside, so that tasks need numpy and pyarrow only."""
    piece = PIECE_ROWS

    def spread(tree, bins, out, add: float | None) -> None:
        """Add ``add`` times the value of each row's leaf, or with None put the leaf itself."""
        todo = [(tree, None)]
        while todo:
            node, rows = todo.pop()
            if isinstance(node, tuple):
                feature, last, left, right = node
                here = bins[feature] <= last
                todo.append((left, here if rows is None else rows & here))
                todo.append((right, ~here if rows is None else rows & ~here))
            elif add is None:
                out[slice(None) if rows is None else rows] = node
            else:
                out[slice(None) if rows is None else rows] += add * node

    def values(column: pa.Array, kind: str) -> np.ndarray:
        """The blocks of a column one behind the other, as they lie."""
        _, starts, data = column.buffers()
        starts = np.frombuffer(starts, np.int64 if pa.types.is_large_binary(column.type) else np.int32)
        first, last = starts[column.offset], starts[column.offset + len(column)]
        return np.frombuffer(data, np.uint8)[first:last].view(kind)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, y = values(batch.column("bins"), kind).reshape(-1, width), values(batch.column("y"), "float64")
            for at in range(0, len(y), piece):
                yield np.ascontiguousarray(bins[at : at + piece].T), y[at : at + piece]

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, width, count * widest))
        for bins, rest in pieces(batches):
            rows = len(rest)
            if done:
                guess = np.zeros(rows)
                for weight, tree in done:
                    spread(tree, bins, guess, weight)
                rest = 2.0 * (rest - guess)
            place = np.empty(rows, dtype=np.int64)
            spread(growing, bins, place, None)
            kept = place >= 0
            if not kept.all():
                bins, rest, place = bins[:, kept], rest[kept], place[kept]
            place *= widest
            square = rest * rest
            for f in range(width):
                cell = place + bins[f]
                total[0, f] += np.bincount(cell, minlength=count * widest)
                total[1, f] += np.bincount(cell, rest, count * widest)
                total[2, f] += np.bincount(cell, square, count * widest)
        n, s, q = total.reshape(3, -1)
        cell = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(a) for a in (cell, n[cell], s[cell], q[cell])], names=["cell", "n", "s", "q"])

    return add_up


def _split(node: Node, cells: np.ndarray, thresholds, learner: GBTRegressor) -> list[Node]:
    """Give the node its best split, if there is one; the children that may be split in turn.

    Of equal gains the first feature and the least threshold win; gains that differ by rounding
    only count as equal, so the order of addition decides nothing.
    """
    if node.depth == 0:
        node.n, node.s, node.q = (float(c) for c in cells[:, 0].sum(axis=1))
    own = float(impurity(node.n, node.s, node.q))
    left = cells.cumsum(axis=2)[:, :, :-1]
    right = cells.sum(axis=2)[:, :, None] - left
    total = left[0] + right[0]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = own - left[0] / total * impurity(*left) - right[0] / total * impurity(*right)
    least = learner.getMinInstancesPerNode()
    usable = np.arange(left.shape[2])[None, :] < np.array([len(t) for t in thresholds])[:, None]
    usable &= (left[0] >= least) & (right[0] >= least) & (gain >= learner.getMinInfoGain())
    if not usable.any():
        return []
    node.impurity = own
    gain = np.where(usable, gain, -np.inf)
    first = int(np.flatnonzero(gain.ravel() >= gain.max() - 1e-12 * abs(own))[0])
    feature, last = divmod(first, gain.shape[1])
    if gain[feature, last] <= 0 or node.depth == learner.getMaxDepth():
        return []
    node.feature, node.bin, node.gain = feature, last, float(gain[feature, last])
    node.left, node.right = (
        Node(*(float(v) for v in side[:, feature, last]), depth=node.depth + 1) for side in (left, right)
    )
    children = []
    for child in (node.left, node.right):
        child.impurity = float(impurity(child.n, child.s, child.q))
        if child.depth < learner.getMaxDepth() and abs(child.impurity) >= EPSILON:
            children.append(child)
    return children


def _model(learner: GBTRegressor, trees: list[Node], thresholds: list[list[float]]) -> GBTRegressionModel:
    """Spark's model of the trees; two equal leaves of one split become one, as in Spark."""
    est = learner._java_obj
    sc = SparkSession.active().sparkContext
    jvm, gateway = sc._jvm, sc._gateway
    ml = jvm.org.apache.spark.ml

    def stats(node: Node):
        three = gateway.new_array(jvm.double, 3)
        three[0], three[1], three[2] = float(node.n), float(node.s), float(node.q)
        return jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(three, int(node.n))

    def made(node: Node) -> tuple:
        """The node and, of a leaf, its prediction."""
        if node.left is not None:
            (left, low), (right, high) = made(node.left), made(node.right)
            if low is None or high is None or low != high:
                split = ml.tree.ContinuousSplit(node.feature, float(thresholds[node.feature][node.bin]))
                inner = ml.tree.InternalNode(node.value, node.impurity, node.gain, left, right, split, stats(node))
                return inner, None
        return ml.tree.LeafNode(node.value, node.impurity, stats(node)), node.value

    kinds = ml.regression
    array = gateway.new_array(kinds.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(jvm.double, len(trees))
    for i, tree in enumerate(trees):
        uid = f"dtr_{est.uid()}_{i}"
        array[i] = kinds.DecisionTreeRegressionModel(uid, made(tree)[0], len(thresholds))
        weights[i] = 1.0 if i == 0 else float(learner.getStepSize())
    model = kinds.GBTRegressionModel(est.uid(), array, weights, len(thresholds))
    return GBTRegressionModel(est.copyValues(model, est.extractParamMap()))
