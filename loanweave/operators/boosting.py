"""Second-order gradient boosting with histograms that the executors sum.

Features are binned once and packed into blocks of rows.  A pass over the blocks adds up
gradients and Hessians per node, feature and bin; the smaller child of each split is counted and
its sibling is the difference to the parent.  Splits have the largest second-order gain.
Trees grow best first up to a number of leaves, or level by level up to a depth; either way
one pass serves all leaves that may be split next, so a tree takes about as many passes as it
is deep.  The driver holds the histograms of one tree's nodes (leaves x features x bins).

A pass is a Spark job, and hundreds of rounds are thousands of jobs.  A matrix that is small
enough for one task's memory is therefore fitted inside of one task: the same rounds over the same
blocks, bags and cells, without a job for each pass.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession, functions as F

from loanweave.operators.preparation import LABEL, WEIGHT
from loanweave.session import ensure_checkpoint_dir

#: Rows of one block, and the largest number of bins (one byte per value).
BLOCK_ROWS, MAX_BINS = 8_192, 256
#: A task adds rows to its histograms once it has so many of them, or has met so many blocks.
ADDED_ROWS, ADDED_BLOCKS = 32_768, 32
#: Values (rows x features, one byte each) of a matrix that is fitted inside of one task, at most.
ONE_TASK_VALUES = 64_000_000
_BLOCK = "block bigint, n int, bins binary, label binary, weight binary, margin binary, loss double, total double"


@dataclass(frozen=True)
class Growth:
    """How trees grow.  ``max_leaves=None`` grows whole levels, ``max_depth=None`` has no depth limit."""

    rounds: int = 200
    learning_rate: float = 0.05
    max_depth: int | None = 6
    max_leaves: int | None = None
    l2: float = 1.0
    min_rows: int = 1
    min_hessian: float = 1e-3
    subsample: float = 1.0
    bagging_every: int = 1
    colsample: float = 1.0
    max_bins: int = 254
    patience: int = 50
    quantile_error: float = 1e-3
    seed: int = 42

    def __post_init__(self):
        if self.max_depth is None and self.max_leaves is None:
            raise ValueError("a tree needs a largest depth or a largest number of leaves")
        if not 2 <= self.max_bins <= MAX_BINS:
            raise ValueError(f"between 2 and {MAX_BINS} bins")


@dataclass
class Node:
    depth: int
    histogram: np.ndarray | None = None  # features x bins x (gradient, Hessian, rows)
    feature: int = -1
    bin: int = -1
    gain: float = 0.0
    left: int = -1
    right: int = -1
    split: bool = False
    sums: np.ndarray = field(default_factory=lambda: np.zeros(3))


def best_split(histogram: np.ndarray, growth: Growth) -> tuple[float, int, int]:
    """(gain, feature, bin) of the best split; rows in bins up to ``bin`` go left."""
    total = histogram[0].sum(0) if len(histogram) else np.zeros(3)
    left = [c.cumsum(1)[:, :-1] for c in np.moveaxis(histogram, -1, 0)]
    right = [t - c for t, c in zip(total, left)]

    def score(s):
        return s[0] ** 2 / np.maximum(s[1] + growth.l2, 1e-300)

    gain = score(left) + score(right) - score(total)
    enough = (np.minimum(left[2], right[2]) >= max(1, growth.min_rows) - 1e-9) & (
        np.minimum(left[1], right[1]) >= growth.min_hessian
    )
    gain = np.where(enough, gain, -np.inf)
    if not gain.size:
        return -math.inf, -1, -1
    at = int(gain.argmax())
    feature, cut = divmod(at, gain.shape[1])
    return float(gain.flat[at]), feature, cut


def route(nodes: list[tuple[int, int, int, int]], bins: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """Node of every row; ``nodes`` are (feature, bin, left, right) with feature -1 at the ends.

    Rows begin at the root, or at the nodes where they ended before the tree grew on.
    """
    feature, cut, left, right = (np.array(c) for c in zip(*nodes))
    at = np.zeros(len(bins), np.int64) if start is None else start
    rows = np.arange(len(bins))
    while len(rows):
        rows = rows[feature[at[rows]] >= 0]
        here = at[rows]
        at[rows] = np.where(bins[rows, feature[here]] <= cut[here], left[here], right[here])
    return at


class _Cells:
    """Sums of gradient, Hessian and rows per used feature, node and bin."""

    def __init__(self, used: Sequence[int], nodes: int, bins: int):
        self.used, self.nodes, self.bins = used, nodes, bins
        self.total = np.zeros((3, len(used), nodes * bins))

    def add(self, slot: np.ndarray, g: np.ndarray, h: np.ndarray, column: Callable[[int], np.ndarray]) -> None:
        """Rows of the nodes ``slot``; ``column`` gives a feature's bins of these rows."""
        cell = slot * self.bins
        for k, f in enumerate(self.used):
            index = cell + column(f)
            for s, weights in enumerate((g, h, None)):
                self.total[s, k] += np.bincount(index, weights, self.total.shape[2])

    def of(self, node: int) -> np.ndarray:
        """features x bins x (gradient, Hessian, rows)."""
        return np.stack(self.total.reshape(3, len(self.used), self.nodes, self.bins)[:, :, node], -1)


def bin_edges(df: DataFrame, features: str, max_bins: int, error: float) -> list[list[float]]:
    """Ascending edges per feature: about equally many rows lie between neighbours, and no edge is the largest value."""
    first = df.select(vector_to_array(features).alias("x")).first()
    if first is None:
        return []
    names = [f"x{k}" for k in range(len(first.x))]
    wide = df.select(vector_to_array(features).alias("x")).select(*[F.col("x")[k].alias(n) for k, n in enumerate(names)])
    found = wide.approxQuantile(names, [k / max_bins for k in range(max_bins + 1)], error)
    return [sorted(set(q))[:-1][: max_bins - 1] for q in found]


def _blocks(df: DataFrame, features: str, edges: list[list[float]], base: float) -> DataFrame:
    read = df.select(
        vector_to_array(features).alias("x"), F.col(LABEL).cast("double").alias("y"),
        (F.col(WEIGHT) if WEIGHT in df.columns else F.lit(1.0)).cast("double").alias("w"),
    )
    shared = df.sparkSession.sparkContext.broadcast([np.array(e) for e in edges])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(shared.value)) if batch.num_rows else None
            for k in range(0, batch.num_rows, BLOCK_ROWS):
                part = np.asfortranarray(x[k : k + BLOCK_ROWS])
                bins = np.empty(part.shape, np.uint8, order="F")
                for f, edge in enumerate(shared.value):
                    bins[:, f] = np.searchsorted(edge, part[:, f], side="left")
                y, w = (batch.column(c).to_numpy()[k : k + BLOCK_ROWS].astype(np.float64) for c in (1, 2))
                yield _row(number, bins, y, w, np.full(len(y), base))
                number += 1

    return read.mapInArrow(run, _BLOCK)


def _row(number: int, bins: np.ndarray, y: np.ndarray, w: np.ndarray, margin: np.ndarray) -> pa.RecordBatch:
    """One block; the values of a feature lie next to each other."""
    loss = float((w * (np.logaddexp(0, margin) - y * margin)).sum())
    columns = [
        pa.array([number], pa.int64()), pa.array([len(y)], pa.int32()), *[pa.array([a.tobytes("F")], pa.binary()) for a in (bins, y, w, margin)],
        pa.array([loss]), pa.array([float(w.sum())]),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["block", "n", "bins", "label", "weight", "margin", "loss", "total"])


def _read(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Number, bins (rows x features), label, weight and margin of every block, without a copy."""
    for k in range(batch.num_rows):
        number, n = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
        bins, *rest = (batch.column(c)[k].as_buffer() for c in range(2, 6))
        yield number, np.frombuffer(bins, np.uint8).reshape(-1, n).T, *(np.frombuffer(r, np.float64) for r in rest)


class _Store:
    """Blocks written to the shared checkpoint folder, one version after the other."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.version = spark, 0
        self.folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/boosting-{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame) -> DataFrame:
        df.write.option("compression", "snappy").parquet(f"{self.folder}/{self.version}")
        found = self.spark.read.schema(_BLOCK).parquet(f"{self.folder}/{self.version}")
        if self.version:
            self._delete(f"{self.folder}/{self.version - 1}")
        self.version += 1
        return found

    def close(self) -> None:
        self._delete(self.folder)

    def _delete(self, path: str) -> None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def histograms(
    blocks: DataFrame, nodes: list[tuple[int, int, int, int]], wanted: list[int], used: list[int], bins: int,
    subsample: float, bag: tuple[int, int],
) -> dict[int, np.ndarray]:
    """features x bins x (gradient, Hessian, rows) of the wanted nodes, over the rows of a bag.

    Every task adds up its blocks and sends the cells that are not empty; Spark sums them.
    """
    place = {node: k for k, node in enumerate(wanted)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _Cells(used, len(wanted), bins)
        slot = _slots(nodes, wanted)
        parts = []

        def add() -> None:
            at, g, h = (np.concatenate(column) for column in list(zip(*parts))[2:])
            cells.add(at, g, h, lambda f: np.concatenate([held[:, f].take(rows) for held, rows, *_ in parts]))
            parts.clear()

        for batch in batches:
            for number, held, y, w, margin in _read(batch):
                at = slot[route(nodes, held)]
                inside = at >= 0
                if subsample < 1:
                    inside &= _bagged(bag, number, len(y), subsample)
                rows = np.flatnonzero(inside)
                parts.append((held, rows, at[rows], *_slopes(y[rows], w[rows], margin[rows])))
                # few rows would cost as much as the cells they are added to
                if sum(len(rows) for _, rows, *_ in parts) >= ADDED_ROWS or len(parts) >= ADDED_BLOCKS:
                    add()
        if parts:
            add()
        total = cells.total
        f, c = np.nonzero(total[2])
        yield pa.RecordBatch.from_arrays(
            [pa.array((c // bins).astype(np.int32)), pa.array(f.astype(np.int32)), pa.array((c % bins).astype(np.int32)), *[pa.array(total[s, f, c]) for s in range(3)]],
            names=["node", "feature", "bin", "g", "h", "n"],
        )

    cells = blocks.select("block", "n", "bins", "label", "weight", "margin").mapInArrow(run, "node int, feature int, bin int, g double, h double, n double")
    summed = cells.groupBy("node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")]).toArrow()
    out = np.zeros((len(wanted), len(used), bins, 3))
    at = tuple(summed[c].to_numpy() for c in ("node", "feature", "bin"))
    for s, c in enumerate(("g", "h", "n")):
        out[(*at, s)] = summed[c].to_numpy()
    return {node: out[k] for node, k in place.items()}


def _slots(nodes: list[tuple[int, int, int, int]], wanted: list[int]) -> np.ndarray:
    """Place of every node among the wanted ones, or -1."""
    slot = np.full(len(nodes), -1)
    slot[wanted] = np.arange(len(wanted))
    return slot


def _bagged(bag: tuple[int, int], number: int, rows: int, subsample: float) -> np.ndarray:
    """Which rows of a block are in a bag."""
    return np.random.default_rng([*bag, number]).random(rows) < subsample


def _slopes(y: np.ndarray, w: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of the weighted logistic loss."""
    p = 1 / (1 + np.exp(-margin))
    return w * (p - y), w * p * (1 - p)


def grow(count: Callable[..., dict[int, np.ndarray]], used: list[int], growth: Growth, ahead: int | None = None) -> list[Node]:
    """One tree; features of the nodes are places in ``used``.

    ``count`` gives the histograms of nodes, of at most ``ahead`` more than the next split needs.
    """
    limit = growth.max_leaves or 2 ** growth.max_depth
    nodes = [Node(0)]

    def described() -> list[tuple[int, int, int, int]]:
        return [(used[n.feature] if n.left >= 0 else -1, n.bin, n.left, n.right) for n in nodes]

    def known(k: int, histogram: np.ndarray) -> None:
        node = nodes[k]
        node.histogram, node.sums = histogram, histogram[0].sum(0)
        if growth.max_depth is None or node.depth < growth.max_depth:
            node.gain, node.feature, node.bin = best_split(histogram, growth)
        else:
            node.gain = -math.inf

    known(0, count(described(), [0])[0])
    open_, leaves = [0], 1
    while leaves < limit:
        open_ = [k for k in open_ if nodes[k].gain > 1e-12]
        if not open_:
            break
        best = max(open_, key=lambda k: (nodes[k].gain, -k))
        if nodes[best].left < 0:
            # one pass for all that may be split next, leaves and what was counted ahead below them
            others = [k for k, n in enumerate(nodes) if n.left < 0 and n.gain > 1e-12 and k != best]
            others = sorted(others, key=lambda k: (-nodes[k].gain, k))[: limit - 1 if ahead is None else ahead]
            counted = {}
            for k in [best, *others]:
                node = nodes[k]
                node.left, node.right = len(nodes), len(nodes) + 1
                nodes += [Node(node.depth + 1), Node(node.depth + 1)]
                left_rows = node.histogram[node.feature, : node.bin + 1, 2].sum()
                counted[node.left if 2 * left_rows <= node.sums[2] else node.right] = k
            found = count(described(), sorted(counted))
            for child, k in counted.items():
                node = nodes[k]
                known(child, found[child])
                known(node.right if child == node.left else node.left, node.histogram - found[child])
                node.histogram = None
        nodes[best].split = True
        open_.remove(best)
        open_ += [nodes[best].left, nodes[best].right]
        leaves += 1
    return nodes


def finished(nodes: list[Node], used: list[int], growth: Growth) -> dict[str, list]:
    """The tree without what was only counted ahead; values are already times the learning rate."""
    tree: dict[str, list] = {"feature": [], "bin": [], "left": [], "right": [], "value": [], "gain": []}

    def add(k: int) -> int:
        node, at = nodes[k], len(tree["feature"])
        value = 0.0 if node.split else float(-growth.learning_rate * node.sums[0] / max(node.sums[1] + growth.l2, 1e-300))
        for name, v in zip(tree, (used[node.feature] if node.split else -1, node.bin if node.split else 0, -1, -1, value, node.gain if node.split else 0.0)):
            tree[name].append(v)
        if node.split:
            tree["left"][at] = add(node.left)
            tree["right"][at] = add(node.right)
        return at

    add(0)
    return tree


def _moved(blocks: DataFrame, tree: dict[str, list]) -> DataFrame:
    nodes, values = list(zip(tree["feature"], tree["bin"], tree["left"], tree["right"])), np.array(tree["value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, bins, y, w, margin in _read(batch):
                yield _row(number, bins, y, w, margin + values[route(nodes, bins)])

    return blocks.mapInArrow(run, _BLOCK)


class _Written:
    """Blocks of any number, in the checkpoint folder; every step is a pass over them."""

    def __init__(self, spark: SparkSession, name: str, sizes: Sequence[int], growth: Growth):
        self.store, self.sizes, self.growth, self.blocks = _Store(spark, name), sizes, growth, None

    def write(self, blocks: DataFrame) -> None:
        self.blocks = self.store.write(blocks)

    def ahead(self, growth: Growth) -> int | None:
        return None

    def histograms(self, nodes: list, wanted: list[int], used: list[int], bag: tuple[int, int]) -> dict[int, np.ndarray]:
        return histograms(self.blocks, nodes, wanted, used, max(self.sizes), self.growth.subsample, bag)

    def move(self, tree: dict[str, list]) -> None:
        self.write(_moved(self.blocks, tree))

    def loss(self) -> float:
        loss, total = self.blocks.agg(F.sum("loss"), F.sum("total")).first()
        return loss / total if total else math.inf


class _Held:
    """The same blocks in the memory of one task."""

    def __init__(self, blocks: list[tuple], sizes: Sequence[int], growth: Growth):
        blocks = sorted(blocks, key=lambda b: b[0])
        self.sizes, self.growth = sizes, growth
        self.lengths = [(number, len(y)) for number, _, y, *_ in blocks]
        self.bins = np.empty((sum(n for _, n in self.lengths), len(sizes)), np.uint8, order="F")
        first = 0
        for _, bins, *_ in blocks:
            self.bins[first : first + len(bins)] = bins
            first += len(bins)
        self.y, self.w, self.margin = (np.concatenate([b[k] for b in blocks] or [np.empty(0)]) for k in (2, 3, 4))
        self.bag, self.inside, self.slopes, self.at = None, None, None, None

    def ahead(self, growth: Growth) -> int | None:
        """A pass costs little here; nodes that are never split would cost more."""
        return None if growth.max_leaves is None else 8

    def histograms(self, nodes: list, wanted: list[int], used: list[int], bag: tuple[int, int]) -> dict[int, np.ndarray]:
        if self.slopes is None:  # the first pass of a tree
            self.slopes, self.at = _slopes(self.y, self.w, self.margin), np.zeros(len(self.y), np.int64)
        if self.growth.subsample < 1 and bag != self.bag:
            self.bag, self.inside = bag, np.concatenate([_bagged(bag, k, n, self.growth.subsample) for k, n in self.lengths])
        self.at = route(nodes, self.bins, self.at)
        slot = _slots(nodes, wanted)[self.at]
        here = np.flatnonzero(slot >= 0 if self.inside is None else (slot >= 0) & self.inside)
        cells = _Cells(used, len(wanted), max(self.sizes))
        for k in range(0, len(here), ADDED_ROWS):
            rows = here[k : k + ADDED_ROWS]
            cells.add(slot[rows], *[s[rows] for s in self.slopes], lambda f: self.bins[:, f].take(rows))
        return {node: cells.of(k) for k, node in enumerate(wanted)}

    def move(self, tree: dict[str, list]) -> None:
        nodes = list(zip(tree["feature"], tree["bin"], tree["left"], tree["right"]))
        self.margin = self.margin + np.array(tree["value"])[route(nodes, self.bins)]
        self.slopes = self.at = None

    def loss(self) -> float:
        total = self.w.sum()
        return float((self.w * (np.logaddexp(0, self.margin) - self.y * self.margin)).sum() / total) if total else math.inf


def _rounds(train: _Written | _Held, held_out: _Written | _Held | None, sizes: Sequence[int], growth: Growth) -> tuple[list[dict], list[float]]:
    """All trees that were grown, and the validation loss after each."""
    trees, losses, best = [], [], 0
    varied = [k for k, n in enumerate(sizes) if n > 1] or [0]
    for k in range(growth.rounds):
        rng = np.random.default_rng([growth.seed, k])
        count = max(1, math.ceil(growth.colsample * len(varied)))
        used = sorted(int(f) for f in rng.choice(varied, count, replace=False))
        passes = partial(train.histograms, used=used, bag=(growth.seed, k // growth.bagging_every))
        tree = finished(grow(passes, used, growth, train.ahead(growth)), used, growth)
        trees.append(tree)
        if held_out is not None:
            held_out.move(tree)
            losses.append(held_out.loss())
            best = k if losses[k] < losses[best] else best
            if k - best >= growth.patience:
                break
        if k + 1 < growth.rounds:
            train.move(tree)
    return trees, losses


def _rounds_in_one_task(
    blocks: DataFrame, held_out: DataFrame | None, sizes: Sequence[int], growth: Growth
) -> tuple[list[dict], list[float]]:
    """``_rounds`` over blocks that fit the memory of one task."""
    both, validated = blocks.withColumn("held_out", F.lit(False)), held_out is not None
    if validated:
        both = both.unionByName(held_out.withColumn("held_out", F.lit(True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[bool, list[tuple]] = {False: [], True: []}
        for batch in batches:
            for kind, block in zip(batch.column("held_out").to_pylist(), _read(batch)):
                parts[kind].append(block)
        batch = block = None  # their buffers are copied next
        train = _Held(parts.pop(False), sizes, growth)
        other = _Held(parts.pop(True), sizes, growth) if validated else None
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(_rounds(train, other, sizes, growth))])], names=["fitted"])

    trees, losses = json.loads(both.coalesce(1).mapInArrow(run, "fitted string").first().fitted)
    return trees, losses


def fit_trees(train: DataFrame, growth: Growth = Growth(), features: str = "features", validation: DataFrame | None = None) -> dict:
    """The fitted ensemble as plain values: ``base``, ``edges``, ``trees`` and ``losses``.

    ``train`` and ``validation`` have ``label``, ``weight`` and a vector of features.  With a
    validation set the trees up to its least loss are kept, and growing ends once ``patience``
    rounds in a row bring no better one.
    """
    edges = bin_edges(train, features, growth.max_bins, growth.quantile_error)
    if not edges:
        raise ValueError("there are no rows to learn from")
    weight = F.col(WEIGHT) if WEIGHT in train.columns else F.lit(1.0)
    share = train.agg(F.sum(weight * F.col(LABEL)) / F.sum(weight)).first()[0]
    share = min(max(share, 1e-6), 1 - 1e-6)
    base = math.log(share / (1 - share))
    sizes = [len(e) + 1 for e in edges]
    written = {"train": _Written(train.sparkSession, "train", sizes, growth)}
    if validation is not None:
        written["validation"] = _Written(train.sparkSession, "validation", sizes, growth)
    try:
        for name, df in (("train", train), ("validation", validation)):
            if name in written:
                written[name].write(_blocks(df, features, edges, base))
        blocks, held_out = written["train"], written.get("validation")
        rows = sum(w.blocks.agg(F.sum("n")).first()[0] or 0 for w in written.values())
        if rows * len(sizes) <= ONE_TASK_VALUES:
            trees, losses = _rounds_in_one_task(blocks.blocks, held_out and held_out.blocks, sizes, growth)
        else:
            trees, losses = _rounds(blocks, held_out, sizes, growth)
    finally:
        for w in written.values():
            w.store.close()
    best = min(range(len(losses)), key=losses.__getitem__) if losses else len(trees)
    kept = trees[: best + 1]
    for tree in kept:
        tree["threshold"] = [edges[f][b] if f >= 0 else 0.0 for f, b in zip(tree["feature"], tree["bin"])]
    return {"base": base, "width": len(edges), "trees": kept, "losses": losses}


def _walked(tree: dict[str, list]) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Depth, features, thresholds, children (left and right of each node in turn) and values; leaves lead to themselves."""
    feature = np.array(tree["feature"])
    own, depths = np.arange(len(feature)), np.zeros(len(feature), int)
    children = np.column_stack([np.where(feature < 0, own, tree[side]) for side in ("left", "right")])
    for k in own[feature >= 0]:  # parents come before their children
        depths[children[k]] = depths[k] + 1
    return int(depths.max()), np.maximum(feature, 0), np.array(tree["threshold"], float), children.ravel(), np.array(tree["value"], float)


def margins(base: float, trees: list[tuple], x: pa.Array) -> pa.Array:
    """Log odds of every row; a NaN goes right as any large value does."""
    there = x.is_valid().to_numpy(zero_copy_only=False)
    out = np.full(len(x), float(base))
    if there.any():
        n = int(there.sum())
        values = np.ascontiguousarray(x.flatten().to_numpy(zero_copy_only=False).reshape(n, -1).T).ravel()
        rows, total = np.arange(n), np.full(n, float(base))
        for depth, feature, threshold, children, value in trees:
            at = np.zeros(n, np.int64)
            for _ in range(depth):
                right = ~(values.take(feature.take(at) * n + rows) <= threshold.take(at))
                at = children.take(2 * at + right)
            total += value.take(at)
        out[there] = total
    return pa.array(out, mask=~there)


class BoostedTrees(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted ensemble as a pipeline stage: features in, probability out."""

    featuresCol = Param(Params._dummy(), "featuresCol", "vector of features", TypeConverters.toString)
    probabilityCol = Param(Params._dummy(), "probabilityCol", "probabilities of both classes", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "the likelier class", TypeConverters.toString)
    ensemble = Param(Params._dummy(), "ensemble", "base, trees and losses as JSON", TypeConverters.toString)

    def __init__(self, ensemble: dict | None = None, prefix: str = ""):
        super().__init__()
        self._set(
            featuresCol=f"{prefix}features", probabilityCol=f"{prefix}probability", predictionCol=f"{prefix}prediction",
            ensemble=json.dumps(ensemble or {"base": 0.0, "width": 0, "trees": [], "losses": []}),
        )

    @property
    def fitted(self) -> dict:
        return json.loads(self.getOrDefault(self.ensemble))

    @property
    def getNumTrees(self) -> int:
        return len(self.fitted["trees"])

    @property
    def featureImportances(self) -> DenseVector:
        """Share of every feature in the gain of all splits."""
        held = self.fitted
        gain = np.zeros(held["width"])
        for tree in held["trees"]:
            for f, g in zip(tree["feature"], tree["gain"]):
                if f >= 0:
                    gain[f] += g
        return DenseVector(gain / gain.sum() if gain.sum() else gain)

    def _transform(self, df: DataFrame) -> DataFrame:
        held = self.fitted
        base, trees = held["base"], [_walked(t) for t in held["trees"]]

        def margin(x: pa.Array) -> pa.Array:
            return margins(base, trees, x)

        p = 1 / (1 + F.exp(-F.col("_margin")))
        probability, prediction = self.getOrDefault(self.probabilityCol), self.getOrDefault(self.predictionCol)
        out = df.withColumn("_x", vector_to_array(self.getOrDefault(self.featuresCol))).withColumn("_margin", F.arrow_udf(margin, "double")("_x"))
        return out.withColumns({
            probability: array_to_vector(F.array(1 - p, p)), prediction: F.when(p >= 0.5, 1.0).otherwise(0.0),
        }).drop("_margin", "_x")
