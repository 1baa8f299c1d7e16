"""One regression tree grown level by level from the counts of bucket numbers (M3).

The rows stay in blocks of numpy arrays on the executors.  For every level each task
counts the rows of the open nodes by bucket (number, sum and sum of squares of the
residuals); what reaches the driver is one small table of counts a task, whatever the
number of rows.  The driver adds the tables and chooses the splits.  Residuals are whole
numbers of grid steps, so the sums are exact and do not depend on the blocks.

The choices are those of Spark ML's regression tree with as many bins as values: the
features of a node are drawn by Spark's own sampler, a split is the midpoint of two
neighbouring bucket numbers that occur in the round's rows, the gain is the fall of the
variance, and the result is an ordinary ``DecisionTreeRegressionModel``.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
from pyspark.ml.regression import DecisionTreeRegressionModel
from pyspark.sql import SparkSession

#: (node, its features) of the nodes to be split next.
Open = list[tuple[int, list[int]]]
#: By open node one table [feature, (rows, sum, squares), bucket].
Counts = list[np.ndarray]


@dataclass
class Node:
    rows: int
    total: int  # sum of the residuals, in grid steps
    squares: int
    depth: int = 0
    gain: float = 0.0
    feature: int = 0
    threshold: float = 0.0
    children: tuple[int, int] | None = None


@dataclass
class Tree:
    """Nodes by place, the root first and parents before children."""

    nodes: list[Node]
    grid: float

    def stats(self, node: Node) -> tuple[float, float, float]:
        return float(node.rows), node.total / self.grid, node.squares / (self.grid * self.grid)

    def value(self, node: Node) -> float:
        rows, total, _ = self.stats(node)
        return total / rows if rows else 0.0

    def impurity(self, node: Node) -> float:
        return float(variance(*(np.float64(x) for x in self.stats(node))))

    def places(self, buckets: np.ndarray) -> np.ndarray:
        """Place of the node each row falls to; ``buckets`` has a line for each feature."""
        kind = np.min_scalar_type(len(self.nodes))
        at = np.zeros(buckets.shape[1], kind)
        for place, node in enumerate(self.nodes):
            if node.children:  # neighbours, the left one first
                right = buckets[node.feature] > math.floor(node.threshold)
                at = np.where(at == place, right.view(np.uint8) + kind.type(node.children[0]), at)
        return at

    def predict(self, buckets: np.ndarray) -> np.ndarray:
        return np.array([self.value(n) for n in self.nodes])[self.places(buckets)]


def variance(rows, total, squares):
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(rows == 0, 0.0, (squares - (total * total) / rows) / rows)


def count(buckets: np.ndarray, residuals: np.ndarray, at: np.ndarray, taken: np.ndarray, open_nodes: Open, bins: int) -> Counts:
    """Counts of one block; ``at`` is the node of each row, ``taken`` whether it is in the round."""
    out = []
    for place, features in open_nodes:
        mine = np.flatnonzero((at == place) & taken)
        r = residuals[mine]
        found = np.empty((len(features), 3, bins), np.int64)
        for i, f in enumerate(features):
            b = buckets[f][mine].astype(np.intp)
            # whole numbers far below 2^53 within a block
            found[i] = [np.bincount(b, minlength=bins), np.bincount(b, r, bins), np.bincount(b, r * r, bins)]
        out.append(found)
    return out


def added(parts: list[Counts]) -> Counts:
    return [sum(tables[1:], tables[0]) for tables in zip(*parts)]


def split(tree: Tree, place: int, features: list[int], found: np.ndarray, present: np.ndarray, least: int) -> None:
    """Splits the node at ``place`` where that lowers the variance; ``present``: [feature,
    bucket], whether the bucket number occurs in the round."""
    node, grid = tree.nodes[place], tree.grid
    scale = np.array([[1.0], [grid], [grid * grid]])
    parent = np.array([[float(node.rows)], [float(node.total)], [float(node.squares)]]) / scale
    impurity = tree.impurity(node)
    best = None
    for f, table in zip(features, found):
        values = np.flatnonzero(present[f])
        if len(values) < 2:
            continue
        sums = table[:, values].cumsum(axis=1)[:, :-1]
        left = sums / scale
        right = parent - left
        gain = impurity - left[0] / parent[0] * variance(*left) - right[0] / parent[0] * variance(*right)
        gain[(left[0] < least) | (right[0] < least) | (gain < 0)] = -sys.float_info.max
        i = int(gain.argmax())
        if best is None or gain[i] > best[0]:
            best = float(gain[i]), f, (float(values[i]) + float(values[i + 1])) / 2, [int(x) for x in sums[:, i]]
    if best is None or best[0] <= 0:
        return
    node.gain, node.feature, node.threshold, low = best
    node.children = len(tree.nodes), len(tree.nodes) + 1
    tree.nodes += [Node(*low, node.depth + 1), Node(node.rows - low[0], node.total - low[1], node.squares - low[2], node.depth + 1)]


def subset_size(strategy: str, width: int) -> int:
    """Features looked at in a node, by Spark ML's names."""
    named = {"all": width, "auto": width, "sqrt": math.ceil(math.sqrt(width)), "log2": max(1, math.ceil(math.log2(width))), "onethird": math.ceil(width / 3.0)}
    if strategy in named:
        return named[strategy]
    return min(int(strategy), width) if strategy.isdigit() else math.ceil(float(strategy) * width)


#: Nodes whose features are drawn before the tree is grown.
DRAWN_AHEAD = 15


def drawn(spark: SparkSession, seed: int, width: int, size: int, depth: int) -> Iterator[list[int]]:
    """The features of one node after another, drawn as Spark's forest does with this seed."""
    if size == width:
        return repeat(list(range(width)))
    jvm = spark._jvm
    rng, numbers, to_scala = jvm.java.util.Random(seed), jvm.java.util.stream.IntStream, jvm.scala.jdk.javaapi.CollectionConverters
    sampling, kind = jvm.org.apache.spark.util.random.SamplingUtils, jvm.scala.reflect.ClassTag.Int()

    def draw() -> list[int]:
        return list(sampling.reservoirSampleAndCount(to_scala.asScala(numbers.range(0, width).iterator()), size, rng.nextLong(), kind)._1())

    ahead = [draw() for _ in range(min(DRAWN_AHEAD, 2 ** max(depth, 1) - 1))]
    return chain(ahead, iter(draw, None))


def grow(draws: Iterator[list[int]], counts: Callable[[Tree | None, Open], tuple[np.ndarray, Counts]], grid: float, depth: int, least: int) -> Tree | None:
    """A tree of at most ``depth`` levels of splits, ``least`` rows a leaf.  ``counts`` gives
    (presence, counts) of the open nodes of the tree so far; None ends the growing, and
    there is no tree."""
    tree, todo = Tree([], grid), [0]
    present = None
    while todo:
        opened = [(place, next(draws)) for place in todo]
        got = counts(tree, opened)
        if got is None:
            return None
        seen, found = got
        if not tree.nodes:
            present = seen
            tree.nodes.append(Node(*(int(x) for x in found[0][0].sum(axis=1))))
            if not tree.nodes[0].rows:
                raise ValueError("no rows in the sample of a round")
            if not depth:
                break
        todo = []
        for (place, features), table in zip(opened, found):
            split(tree, place, features, table, present, least)
            node = tree.nodes[place]
            # the last one put down is drawn first, as in Spark's stack of open nodes
            for child in node.children or ():
                if node.depth + 1 < depth and abs(tree.impurity(tree.nodes[child])) >= sys.float_info.epsilon:
                    todo.insert(0, child)
    return tree


def spark_tree(spark: SparkSession, tree: Tree, width: int) -> DecisionTreeRegressionModel:
    """Spark ML's model of the tree; two leaves of one value are one leaf."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    ml = jvm.org.apache.spark.ml
    leaf, inner, cut, double = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, gateway.jvm.double
    model, calculator = ml.regression.DecisionTreeRegressionModel, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator

    def made(place: int):
        """(Java node, value where it is a leaf)"""
        node = tree.nodes[place]
        sides = [made(c) for c in node.children or ()]
        stats = gateway.new_array(double, 3)
        stats[0], stats[1], stats[2] = tree.stats(node)
        about = calculator(stats, node.rows)
        value, impurity = tree.value(node), tree.impurity(node)
        if not sides or sides[0][1] is not None and sides[0][1] == sides[1][1]:
            value = sides[0][1] if sides else value
            return leaf(value, impurity, about), value
        return inner(value, impurity, node.gain, sides[0][0], sides[1][0], cut(node.feature, node.threshold), about), None

    return DecisionTreeRegressionModel(model(ml.util.Identifiable.randomUID("dtr"), made(0)[0], width))
