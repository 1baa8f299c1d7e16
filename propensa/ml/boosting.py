"""Boosting of regression trees for a 0/1 label, one Spark ML tree a round (M3).

The fit does not depend on how the rows are partitioned:

* Features are bucket numbers.  The bucket limits are exact quantiles of a sample of
  about ``BIN_ROWS`` training rows, those with the smallest id hashes, so a feature has
  at most ``maxBins`` values, and the tree learner counts them all instead of sampling.
* The rows of a round are those whose hash of (seed, round, id) is below the
  sampling rate.
* The pseudo-residuals are rounded to multiples of 2^-12, so sums of them and of
  their squares are exact in any order.

The rows are brought into blocks of arrays once, with the samples of all rounds; a round is
one small job for each level of its tree (``ml.trees``).

Round 0 is a tree of one leaf, the log-odds of the training rows; every later round is
a tree fitted to the residuals of the log loss, weighted by the step size.  After
each round the loss of the validation rows is taken; boosting ends at the first
round whose loss is not below the worst of the ``patience`` rounds before it by
more than the tolerance.  The rounds done are the model, nothing is fitted twice.

The margins of all rows are written to the checkpoint folder with their blocks every
``CHECKPOINT_ROUNDS`` rounds; the trees grown since are applied in the tasks that need
them, so a lost executor costs reading its blocks again.  The trees form an ordinary ``GBTClassificationModel``, which Spark
saves, loads and applies.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import Bucketizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa.ml.trees import Counts, Open, Tree, added, count, drawn, grow, spark_tree, subset_size

#: Rows (about) that the bucket limits of the features are taken from.
BIN_ROWS = 20_000
CHECKPOINT_ROUNDS = 10
#: Rows of a task, at least.
ROWS_PER_TASK = 20_000
#: Rows of a block of arrays, at least, but for the last of a task.
BLOCK_ROWS = 200_000
#: Steps a unit of the rounded residuals.
GRID = 4096.0
#: Parts of the unit interval a sampling hash falls into.
HASH_PARTS = 1 << 20


def bucket_limits(rows: DataFrame, cols: list[str], bins: int, key: str, n: int, sample_rows: int = BIN_ROWS) -> list[list[float]]:
    """Limits of at most ``bins`` buckets for each column: a value is in the bucket of the
    largest limit that is not above it."""
    sample = rows.where(F.pmod(F.xxhash64(F.col(key), F.lit("bins")), F.lit(max(n, sample_rows))) < sample_rows) if n > sample_rows else rows
    found = sample.approxQuantile([*cols], [i / bins for i in range(1, bins)], 0.0)
    out = []
    for q in found:
        # a quantile is an occurring value; the bucket it opens must have rows below it
        inner = sorted(set(q or []))
        out.append([-math.inf, *inner, math.inf] if inner else [-math.inf, 0.0, math.inf])
    return out


def bucketizer(rows: DataFrame, cols: list[str], outputs: list[str], bins: int, key: str, n: int) -> Bucketizer:
    return Bucketizer(splitsArray=bucket_limits(rows, cols, bins, key, n), inputCols=cols, outputCols=outputs, handleInvalid="keep")


def sampled(key: str, seed: int, turn: int, rate: float) -> Column:
    """Whether a row is in the sample of a round, from its key alone."""
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), F.col(key)), F.lit(HASH_PARTS)) < int(rate * HASH_PARTS)


def residuals(y: np.ndarray, margin: np.ndarray) -> np.ndarray:
    """Negative gradient of 2 log(1 + exp(-2 y margin)), in whole steps of the grid."""
    y = y.astype(float)
    with np.errstate(over="ignore"):
        return np.floor(4 * y / (1 + np.exp(2 * y * margin)) * GRID + 0.5)


def loss(y: np.ndarray, margin: np.ndarray) -> float:
    z = -2.0 * y * margin
    return float((2 * (np.maximum(z, 0.0) + np.log1p(np.exp(-np.abs(z))))).sum())


@dataclass
class Block:
    """Some rows: a line of bucket numbers for each feature, label -1 or 1, whether held
    out, a line of packed bits for each round to come (whether sampled), margin."""

    buckets: np.ndarray
    y: np.ndarray
    held: np.ndarray
    samples: np.ndarray
    margin: np.ndarray

    def ahead(self, since: list[Tree], step: float) -> np.ndarray:
        """The margin after the trees grown since it was written."""
        margin = self.margin
        for tree in since:
            margin = margin + step * tree.predict(self.buckets)
        return margin

    def taken(self, i: int) -> np.ndarray:
        """The rows of the ``i``-th round to come."""
        return ~self.held & np.unpackbits(self.samples[i], count=len(self.y)).view(bool)


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Columns: features (list), y, held, then a boolean for each round."""
    waiting: list[pa.RecordBatch] = []

    def block() -> pa.RecordBatch:
        t = pa.Table.from_batches(waiting).combine_chunks()
        n = t.num_rows
        flags = [np.packbits(c.to_numpy(zero_copy_only=False).astype(bool)) for c in (t.column(i).combine_chunks() for i in range(3, t.num_columns))]
        buckets = t.column(0).combine_chunks().flatten().to_numpy().reshape(n, -1).T.astype("<u2")
        made = [buckets, t.column(1).to_numpy().astype("i1"), t.column(2).to_numpy().astype(bool), np.array(flags, np.uint8)]
        return pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), **{c: pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for c, x in zip(("buckets", "y", "held", "samples"), made)}})

    for batch in batches:
        if batch.num_rows:
            waiting.append(batch)
        if sum(b.num_rows for b in waiting) >= BLOCK_ROWS:
            yield block()
            waiting = []
    if waiting:
        yield block()


def blocks(state: DataFrame, params: dict, key: str, start: float) -> RDD:
    """``state`` (key, features, y, held) as blocks with the first margin."""
    rounds = params["maxIter"]
    rows = state.select(vector_to_array("features").cast("array<int>").alias("features"), F.col("y").cast("int").alias("y"), "held",
                        *[sampled(key, params["seed"], turn, params["subsamplingRate"]).alias(f"s{turn}") for turn in range(1, rounds + 1)])

    def read(r) -> Block:
        line = lambda x, t, lines: np.frombuffer(x, t).reshape(lines, -1) if lines else np.empty((0, 0), t)
        buckets = line(r.buckets, "<u2", len(r.buckets) // (2 * r.n))
        return Block(buckets.astype(np.min_scalar_type(buckets.max())), np.frombuffer(r.y, "i1"), np.frombuffer(r.held, bool), line(r.samples, np.uint8, rounds), np.full(r.n, start))

    return rows.mapInArrow(_to_blocks, "n long, buckets binary, y binary, held binary, samples binary").rdd.map(read)


def stops(losses: list[float], patience: int, tolerance: float) -> bool:
    """Whether the last loss is not below the worst of the ``patience`` before it by more than ``tolerance``."""
    return len(losses) > patience and losses[-1] + tolerance >= max(losses[-patience - 1:-1])


def ensemble(spark: SparkSession, trees: Iterable[DecisionTreeRegressionModel], weights: list[float], features: int,
             like: dict[str, str] | None = None) -> GBTClassificationModel:
    """A classification model of given regression trees and weights; ``like`` has column
    parameters by name (featuresCol, ...)."""
    trees = list(trees)
    gateway, ml = spark.sparkContext._gateway, spark._jvm.org.apache.spark.ml
    jtrees = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    jweights = gateway.new_array(gateway.jvm.double, len(trees))
    for i, t in enumerate(trees):
        jtrees[i], jweights[i] = t._java_obj, float(weights[i])
    uid = ml.util.Identifiable.randomUID("gbtc")
    model = GBTClassificationModel(ml.classification.GBTClassificationModel(uid, jtrees, jweights, features, 2))
    for name, value in (like or {}).items():
        model.set(model.getParam(name), value)
    return model


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model cut to its first tree (round 0) and the ``rounds`` trees after it."""
    spark = SparkSession.getActiveSession()
    like = {p.name: model.getOrDefault(p) for p in model.params if model.isSet(p) and p.name.endswith("Col")}
    return ensemble(spark, model.trees[:rounds + 1], model.treeWeights[:rounds + 1], model.numFeatures, like)


def boost(rows: DataFrame, params: dict, patience: int, tolerance: float, key: str = "clinician_id",
          features: str = "buckets", columns: dict[str, str] | None = None) -> tuple[GBTClassificationModel, list[float]]:
    """(model, validation loss of each round) from ``rows`` with ``key``, ``label`` (0 or 1),
    ``split`` (train or validation) and the vector ``features`` of bucket numbers."""
    spark = rows.sparkSession
    state = rows.select(key, F.col(features).alias("features", metadata={}), (2.0 * F.col("label") - 1).alias("y"), (F.col("split") == "validation").alias("held"))
    counted = {r.held: r for r in state.groupBy("held").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("s")).collect()}
    if False not in counted:
        raise ValueError("no training rows")
    n, train = counted[False].n, state.where(~F.col("held")).limit(1)
    width = train.select("features").first()[0].size
    share = min(max((counted[False].s / n + 1) / 2, 1e-6), 1 - 1e-6)
    start = 0.5 * math.log(share / (1 - share))
    leaf = DecisionTreeRegressor(featuresCol="features", labelCol="start", maxDepth=0)
    first = leaf.fit(train.select("features", F.lit(start).alias("start")))
    # a round is some small jobs: few rows are kept in few tasks
    tasks = -(-sum(r.n for r in counted.values()) // ROWS_PER_TASK)
    base = blocks(state.coalesce(tasks), params, key, start).persist(StorageLevel.MEMORY_AND_DISK)
    base.checkpoint()
    bins = max(base.map(lambda b: int(b.buckets.max())).collect()) + 1
    step, size = params["stepSize"], subset_size(str(params["featureSubsetStrategy"]), width)
    held = counted[True].n if True in counted and patience else 0
    trees: list[Tree] = []
    losses: list[float] = []
    since: list[Tree] = []

    def ended(sums: list[float]) -> bool:
        """Takes the loss of the round before, and tells whether it was the last."""
        if trees and held:
            losses.append(round(math.fsum(sums) / held, 9))
        return bool(held) and stops(losses, patience, tolerance)

    def counts(tree: Tree, opened: Open) -> tuple[np.ndarray, Counts] | None:
        root = not tree.nodes
        found = base.mapPartitions(surveyor(since, step, tree, opened, bins, bool(held) and root)).collect()
        if root and ended([f[0] for f in found]):
            return None
        return np.any([f[1] for f in found], axis=0) if root else None, added([f[2] for f in found])

    made = []
    with ThreadPoolExecutor(1) as beside:  # calls to the JVM that no job waits for
        draws = lambda turn: beside.submit(drawn, spark, params["seed"] + turn, width, size, params["maxDepth"])
        coming = draws(1)
        for turn in range(1, params["maxIter"] + 1):
            draw, coming = coming.result(), draws(turn + 1)
            tree = grow(draw, counts, GRID, params["maxDepth"], params["minInstancesPerNode"])
            if tree is None:
                break
            trees.append(tree)
            made.append(beside.submit(spark_tree, spark, tree, width))
            since = [*since, tree]
            if len(since) == CHECKPOINT_ROUNDS:
                old, base, since = base, base.map(forward(since, step)).persist(StorageLevel.MEMORY_AND_DISK), []
                base.checkpoint()
                base.count()
                old.unpersist()
        else:
            if held:
                ended(base.map(held_loss(since, step)).collect())
        base.unpersist()
        return ensemble(spark, [first, *[m.result() for m in made]], [1.0, *[step] * len(trees)], width, {"featuresCol": features, **(columns or {})}), losses


def surveyor(since: list[Tree], step: float, tree: Tree, opened: Open, bins: int, with_loss: bool) -> Callable:
    """What a task tells of its blocks for a level of a tree: (loss of the held rows,
    bucket numbers that occur in the round, counts of the open nodes); the first two at the root only."""
    root = not tree.nodes

    def survey(parts: Iterable[Block]) -> Iterator[tuple[float, np.ndarray, Counts]]:
        lost, seen, found = 0.0, None, []
        for b in parts:
            margin, taken = b.ahead(since, step), b.taken(len(since))
            found.append(count(b.buckets, residuals(b.y, margin), tree.places(b.buckets), taken, opened, bins))
            if root:
                mine = np.flatnonzero(taken)
                here = np.array([np.bincount(line.take(mine), minlength=bins) > 0 for line in b.buckets])
                seen = here if seen is None else seen | here
            if with_loss:
                lost += loss(b.y[b.held], margin[b.held])
        if found:
            yield lost, seen, added(found)
    return survey


def forward(since: list[Tree], step: float) -> Callable[[Block], Block]:
    return lambda b: replace(b, margin=b.ahead(since, step), samples=b.samples[len(since):])


def held_loss(since: list[Tree], step: float) -> Callable[[Block], float]:
    return lambda b: loss(b.y[b.held], b.ahead(since, step)[b.held])
