"""Random forests grown in tasks, a tree at a time, for fits whose trees the driver cannot hold.

Spark's forest keeps all growing trees on the driver and sends a dense block of bin statistics
for every node and partition. Here the rows are binned once and written as a compact table; a
task reads it, draws its tree's bootstrap and grows the tree level by level. The candidate
splits, the gain, the order among equal gains and the rules that end a branch are those of
``RandomForestRegressor``, whose parameters are taken; only the draws are others. Trees go from
the task to files and from files to the tasks that predict: the driver has the split points.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.files import filesystem
from hourgrid.session import ready, scratch_path

SPLIT_ROWS = 10_000  # of the sample that split points come from, as in Spark
NODES_AT_ONCE = 1 << 14  # whose bins a task holds
EPSILON = np.finfo(float).eps  # an impurity below is none
ROWS = "bins binary, label binary"
TREE = "tree int, feature binary, bin binary, left binary, value binary"
KINDS = {"feature": np.uint8, "bin": np.uint8, "left": "<i4", "value": "<f8"}


def can_grow(forest) -> bool:
    """Whether ``forest`` is a regression forest without the options that are not built here."""
    return (
        isinstance(forest, RandomForestRegressor)
        and forest.getFeatureSubsetStrategy() == "all"
        and forest.getMaxBins() <= 256
        and not (forest.isDefined(forest.weightCol) and forest.getWeightCol())
        and forest.getMinWeightFractionPerNode() == 0
    )


def points(values: np.ndarray, most: int) -> np.ndarray:
    """Split points of one feature: between all its values, or about evenly many rows apart."""
    found, count = np.unique(values, return_counts=True)
    between = (found[:-1] + found[1:]) / 2
    if len(between) <= most:
        return between
    step = len(values) / (most + 1)
    passed, target, out = np.cumsum(count), step, []
    for i in range(1, len(found)):
        if abs(passed[i - 1] - target) < abs(passed[i] - target):
            out.append(between[i - 1])
            target += step
    return np.array(out)


def yes_or_no(rows: DataFrame, features: str) -> set[int]:
    """The features that are marked as two categories, as one-hot digits are."""
    attrs = rows.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    return {a["idx"] for a in attrs.get("binary", [])}


def split_points(rows: DataFrame, features: str, count: int, forest: RandomForestRegressor) -> list[np.ndarray]:
    """Split points of every feature, from a sample of fixed size; yes-or-no features have one."""
    binary = yes_or_no(rows, features)
    wanted = max(forest.getMaxBins() ** 2, SPLIT_ROWS)
    sample = rows if count <= wanted else rows.sample(wanted / count, forest.getSeed())
    values = np.array([r[0].toArray() for r in sample.select(features).collect()])
    most = min(forest.getMaxBins(), count) - 1
    return [np.array([0.5]) if k in binary else points(values[:, k], most) for k in range(values.shape[1])]


def binned(values: np.ndarray, splits: list[np.ndarray]) -> np.ndarray:
    """The bin of every value, a row a feature; a value equal to a split point is left of it."""
    return np.stack([np.searchsorted(s, values[:, k], "left").astype(np.uint8) for k, s in enumerate(splits)])


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _binned_rows(splits: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = np.ascontiguousarray(binned(_matrix(batch.column(0)), splits).T)
                y = batch.column(1).to_numpy(zero_copy_only=False).astype("<f8")
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], names=["bins", "label"])

    return run


def _table(uri: str, columns: list[str]) -> Iterator[dict]:
    """The rows of a table in the shared folder, files by name."""
    fs, path = filesystem(uri)
    from pyarrow.fs import FileSelector

    for info in sorted(fs.get_file_info(FileSelector(path)), key=lambda f: f.path):
        if info.base_name.startswith("part-"):
            with fs.open_input_file(info.path) as f:
                for batch in pq.ParquetFile(f).iter_batches(batch_size=16, columns=columns):
                    yield from batch.to_pylist()


@lru_cache(maxsize=1)
def _rows_of(uri: str, features: int) -> tuple[np.ndarray, np.ndarray]:
    bins, label = [], []
    for row in _table(uri, ["bins", "label"]):
        bins.append(np.frombuffer(row["bins"], np.uint8).reshape(-1, features).T)
        label.append(np.frombuffer(row["label"], "<f8"))
    return np.concatenate(bins, axis=1), np.concatenate(label)


@lru_cache(maxsize=1)
def _trees_of(uri: str) -> list[tuple[np.ndarray, ...]]:
    rows = {r["tree"]: tuple(np.frombuffer(r[k], kind) for k, kind in KINDS.items()) for r in _table(uri, ["tree", *KINDS])}
    return [rows[k] for k in sorted(rows)]


def drawn(count: int, tree: int, seed: int, rate: float, bootstrap: bool) -> np.ndarray:
    """How often each row is in a tree's sample."""
    random = np.random.default_rng([seed & (2**64 - 1), tree])
    if bootstrap:
        return random.poisson(rate, count)
    return (random.random(count) < rate).astype(np.int64) if rate < 1 else np.ones(count, np.int64)


def _impurity(n: np.ndarray, s: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (q - s * s / n) / n


def _best(x: np.ndarray, bins: list[int], two: set[int], rows: np.ndarray, at: np.ndarray, sums: list[np.ndarray], node: list[np.ndarray], least: int, gain_least: float):
    """For nodes 0, 1, ... the best split: gain (0 for none), feature, bin, and the sums left of it.

    ``at`` is the node of each row, ``sums`` each row's weight, label and square, ``node`` their
    totals by node and its impurity. Of equal gains the first feature's first split wins; ``two``
    are features of two categories, of which Spark takes the one with the lower mean first.
    """
    n, s, q, impurity = node
    k = len(n)
    gain, feature, bin_ = np.zeros(k), np.zeros(k, np.uint8), np.zeros(k, np.uint8)
    left = [np.zeros(k) for _ in range(3)]
    for f, width in enumerate(bins):
        if width < 2:
            continue
        key = at * width + x[f, rows]
        ln, ls, lq = (np.bincount(key, v, k * width).reshape(k, width).cumsum(axis=1)[:, :-1] for v in sums)
        rn = n[:, None] - ln
        li, ri = _impurity(ln, ls, lq), _impurity(rn, s[:, None] - ls, q[:, None] - lq)
        total = n[:, None]
        a, b = ln / total * li, rn / total * ri
        if f in two:
            turned = ls / ln > (s[:, None] - ls) / rn
            a, b = np.where(turned, b, a), np.where(turned, a, b)
        g = impurity[:, None] - a - b
        g[(ln < least) | (rn < least) | ~(g >= gain_least)] = -np.inf
        b = g.argmax(axis=1)
        own = np.arange(k)
        better = np.flatnonzero(g[own, b] > gain)
        gain[better], feature[better], bin_[better] = g[better, b[better]], f, b[better]
        for to, of in zip(left, (ln, ls, lq)):
            to[better] = of[better, b[better]]
    return gain, feature, bin_, left


def grow_tree(x: np.ndarray, bins: list[int], two: set[int], y: np.ndarray, times: np.ndarray, depth: int, least: int, gain_least: float) -> dict[str, np.ndarray]:
    """Nodes of one tree, level by level: feature and bin of a split, its left child (0 in a leaf;
    the right one follows it) and the value."""
    rows = np.flatnonzero(times).astype(np.int32)
    w = times[rows].astype(float)
    sums = [w, w * y[rows], w * y[rows] * y[rows]]
    at = np.zeros(len(rows), np.int64)
    totals = [np.array([v.sum()]) for v in sums]
    with np.errstate(divide="ignore", invalid="ignore"):
        node = [*totals, _impurity(*totals)]
        value = totals[1] / totals[0] if totals[0][0] else np.zeros(1)
        levels = [{"feature": np.zeros(1, np.uint8), "bin": np.zeros(1, np.uint8), "left": np.zeros(1, np.int32), "value": value}]
        open_, made = np.zeros(1, np.int64), 1  # places of the nodes that may be split in their level
        for level in range(depth):
            if not len(open_) or not len(rows):
                break
            order = np.argsort(at, kind="stable")
            rows, at, sums = rows[order], at[order], [v[order] for v in sums]
            found = []
            for a in range(0, len(open_), NODES_AT_ONCE):
                b = min(len(open_), a + NODES_AT_ONCE)
                i, j = np.searchsorted(at, [a, b])
                found.append(_best(x, bins, two, rows[i:j], at[i:j] - a, [v[i:j] for v in sums], [v[a:b] for v in node], least, gain_least))
            gain, feature, bin_ = (np.concatenate([f[k] for f in found]) for k in range(3))
            left = [np.concatenate([f[3][k] for f in found]) for k in range(3)]
            split = gain > 0
            rank = np.cumsum(split) - 1
            now, place = levels[-1], open_[split]
            now["feature"][place], now["bin"][place], now["left"][place] = feature[split], bin_[split], made + 2 * rank[split]
            # children in pairs; one without impurity stays a leaf
            both = [np.stack([v[split], t[split] - v[split]], 1).ravel() for v, t in zip(left, node)]
            node = [*both, _impurity(*both)]
            size = len(both[0])
            levels.append({"feature": np.zeros(size, np.uint8), "bin": np.zeros(size, np.uint8), "left": np.zeros(size, np.int32), "value": both[1] / both[0]})
            made += size
            open_ = np.flatnonzero(np.abs(node[3]) >= EPSILON)
            new = np.full(size + 1, -1)
            new[open_] = np.arange(len(open_))
            child = np.where(split[at], 2 * rank[at] + (x[feature[at], rows] > bin_[at]), size)
            stay = np.flatnonzero(new[child] >= 0)
            rows, at, sums = rows[stay], new[child[stay]], [v[stay] for v in sums]
            node = [v[open_] for v in node]
    return {k: np.concatenate([v[k] for v in levels]) for k in KINDS}


def _grown(uri: str, bins: list[int], two: set[int], seed: int, rate: float, bootstrap: bool, limits: tuple[int, int, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree in batch.column(0).to_pylist():
                x, y = _rows_of(uri, len(bins))
                nodes = grow_tree(x, bins, two, y, drawn(len(y), tree, seed, rate, bootstrap), *limits)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([tree], pa.int32()), *(pa.array([nodes[k].astype(kind).tobytes()], pa.binary()) for k, kind in KINDS.items())],
                    names=["tree", *KINDS])

    return run


def grow(forest: RandomForestRegressor, rows: DataFrame, count: int) -> GrownForest:
    """``forest`` fitted on ``rows`` (``count`` of them), its trees in files of the shared folder."""
    spark = ready(rows.sparkSession)
    features, label = forest.getFeaturesCol(), forest.getLabelCol()
    splits = split_points(rows, features, count, forest)
    table, trees = scratch_path(spark, "forest-rows"), scratch_path(spark, "forest")
    rows.select(vector_to_array(features), F.col(label).cast("double")).mapInArrow(_binned_rows(splits), ROWS).write.parquet(table)
    limits = forest.getMaxDepth(), forest.getMinInstancesPerNode(), forest.getMinInfoGain()
    run = _grown(table, [len(s) + 1 for s in splits], yes_or_no(rows, features), forest.getSeed(), forest.getSubsamplingRate(), forest.getBootstrap(), limits)
    spark.range(0, forest.getNumTrees(), 1, forest.getNumTrees()).mapInArrow(run, TREE).write.parquet(trees)
    model = GrownForest(trees, splits)
    return model._set(featuresCol=features, predictionCol=forest.getPredictionCol())


def predicted(matrix: np.ndarray, splits: list[np.ndarray], trees: list[tuple[np.ndarray, ...]]) -> np.ndarray:
    """The mean of the trees' values for every row."""
    x = binned(matrix, splits)
    rows, total = np.arange(len(matrix)), np.zeros(len(matrix))
    for feature, bin_, left, value in trees:
        node = np.zeros(len(matrix), np.int32)
        todo = rows[left[node] > 0]
        while len(todo):
            here = node[todo]
            node[todo] = here = left[here] + (x[feature[here], todo] > bin_[here])
            todo = todo[left[here] > 0]
        total += value[node]
    return total / len(trees)


class GrownForest(Model, HasFeaturesCol, HasPredictionCol, MLWritable, MLReadable):
    """A forest whose trees lie in a table of the shared folder, read by the tasks that predict."""

    def __init__(self, trees: str | None = None, splits: list[np.ndarray] | None = None):
        super().__init__()
        self.trees, self.splits = trees, splits

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ready(dataset.sparkSession)
        trees, splits = self.trees, self.splits

        @F.arrow_udf("double")
        def value(features: pa.Array) -> pa.Array:
            if not len(features):
                return pa.array([], pa.float64())
            return pa.array(predicted(_matrix(features), splits, _trees_of(trees)))

        return dataset.withColumn(self.getPredictionCol(), value(vector_to_array(self.getFeaturesCol())))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, forest: GrownForest):
        super().__init__()
        self.forest = forest

    def saveImpl(self, path: str) -> None:
        splits = json.dumps([s.tolist() for s in self.forest.splits])
        DefaultParamsWriter.saveMetadata(self.forest, path, self.sparkSession, extraMetadata={"splits": splits})
        self.sparkSession.read.schema(TREE).parquet(self.forest.trees).write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def load(self, path: str) -> GrownForest:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        forest = GrownForest(f"{path}/trees", [np.array(s) for s in json.loads(metadata["splits"])])
        DefaultParamsReader.getAndSetParams(forest, metadata)
        return forest._resetUid(metadata["uid"])
