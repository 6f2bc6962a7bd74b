"""A random forest of full depth, grown and scored on Spark.

Fit. Features are binned once (thresholds from a bounded sample: the rows with the
smallest key hashes) and written as a compact table. A row's weight in a tree is a
Poisson draw from the hash of its key, so bagging needs no copy of the rows and is
the same in any partitioning. While a node holds more than ``subtreeRows`` rows, trees
grow level by level: tasks add up histograms per (tree, node), Spark sums them, and one
small group per node picks its split. Then every row is sent once per tree to the node
it has come to, and each node's subtree is finished in one task, in arrays. Labels are
rounded to a fixed-point number chosen so that all sums are exact; therefore trees do
not depend on the order of rows, on partitions or on where growth by levels ends.

The model is a table of nodes: ``tree``, ``node`` (the root is 1, the children of i are
2i and 2i + 1), ``feature`` and ``bin`` of the split (feature -1: a leaf), ``value``,
``gain``, ``weight``. It is saved as Parquet beside Spark ML metadata and is a
stage of a ``PipelineModel`` like any other.

Score. Trees become flat arrays: one 64-bit entry per node packs the left child, the
feature and the bin. A batch of rows is binned once and walks each tree level by level,
without the rows that have come to a leaf. A model of up to ``BLOCK_BYTES`` is broadcast.
A larger one does not pass through the driver: only its upper splits do (nodes of more than
``subtreeRows``), by which rows and nodes are dealt to cells, the subtrees below. A task holds
the nodes of one cell at a time and lets that cell's rows walk them; the values come back
by row and are added in the order of the trees.

Rows without a usable label (null, NaN, infinite) are no training rows. A NaN feature
counts as larger than any number, a null one as 0.0. Equal keys get equal weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktrips.session import scratch_path, ship_package

_PACKED = "h binary, bins binary, y binary"
NODE_SCHEMA = "tree int, node bigint, feature int, bin int, value double, gain double, weight double"
#: Rows that the thresholds are taken from: as many as Spark ML takes, at least.
SAMPLE_ROWS = 1 << 16
#: Bytes of histograms that a task may hold while trees grow by levels.
HISTOGRAM_BYTES = 1 << 28
#: Bytes of flat trees that are broadcast; larger models are scored cell by cell.
BLOCK_BYTES = 1 << 25
#: Rows whose values are added up together, and nodes in one value of a cell.
CHUNK_BITS, PACK_NODES = 12, 1 << 11
#: Rows that walk a tree together.
WALK_ROWS = 1 << 14
#: Binned rows in one record of the table that trees grow from, and rows that a task counts or deals together.
PACK_ROWS, COUNT_ROWS = 1 << 8, 1 << 16
_U = np.uint64


# --- bins and weights ---------------------------------------------------------

def thresholds_of(values: np.ndarray, max_bins: int) -> list[float]:
    """Cuts between bins: midpoints of the distinct values, or of even shares of the sample."""
    v, n = np.unique(values[np.isfinite(values)], return_counts=True)
    if len(v) <= 1:
        return []
    cut = (v[:-1] + v[1:]) / 2
    cut = np.where(cut < v[1:], cut, v[:-1])  # neighbours in floating point
    if len(v) > max_bins:
        upto = np.cumsum(n)[:-1]
        wanted = np.arange(1, max_bins) * n.sum() / max_bins
        cut = cut[np.unique(np.minimum(np.searchsorted(upto, wanted), len(cut) - 1))]
    return cut.tolist()


def binned(columns: list[np.ndarray], thresholds: list[list[float]]) -> np.ndarray:
    """The bin of each value, a column per feature: how many cuts lie below it."""
    kind = np.uint8 if max(map(len, thresholds), default=0) < 256 else np.uint16
    return np.stack([np.searchsorted(np.array(t), c, side="left").astype(kind) for c, t in zip(columns, thresholds)], axis=1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])


def bag_weights(hashes: np.ndarray, tree: int, seed: int, bootstrap: bool) -> np.ndarray:
    """How often each row is in the tree's bag: Poisson of mean 1, by its hash."""
    if not bootstrap:
        return np.ones(len(hashes))
    salt = mixed(np.array([(seed & 0xFFFFFFFF) << 32 | tree], _U))[0]
    u = (mixed(hashes ^ salt) >> _U(11)).astype(float) * 2.0 ** -53
    out = np.zeros(len(u), np.uint8)
    for p in _POISSON[:4]:
        out += u >= p
    far = np.flatnonzero(out == 4)
    out[far] = np.searchsorted(_POISSON, u[far], side="right")
    return out.astype(float)


# --- growth -------------------------------------------------------------------

def _gains(weight, total, whole_weight, whole):
    """What the split after each position explains, where both sides hold rows."""
    rest = whole_weight - weight
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where((weight > 0) & (rest > 0), total * total / weight + (whole - total) ** 2 / rest, -np.inf)


def _worth(gain: np.ndarray, weight: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Whether a split explains more than the node's mean does, beyond rounding."""
    alone = total * total / weight
    return gain > alone + 1e-12 * np.maximum(alone, 1.0)


def grow(bins: np.ndarray, label: np.ndarray, weight: np.ndarray, root: int, max_depth: int, least: int) -> dict[str, np.ndarray]:
    """The subtree below ``root``, level by level. Each feature keeps the rows in order
    of (node, bin); of each run of one bin only the sums (weight and, as the imaginary
    part, label sum) go on. Sums are of whole numbers, so exact in any order."""
    columns = np.ascontiguousarray(bins.T)
    features, total = len(columns), label * weight
    both = weight + 1j * total
    order = [np.argsort(c, kind="stable").astype(np.int32) for c in columns]
    ids, begin = np.array([root], np.int64), np.array([0])
    out = []
    while len(ids):
        first = order[0]
        m = len(first)
        size = np.diff(np.append(begin, m))
        node = np.repeat(np.arange(len(ids), dtype=np.int32), size)
        whole, own = np.add.reduceat(both[first], begin), label[first]
        w, s = whole.real, whole.imag
        mixed_labels = np.minimum.reduceat(own, begin) < np.maximum.reduceat(own, begin)
        best, best_feature, best_bin = np.full(len(ids), -np.inf), np.full(len(ids), -1), np.zeros(len(ids), np.int64)
        deep = int(ids[0]).bit_length() - 1 >= max_depth
        begins = np.zeros(m, bool)
        begins[begin] = True
        for f in range(features if mixed_labels.any() and not deep else 0):
            o = order[f]
            b = columns[f][o]
            run = begins.copy()
            run[1:] |= b[1:] != b[:-1]
            run = np.flatnonzero(run)
            if len(run) == len(ids):
                continue  # one bin in each node
            sums = np.add.reduceat(both[o], run) if len(run) < m else both[o]
            of = node[run]
            at = np.searchsorted(run, begin)
            upto = np.cumsum(sums)
            upto -= (upto[at] - sums[at])[of]
            inner = np.flatnonzero(of[1:] == of[:-1])
            of, upto = of[inner], upto[inner]
            gain = _gains(upto.real, upto.imag, w[of], s[of])
            if least > 1:
                gain[(upto.real < least) | (w[of] - upto.real < least)] = -np.inf
            starts = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            have = of[starts]
            most = np.maximum.reduceat(gain, starts)
            better = most > best[have]
            # the first of the best runs of each node
            top = np.flatnonzero(gain == np.repeat(most, np.diff(np.append(starts, len(of)))))
            top = top[np.append(True, of[top[1:]] != of[top[:-1]])]
            have, top = have[better], top[better]
            best[have], best_feature[have], best_bin[have] = most[better], f, b[run[inner[top]]]
        splits = mixed_labels & (best_feature >= 0) & _worth(best, w, s)
        out.append((ids, np.where(splits, best_feature, -1), np.where(splits, best_bin, 0), s / w, np.where(splits, best - s * s / w, 0.0), w))
        if not splits.any():
            break
        # the rows of nodes that split go to child 2k or 2k + 1 of the k-th such node
        place = np.cumsum(splits) - 1
        on = splits[node]
        rows, of = first[on], node[on]
        right = columns.ravel()[best_feature[of] * len(label) + rows] > best_bin[of]
        n = 2 * int(splits.sum())
        child = np.empty(len(label), np.uint16 if n <= 1 << 16 else np.int64)  # 16 bits are sorted by radix
        child[rows] = 2 * place[of] + right
        count = np.bincount(child[rows], minlength=n)
        for f in range(features):
            o = order[f][on]
            order[f] = o[np.argsort(child[o], kind="stable")]
        begin = np.cumsum(count) - count
        ids = (2 * np.repeat(ids[splits], 2) + np.tile([0, 1], int(splits.sum()))).astype(np.int64)
    return dict(zip(("node", "feature", "bin", "value", "gain", "weight"), map(np.concatenate, zip(*out))))


class Top:
    """The upper part of the trees: per tree its split nodes, while they grow by levels or of a fitted model."""

    def __init__(self, trees: int):
        self.splits: list[dict[int, tuple[int, int]]] = [{} for _ in range(trees)]
        self.leaves: list[set[int]] = [set() for _ in range(trees)]
        self._sorted: dict[int, tuple] = {}

    def _arrays(self, tree: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids, features and bins of a tree's splits, by id, and the places of their children, left and right in
        turn (-1: no split); splits are only ever added."""
        splits = self.splits[tree]
        if tree not in self._sorted or len(self._sorted[tree][0]) != len(splits):
            ids = np.array(sorted(splits), np.int64)
            children = (2 * ids[:, None] + np.arange(2)).ravel()
            place = np.minimum(np.searchsorted(ids, children), len(ids) - 1)
            self._sorted[tree] = ids, *(np.array([splits[i][k] for i in ids.tolist()]) for k in (0, 1)), np.where(ids[place] == children, place, -1)
        return self._sorted[tree]

    def cell_of(self, tree: int, node: np.ndarray) -> np.ndarray:
        """The first node on the way from the root to each node that is no split of the upper part; the node itself for those that are."""
        ids = self._arrays(tree)[0]
        at, above = np.ones(len(node), np.int64), np.zeros(len(node), np.int64)
        rest = node >> 1
        while rest.any():
            above += rest > 0
            rest = rest >> 1
        moving = np.flatnonzero(above > 0)
        while len(moving) and len(ids):
            place = np.minimum(np.searchsorted(ids, at[moving]), len(ids) - 1)
            moving = moving[(ids[place] == at[moving]) & (above[moving] > 0)]
            above[moving] -= 1
            at[moving] = node[moving] >> above[moving]
        return at

    def node_of(self, tree: int, bins: np.ndarray) -> np.ndarray:
        """The node each row has come to."""
        at = np.ones(len(bins), np.int64)
        if not self.splits[tree]:
            return at
        ids, feature, cut, children = self._arrays(tree)
        moving, place = (np.arange(len(bins)), np.zeros(len(bins), np.int64)) if ids[0] == 1 else (np.zeros(0, np.int64),) * 2
        flat, features = bins.ravel(), bins.shape[1]
        while len(moving):
            right = flat[moving * features + feature[place]] > cut[place]
            at[moving] = 2 * ids[place] + right
            place = children[2 * place + right]
            inner = place >= 0
            moving, place = moving[inner], place[inner]
        return at


def histograms(rows: DataFrame, top: Top, active: list[tuple[int, int]], features: int, bins: int, seed: int, bootstrap: bool) -> DataFrame:
    """``(tree, node, feature, bin, w, s)``: weights and label sums of the active nodes."""
    wanted: dict[int, list[int]] = {}
    for tree, node in active:
        wanted.setdefault(tree, []).append(node)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {tree: np.zeros((2, len(nodes) * features * bins)) for tree, nodes in wanted.items()}
        for hashes, b, y in _unpacked(batches, features):
            for tree, nodes in wanted.items():
                ids = np.array(sorted(nodes), np.int64)
                w = bag_weights(hashes, tree, seed, bootstrap)
                bag = np.flatnonzero(w > 0)
                rows = b[bag]
                at = top.node_of(tree, rows)
                place = np.minimum(np.searchsorted(ids, at), len(ids) - 1)
                own = ids[place] == at
                place, rows, w, y_own = place[own], rows[own], w[bag][own], y[bag][own]
                total = w * y_own
                for f in range(features):
                    cell = (place * features + f) * bins + rows[:, f]
                    for k, values in enumerate((w, total)):
                        sums[tree][k] += np.bincount(cell, values, minlength=sums[tree].shape[1])
        for tree, (w, s) in sums.items():
            ids, full = np.array(sorted(wanted[tree]), np.int64), np.flatnonzero(w)
            columns = [pa.array(np.full(len(full), tree, np.int32)), pa.array(ids[full // (features * bins)]), pa.array((full // bins % features).astype(np.int32)),
                       pa.array((full % bins).astype(np.int32)), pa.array(w[full]), pa.array(s[full])]
            yield pa.RecordBatch.from_arrays(columns, ["tree", "node", "feature", "bin", "w", "s"])

    found = rows.mapInArrow(count, "tree int, node bigint, feature int, bin int, w double, s double")
    return found.groupBy("tree", "node", "feature", "bin").agg(F.sum("w").alias("w"), F.sum("s").alias("s"))


def best_splits(sums: DataFrame, least: int) -> DataFrame:
    """Per (tree, node) its best split as a node row, and the weight of its left side."""

    def choose(table: pa.Table) -> pa.Table:
        feature, cut, w, s = (table.column(c).to_numpy() for c in ("feature", "bin", "w", "s"))
        by = np.lexsort((cut, feature))
        feature, cut, w, s = feature[by], cut[by], w[by], s[by]
        begin = np.flatnonzero(np.append(True, feature[1:] != feature[:-1]))
        size = np.diff(np.append(begin, len(w)))
        whole_w, whole_s = w[:size[0]].sum(), s[:size[0]].sum()
        cw, cs = np.cumsum(w), np.cumsum(s)
        cw, cs = cw - np.repeat(cw[begin] - w[begin], size), cs - np.repeat(cs[begin] - s[begin], size)
        gain = _gains(cw, cs, whole_w, whole_s)
        gain[(cw < least) | (whole_w - cw < least)] = -np.inf
        at = int(np.argmax(gain))
        splits = bool(_worth(gain[at:at + 1], whole_w, whole_s)[0])
        row = {"tree": table["tree"][0].as_py(), "node": table["node"][0].as_py(), "feature": int(feature[at]) if splits else -1, "bin": int(cut[at]) if splits else 0,
               "value": whole_s / whole_w, "gain": float(gain[at] - whole_s ** 2 / whole_w) if splits else 0.0, "weight": whole_w, "left": float(cw[at])}
        return pa.Table.from_pylist([row], schema=_arrow_schema(left=True))

    return sums.groupBy("tree", "node").applyInArrow(choose, NODE_SCHEMA + ", left double")


def _arrow_schema(left: bool = False) -> pa.Schema:
    fields = [("tree", pa.int32()), ("node", pa.int64()), ("feature", pa.int32()), ("bin", pa.int32()), ("value", pa.float64()), ("gain", pa.float64()), ("weight", pa.float64())]
    return pa.schema(fields + [("left", pa.float64())] * left)


def _kind_of(size: int, values: int) -> type:
    """The type of the bins by the bytes of so many of them."""
    return np.uint8 if size == values else np.uint16


def _unpacked(batches: Iterator[pa.RecordBatch], features: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hashes, bins and labels of packed rows, about ``COUNT_ROWS`` at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, COUNT_ROWS // PACK_ROWS):
            h, b, y = (b"".join(batch.column(c).slice(start, COUNT_ROWS // PACK_ROWS).to_pylist()) for c in ("h", "bins", "y"))
            label = np.frombuffer(y, float)
            yield np.frombuffer(h, _U), np.frombuffer(b, _kind_of(len(b), len(label) * features)).reshape(-1, features), label


# --- parameters, estimator, model -----------------------------------------------

class _ForestParams(Params):
    featureCols = Param(Params._dummy(), "featureCols", "feature columns, in order", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction column", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "row key that bagging hashes (empty: all features and the label)", TypeConverters.toString)
    numTrees = Param(Params._dummy(), "numTrees", "trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree at most", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature at most", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "weight of a node at least", TypeConverters.toInt)
    bootstrap = Param(Params._dummy(), "bootstrap", "whether rows are bagged", TypeConverters.toBoolean)
    seed = Param(Params._dummy(), "seed", "seed of the bagging", TypeConverters.toInt)
    subtreeRows = Param(Params._dummy(), "subtreeRows", "rows of a node whose subtree one task finishes, at most", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(labelCol="label", predictionCol="prediction", keyCol="", numTrees=100, maxDepth=30, maxBins=256, minInstancesPerNode=1,
                         bootstrap=True, seed=42, subtreeRows=100_000)


class ForestRegressor(Estimator, _ForestParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits a ``ForestModel`` on rows with feature, label and key columns."""

    @keyword_only
    def __init__(self, *, featureCols=None, labelCol="label", predictionCol="prediction", keyCol="", numTrees=100, maxDepth=30, maxBins=256,
                 minInstancesPerNode=1, bootstrap=True, seed=42, subtreeRows=100_000):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ForestModel":
        get = self.getOrDefault
        spark, names = df.sparkSession, get("featureCols")
        ship_package(spark)
        keyed = get("keyCol") and get("keyCol") in df.columns
        label = F.col(get("labelCol")).cast("double")
        rows = df.select(F.xxhash64(F.lit(get("seed")), *([F.col(get("keyCol"))] if keyed else [F.col(c) for c in [*names, get("labelCol")]])).alias("h"),
                         label.alias("y"), *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"f{i}") for i, c in enumerate(names)])
        rows = rows.where(F.col("y").isNotNull() & ~F.isnan("y") & (F.abs("y") < float("inf")))
        seen = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs("y")).alias("most")).first()
        if not seen.n:
            raise ValueError("no training rows with a label")
        thresholds = self._thresholds(rows, seen.n, len(names))
        # labels as whole numbers: the sum over all rows (and their weights) stays below 2^53, so it is exact
        shift = max(-40, min(40, 50 - math.ceil(math.log2(max(seen.most, 1.0))) - math.ceil(math.log2(seen.n + 1))))
        table = self._binned(rows, thresholds, shift)
        nodes, path = self._grow(table, seen.n, len(names)), scratch_path(spark, "forest-nodes")
        nodes.withColumn("value", F.col("value") * 2.0 ** -shift).withColumn("gain", F.col("gain") * 4.0 ** -shift).write.parquet(path)
        model = ForestModel(thresholds=thresholds, nodes=spark.read.schema(NODE_SCHEMA).parquet(path))
        return self._copyValues(model)

    def _thresholds(self, rows: DataFrame, n: int, features: int) -> list[list[float]]:
        """From the rows of the smallest hashes: about ``SAMPLE_ROWS``, or ``maxBins`` squared."""
        bins = self.getOrDefault("maxBins")
        share = min(1.0, 1.05 * max(SAMPLE_ROWS, bins * bins) / n)
        sample = rows if share >= 1 else rows.where(F.col("h") < int(-2 ** 63 + share * 2.0 ** 64))
        values = sample.select(*[f"f{i}" for i in range(features)]).toPandas()
        return [thresholds_of(values[c].to_numpy(float), bins) for c in values.columns]

    @staticmethod
    def _binned(rows: DataFrame, thresholds: list[list[float]], shift: int) -> DataFrame:
        def bin_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    bins = binned([batch.column(f"f{i}").to_numpy(zero_copy_only=False) for i in range(len(thresholds))], thresholds)
                    label = np.rint(batch.column("y").to_numpy(zero_copy_only=False) * 2.0 ** shift)
                    ends = np.append(np.arange(0, batch.num_rows, PACK_ROWS), batch.num_rows)
                    yield pa.RecordBatch.from_arrays([_packed(x, ends) for x in (batch.column("h").to_numpy(zero_copy_only=False), np.ascontiguousarray(bins), label)], ["h", "bins", "y"])

        path = scratch_path(rows.sparkSession, "forest-rows")
        rows.mapInArrow(bin_rows, _PACKED).write.parquet(path)
        return rows.sparkSession.read.schema(_PACKED).parquet(path)

    def _grow(self, table: DataFrame, n: int, features: int) -> DataFrame:
        get = self.getOrDefault
        trees, seed, bootstrap, least, depth = (get(c) for c in ("numTrees", "seed", "bootstrap", "minInstancesPerNode", "maxDepth"))
        spark, bins = table.sparkSession, max(2, get("maxBins"))
        top, done = Top(trees), []
        large = [(tree, 1) for tree in range(trees)] if n > get("subtreeRows") else []
        small = 0 if large else trees
        at_once = max(1, HISTOGRAM_BYTES // (16 * features * bins))
        while large:
            following = []
            for i in range(0, len(large), at_once):
                found = best_splits(histograms(table, top, large[i:i + at_once], features, bins, seed, bootstrap), least).collect()  # a row per node
                for row in found:
                    level = row.node.bit_length() - 1
                    done.append(tuple(row)[:-1] if row.feature >= 0 and level < depth else (row.tree, row.node, -1, 0, row.value, 0.0, row.weight))
                    if row.feature < 0 or level >= depth:
                        top.leaves[row.tree].add(row.node)
                        continue
                    top.splits[row.tree][row.node] = row.feature, row.bin
                    for child, weight in ((2 * row.node, row.left), (2 * row.node + 1, row.weight - row.left)):
                        if weight > get("subtreeRows"):
                            following.append((row.tree, child))
                        else:
                            small += 1
            large = following
        shared = spark.sparkContext.broadcast(top)

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for hashes, b, y in _unpacked(batches, features):
                for tree in range(trees):
                    w = bag_weights(hashes, tree, seed, bootstrap)
                    bag = np.flatnonzero(w > 0)
                    node = shared.value.node_of(tree, b[bag])
                    if shared.value.leaves[tree]:
                        ended = np.array(sorted(shared.value.leaves[tree]), np.int64)
                        goes_on = ~np.isin(node, ended)
                        bag, node = bag[goes_on], node[goes_on]
                    if len(bag):
                        by = np.argsort(node, kind="stable")
                        own, node = bag[by], node[by]
                        ends = _starts(node)
                        first = node[ends[:-1]]
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), tree, np.int32)), pa.array(first), *(_packed(x, ends) for x in (b[own], y[own], w[own]))],
                                                         ["tree", "node", "bins", "y", "w"])

        def finish(group: pa.Table) -> pa.Table:
            bins, y, w = (b"".join(group.column(c).to_pylist()) for c in ("bins", "y", "w"))
            label = np.frombuffer(y, float)
            found = grow(np.frombuffer(bins, _kind_of(len(bins), len(label) * features)).reshape(-1, features), label, np.frombuffer(w, float),
                         group.column("node")[0].as_py(), depth, least)
            columns = {"tree": np.full(len(found["node"]), group.column("tree")[0].as_py(), np.int32), **found}
            return pa.table({f.name: pa.array(columns[f.name]).cast(f.type) for f in _arrow_schema()}, schema=_arrow_schema())

        # a task per few subtrees: the work is in the tasks, not in the bytes that adaptive merging goes by
        parts = max(1, min(small, max(4 * spark.sparkContext.defaultParallelism, small * get("subtreeRows") // 2_000_000)))
        dealt = table.mapInArrow(deal, "tree int, node bigint, bins binary, y binary, w binary").repartition(parts, "tree", "node")
        below = dealt.groupBy("tree", "node").applyInArrow(finish, NODE_SCHEMA)
        return below.unionAll(spark.createDataFrame(done, NODE_SCHEMA)) if done else below


class Flat:
    """Trees as arrays: ``entries[i]`` packs the left child's place, the feature and the
    bin of node i (the right child follows the left one); a leaf points to itself."""

    def __init__(self, tree: np.ndarray, node: np.ndarray, feature: np.ndarray, cut: np.ndarray, value: np.ndarray):
        by = np.lexsort((node, tree))
        tree, node, feature, cut, self.value = tree[by], node[by], feature[by], cut[by], value[by]
        self.roots = np.flatnonzero(np.append(True, tree[1:] != tree[:-1])) if len(tree) else np.zeros(0, np.int64)
        entries = []
        for a, b in zip(self.roots, np.append(self.roots[1:], len(tree))):
            inner = feature[a:b] >= 0
            left = np.where(inner, np.searchsorted(node[a:b], 2 * node[a:b]), np.arange(b - a)).astype(np.int64)
            entries.append(left << 32 | np.where(inner, feature[a:b], 0).astype(np.int64) << 16 | np.where(inner, cut[a:b], 0xFFFF).astype(np.int64))
        self.entries = np.concatenate(entries) if entries else np.zeros(0, np.int64)

    def total(self, bins: np.ndarray) -> np.ndarray:
        """The sum of the trees' values for each row."""
        out = np.zeros(len(bins))
        flat, features = np.ascontiguousarray(bins).ravel(), bins.shape[1]
        ends = np.append(self.roots[1:], len(self.entries))
        for start in range(0, len(bins), WALK_ROWS):
            rows = np.arange(start, min(len(bins), start + WALK_ROWS))
            for a, b in zip(self.roots, ends):
                entries, value = self.entries[a:b], self.value[a:b]
                at, moving = np.zeros(len(rows), np.int64), rows
                while len(moving):
                    e = entries[at]
                    inner = (e & 0xFFFF) != 0xFFFF
                    if not inner.all():
                        out[moving[~inner]] += value[at[~inner]]
                        moving, e = moving[inner], e[inner]
                    at = (e >> 32) + (flat[moving * features + (e >> 16 & 0xFFFF)] > (e & 0xFFFF))
        return out


def _total_of(shared, thresholds: list[list[float]]):
    """The sum of a block's trees as a vectorised function of the features."""

    def total(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            yield pd.Series(shared.value.total(binned([c.to_numpy(float) for c in columns], thresholds)))

    return F.pandas_udf(total, "double")


_NODE = np.dtype([("node", "<i8"), ("feature", "<i4"), ("bin", "<i4"), ("value", "<f8")])
_DEALT = "tree int, cell bigint, kind int, chunk bigint, data binary, bins binary"
_WALKED = "tree int, chunk bigint, data binary, total binary"


def _packed(array: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The array's bytes as binary values that begin after ``ends[i]`` items and end with ``ends[i + 1]``."""
    width = array.nbytes // max(1, len(array))
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(array).tobytes())])


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    changes = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.concatenate([[0], np.flatnonzero(changes) + 1, [len(columns[0])]])


def _deal_nodes(shared):
    """Nodes, packed by the cell they lie in; the splits of the upper part are left out."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, node, feature, cut, value = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("tree", "node", "feature", "bin", "value"))
            cell = np.zeros(len(node), np.int64)
            for t in np.unique(tree).tolist():
                own = tree == t
                cell[own] = shared.value.cell_of(t, node[own])
                upper = own & np.isin(node, shared.value._arrays(t)[0])
                cell[upper] = 0
            by = np.lexsort((cell, tree))
            by = by[cell[by] > 0]
            if not len(by):
                continue
            tree, cell, data = tree[by], cell[by], np.empty(len(by), _NODE)
            data["node"], data["feature"], data["bin"], data["value"] = node[by], feature[by], cut[by], value[by]
            ends = np.unique(np.concatenate([_starts(tree, cell), np.arange(0, len(by), PACK_NODES)]))
            first, zero = ends[:-1], np.zeros(len(ends) - 1, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(tree[first].astype(np.int32)), pa.array(cell[first]), pa.array(zero.astype(np.int32)), pa.array(zero), _packed(data, ends),
                                              _packed(np.zeros(0, np.uint8), zero[:1].repeat(len(ends)))], ["tree", "cell", "kind", "chunk", "data", "bins"])

    return deal


def _deal_rows(shared, thresholds: list[list[float]], trees: int):
    """The binned rows, once per tree, packed by their cell and chunk."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, *columns = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            bins, chunk, place = binned(columns, thresholds), ids >> CHUNK_BITS, (ids & (1 << CHUNK_BITS) - 1).astype(np.uint16)
            for tree in range(trees):
                cell = shared.value.node_of(tree, bins)
                by = np.lexsort((chunk, cell))
                ends = _starts(cell[by], chunk[by])
                first = by[ends[:-1]]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(first), tree, np.int32)), pa.array(cell[first]), pa.array(np.ones(len(first), np.int32)), pa.array(chunk[first]),
                                                  _packed(place[by], ends), _packed(bins[by], ends)], ["tree", "cell", "kind", "chunk", "data", "bins"])

    return deal


def _walk_cells(thresholds: list[list[float]]):
    """Rows walk the nodes of their cell. Records come in the order of (tree, cell, kind), so the nodes of a cell come before its rows."""
    kind_of_bins, features = np.uint8 if max(map(len, thresholds), default=0) < 256 else np.uint16, len(thresholds)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, nodes, flat = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            tree, cell, kind, chunk = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("tree", "cell", "kind", "chunk"))
            ends = _starts(tree, cell, kind).tolist()
            for a, b in zip(ends, ends[1:]):
                if held != (tree[a], cell[a]):
                    held, nodes, flat = (tree[a], cell[a]), [], None
                data = batch.column("data").slice(a, b - a)
                if kind[a] == 0:
                    nodes += data.to_pylist()
                    continue
                if flat is None:
                    n = np.frombuffer(b"".join(nodes), _NODE)
                    flat, nodes = Flat(np.zeros(len(n), np.int32), *(n[c] for c in ("node", "feature", "bin", "value"))), []
                places = data.to_pylist()
                total = flat.total(np.frombuffer(b"".join(batch.column("bins").slice(a, b - a).to_pylist()), kind_of_bins).reshape(-1, features))
                upto = np.cumsum([0] + [len(p) // 2 for p in places])
                yield pa.RecordBatch.from_arrays([pa.array(tree[a:b]), pa.array(chunk[a:b]), pa.array(places, pa.binary()), _packed(total, upto)], ["tree", "chunk", "data", "total"])

    return walk


def _add_trees(group: pa.Table) -> pa.Table:
    """The totals of one chunk's rows, added in the order of the trees."""
    total, there = np.zeros(1 << CHUNK_BITS), np.zeros(1 << CHUNK_BITS, bool)
    places, totals = group.column("data").to_pylist(), group.column("total").to_pylist()
    for i in np.argsort(group.column("tree").to_numpy(), kind="stable").tolist():
        place = np.frombuffer(places[i], np.uint16)
        total[place] += np.frombuffer(totals[i], float)
        there[place] = True
    place = np.flatnonzero(there)
    return pa.table({_ROW: (group.column("chunk")[0].as_py() << CHUNK_BITS) + place, "_total": total[place]})


_ROW = "_forest_row"


class ForestModel(Model, _ForestParams, MLWritable, MLReadable):
    """Fitted trees; ``transform`` adds the mean of their values as the prediction."""

    def __init__(self, thresholds: list[list[float]] = (), nodes: DataFrame | None = None):
        super().__init__()
        self.thresholds, self.nodes, self._blocks, self._large = [list(t) for t in thresholds], nodes, None, None

    @property
    def featureImportances(self) -> DenseVector:
        """Share of each feature in what the splits explain: per tree, then the mean."""
        gains = {(r.tree, r.feature): r.gain for r in self.nodes.where("feature >= 0").groupBy("tree", "feature").agg(F.sum("gain").alias("gain")).collect()}
        table = np.zeros((self.getOrDefault("numTrees"), len(self.thresholds)))
        for (tree, feature), gain in gains.items():
            table[tree, feature] = gain
        whole = table.sum(axis=1, keepdims=True)
        mean = np.divide(table, whole, out=np.zeros_like(table), where=whole > 0).mean(axis=0)
        return Vectors.dense(mean / mean.sum() if mean.sum() else mean)

    def _tree_groups(self) -> list[list[int]]:
        """Trees that fit into ``BLOCK_BYTES`` together, or one tree."""
        sizes = sorted((r.tree, r.n) for r in self.nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).collect())
        groups, held = [], 0
        for tree, n in sizes:
            if not groups or held + 16 * n > BLOCK_BYTES:
                groups.append([])
                held = 0
            groups[-1].append(tree)
            held += 16 * n
        self._large = len(groups) > 1 or held > BLOCK_BYTES
        return groups

    def _flat_blocks(self) -> list:
        """Broadcasts of the trees, each of ``BLOCK_BYTES`` or one tree at most."""
        if self._blocks is None:
            self._blocks = []
            for trees in self._tree_groups():
                part = self.nodes.where(F.col("tree").between(trees[0], trees[-1])).select("tree", "node", "feature", "bin", "value").toArrow()
                flat = Flat(*(part.column(c).to_numpy() for c in ("tree", "node", "feature", "bin", "value")))
                self._blocks.append(self.nodes.sparkSession.sparkContext.broadcast(flat))
        return self._blocks

    def _top(self) -> Top:
        """The splits of nodes that weigh more than ``subtreeRows``: some thousand rows' worth each, so few."""
        top = Top(self.getOrDefault("numTrees"))
        for r in self.nodes.where(F.col("feature") >= 0).where(F.col("weight") > self.getOrDefault("subtreeRows")).select("tree", "node", "feature", "bin").collect():
            top.splits[r.tree][r.node] = r.feature, r.bin
        return top

    def _by_cells(self, df: DataFrame, inputs: list) -> DataFrame:
        """``df`` with ``_total``; rows and nodes meet in the cells."""
        spark, path, trees = df.sparkSession, scratch_path(df.sparkSession, "forest-scores"), self.getOrDefault("numTrees")
        df.withColumn(_ROW, F.monotonically_increasing_id()).write.parquet(path)
        rows = spark.read.parquet(path)
        shared = spark.sparkContext.broadcast(self._top())
        nodes = self.nodes.select("tree", "node", "feature", "bin", "value").mapInArrow(_deal_nodes(shared), _DEALT)
        named = [c.alias(f"f{i}") for i, c in enumerate(inputs)]
        dealt = nodes.unionAll(rows.select(_ROW, *named).mapInArrow(_deal_rows(shared, self.thresholds, trees), _DEALT))
        # a task's share of nodes and rows, in about 32 MB; more tasks than cells are of no use, but do no harm
        size = _NODE.itemsize * self.nodes.count() + (2 + len(inputs)) * trees * rows.count()
        parts = max(4 * spark.sparkContext.defaultParallelism, size >> 25)
        walked = dealt.repartition(parts, "tree", "cell").sortWithinPartitions("tree", "cell", "kind").mapInArrow(_walk_cells(self.thresholds), _WALKED)
        totals = walked.groupBy("chunk").applyInArrow(_add_trees, f"{_ROW} bigint, _total double")
        return rows.join(totals, _ROW)

    def _transform(self, df: DataFrame) -> DataFrame:
        names, out, trees = self.getOrDefault("featureCols"), self.getOrDefault("predictionCol"), self.getOrDefault("numTrees")
        ship_package(df.sparkSession)
        kept = df.columns
        inputs = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in names]
        if self._large is None:
            self._tree_groups()
        if self._large:
            df = self._by_cells(df, inputs)
        else:
            blocks = self._flat_blocks()
            df = df.select(*[F.col(f"`{c}`") for c in kept], (_total_of(blocks[0], self.thresholds)(*inputs) if blocks else F.lit(0.0)).alias("_total"))
        return df.select(*[F.col(f"`{c}`") for c in kept if c != out], (F.col("_total") / trees).alias(out))

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()


class _ForestWriter(MLWriter):
    def __init__(self, instance: ForestModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata={"thresholds": self.instance.thresholds})
        self.instance.nodes.write.parquet(f"{path}/data")


class _ForestReader(MLReader):
    def load(self, path: str) -> ForestModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = ForestModel(thresholds=metadata["thresholds"], nodes=spark.read.schema(NODE_SCHEMA).parquet(f"{path}/data"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
