"""The forest: a tree against a naive grower, partitionings, growth by levels, scoring, persistence."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktrips.operators import forest
from sparktrips.operators.forest import ForestModel, ForestRegressor
from sparktrips.session import scratch_path

NAMES = ["a", "b", "c"]


def table(spark, n=600, seed=0, parts=3):
    draw = np.random.default_rng(seed)
    x = np.stack([draw.integers(0, 30, n) / 2, draw.normal(size=n).round(1), draw.integers(0, 2, n)], axis=1)
    y = 3 * x[:, 0] - np.abs(x[:, 1]) * 4 + 2 * x[:, 2] + draw.normal(size=n).round(2)
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "k bigint, a double, b double, c double, label double").repartition(parts)


def nodes_of(model):
    return sorted(map(tuple, model.nodes.collect()))


def naive(x, y, depth=0, most=30):
    """A regression tree by trying every cut, as nested (feature, cut, left, right) or a mean."""
    if depth < most and len(set(y)) > 1:
        best = None
        for f in range(x.shape[1]):
            v = np.unique(x[:, f])
            for low, high in zip(v, v[1:]):
                left = x[:, f] <= low
                a, b = y[left], y[~left]
                gain = a.sum() ** 2 / len(a) + b.sum() ** 2 / len(b)
                if best is None or gain > best[0] + 1e-9 * abs(gain):
                    best = gain, f, (low + high) / 2, left
        if best is not None and best[0] > y.sum() ** 2 / len(y) * (1 + 1e-12):
            _, f, cut, left = best
            return f, cut, naive(x[left], y[left], depth + 1, most), naive(x[~left], y[~left], depth + 1, most)
    return y.mean()


def walk(tree, row):
    while isinstance(tree, tuple):
        f, cut, left, right = tree
        tree = left if row[f] <= cut else right
    return tree


def test_one_tree_equals_a_naive_grower(spark):
    df = table(spark, 200)
    rows = df.collect()
    x, y = np.array([[r[n] for n in NAMES] for r in rows]), np.array([r["label"] for r in rows])
    for depth in (1, 3, 30):
        model = ForestRegressor(featureCols=NAMES, keyCol="k", numTrees=1, maxDepth=depth, bootstrap=False).fit(df)
        got = {r["k"]: r["prediction"] for r in model.transform(df).collect()}
        tree = naive(x, y, most=depth)
        assert [got[r["k"]] for r in rows] == pytest.approx([walk(tree, v) for v in x], abs=1e-5)


def test_the_same_trees_in_any_partitioning_and_by_levels(spark):
    fit = lambda df, **kw: nodes_of(ForestRegressor(featureCols=NAMES, keyCol="k", numTrees=4, seed=5, **kw).fit(df))
    one = fit(table(spark, parts=1))
    assert fit(table(spark, parts=6)) == one
    # nodes of more than 40 rows grow by levels over the tasks, the rest in one task each
    by_levels = fit(table(spark, parts=4), subtreeRows=40)
    assert [n[:4] for n in by_levels] == [n[:4] for n in one]
    assert np.array([n[4:] for n in by_levels]) == pytest.approx(np.array([n[4:] for n in one]), rel=1e-9, abs=1e-6)
    assert fit(table(spark, parts=4), subtreeRows=1, maxDepth=3) == fit(table(spark, parts=2), maxDepth=3)


def test_histograms_in_several_rounds_give_the_same_trees(spark, monkeypatch):
    fit = lambda: [n[:4] for n in nodes_of(ForestRegressor(featureCols=NAMES, keyCol="k", numTrees=3, subtreeRows=30).fit(table(spark)))]
    whole = fit()
    monkeypatch.setattr(forest, "HISTOGRAM_BYTES", 16 * 3 * 256 * 2)  # two nodes at a time
    assert fit() == whole


def test_weights_of_a_bag():
    h = forest.mixed(np.arange(200_000, dtype=np.uint64))
    w = np.stack([forest.bag_weights(h, t, 42, True) for t in range(3)])
    assert w.mean(axis=1) == pytest.approx([1, 1, 1], abs=0.01) and w.var(axis=1) == pytest.approx([1, 1, 1], abs=0.02)
    assert abs(np.corrcoef(w)[0, 1]) < 0.01
    assert (forest.bag_weights(h, 0, 42, False) == 1).all()


def test_bins():
    assert forest.thresholds_of(np.array([3.0, 1.0, 1.0, np.nan]), 8) == [2.0]
    assert forest.thresholds_of(np.array([5.0]), 8) == [] == forest.thresholds_of(np.array([]), 8)
    near = np.array([1.0, np.nextafter(1.0, 2)])
    cut = forest.thresholds_of(near, 8)
    assert forest.binned([near], [cut])[:, 0].tolist() == [0, 1]
    many = forest.thresholds_of(np.arange(10_000.0), 16)
    assert len(many) == 15 and np.bincount(forest.binned([np.arange(10_000.0)], [many])[:, 0]).min() > 600
    assert forest.binned([np.array([np.nan, 1e9, -1e9])], [[0.0, 1.0]])[:, 0].tolist() == [2, 2, 0]


def test_scores_in_blocks_equal_scores_at_once(spark, monkeypatch):
    df = table(spark)
    model = ForestRegressor(featureCols=NAMES, keyCol="k", numTrees=7).fit(df)
    at_once = {r["k"]: r["prediction"] for r in model.transform(df).collect()}
    monkeypatch.setattr(forest, "BLOCK_BYTES", 16 * 1500)
    model._blocks = None
    assert len(model._flat_blocks()) > 2
    assert {r["k"]: r["prediction"] for r in model.transform(df).collect()} == pytest.approx(at_once, rel=1e-12)


def test_save_load_and_importances(spark):
    df = table(spark)
    model = ForestRegressor(featureCols=NAMES, keyCol="k", numTrees=3, maxDepth=6, labelCol="label").fit(df)
    path = scratch_path(spark, "forest")
    model.write().overwrite().save(path)
    again = ForestModel.load(path)
    assert nodes_of(again) == nodes_of(model) and again.thresholds == model.thresholds and again.uid == model.uid
    assert [r["prediction"] for r in again.transform(df).orderBy("k").collect()] == [r["prediction"] for r in model.transform(df).orderBy("k").collect()]
    shares = model.featureImportances.toArray()
    assert shares.sum() == pytest.approx(1) and shares.argmax() == 0


def test_awkward_rows(spark):
    df = table(spark, 100).withColumn("label", F.when(F.col("k") % 10 == 0, None).when(F.col("k") % 10 == 1, float("nan")).otherwise(F.col("label")))
    df = df.withColumn("b", F.when(F.col("k") % 3 == 0, None).when(F.col("k") % 7 == 0, float("nan")).otherwise(F.col("b"))).withColumn("node", F.lit("x"))
    model = ForestRegressor(featureCols=NAMES, keyCol="k", numTrees=2).fit(df)
    got = model.transform(df)
    assert got.count() == 100 and got.where("prediction is null or isnan(prediction)").count() == 0 and "node" in got.columns
    with pytest.raises(ValueError):
        ForestRegressor(featureCols=NAMES, keyCol="k").fit(df.where("false"))
    constant = ForestRegressor(featureCols=NAMES, numTrees=2).fit(df.withColumn("label", F.lit(4.5)))
    assert constant.nodes.count() == 2 and constant.transform(df.limit(1)).first()["prediction"] == pytest.approx(4.5)
    assert model.transform(df.where("false")).count() == 0


def test_a_large_model_is_scored_by_cells_without_the_driver(spark, monkeypatch):
    df = table(spark, 3000, parts=5).withColumn("k", F.col("k") + 7)
    model = ForestRegressor(featureCols=NAMES, keyCol="k", numTrees=5, subtreeRows=200).fit(df)
    odd = df.withColumn("b", F.when(F.col("k") % 3 == 0, None).when(F.col("k") % 7 == 0, float("nan")).otherwise(F.col("b"))).unionAll(df)
    at_once = sorted((r["k"], r["prediction"]) for r in model.transform(odd).collect())
    monkeypatch.setattr(forest, "BLOCK_BYTES", 1000)
    monkeypatch.setattr(forest, "PACK_NODES", 10)
    monkeypatch.setattr(ForestModel, "_flat_blocks", lambda self: pytest.fail("the trees went through the driver"))
    for subtree_rows in (200, 50, 1_000_000):
        again = ForestModel(thresholds=model.thresholds, nodes=model.nodes)
        model._copyValues(again)
        again._set(subtreeRows=subtree_rows)
        assert sorted((r["k"], r["prediction"]) for r in again.transform(odd).collect()) == at_once
    assert again.transform(odd.where("false")).count() == 0


def test_trees_grow_from_records_of_many_rows(spark):
    rows = table(spark, parts=1).selectExpr("k as h", "label as y", "a as f0", "b as f1")
    packed = ForestRegressor._binned(rows, [[1.0, 2.0], [0.0]], 10)
    assert packed.count() == -(-600 // forest.PACK_ROWS)
    (h, b, y), = forest._unpacked(iter(packed.toArrow().to_batches()), 2)
    assert sorted(h.tolist()) == list(range(600)) and b.shape == (600, 2) and len(y) == 600


def test_rows_of_one_bin_are_added_up_once(monkeypatch):
    """Gains are worked out per run of a bin, not per row: few for features of few values."""
    draw = np.random.default_rng(2)
    bins, label = draw.integers(0, 3, (5000, 4)).astype(np.uint8), np.rint(draw.normal(size=5000) * 9)
    seen, gains = [], forest._gains
    monkeypatch.setattr(forest, "_gains", lambda w, *a: seen.append(len(w)) or gains(w, *a))
    nodes = forest.grow(bins, label, draw.poisson(1, 5000) + 1.0, 1, 30, 1)
    assert max(seen) < 200 and (nodes["feature"] >= 0).sum() > 40


def test_weights_of_a_bag_are_poisson_quantiles():
    h = forest.mixed(np.arange(50_000, dtype=np.uint64))
    salt = forest.mixed(np.array([42 << 32 | 3], np.uint64))[0]
    u = (forest.mixed(h ^ salt) >> np.uint64(11)).astype(float) * 2.0 ** -53
    assert (forest.bag_weights(h, 3, 42, True) == np.searchsorted(forest._POISSON, u, side="right")).all()
