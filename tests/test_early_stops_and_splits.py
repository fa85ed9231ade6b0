"""Patience stops, the split limit of trees, nets in segments."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from outcomelab.plans.models import Spec, _net, evaluate, experiment, fit_pipeline, params_of, score
from outcomelab.plans.trees import Node, fit_boosted, fold_forest, fold_nodes, node_table, saved, stale


def _frame(spark, n=3000, seed=3, noise=1.0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = (rng.random(n) < 1 / (1 + np.exp(-noise * (2 * x[:, 0] - x[:, 1])))).astype(float)
    rows = [(i, *map(float, x[i]), float(y[i]), i % 10 == 0) for i in range(n)]
    return spark.createDataFrame(rows, "id long, f0 double, f1 double, f2 double, _label double, _valid boolean").repartition(4)


def test_stale_looks_at_all_rounds_of_the_window():
    assert not stale([1.0, 0.9, 0.95, 0.97], 4, 0)          # fewer rounds than the window
    assert stale([1.0, 1.0], 1, 0) and not stale([1.0, 0.9], 1, 0)
    # one weak round is not the end as long as it beats one of the last four
    assert stale([1.0, 0.9, 0.95], 1, 0) and not stale([1.2, 1.0, 0.9, 0.85, 0.95], 4, 0)
    assert stale([0.9, 0.8, 0.8, 0.8, 0.95], 4, 0)
    assert stale([1.0, 0.9999], 1, 1e-3) and not stale([1.0, 0.99], 1, 1e-3)


def test_patience_one_and_four_stop_at_different_rounds(spark):
    data = _frame(spark, 1200, noise=0.7)
    names = ["f0", "f1", "f2"]
    short = fit_boosted(data, names, 60, 50, patience=1, step=0.5)
    long = fit_boosted(data, names, 60, 50, patience=4, step=0.5)
    assert short.stopped and long.stopped and short.rounds < long.rounds < 60
    assert short.losses == pytest.approx(long.losses[:short.rounds], abs=1e-12)   # same rounds until the stop
    for model, patience in ((short, 1), (long, 4)):
        cut = next(i + 1 for i in range(len(long.losses)) if stale(long.losses[:i + 1], patience, 1e-4))
        assert model.rounds == cut


def test_boosting_equals_a_plain_replay(spark):
    """Margins, losses, leaf values and row counts recomputed in NumPy from the recorded splits."""
    data = _frame(spark, 1500)
    names = ["f0", "f1", "f2"]
    model = fit_boosted(data, names, 25, 200)       # crosses a rewrite of the margins
    p = data.toPandas().sort_values("id")
    x, y, held = p[names].to_numpy(), p["_label"].to_numpy(), p["_valid"].to_numpy()
    share = y[~held].mean()
    m = np.full(len(y), math.log(share / (1 - share)))
    assert model.prior == pytest.approx(m[0])

    def leaf_of(node, row):
        while node.feature is not None:
            node = node.left if row[node.feature] <= node.threshold else node.right
        return node

    for tree, loss in zip(model.trees, model.losses):
        own = [leaf_of(tree, r) for r in x]
        prob = 1 / (1 + np.exp(-m))
        move = np.zeros(len(y))
        for leaf in tree.leaves():
            inside = np.array([o is leaf for o in own])
            t = inside & ~held
            assert leaf.rows == t.sum()
            value = (y - prob)[t].sum() / (prob * (1 - prob))[t].sum()
            assert leaf.value() == pytest.approx(value, rel=1e-9)
            move[inside] = value
        m = m + 0.1 * move
        assert loss == pytest.approx(2 * np.mean(np.log1p(np.exp(m[held])) - y[held] * m[held]), rel=1e-9)
        assert all(n.rows >= 200 for n in tree.walk() if n.feature is not None)
        assert sum(n.rows for n in tree.leaves()) == (~held).sum()
    got = model.transform(data).orderBy("id").select("probability", "prediction").collect()   # scored by MLlib
    prob = 1 / (1 + np.exp(-m))
    assert np.allclose([r.probability[1] for r in got], prob, atol=1e-12)
    assert [r.prediction for r in got] == [float(v > 0.5) for v in prob]


def test_fold_of_a_tree():
    deep = Node(0, 0.0, Node(1, 1.0, Node(rows=30, r=3.0, h=5.0), Node(rows=40, r=-1.0, h=8.0)), Node(rows=500, r=9.0, h=90.0))
    deep.fold(100)
    assert deep.rows == 570 and deep.left.feature is None
    assert (deep.left.rows, deep.left.r, deep.left.h) == (70, 2.0, 13.0) and deep.left.value() == 2 / 13
    deep.fold(1000)
    assert deep.feature is None and deep.value() == pytest.approx(11 / 103)
    assert Node().value() == 0.0


def test_boosting_without_held_out_rows_or_without_a_class(spark):
    data = _frame(spark, 300)
    model = fit_boosted(data.withColumn("_valid", F.lit(False)), ["f0"], 3, 10)
    assert model.rounds == 3 and not model.stopped and model.losses == []
    with pytest.raises(ValueError):
        fit_boosted(data.withColumn("_label", F.lit(1.0)), ["f0"], 3, 10)
    with pytest.raises(ValueError):
        fit_boosted(data.limit(0), ["f0"], 3, 10)


def _forest(spark, depth=6, trees=5):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    data = VectorAssembler(inputCols=["f0", "f1", "f2"], outputCol="v").transform(_frame(spark))
    rf = RandomForestClassifier(numTrees=trees, maxDepth=depth, featuresCol="v", labelCol="_label", seed=1)
    return data, rf.fit(data)


def test_folded_forest_is_the_upper_part_of_the_grown_one(spark):
    data, grown = _forest(spark)
    limit = 400
    folded = fold_forest(spark, grown, limit)
    old = {(r.treeID, r.id): r for r in node_table(spark, saved(spark, grown)).collect()}
    new = {(r.treeID, r.id): r for r in node_table(spark, saved(spark, folded)).collect()}
    assert len(new) < len(old) and folded.getNumTrees == grown.getNumTrees

    def compare(tree, a, b):
        was, now = old[tree, a], new[tree, b]
        assert (was.rawCount, was.prediction, was.impurityStats) == (now.rawCount, now.prediction, now.impurityStats)
        if was.leftChild < 0 or was.rawCount < limit:
            assert now.leftChild < 0 and now.rightChild < 0
            return 1
        assert was.split == now.split
        return 1 + compare(tree, was.leftChild, now.leftChild) + compare(tree, was.rightChild, now.rightChild)

    assert sum(compare(t, 0, 0) for t in range(5)) == len(new)
    for t in range(5):
        assert sorted(i for k, i in new if k == t) == list(range(sum(k == t for k, _ in new)))
    assert all(r.rawCount >= limit for r in new.values() if r.leftChild >= 0)
    # scores come from the folded nodes: mean of the leaves' class shares
    rows = data.orderBy("id").limit(50).collect()
    got = {r.id: r.probability[1] for r in folded.transform(data.where("id < 50")).collect()}
    for row in rows:
        shares = []
        for t in range(5):
            n = new[t, 0]
            while n.leftChild >= 0:
                n = new[t, n.leftChild if row.v[n.split.featureIndex] <= n.split.leftCategoriesOrThreshold[0] else n.rightChild]
            shares.append(n.impurityStats[1] / sum(n.impurityStats))
        assert got[row.id] == pytest.approx(np.mean(shares), abs=1e-9)


def test_fold_limits_that_change_nothing_or_everything(spark):
    _, grown = _forest(spark, 4, 3)
    nodes = node_table(spark, saved(spark, grown))
    assert sorted(map(tuple, fold_nodes(nodes, 0).select("treeID", "id", "rawCount", "leftChild").collect())) == sorted(
        map(tuple, nodes.select("treeID", "id", "rawCount", "leftChild").collect()))
    only_roots = fold_nodes(nodes, 10 ** 9).collect()
    assert [(r.id, r.leftChild) for r in only_roots] == [(0, -1)] * 3


def _scaled(spark, n=1200):
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=["f0", "f1", "f2"], outputCol="_scaled").transform(_frame(spark, n))


def test_net_stops_before_its_last_step_and_keeps_the_best_weights(spark):
    rows = _scaled(spark).persist()
    model, notes = _net(rows, 3, [4], 100, segment=5)
    assert notes["stopped_early"] and notes["stop_step"] < 100
    curve = notes["validation_curve"]
    assert len(curve) * 5 == notes["stop_step"] and notes["best_step"] == 5 * (curve.index(max(curve)) + 1)
    hits = model.transform(rows.where("_valid")).agg(F.avg((F.col("prediction") == F.col("_label")).cast("double"))).first()[0]
    assert hits == pytest.approx(max(curve))
    patient, more = _net(rows, 3, [4], 100, segment=5, patience=3)
    assert more["stop_step"] >= notes["stop_step"] and more["validation_curve"][:len(curve)] == pytest.approx(curve)
    full, none = _net(rows.withColumn("_valid", F.lit(False)), 3, [4], 12, segment=5)
    assert none["stop_step"] == 12 and not none["stopped_early"] and none["validation_curve"] == []


def test_ledger_records_the_stops(spark):
    data = _frame(spark, 1500).withColumn("y", F.col("_label") == 1.0).select("id", "f0", "f1", "f2", "y")
    train, dev = data.where("id % 4 != 0"), data.where("id % 4 = 0")
    model = fit_pipeline(train, ["f0", "f1", "f2"], "y", Spec("g", "gbt", {"maxIter": 40}), min_split=100)
    notes = params_of(model)
    assert int(notes["rounds"]) == model.classifier.rounds and notes["stopped_early"] == str(model.classifier.stopped)
    assert evaluate(score(model, dev, ["f0", "f1", "f2"], "y"), "y")["test_roc_auc"] > 0.7
    row = experiment(train, dev, ["f0", "f1"], "y", Spec("n", "mlp", {"hidden": [3], "maxIter": 30}), ["x"])
    assert row["error"] is None and int(row["parameters"]["stop_step"]) <= 30
    row = experiment(train, dev, ["f0", "f1"], "y", Spec("r", "rf", {"numTrees": 4, "maxDepth": 5}), ["x"])
    assert row["error"] is None and row["parameters"]["min_split"] == "500"
