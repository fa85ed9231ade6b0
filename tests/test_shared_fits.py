"""Fits of a sweep that share rows and growth, and equal those made alone."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from outcomelab.plans import models
from outcomelab.plans.models import Ready, Spec, fit_pipeline, score
from outcomelab.plans.trees import cut_nodes, fold_saved, node_table, saved

NAMES = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(1500, 5))
    y = (rng.random(1500) < 1 / (1 + np.exp(-x[:, 0] + x[:, 1] * x[:, 2]))).astype(int)
    rows = [(i, *map(float, x[i]), int(y[i])) for i in range(1500)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, e double, y int").repartition(3).localCheckpoint()


def _nodes(df):
    """All fields but a leaf's impurity, which MLlib sets to -1 where it tried to split in vain."""
    inner = F.when(F.col("leftChild") >= 0, F.col("impurity"))
    return sorted(map(repr, df.withColumn("impurity", inner).collect()))


@pytest.mark.parametrize("depth", [1, 3, 6])
def test_cut_forest_is_the_forest_of_that_depth(spark, frame, depth):
    rows = VectorAssembler(inputCols=NAMES, outputCol="x").transform(frame)

    def grown(d):
        return RandomForestClassifier(numTrees=12, maxDepth=d, minInstancesPerNode=5, featureSubsetStrategy="sqrt", seed=0,
                                      featuresCol="x", labelCol="y").fit(rows)

    own, deep = saved(spark, grown(depth)), saved(spark, grown(6))
    assert _nodes(cut_nodes(node_table(spark, deep), depth)) == _nodes(node_table(spark, own))
    cut = fold_saved(spark, deep, 200, depth)
    assert cut.getMaxDepth() == depth and max(t.depth for t in cut.trees) <= depth
    assert _nodes(node_table(spark, saved(spark, cut))) == _nodes(node_table(spark, saved(spark, fold_saved(spark, own, 200))))


def test_shared_fits_equal_fits_alone(frame, monkeypatch):
    specs = [Spec("flat", "rf", {"numTrees": 6, "maxDepth": 2}), Spec("deep", "rf", {"numTrees": 6, "maxDepth": 4}),
             Spec("more", "rf", {"numTrees": 8, "maxDepth": 2}), Spec("few", "gbt", {"maxIter": 3}),
             Spec("rounds", "gbt", {"maxIter": 6}), Spec("lr", "logistic", {"maxIter": 20})]
    asked = {"rows": 0, "rf": 0, "gbt": 0}

    def counted(name, real):
        def run(*args, **more):
            asked[name] += 1
            return real(*args, **more)
        return run

    monkeypatch.setattr(models, "_rows", counted("rows", models._rows))
    monkeypatch.setattr(models, "fit_boosted", counted("gbt", models.fit_boosted))
    monkeypatch.setattr(models, "saved", counted("rf", models.saved))
    ready = Ready(frame, specs)
    together = {s.name: fit_pipeline(ready, NAMES, "y", s, min_split=100) for s in specs}
    assert asked == {"rows": 1, "rf": 2, "gbt": 1}      # before: six, three and two
    assert together["few"].notes["rounds"] == 3 and not together["few"].notes["stopped_early"]
    for s in specs:
        alone = fit_pipeline(frame, NAMES, "y", s, min_split=100)
        got, want = (sorted(map(tuple, score(m, frame, NAMES, "y").collect())) for m in (together[s.name], alone))
        assert got == want, s.name
        assert models.params_of(together[s.name]) == models.params_of(alone) and len(together[s.name].notes) == len(alone.notes)
    ready.release()


def test_a_broken_configuration_does_not_take_its_family_along(frame):
    specs = [Spec("too deep", "rf", {"numTrees": 2, "maxDepth": 99}), Spec("flat", "rf", {"numTrees": 2, "maxDepth": 2})]
    ready = Ready(frame, specs)
    rows = {s.name: models.attempt(ready, frame, NAMES, "y", s, ["x"])[0] for s in specs}
    assert rows["too deep"]["error"] and not rows["flat"]["error"]
    ready.release()


def test_deep_forests_are_counted_by_kept_nodes_and_stay_the_same(spark, frame, monkeypatch):
    asked, real = [], models.RandomForestClassifier

    def seen(**kw):
        asked.append((kw["maxDepth"], kw["cacheNodeIds"]))
        return real(**kw)

    monkeypatch.setattr(models, "RandomForestClassifier", seen)
    ready = Ready(frame, [Spec(f"d{d}", "rf", {"numTrees": 5, "maxDepth": d}) for d in (2, 9)])
    kept = {s.name: fit_pipeline(ready, NAMES, "y", s, min_split=20) for s in ready.specs}
    fit_pipeline(frame, NAMES, "y", ready.specs[0], min_split=20)
    assert asked == [(9, True), (2, False)]
    monkeypatch.setattr(models, "DEEP", 99)      # walking down the trees at each level
    for s in ready.specs:
        walked = fit_pipeline(frame, NAMES, "y", s, min_split=20)
        assert asked.pop() == (s.params["maxDepth"], False)
        a, b = (_nodes(node_table(spark, saved(spark, m.classifier))) for m in (kept[s.name], walked))
        assert a == b and max(t.depth for t in walked.classifier.trees) == min(s.params["maxDepth"], 9)
        assert models.params_of(kept[s.name]) == models.params_of(walked)
    ready.release()
