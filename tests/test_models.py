"""Models on seeded data with a known signal; ledger and failure capture."""

import numpy as np
from pyspark.sql import functions as F

from outcomelab.plans.models import Spec, evaluate, experiment, fit_pipeline, score, standardize_apply, standardize_fit
from outcomelab.plans.sweep import best_per_label, ledger_frame, union_all


def _signal(spark, n=1500, seed=11):
    rng = np.random.default_rng(seed)
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    y = (rng.random(n) < 1 / (1 + np.exp(-(1.5 * x1 - x2)))).astype(int)
    rows = [(i, float(x1[i]), float(x2[i]), float(rng.normal()), bool(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, `a.b` double, c double, noise double, y boolean")
    return df.filter("id % 4 != 0"), df.filter("id % 4 = 0")


def test_logistic_learns_signal(spark):
    train, dev = _signal(spark)
    feats = ["a.b", "c", "noise"]
    model = fit_pipeline(train, feats, "y", Spec("lr", "logistic", {"maxIter": 200}))
    m = evaluate(score(model, dev, feats, "y"), "y")
    assert m["test_roc_auc"] > 0.75
    assert m["top_10_percentile"] >= m["random"]


def test_logistic_coefficients_match_a_newton_solve(spark):
    train, _ = _signal(spark)
    feats = ["a.b", "c", "noise"]
    fitted = fit_pipeline(train, feats, "y", Spec("lr", "logistic", {"maxIter": 200})).stages[-1]
    p = train.toPandas()
    x, y = p[feats].to_numpy(), p["y"].to_numpy(float)
    z = np.hstack([(x - x.mean(0)) / x.std(0), np.ones((len(x), 1))])
    w, penalty = np.zeros(4), np.diag([1.0, 1.0, 1.0, 0.0])   # C = 1, free intercept
    for _ in range(50):
        q = 1 / (1 + np.exp(-z @ w))
        w -= np.linalg.solve((z * (q * (1 - q))[:, None]).T @ z + penalty, z.T @ (q - y) + penalty @ w)
    assert np.allclose(fitted.coefficients.toArray(), w[:3], atol=1e-3)
    assert abs(fitted.intercept - w[3]) < 1e-3


def test_tree_and_net_fit(spark):
    train, dev = _signal(spark)
    feats = ["a.b", "c"]
    for spec in (Spec("rf", "rf", {"numTrees": 10, "maxDepth": 3}), Spec("gbt", "gbt", {"maxIter": 5}),
                 Spec("mlp", "mlp", {"hidden": [4], "maxIter": 20})):
        row = experiment(train, dev, feats, "y", spec, ["x"])
        assert row["error"] is None and row["test_roc_auc"] > 0.6, spec.name


def test_failure_is_recorded_and_ledger_builds(spark):
    train, dev = _signal(spark)
    bad = experiment(train, dev, ["missing_column"], "y", Spec("lr", "logistic"), ["x"])
    assert bad["error"] is not None and bad["test_roc_auc"] is None
    good = experiment(train, dev, ["a.b"], "y", Spec("lr", "logistic"), ["x"])
    good2 = dict(good, label="z", test_roc_auc=0.5)
    tie = dict(good, classifier="copy")
    ledger = union_all([ledger_frame(spark, [bad, good]), ledger_frame(spark, [good2, tie])])
    best = best_per_label(ledger).collect()
    assert {(r.label, r.classifier) for r in best} == {("y", "lr"), ("y", "copy"), ("z", "lr")}


def test_standardize_population_deviation(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 3.0), (2, 5.0)], "id long, x double")
    out = standardize_apply(df, standardize_fit(df, ["x"]), ["x"]).orderBy("id").collect()
    sd = np.std([1.0, 3.0, 5.0])
    assert np.allclose([r.x for r in out], [-2 / sd, 0.0, 2 / sd])
    _ = F


def test_label_ensemble_product_and_thread_pool(spark):
    from conftest import SF_SMALL
    from outcomelab.plans.prepare import fixture_study
    from outcomelab.plans.sweep import FeatureCache, label_ensemble

    st = fixture_study(spark, SF_SMALL)
    labels = ["label", "flag_r", "flag_big"]
    cache = FeatureCache(st, labels)
    out, metrics = label_ensemble(st, labels, k=6, cache=cache, parallelism=3)
    rows = out.collect()
    n_dev = st.split.rows(st.items, "dev").count()
    assert len(rows) == n_dev and len({r.id for r in rows}) == n_dev
    for r in rows:        # the main label's own model is left out of the product
        assert abs(r.ensemble - r.flag_r * r.flag_big) < 1e-12
        assert 0.0 <= r.label <= 1.0
    assert 0.0 <= metrics["roc_auc"] <= 1.0
    seq, _ = label_ensemble(st, labels, k=6, cache=cache, parallelism=1)
    by_id = {r.id: r.ensemble for r in seq.collect()}
    assert all(abs(by_id[r.id] - r.ensemble) < 1e-9 for r in rows)
