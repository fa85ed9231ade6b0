"""Idempotent commits, the resumable sweep and metrics of many models at once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from outcomelab.operators import evaluate
from outcomelab.plans import models, sweep as SW
from outcomelab.plans.models import Spec
from outcomelab.sources.store import ResultStore


def _rows(df):
    return sorted(tuple(sorted(r.asDict().items())) for r in df.collect())


def test_store_replaces_a_key_and_reads_committed_rows_only(spark, tmp_path):
    store = ResultStore(spark, str(tmp_path / "s"), ["run", "label"])
    assert store.read() is None and not store.contains(run="1") and store.commits().count() == 0
    one = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    store.commit(one, run="1", label="a/b %2F ü=")
    store.commit(one.limit(1), run="1", label="other")
    store.commit(one.withColumn("x", F.col("x") * 10), run="1", label="a/b %2F ü=")    # delivered again
    assert _rows(store.read(label="a/b %2F ü=").select("x", "run")) == [(("run", "1"), ("x", 10)), (("run", "1"), ("x", 20))]
    assert store.read().count() == 3 and store.commits().count() == 2 and store.contains(run="1", label="other")
    assert store.read(run="2") is None
    # a writer that died before its marker leaves nothing a reader sees
    one.write.parquet(f"{store.root}/rows/cdead")
    one.write.parquet(f"{store.root}/commits/marker=cdead/_temporary/0")
    assert store.read().count() == 3
    empty = store.commit(one.limit(0), run="3", label="none")
    assert store.read(run="3").count() == 0 and store.commits().where(F.col("folder") == empty).first()["rows"] == 0
    with pytest.raises(ValueError):
        store.commit(one, run="1")


def _models(spark, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for g, n in (("a", 400), ("b", 37), ("c", 9), ("one class", 20), ("ties", 50)):
        for i in range(n):
            y = 1 if g == "one class" else int(rng.random() < 0.4)
            rows.append((g, len(g) % 2, i, y, 0.5 if g == "ties" else round(float(rng.normal() + y), 2)))
    return spark.createDataFrame(rows, "model string, kind int, id int, y int, s double").repartition(5)


def test_grouped_metrics_equal_one_by_one(spark):
    df = _models(spark)
    got = {r["model"]: r for r in evaluate.grouped_metrics(df, ["model", "kind"], "s", "y").collect()}
    assert len(got) == 5
    for model, r in got.items():
        own = df.where(F.col("model") == model)
        auc = evaluate.roc_auc(own, "s", "y").first()["roc_auc"]
        assert (r["roc_auc"] is None) == (auc is None) and (auc is None or abs(r["roc_auc"] - auc) < 1e-12)
        want = evaluate.top_fraction_precision(own, "s", "y").first().asDict()
        for name, value in want.items():
            assert (r[name] is None and value is None) or abs(r[name] - value) < 1e-12, (model, name)
    assert got["one class"]["roc_auc"] is None and abs(got["ties"]["roc_auc"] - 0.5) < 1e-12


def test_grouped_metrics_do_not_depend_on_partitions(spark):
    df = _models(spark, 6)
    key = lambda r: (r["model"], r["roc_auc"], r["top_10_percentile"], r["random"])
    a = sorted(map(key, evaluate.grouped_metrics(df.coalesce(1), ["model"], "s", "y").collect()), key=str)
    b = sorted(map(key, evaluate.grouped_metrics(df.repartition(13), ["model"], "s", "y").collect()), key=str)
    assert a == b
    assert evaluate.grouped_metrics(df.limit(0), ["model"], "s", "y").count() == 0


SPECS = [Spec("lr", "logistic", {"maxIter": 20}), Spec("rf", "rf", {"numTrees": 3, "maxDepth": 2}),
         Spec("broken", "no such kind")]
LABELS = ["label", "flag_big"]


@pytest.fixture(scope="module")
def study(spark):
    from outcomelab.plans.prepare import fixture_study
    st = fixture_study(spark, SF_SMALL)
    return st, SW.FeatureCache(st, LABELS), ["labor", "date_posted_relative", "school_pct_exciting"]


def test_killed_sweep_resumes_with_what_is_absent(spark, study, tmp_path, monkeypatch):
    st, cache, feats = study
    ledger = SW.Ledger(spark, str(tmp_path / "ledger"))
    real, calls = models.attempt, []

    def watched(train, dev, features, label, spec, *rest):
        if len(calls) == 4:
            raise KeyboardInterrupt          # not an Exception: the driver is gone
        calls.append((label, spec.name))
        return real(train, dev, features, label, spec, *rest)

    monkeypatch.setattr(SW, "attempt", watched)
    with pytest.raises(KeyboardInterrupt):
        SW.sweep(st, LABELS, SPECS, features=feats, cache=cache, ledger=ledger, parallelism=1)
    assert len(calls) == 4 and len(ledger.committed()) == 4
    before = {(r.label, r.classifier): r.timestamp for r in ledger.table().collect()}

    again, first = [], list(calls)
    monkeypatch.setattr(SW, "attempt", lambda *a: (again.append((a[3], a[4].name)), real(*a))[1])
    fresh = SW.Ledger(spark, str(tmp_path / "ledger"))     # as a new driver would open it
    out = SW.sweep(st, LABELS, SPECS, features=feats, cache=cache, ledger=fresh, parallelism=2).collect()
    assert sorted(again + first) == sorted((lb, s.name) for lb in LABELS for s in SPECS)
    assert len(out) == 6 and all(r.timestamp == before[r.label, r.classifier] for r in out if (r.label, r.classifier) in before)
    for r in out:
        assert (r.error is None) == (r.classifier != "broken")
        assert (r.test_roc_auc is None) == (r.classifier == "broken")

    again.clear()
    SW.sweep(st, LABELS, SPECS, features=feats, cache=cache, ledger=fresh, retry_failed=True)
    assert sorted(again) == sorted((lb, "broken") for lb in LABELS)
    again.clear()
    other = [Spec("lr", "logistic", {"maxIter": 21})]      # another configuration is another entry
    assert SW.sweep(st, ["label"], other, features=feats, cache=cache, ledger=fresh).count() == 7
    assert again == [("label", "lr")]


def test_ledger_metrics_equal_single_evaluation(spark, study, tmp_path):
    st, cache, feats = study
    ledger = SW.Ledger(spark, str(tmp_path / "ledger"))
    out = SW.sweep(st, LABELS, SPECS[:2], features=feats, cache=cache, ledger=ledger).collect()
    from outcomelab.plans.dataset import train_test
    for r in out:
        spec = next(s for s in SPECS if s.name == r.classifier)
        train, dev = train_test(st, cache.sets(r.label), r.label, features=feats)
        want = models.experiment(train, dev, feats, r.label, spec, ["x"])
        for m in SW.METRICS:
            assert abs(r[m] - want[m]) < 1e-9
    assert {(r.label, r.classifier) for r in SW.best_per_label(spark.createDataFrame(out, SW.LEDGER_SCHEMA)).collect()}
    assert SW.Ledger(spark, str(tmp_path / "none")).table().count() == 0
