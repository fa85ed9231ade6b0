"""Classifiers and their evaluation.

Each experiment is an MLlib ``Pipeline``: VectorAssembler -> StandardScaler
(mean 0, unit deviation, fitted on train rows) -> classifier.  Scoring is a
narrow ``transform``; the positive-class probability is element 1 of the
probability vector.  Metrics come from :mod:`outcomelab.operators.evaluate`
on the scored dev rows, joined to their labels by id.

Configuration notes (library differences, recorded in the ledger):
* logistic regression: L2 with regParam = 1/n_train and no internal
  standardisation equals the usual C = 1 penalty on a summed log-loss;
* forests are grown over blocks of binned rows (:mod:`outcomelab.plans.forest`), by
  MLlib's method and into MLlib's model; only the random draws differ;
* tree ensembles: no node of fewer than 500 rows is split.  MLlib limits
  children, not the split node, so forests are folded after the fit and boosting
  folds each round's tree (:mod:`outcomelab.plans.trees`).  A forest's children have
  at least 125 rows (1 in the reference): on small tables a thousand deep trees
  would otherwise grow down to single rows, only to be folded;
* boosting: depth 3, step 0.1, up to 250 or 1000 rounds; ends when the loss on a
  10 % validation flag, taken from a hash of the id, is no better than any of
  the four rounds before;
* feed-forward nets: MLlib's sigmoid/L-BFGS perceptron with the same hidden
  layer sizes, trained in warm-started segments of iterations up to 100 in all;
  ends when the accuracy on the validation rows has not risen for more than
  one segment, and keeps the best segment's weights (no weight penalty).
"""

from __future__ import annotations

import datetime as _dt
import math
import threading
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelab.functions.columns import qcol, scatter
from outcomelab.operators.evaluate import roc_auc, top_fraction_precision
from outcomelab.plans.forest import fit_forest
from outcomelab.plans.trees import fit_boosted, fold_saved, saved
from outcomelab.session import materialize, release

SEED = 0
NET_SEGMENT = 10     # solver iterations between two looks at the validation rows
NET_PATIENCE = 1
NET_TOLERANCE = 1e-4


@dataclass
class Spec:
    """A named classifier configuration."""
    name: str
    kind: str                      # logistic | gbt | mlp | rf
    params: dict = field(default_factory=dict)


# The ten configurations compared per label, names and parameters.
CLASSIFIERS = [
    Spec("Logistic Regression", "logistic", {"maxIter": 200}),
    Spec("FFNN (d=3)", "mlp", {"hidden": [20, 10, 5], "maxIter": 100}),
    Spec("FFNN (d=4)", "mlp", {"hidden": [30, 20, 10, 5], "maxIter": 100}),
    Spec("FFNN (d=5)", "mlp", {"hidden": [30, 20, 20, 10, 5], "maxIter": 100}),
    Spec("Random Forest", "rf", {"numTrees": 250, "maxDepth": 5}),
    Spec("Random Forest (deep)", "rf", {"numTrees": 250, "maxDepth": 10}),
    Spec("Random Forest (more trees)", "rf", {"numTrees": 1000, "maxDepth": 5}),
    Spec("Random Forest (deep, more trees)", "rf", {"numTrees": 1000, "maxDepth": 10}),
    Spec("Gradient Boost", "gbt", {"maxIter": 250}),
    Spec("Gradient Boost (more)", "gbt", {"maxIter": 1000}),
]
MIN_SPLIT = 500
DEEP = 8            # learners this deep ask MLlib to keep every row's node; only its own fit does (plans/forest.py grows them here)
LEAF_SHARE = 4      # a forest's children have at least MIN_SPLIT / LEAF_SHARE rows, so that little is grown to be folded


def standardize_fit(train: DataFrame, columns: list[str]) -> DataFrame:
    """One-row table of mean and population deviation per column."""
    aggs = []
    for c in columns:
        aggs += [F.avg(qcol(c)).alias(f"{c}__mean"), F.stddev_pop(qcol(c)).alias(f"{c}__sd")]
    return train.agg(*aggs)


def standardize_apply(df: DataFrame, stats: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / sd, sd 0 treated as 1; stats joined as one broadcast row."""
    joined = df.crossJoin(F.broadcast(stats))
    out = []
    for c in df.columns:
        if c in columns:
            sd = F.col(f"`{c}__sd`")
            scale = F.when(sd > 0, sd).otherwise(F.lit(1.0))
            out.append(((qcol(c) - F.col(f"`{c}__mean`")) / scale).alias(c))
        else:
            out.append(qcol(c))
    return joined.select(*out)


def _net(rows: DataFrame, n_features: int, hidden: list[int], iterations: int, segment: int = NET_SEGMENT,
         patience: int = NET_PATIENCE, tolerance: float = NET_TOLERANCE):
    """(model, notes).  The net is trained ``segment`` iterations at a time, each
    time from the weights reached, and scored on the validation rows in
    between.  More than ``patience`` segments in a row without a better accuracy end
    the training; the best segment's weights are the model."""
    train, held = rows.where(~F.col("_valid")), rows.where("_valid")
    layers = [n_features, *hidden, 2]
    best, best_model, curve, still, weights, done = -math.inf, None, [], 0, None, 0
    while done < iterations:
        step = min(segment, iterations - done)
        net = MultilayerPerceptronClassifier(layers=layers, maxIter=step, seed=SEED, featuresCol="_scaled", labelCol="_label",
                                             **({} if weights is None else {"initialWeights": weights}))
        model = net.fit(train)
        weights, done = model.weights, done + step
        hits = model.transform(held).agg(F.avg((F.col("prediction") == F.col("_label")).cast("double"))).first()[0]
        if hits is None:   # no validation rows: nothing to stop by
            best_model = model
            continue
        curve.append(hits)
        still = still + 1 if hits < best + tolerance else 0
        if hits > best:
            best, best_model = hits, model
        if still > patience:
            break
    return best_model, {"stop_step": done, "best_step": segment * (curve.index(best) + 1) if curve else done,
                        "validation_curve": curve, "stopped_early": done < iterations}


EXTENT = {"rf": "maxDepth", "gbt": "maxIter"}    # what a fit may be cut back in without another fit


def family(spec: Spec) -> tuple:
    """Configurations of one family differ in nothing but their extent."""
    extent = EXTENT.get(spec.kind)
    return spec.kind, extent, tuple(sorted((k, str(v)) for k, v in spec.params.items() if k != extent)), \
        None if extent else spec.name


class Ready:
    """Train rows for several configurations.  What these share is made once, by
    the first that needs it: the prepared rows, their scaler, and one growth a
    family, to the largest extent among ``specs``."""

    def __init__(self, train: DataFrame, specs: list[Spec]):
        self.train, self.specs = train, list(specs)
        self._made, self._locks, self._guard = {}, {}, threading.Lock()

    def once(self, key, make):
        with self._guard:
            lock = self._locks.setdefault(key, threading.Lock())
        with lock:
            if key not in self._made:
                self._made[key] = make()
            return self._made[key]

    def extent(self, spec: Spec) -> int:
        """The largest extent of the family of ``spec``."""
        at = EXTENT[spec.kind]
        return max([spec.params[at], *(s.params.get(at, 0) for s in self.specs if family(s) == family(spec))])

    def release(self) -> None:
        if "rows" in self._made:
            release(self._made["rows"][0])


def _classifier(rows: DataFrame, spec: Spec, names: list[str], n_train: int, min_split: int, ready: Ready,
                id_col: str = "id"):
    """(fitted classifier, notes for the ledger) on prepared rows."""
    p = spec.params
    common = dict(featuresCol="_scaled", labelCol="_label")
    if spec.kind == "logistic":
        return LogisticRegression(maxIter=p.get("maxIter", 100), regParam=p.get("penalty", 1.0) / max(n_train, 1),
                                  elasticNetParam=0.0, standardization=False, tol=p.get("tol", 1e-6), **common).fit(rows), {}
    if spec.kind == "gbt":
        run = ready.once(family(spec), lambda: fit_boosted(rows, names, ready.extent(spec), min_split, seed=SEED,
                                                           **{k: p[k] for k in ("patience",) if k in p}))
        model = run.first(rows.sparkSession, p["maxIter"])
        return model, {"rounds": model.rounds, "stopped_early": model.stopped, "validation_curve": model.losses}
    if spec.kind == "rf":
        least = max(1, min_split // LEAF_SHARE)

        def grow():
            depth = ready.extent(spec)
            learner = RandomForestClassifier(
                numTrees=p["numTrees"], maxDepth=depth, minInstancesPerNode=least, featureSubsetStrategy="sqrt", seed=SEED,
                cacheNodeIds=depth >= DEEP, **common)
            return depth, saved(rows.sparkSession, fit_forest(rows, learner, id_col))

        depth, grown = ready.once(family(spec), grow)
        return fold_saved(rows.sparkSession, grown, min_split, p["maxDepth"] if p["maxDepth"] < depth else None), {
            "min_split": min_split, "min_leaf": least}
    if spec.kind == "mlp":
        return _net(rows, len(names), p["hidden"], p["maxIter"], p.get("segment", NET_SEGMENT))
    raise ValueError(f"unknown classifier kind {spec.kind!r}")


@dataclass
class Fitted:
    """The preparing stages, the classifier on top and what the ledger notes
    about the fit (rounds, stop step, validation curve)."""
    prepared: PipelineModel
    classifier: object
    notes: dict = field(default_factory=dict)

    @property
    def stages(self) -> list:
        return [*self.prepared.stages, self.classifier]

    def transform(self, df: DataFrame) -> DataFrame:
        return self.classifier.transform(self.prepared.transform(df))


def _prepared(df: DataFrame, features: list[str], label: str, id_col: str) -> DataFrame:
    """Positional feature names f0..fn (assemblers dislike dots), a double
    label and a stable 10 % validation flag."""
    return df.select(id_col, *[qcol(c).cast("double").alias(f"f{i}") for i, c in enumerate(features)],
                     F.col(label).cast("double").alias("_label"),
                     (scatter(id_col, SEED) % 10 == 0).alias("_valid"))


def _rows(train: DataFrame, features: list[str], label: str, id_col: str) -> tuple[DataFrame, int, PipelineModel]:
    """The prepared rows, written once: the count, the scaler, every pass of the
    solver and the looks at the validation rows read that table."""
    data = materialize(_prepared(train, features, label, id_col), "prepared")
    n = data.count()
    names = [f"f{i}" for i in range(len(features))]
    # the scaler divides by the n-1 deviation; the factor makes it the population one
    factor = math.sqrt(n / (n - 1)) if n > 1 else 1.0
    stages = [VectorAssembler(inputCols=names, outputCol="_vec", handleInvalid="error"),
              StandardScaler(inputCol="_vec", outputCol="_std", withMean=True, withStd=True),
              ElementwiseProduct(inputCol="_std", outputCol="_scaled", scalingVec=Vectors.dense([factor] * len(names)))]
    return data, n, Pipeline(stages=stages).fit(data)


def fit_pipeline(train: DataFrame | Ready, features: list[str], label: str, spec: Spec, id_col: str = "id",
                 min_split: int = MIN_SPLIT) -> Fitted:
    """Fit assembler + scaler + classifier on the train rows (O76).  Fits on
    the same ``Ready`` share its rows, features, label and split limit."""
    ready = train if isinstance(train, Ready) else Ready(train, [spec])
    data, n, prepared = ready.once("rows", lambda: _rows(ready.train, features, label, id_col))
    names = [f"f{i}" for i in range(len(features))]
    rows = data if spec.kind == "gbt" else prepared.transform(data)   # trees of a round read the columns themselves
    try:
        classifier, notes = _classifier(rows, spec, names, n, min_split, ready, id_col)
    except Exception:
        ready.specs = [s for s in ready.specs if s is not spec]     # its extent is not asked of the others
        raise
    finally:
        if ready is not train:
            ready.release()
    return Fitted(prepared, classifier, notes)


def score(model, df: DataFrame, features: list[str], label: str, id_col: str = "id",
          out_col: str = "prediction") -> DataFrame:
    """id, label and positive-class probability of each row."""
    scored = model.transform(_prepared(df, features, label, id_col))
    return scored.select(id_col, F.col("_label").alias(label),
                         vector_to_array("probability")[1].alias(out_col),
                         F.col("prediction").alias("hard_prediction"))


def evaluate(scored: DataFrame, label: str, score_col: str = "prediction", id_col: str = "id") -> dict:
    """ROC AUC, top 10/20/30 % precision and the base rate."""
    auc = roc_auc(scored, score_col, label).first()["roc_auc"]
    top = top_fraction_precision(scored, score_col, label, id_col).first().asDict()
    return {"test_roc_auc": auc, **top}


def params_of(model: Fitted) -> dict[str, str]:
    """Parameters of the fitted classifier and the notes of its fit as text."""
    return ({p.name: str(v) for p, v in model.classifier.extractParamMap().items()}
            | {k: str(v) for k, v in model.notes.items()})


def attempt(train: DataFrame | Ready, dev: DataFrame, features: list[str], label: str, spec: Spec,
            entities: list[str], id_col: str = "id") -> tuple[dict, DataFrame | None]:
    """(ledger row without metrics, scored dev rows) of one configuration; a
    failure is recorded in the row instead of raised (O78), without scores."""
    row = {"classifier": spec.name, "entities": list(entities), "label": label,
           "features": list(features), "timestamp": _dt.datetime.now(),
           "test_roc_auc": None, "top_10_percentile": None, "top_20_percentile": None,
           "top_30_percentile": None, "random": None, "classifier_pipeline": spec.kind,
           "parameters": {}, "error": None}
    try:
        model = fit_pipeline(train, features, label, spec, id_col)
        scored = score(model, dev, features, label, id_col)
        row["parameters"] = params_of(model)
        row["classifier_pipeline"] = str(model.stages[-1])
        return row, scored
    except Exception as e:  # noqa: BLE001 - reported and skipped, like the sweep it mirrors
        row["error"] = f"{type(e).__name__}: {e}"
        return row, None


def experiment(train: DataFrame, dev: DataFrame, features: list[str], label: str, spec: Spec,
               entities: list[str], id_col: str = "id") -> dict:
    """:func:`attempt` with its metrics: one ledger row."""
    row, scored = attempt(train, dev, features, label, spec, entities, id_col)
    if scored is not None:
        try:
            row.update(evaluate(scored, label, "prediction", id_col))
        except Exception as e:  # noqa: BLE001 - scoring is lazy, so it fails here
            row["error"] = f"{type(e).__name__}: {e}"
    return row
