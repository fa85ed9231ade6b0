"""Classifier sweep over labels, best per label, and the label ensemble
(O37, O41, O56, O78-O80).

Feature sets are built once for all labels: only the teacher and school
sets depend on the label, so the project and geo sets (and the labelled
table and split) are shared.  The selected features come from one ranking
against the main label, reused for every label.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelab.functions.columns import product_of
from outcomelab.operators.evaluate import grouped_metrics, roc_auc, top_fraction_precision
from outcomelab.operators.hot_keys import join_groups
from outcomelab.plans import features as FT
from outcomelab.plans.dataset import train_test
from outcomelab.plans.models import CLASSIFIERS, EXTENT, MIN_SPLIT, SEED, Ready, Spec, attempt, family, fit_pipeline, score
from outcomelab.plans.prepare import Study
from outcomelab.plans.ranking import feature_set_ranking, top_k
from outcomelab.session import ensure_checkpoint_dir, materialize, materialize_by_key, release
from outcomelab.sources.store import ResultStore

# The ledger's column names are part of the result's schema.
LEDGER_SCHEMA = T.StructType([
    T.StructField("classifier", T.StringType()),
    T.StructField("entities", T.ArrayType(T.StringType())),
    T.StructField("test_roc_auc", T.DoubleType()),
    T.StructField("top_10_percentile", T.DoubleType()),
    T.StructField("top_20_percentile", T.DoubleType()),
    T.StructField("top_30_percentile", T.DoubleType()),
    T.StructField("random", T.DoubleType()),
    T.StructField("classifier_pipeline", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("parameters", T.MapType(T.StringType(), T.StringType())),
    T.StructField("features", T.ArrayType(T.StringType())),
    T.StructField("label", T.StringType()),
    T.StructField("error", T.StringType()),
])


class FeatureCache:
    """Feature sets for several labels, built once.

    The project and geo sets do not depend on the label.  The teacher and
    school sets are built once with every label's statistics side by side
    (one aggregate / one ordered pass carries all label sums); a label's
    view selects its columns."""

    def __init__(self, study: Study, labels: list[str]):
        self.study = study
        self.labels = list(labels)
        self._built: dict[str, DataFrame] = {}

    def _write(self, entity, builder):
        features = builder()
        table = materialize_by_key(features, f"{entity}_features", self.study.cols.id)
        release(getattr(features, "_reads", None))
        return table

    def _build(self, entities):
        st, lbs = self.study, self.labels
        builders = {"project": lambda: FT.project_features(st),
                    "geo": lambda: FT.geo_features(st),
                    "teacher": lambda: FT.teacher_features(st, lbs),
                    "school": lambda: FT.school_features(st, lbs)}
        builders = {e: b for e, b in builders.items() if e in entities and e not in self._built}
        if not builders:
            return
        # tables, not RDD checkpoints: a sweep reads 26 selected columns.  They
        # are bucketed by id, like the labelled table, so that assembling
        # them for a split and a label needs no exchange.  The four sets are independent; their fit steps are many small jobs, so
        # they are built concurrently rather than one after another.
        with ThreadPoolExecutor(max_workers=len(builders)) as pool:
            futures = {e: pool.submit(self._write, e, b) for e, b in builders.items()}
            self._built.update({e: f.result() for e, f in futures.items()})

    def sets(self, label: str, entities=FT.ENTITIES) -> dict[str, DataFrame]:
        """The sets of the given entities for ``label``; those not read before are built."""
        if label not in self.labels:
            raise ValueError(f"label {label!r} not among {self.labels}")
        self._build(entities)
        return {e: (FT.for_label(self._built[e], label) if e in ("teacher", "school") else self._built[e])
                for e in entities}


def selected_features(study: Study, cache: FeatureCache, main_label: str, k: int = 26) -> list[str]:
    """Top ``k`` features of the second-pass ranking against the main label."""
    ranking = feature_set_ranking(study, cache.sets(main_label), main_label)
    return [r["feature"] for r in top_k(ranking, k).collect()]


def ledger_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Experiment rows (one per label and classifier; O41/O77) as a table."""
    return spark.createDataFrame([tuple(r.get(f.name) for f in LEDGER_SCHEMA.fields) for r in rows],
                                 LEDGER_SCHEMA)


METRICS = ["test_roc_auc", "top_10_percentile", "top_20_percentile", "top_30_percentile", "random"]


class Ledger:
    """The durable record of a sweep.

    Every fit is one commit: its scored dev rows and then its ledger row,
    under the hash of all that decides its result (label, configuration,
    features, seed, split limit).  A sweep that starts again on the same folder finds
    what is committed and fits only the rest.  Metrics are not stored: they
    come from the score rows of all fits, rated together in one pass."""

    def __init__(self, spark: SparkSession, root: str | None = None, id_col: str = "id"):
        self.spark, self.id_col = spark, id_col
        root = root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgers/{uuid.uuid4().hex}"
        self.root = root
        self.rows = ResultStore(spark, f"{root}/fits", ["entry"])
        self.scores = ResultStore(spark, f"{root}/scores", ["entry"])

    @staticmethod
    def entry(label: str, spec: Spec, features: list[str], entities) -> str:
        decides = [label, spec.name, spec.kind, spec.params, list(features), list(entities), SEED, MIN_SPLIT]
        return hashlib.sha256(json.dumps(decides, sort_keys=True).encode()).hexdigest()[:32]

    def committed(self, retry_failed: bool = False) -> set[str]:
        """Entries that need no fit: those recorded, without failed ones if
        these are to be tried again.  One entry per label and configuration."""
        rows = self.rows.read()
        if rows is None:
            return set()
        if retry_failed:
            rows = rows.where(F.col("error").isNull())
        return {r["entry"] for r in rows.select("entry").collect()}

    def commit(self, entry: str, row: dict, scored: DataFrame | None, label: str) -> None:
        if scored is not None:
            try:
                self.scores.commit(scored.select(
                    F.col(self.id_col).alias("id"), F.col(label).cast("double").alias("actual"),
                    F.col("prediction").alias("score")), entry=entry)
            except Exception as e:  # noqa: BLE001 - scoring is lazy, so a failing fit may show here
                row["error"] = f"{type(e).__name__}: {e}"
        self.rows.commit(ledger_frame(self.spark, [row]), entry=entry)

    def table(self) -> DataFrame:
        """The ledger rows of all committed fits, rated in one pass."""
        rows = self.rows.read()
        if rows is None:
            return ledger_frame(self.spark, [])
        rows = rows.drop(*METRICS)
        scores = self.scores.read()
        if scores is None:
            rated = rows.select("entry", *[F.lit(None).cast("double").alias(m) for m in METRICS])
        else:
            rated = grouped_metrics(scores, ["entry"], "score", "actual").withColumnRenamed("roc_auc", "test_roc_auc")
        failed = F.col("error").isNotNull()
        out = rows.join(rated, "entry", "left").withColumns(
            {m: F.when(~failed, F.col(m)) for m in METRICS})
        return out.select(*[f.name for f in LEDGER_SCHEMA.fields])


def sweep(study: Study, labels: list[str], classifiers: list[Spec] = CLASSIFIERS,
          entities=FT.ENTITIES, k: int = 26, parallelism: int = 4,
          features: list[str] | None = None, cache: FeatureCache | None = None,
          ledger: Ledger | None = None, retry_failed: bool = False) -> DataFrame:
    """Every classifier on every label (O78), recorded in ``ledger``; what it
    already holds is not fitted again.  All fits share one small thread pool
    (as CrossValidator's ``parallelism`` does), which never drains between labels; each fit
    is itself a distributed job.  A label's fits share its prepared rows, and forests or
    boosting runs that differ in depth or rounds alone share one growth, of
    which the smaller ones are the beginning; these come last."""
    spark = study.items.sparkSession
    cache = cache or FeatureCache(study, labels)
    feats = features or selected_features(study, cache, labels[0], k)
    ledger = ledger or Ledger(spark, id_col=study.cols.id)
    done = ledger.committed(retry_failed)
    fits = [(ledger.entry(label, spec, feats, entities), label, spec) for label in labels for spec in classifiers]
    fits = [f for f in fits if f[0] not in done]
    left, sets = {}, {}
    for _, label, spec in fits:
        left.setdefault(label, []).append(spec)
        sets[label] = cache.sets(label)

    def rows(label: str):
        train, dev = train_test(study, sets[label], label, entities, feats)
        return Ready(materialize(train, "sweep_train"), left[label]), materialize(dev, "sweep_dev")

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        data = dict(zip(left, pool.map(rows, left)))

    def begins_another(fit) -> bool:
        _, label, spec = fit
        at = EXTENT.get(spec.kind)
        return any(family(s) == family(spec) and s.params.get(at, 0) > spec.params.get(at, 0) for s in left[label] if at)

    # a label's longest fits first
    fits.sort(key=lambda f: (begins_another(f), labels.index(f[1]), -f[2].params.get("numTrees", 0)))

    def one(fit) -> None:
        entry, label, spec = fit
        row, scored = attempt(*data[label], feats, label, spec, list(entities), study.cols.id)
        ledger.commit(entry, row, scored, label)

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        list(pool.map(one, fits))
    for train, dev in data.values():
        train.release()
        release(train.train, dev)
    return ledger.table()


def best_per_group(df: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """Rows equal to their group's maximum, ties kept (O37/O79).  The group
    maxima come from a map-side-combined aggregate; heavy groups meet theirs
    by broadcast, so no group is gathered in one task."""
    maxima = df.groupBy(group_col).agg(F.max(value_col).alias("_max"), F.count(F.lit(1)).alias("_size"))
    return (join_groups(df, maxima, group_col, "_size")
            .filter(F.col(value_col) == F.col("_max")).drop("_max", "_size"))


def best_per_label(ledger: DataFrame) -> DataFrame:
    """Best classifier(s) per label by test ROC AUC, best label first."""
    return best_per_group(ledger.filter(F.col("test_roc_auc").isNotNull()), "label", "test_roc_auc") \
        .orderBy(F.col("test_roc_auc").desc(), F.col("label"))


def label_ensemble(study: Study, labels: list[str], main_label: str | None = None,
                   spec: Spec = CLASSIFIERS[0], entities=FT.ENTITIES, k: int = 26,
                   features: list[str] | None = None,
                   cache: FeatureCache | None = None, parallelism: int = 4) -> tuple[DataFrame, dict]:
    """One model per label, scored on the dev rows; the ensemble is the
    product of the other labels' probabilities, evaluated against the main
    label (O56, O80).  The labels' fits are independent distributed jobs and
    run in a small thread pool, as the sweep's do.  Returns (per-row
    predictions, metrics)."""
    main_label = main_label or labels[0]
    cache = cache or FeatureCache(study, labels)
    feats = features or selected_features(study, cache, main_label, k)
    idc = study.cols.id

    def label_scores(label: str) -> DataFrame:
        train, dev = train_test(study, cache.sets(label), label, entities, feats)
        model = fit_pipeline(train, feats, label, spec, idc)     # writes the assembled rows once
        # materialise each label's (id, probability): the final plan then joins
        # six small scans instead of six model + assembly plans at once
        return (score(model, dev, feats, label, idc, out_col="_p")
                .select(idc, F.col("_p").alias(label)).checkpoint(eager=True))

    cache.sets(main_label)                     # build the shared feature tables once, up front
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        per_label = list(pool.map(label_scores, labels))
    # a row per dev item each: merged, whatever their estimated sizes, not sent through the driver
    preds = reduce(lambda a, b: a.join(b.hint("merge"), idc, "inner"), per_label)
    others = [lb for lb in labels if lb != main_label]
    actual = study.items.select(idc, F.col(main_label).alias("actual"))
    out = (preds.withColumn("ensemble", product_of(*others))
           .join(actual.hint("merge"), idc, "inner")).checkpoint(eager=True)
    metrics = {"roc_auc": roc_auc(out, "ensemble", "actual").first()["roc_auc"],
               **top_fraction_precision(out, "ensemble", "actual", idc).first().asDict()}
    return out, metrics


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Append tables, columns unioned by name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
