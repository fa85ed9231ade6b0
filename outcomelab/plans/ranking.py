"""Feature ranking by mutual information (O68 first and second pass, O40)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from outcomelab.operators.encode import indicator_columns
from outcomelab.operators.info import (discrete_columns, indicator_cells, jittered_points, mi_from_points,
                                       mi_of_cells, mutual_information, repeats)
from outcomelab.operators.profile import drop_missing
from outcomelab.plans.features import ENTITIES
from outcomelab.plans.prepare import Study
from outcomelab.session import materialize, release

# Raw item columns scored by the first pass (the fixture's roles).
RAW_FEATURES = ["latitude", "longitude", "city", "state", "prefix", "subject", "area",
                "resource", "labor", "price"]

# Sparse columns leave the table before rows with missing values are dropped.
SPARSE = ["metro"]


def raw_ranking(study: Study, label: str = "label", features: list[str] = RAW_FEATURES) -> DataFrame:
    """First pass: rows without any missing value; text/boolean columns are
    discrete, numeric ones continuous.  (feature, mutual_information, discrete)."""
    rows = drop_missing(study.items.drop(*SPARSE))
    return mutual_information(rows, features, label, study.cols.id, discrete_columns(rows, features))


def feature_set_ranking(study: Study, feature_sets: dict[str, DataFrame], label: str = "label",
                        entities=ENTITIES) -> DataFrame:
    """Second pass: every feature of every set against ``label`` (all rows
    that have it).  The 0/1 columns of one-hot encoding are scored from their
    contingency tables, one aggregate per set; the numeric features of all
    sets are stacked into one long table, written once, and go through the
    continuous estimator together.  (entity, feature, mutual_information)."""
    idc = study.cols.id
    y = study.items.select(idc, label)
    points, cells, owner, repeated = [], [], [], False
    for e in entities:
        x = feature_sets[e]
        flags = set(indicator_columns(x))
        feats = [c for c in x.columns if c != idc]
        numeric = [c for c in feats if c not in flags]
        joined = x.join(y.hint("merge"), idc, "inner")   # a row per item: never a broadcast
        disc = discrete_columns(joined, numeric)
        if disc:
            raise ValueError(f"feature set {e!r} still has text columns {disc}; one-hot them first")
        if numeric:
            points.append(jittered_points(joined, numeric, label, idc))
            repeated = repeated or repeats(joined, label, idc)
        if flags:
            cells.append(indicator_cells(joined, [c for c in feats if c in flags], label))
        owner += [(e, f) for f in feats]
    scored = []
    if points:
        table = reduce(DataFrame.unionByName, points)
        table = materialize(table if repeated else table.drop("_id"), "mi_points")
        scored.append(mi_from_points(table, repeated=repeated))
        release(table)
    if cells:
        scored.append(mi_of_cells(materialize(reduce(DataFrame.unionByName, cells), "mi_cells")))
    owners = study.items.sparkSession.createDataFrame(owner, "entity string, feature string")
    return (F.broadcast(owners).join(reduce(DataFrame.unionByName, scored), "feature")
            .select("entity", "feature", "mutual_information"))


def top_k(ranking: DataFrame, k: int) -> DataFrame:
    """The k best rows by mutual information, ties by name, with their rank
    (O39/O40)."""
    return (ranking.orderBy(F.col("mutual_information").desc(), F.col("feature")).limit(k)
            .withColumn("rank", F.row_number().over(     # window over the k kept rows only
                W.orderBy(F.col("mutual_information").desc(), F.col("feature")))))
