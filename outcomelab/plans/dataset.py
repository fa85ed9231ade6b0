"""Dataset assembly by key.

Features and labels stay in one DataFrame joined by id; nothing is aligned
by row position.  Every feature set has one row per item, so each join is
1:1 on id.  The labelled table and the cached sets are bucketed by id, so
the joins read them in place: no exchange, for any split, label or column
choice.  They are sort-merge joins by hint: the size of a narrow projection of
a compressed file is estimated at a few bytes a row, so Spark would send
tables with a row per item through the driver as broadcasts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelab.functions.columns import qcol
from outcomelab.operators.keys import require_unique
from outcomelab.plans.features import ENTITIES
from outcomelab.plans.prepare import Study


def prefix_columns(df: DataFrame, prefix: str, exclude: list[str] = ()) -> DataFrame:
    """Prefix every column name except ``exclude``."""
    return df.select(*[qcol(c) if c in set(exclude) else qcol(c).alias(prefix + c) for c in df.columns])


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on all shared column names."""
    shared = sorted(set(left.columns) & set(right.columns))
    if not shared:
        raise ValueError("no shared columns to join on")
    return left.join(right.hint("merge"), shared, how)


def assemble(study: Study, feature_sets: dict[str, DataFrame], split: str = "train",
             entities=ENTITIES, drop_id: bool = False, strict: bool = False) -> DataFrame:
    """Rows of one split with every entity's features attached.
    An unknown split raises ``ValueError``; with ``strict``, a set that repeats
    an id raises ``DuplicateKeys`` instead of adding rows."""
    idc = study.cols.id
    if strict:
        require_unique({e: feature_sets[e].select(idc) for e in entities}, idc)
    out = study.split.rows(study.items, split).select(idc)
    for e in entities:
        out = out.join(feature_sets[e].hint("merge"), idc, "left")
    return out.drop(idc) if drop_id else out


def labels(study: Study, split: str, label: str) -> DataFrame:
    """id and label of one split."""
    idc = study.cols.id
    ids = study.split.rows(study.items, split).select(idc)
    return natural_join(ids, study.items.select(idc, label))


def train_test(study: Study, feature_sets: dict[str, DataFrame], label: str,
               entities=ENTITIES, features: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, dev): id, the chosen features (O7) and the label."""
    idc = study.cols.id
    out = []
    for split in ("train", "dev"):
        x = assemble(study, feature_sets, split, entities)
        if features is not None:
            x = x.select(idc, *[qcol(c) for c in features])
        out.append(x.join(labels(study, split, label).hint("merge"), idc, "inner"))
    return out[0], out[1]


def feature_names(df: DataFrame, id_col: str = "id", label: str | None = None) -> list[str]:
    return [c for c in df.columns if c not in (id_col, label)]


def select_ranked(df: DataFrame, ranking: DataFrame, k: int, id_col: str = "id") -> list[str]:
    """Names of the ``k`` best features of a ranking (O7, O40): at most k
    rows reach the driver."""
    top = ranking.orderBy(F.col("mutual_information").desc(), F.col("feature")).limit(k).collect()
    names = [r["feature"] for r in top]
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"ranked features not in the dataset: {missing}")
    return names
