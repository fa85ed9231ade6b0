"""The four feature sets (O59-O63), each one row per item keyed by id.

Order of steps inside each builder follows the reference: derive, attach
entity statistics, downsize text columns (fit on all rows), impute, prune,
one-hot.  Downsizing runs before the '_missing_' recipes, so missing text
becomes 'Other' and the recipe is a no-op (kept for fidelity).

The joined statistics are written before the fits, bucketed by id: each fit
reads its own columns of that table, and none repeats the joins and the
ordered pass below it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelab.functions.columns import concat_strict
from outcomelab.operators.encode import downsize, equal_width_bins, one_hot
from outcomelab.operators.entity import group_median_ratio, group_size, overall_performance, past_performance
from outcomelab.operators.impute import fill_missing, impute
from outcomelab.plans.prepare import Study
from outcomelab.session import materialize_by_key

MISSING = "_missing_"


def _over(features: DataFrame, written: DataFrame) -> DataFrame:
    """``features`` with the table that it is a projection of, for who writes it out and then releases that."""
    features._reads = written
    return features


def project_features(study: Study, share: float = 0.9, max_items: int = 5) -> DataFrame:
    c = study.cols
    f = study.items.select(c.id, c.subject, c.area, c.labor, c.resource, c.date, c.price)
    first_day = f.agg(F.min(c.date).alias("_first"))
    f = (f.crossJoin(F.broadcast(first_day))
         .withColumn("date_posted_relative", F.datediff(F.col(c.date), F.col("_first")))
         .drop("_first"))
    f = group_median_ratio(f, c.price, c.area, c.id, "area_median_price", "price_relative_to_focus_area")
    f = written = materialize_by_key(f.drop(c.date, "area_median_price", c.price), "project_rows", c.id)
    f = downsize(f, [c.subject, c.area, c.resource], share, max_items)
    f = impute(f, {c.area: {"strategy": "constant", "fill_value": MISSING},
                   c.subject: {"strategy": "constant", "fill_value": MISSING},
                   c.resource: {"strategy": "constant", "fill_value": MISSING},
                   "price_relative_to_focus_area": {"strategy": "median"}}, c.id)
    return _over(one_hot(f, exclude=[c.id]), written)


def teacher_features(study: Study, label: str | list[str], share: float = 0.9, max_items: int = 5) -> DataFrame:
    c = study.cols
    f = study.items.select(c.id, c.teacher, c.date, c.prefix)
    perf = past_performance(study.items, study.split, c.teacher, "teacher", label)
    f = f.join(perf, c.id, "left").drop(c.date, c.teacher)
    f = written = materialize_by_key(f, "teacher_rows", c.id)
    f = downsize(f, [c.prefix], share, max_items)
    f = impute(f, {c.prefix: {"strategy": "constant", "fill_value": MISSING}}, c.id)
    return _over(one_hot(f, exclude=[c.id]), written)


def school_features(study: Study, label: str | list[str], share: float = 0.9, max_items: int = 5) -> DataFrame:
    c = study.cols
    f = study.items.select(c.id, c.metro)
    perf = overall_performance(study.items, study.split, c.school, "school", label)
    f = f.join(perf, c.id, "left").drop("school_num_projects")
    f = written = materialize_by_key(f, "school_rows", c.id)
    f = downsize(f, [c.metro], share, max_items)
    f = impute(f, {c.metro: {"strategy": "constant", "fill_value": MISSING}}, c.id)
    return _over(one_hot(f, exclude=[c.id]), written)


def geo_features(study: Study, num_bins: int = 5, share: float = 0.9, max_items: int = 5) -> DataFrame:
    c = study.cols
    f = study.items.select(c.id, c.date, c.latitude, c.longitude, c.city, c.state, c.school)
    f = equal_width_bins(f, c.latitude, num_bins, "latitude_group")
    f = equal_width_bins(f, c.longitude, num_bins, "longitude_group")
    f = f.withColumn("city_state", concat_strict(c.city, c.state))
    sizes = group_size(study.split.rows(f, "train"), "city_state", c.school, c.id)
    # city and city_state leave the set, so they need no downsizing
    f = f.join(sizes, "city_state", "left").select(
        c.id, c.state, "latitude_group", "longitude_group", "city_state_num_schools",
        "city_state_num_projects", "city_state_projects_per_school")
    f = written = materialize_by_key(f, "geo_rows", c.id)
    f = downsize(f, [c.state, "latitude_group", "longitude_group"], share, max_items)
    f = impute(f, {"city_state_projects_per_school": {"strategy": "median"}}, c.id)
    f = fill_missing(f, 0)
    return _over(one_hot(f, exclude=[c.id]), written)


ENTITIES = ("project", "teacher", "school", "geo")


# How the names of the label-dependent columns of the two entity builders end,
# after the entity's name.
LABEL_FEATURES = ("_num_prev_exciting_projects", "_pct_prev_exciting", "_pct_exciting")


def for_label(multi: DataFrame, label: str) -> DataFrame:
    """Columns of one label from a multi-label feature set (``x__{label}``
    renamed to ``x``; other labels' columns dropped).  Only LABEL_FEATURES
    carry a label; every other name is taken as it is, whatever it contains."""
    from outcomelab.functions.columns import qcol
    from outcomelab.operators.entity import LABEL_SEP
    out = []
    for c in multi.columns:
        mark = next((m for m in LABEL_FEATURES if m + LABEL_SEP in c), None)
        if mark is None:
            out.append(qcol(c))
        elif c.split(mark + LABEL_SEP, 1)[1] == label:
            out.append(qcol(c).alias(c.split(mark + LABEL_SEP, 1)[0] + mark))
    return multi.select(*out)


def all_features(study: Study, label: str = "label") -> dict[str, DataFrame]:
    """Every feature set for one label (O63).  Only the teacher and school
    sets depend on the label."""
    return {"project": project_features(study),
            "teacher": teacher_features(study, label),
            "school": school_features(study, label),
            "geo": geo_features(study)}
