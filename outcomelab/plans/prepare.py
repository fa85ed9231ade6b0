"""The labelled item table (O9, O14, O51 on outcomes, O53) and the study
context shared by the feature builders."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from outcomelab.functions.columns import any_of
from outcomelab.operators.impute import impute
from outcomelab.operators.split import Split, date_floor, make_split
from outcomelab.session import materialize_by_key
from outcomelab.sources import fixtures


@dataclass(frozen=True)
class Columns:
    """Roles of the item columns (defaults: the fixture's names)."""
    id: str = "id"
    date: str = "d"
    teacher: str = "teacher"
    school: str = "school"
    price: str = "price"
    area: str = "area"
    subject: str = "subject"
    resource: str = "resource"
    labor: str = "labor"
    prefix: str = "prefix"
    metro: str = "metro"
    city: str = "city"
    state: str = "state"
    latitude: str = "latitude"
    longitude: str = "longitude"


def joined_items(items: DataFrame, outcomes: DataFrame, id_col: str, date_col: str,
                 min_date: str | None) -> DataFrame:
    """Items on/after ``min_date`` with a known outcome (inner join)."""
    if min_date:
        items = date_floor(items, date_col, min_date)
    return items.join(outcomes, id_col, "inner")


def finish_labels(joined: DataFrame, id_col: str, mode_cols: list[str], or_parts: list[str],
                  or_name: str) -> DataFrame:
    """Missing outcome flags imputed by their mode, and an OR-ed label: one
    small fit job, then a projection."""
    joined = impute(joined, {c: {"strategy": "most_frequent"} for c in mode_cols}, id_col)
    return joined.withColumn(or_name, any_of(*or_parts))


def label_items(items: DataFrame, outcomes: DataFrame, id_col: str, date_col: str,
                min_date: str | None, mode_cols: list[str], or_parts: list[str],
                or_name: str) -> DataFrame:
    """Items on/after ``min_date`` with a known outcome (inner join), missing
    outcome flags imputed by their mode, and an OR-ed label."""
    return finish_labels(joined_items(items, outcomes, id_col, date_col, min_date),
                         id_col, mode_cols, or_parts, or_name)


def fixture_joined(spark: SparkSession, folder: str, min_date: str | None = fixtures.DATE_FLOOR) -> DataFrame:
    return joined_items(fixtures.items(spark, folder), fixtures.outcomes(spark, folder), "id", "d", min_date)


def fixture_items(spark: SparkSession, folder: str, min_date: str | None = fixtures.DATE_FLOOR) -> DataFrame:
    """Labelled items of the test tables (see :mod:`outcomelab.sources.fixtures`)."""
    return finish_labels(fixture_joined(spark, folder, min_date), "id",
                         fixtures.MODE_IMPUTED, fixtures.OR_PARTS, fixtures.OR_LABEL)


@dataclass
class Study:
    """Labelled items plus their split: the inputs of every feature set."""
    items: DataFrame
    split: Split
    cols: Columns = Columns()


def fixture_study(spark: SparkSession, folder: str, persist: bool = True) -> Study:
    if persist:
        # the joined table feeds every feature set: write it once as a table,
        # so the lineitem roll-up and the joins run once (the mode fit reads
        # five pruned columns of the written table), and each reader prunes
        # columns and pushes the split filter through the imputing projection;
        # bucketed by id, so feature sets join it without an exchange
        joined = materialize_by_key(fixture_joined(spark, folder), "labelled_items", "id")
        items = finish_labels(joined, "id", fixtures.MODE_IMPUTED, fixtures.OR_PARTS, fixtures.OR_LABEL)
    else:
        items = fixture_items(spark, folder)
    split = make_split(items, "id", "d", fixtures.DEV_SHARE, shuffle=False,
                       recent_from=fixtures.RECENT_FROM)
    return Study(items, split)


def split_labels(study: Study) -> DataFrame:
    """id, date, split name for every labelled item."""
    s = study.split
    return study.items.select(s.id_col, s.date_col, s.name().alias("split"))
