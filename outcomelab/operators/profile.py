"""Whole-table profiles (O12, O13, O25, O32): one aggregate each."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def year_counts(items: DataFrame, date_col: str = "d", id_col: str = "id",
                drop_last_year: bool = True) -> DataFrame:
    """Items per year; the largest year present (incomplete) is dropped."""
    per_year = items.groupBy(F.year(date_col).alias("year")).agg(F.count(id_col).alias("n"))
    if not drop_last_year:
        return per_year
    last = per_year.agg(F.max("year").alias("_last"))
    return per_year.crossJoin(F.broadcast(last)).filter(F.col("year") < F.col("_last")).drop("_last")


def true_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of true values of each boolean column, as long rows."""
    wide = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns])
    return wide.unpivot([], columns, "requirement", "true_proportion")


def missing_cells(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Number of missing cells over the given columns, and the row count."""
    columns = columns or df.columns
    per_col = [F.sum(F.col(c).isNull().cast("long")) for c in columns]
    return df.agg(reduce(lambda a, b: a + b, per_col).alias("missing_cells"),
                  F.count(F.lit(1)).alias("rows"))


def drop_missing(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with any missing value."""
    return df.na.drop("any", subset=columns)
