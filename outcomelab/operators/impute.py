"""Missing-value imputation by recipe (O51) and scalar fills.

A recipe maps column -> {"strategy": ..., "fill_value": ...} with strategies
``constant``, ``most_frequent``, ``median`` and ``mean``.  ``fit`` runs one
small job for all mode columns (distributed value counts, top-1 each), one
aggregate for the mean columns and one exact-median pass per median column,
and returns plain Python values; ``apply`` is one projection of
``coalesce(col, literal)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from outcomelab.functions.columns import qcol
from outcomelab.operators.entity import exact_median


def modes(df: DataFrame, columns: list[str]) -> dict:
    """Most frequent non-missing value per column, the smallest one on a tie
    (as the usual imputer does).  Value counts are map-side combined and the
    top value is a window group limit, one row a column and task, so no task
    holds a column's whole value set.  Columns of one type share a read of
    the input; one small job for all columns."""
    if not columns:
        return {}
    by_type = {}
    for c in dict.fromkeys(columns):
        by_type.setdefault(df.schema[c].dataType.simpleString(), []).append(c)
    first = F.row_number().over(W.partitionBy("_col").orderBy(F.col("_n").desc(), F.col("_v").asc()))
    tops = [df.select(*[qcol(c) for c in cs]).unpivot([], [qcol(c) for c in cs], "_col", "_v").filter(F.col("_v").isNotNull())
            .groupBy("_col", "_v").agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_rank", first).filter(F.col("_rank") == 1)
            .select("_col", F.col("_v").cast("string").alias("_v")) for cs in by_type.values()]
    out = {c: None for c in columns}
    for r in reduce(lambda a, b: a.unionByName(b), tops).collect():
        out[r["_col"]] = r["_v"]
    return out


def fit_impute(df: DataFrame, recipe: dict, id_col: str = "id") -> dict:
    fills, aggs, mode_cols = {}, [], []
    for c, spec in recipe.items():
        strategy = spec.get("strategy", "mean")
        if strategy == "constant":
            fills[c] = spec.get("fill_value")
        elif strategy == "most_frequent":
            mode_cols.append(c)
        elif strategy == "mean":
            aggs.append(F.avg(c).alias(c))
        elif strategy != "median":
            raise ValueError(f"unknown strategy {strategy!r} for {c}")
    fills.update(modes(df, mode_cols))
    if aggs:
        row = df.agg(*aggs).first()
        fills.update(row.asDict())
    for c, spec in recipe.items():
        if spec.get("strategy") == "median":
            fills[c] = exact_median(df, c, [], id_col).first()["median"]
    return fills


def apply_impute(df: DataFrame, fills: dict) -> DataFrame:
    """coalesce(col, fill) with the fill cast to the column's type; an integer
    column with a fractional fill (a mean or median) becomes double."""
    exprs = []
    for c in df.columns:
        if c in fills and isinstance(fills[c], float) and isinstance(df.schema[c].dataType, T.IntegralType):
            exprs.append(F.coalesce(F.col(c).cast("double"), F.lit(fills[c])).alias(c))
        elif c in fills and fills[c] is not None:
            exprs.append(F.coalesce(F.col(c), F.lit(fills[c]).cast(df.schema[c].dataType)).alias(c))
        else:
            exprs.append(F.col(c))
    return df.select(*exprs)


def impute(df: DataFrame, recipe: dict, id_col: str = "id") -> DataFrame:
    """Fit the recipe on ``df`` and fill its missing values."""
    return apply_impute(df, fit_impute(df, recipe, id_col))


def fill_missing(df: DataFrame, value, columns: list[str] | None = None) -> DataFrame:
    """Fill remaining NULLs with a scalar (O52); numeric columns only for a
    number, string columns only for text (as ``na.fill`` does)."""
    return df.na.fill(value, subset=columns)
