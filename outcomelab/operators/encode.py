"""Categorical and numeric encoders.

Each data-dependent encoder is a ``fit`` that returns small parameters (kept
categories, vocabulary, edges) and an ``apply`` that is a single projection,
so the learned values are literals inside whole-stage codegen.  What ``fit``
brings to the driver is bounded: at most ``max_items`` values per column for
downsizing, and the vocabulary of the wide one-hot form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from outcomelab.functions.columns import flag_to_bool, qcol
from outcomelab.operators.ordered import running_totals

OTHER = "Other"


def string_columns(df: DataFrame, skip: list[str] = ()) -> list[str]:
    """Text columns of ``df`` except ``skip``."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in set(skip)]


def replace_flags(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """'t'/'f' text columns to booleans (O42); by default every string column."""
    columns = columns if columns is not None else string_columns(df)
    return df.select(*[flag_to_bool(c).alias(c) if c in columns else F.col(c) for c in df.columns])


def _long_values(df: DataFrame, columns: list[str]) -> DataFrame:
    casted = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return casted.unpivot([], columns, "column", "value").filter(F.col("value").isNotNull())


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, count) over non-missing values."""
    return _long_values(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def _by_freq():
    return W.partitionBy("column").orderBy(F.col("count").desc(), F.col("value"))


def top_values(counts: DataFrame, max_items: int) -> DataFrame:
    """The ``max_items`` most frequent values per column of a value-count
    table, with their ``_rank``.  The rank filter becomes a window group
    limit: each map task keeps at most ``max_items`` rows per column before
    the shuffle, so a high-cardinality column never reaches one task whole."""
    return (counts.withColumn("_rank", F.row_number().over(_by_freq()))
            .filter(F.col("_rank") <= max_items))


def fit_downsize(df: DataFrame, columns: list[str], desired_share: float = 0.9,
                 max_items: int = 10) -> dict[str, list[str]]:
    """Values kept per column (O47/O48): sorted by frequency (ties by value),
    the strict prefix whose cumulative share of non-missing rows stays below
    ``desired_share``, cut to ``max_items``."""
    if not columns:
        return {}
    counts = value_counts(df, columns)
    totals = counts.groupBy("column").agg(F.sum("count").alias("_total"))
    top = top_values(counts, max_items).join(F.broadcast(totals), "column")
    cum = F.sum("count").over(_by_freq().rowsBetween(W.unboundedPreceding, 0))
    kept = (top.withColumn("_share", cum / F.col("_total"))
            .filter(F.col("_share") < desired_share)
            .select("column", "value", "_rank").collect())
    out = {c: [] for c in columns}
    for r in sorted(kept, key=lambda r: (r["column"], r["_rank"])):
        out[r["column"]].append(r["value"])
    return out


def apply_downsize(df: DataFrame, kept: dict[str, list[str]], other: str = OTHER) -> DataFrame:
    """Replace values outside the kept list (and missing values) by 'Other'."""
    exprs = []
    for c in df.columns:
        if c in kept:
            vals = kept[c]
            cond = F.col(c).cast("string").isin(vals) if vals else F.lit(False)
            exprs.append(F.when(cond, F.col(c).cast("string")).otherwise(F.lit(other)).alias(c))
        else:
            exprs.append(F.col(c))
    return df.select(*exprs)


def downsize(df: DataFrame, columns: list[str] | None = None, desired_share: float = 0.9,
             max_items: int = 10, skip: list[str] = ()) -> DataFrame:
    """Downsize every (or the given) text column except ``skip``."""
    columns = columns if columns is not None else string_columns(df, skip)
    return apply_downsize(df, fit_downsize(df, columns, desired_share, max_items))


INDICATOR = {"indicator": True}


def fit_one_hot(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted distinct non-missing values per column (O49 fit).  The values
    become column names, so this is for vocabularies that downsizing or the
    data model bounds; others go through :func:`one_hot_sparse`."""
    if not columns:
        return {}
    levels = {c: [] for c in columns}
    for r in _long_values(df, columns).distinct().collect():
        levels[r["column"]].append(r["value"])
    return {c: sorted(v) for c, v in levels.items()}


def one_hot_sparse(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """The non-zero cells of a one-hot table as (id, feature, value) rows,
    feature ``{col}_{value}`` (O49): a narrow projection for vocabularies of
    any size, none of which reaches the driver."""
    casted = df.select(id_col, *[qcol(c).cast("string").alias(c) for c in columns])
    return (casted.unpivot([id_col], [qcol(c) for c in columns], "column", "level")
            .filter(F.col("level").isNotNull())
            .select(id_col, F.concat("column", F.lit("_"), "level").alias("feature"), F.lit(1).alias("value")))


def apply_one_hot(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """Replace each encoded column by 0/1 columns ``{col}_{value}`` (all
    levels kept; a missing value is all zeros), placed after the others.
    Their column metadata marks them, so later steps know them by kind."""
    keep = [qcol(c) for c in df.columns if c not in levels]
    dummies = []
    for c in df.columns:
        if c in levels:
            for v in levels[c]:
                dummies.append(F.when(F.col(c).cast("string") == F.lit(v), F.lit(1)).otherwise(F.lit(0))
                               .alias(f"{c}_{v}", metadata=INDICATOR))
    return df.select(*keep, *dummies)


def indicator_columns(df: DataFrame) -> list[str]:
    """The 0/1 columns that one-hot encoding made, by their metadata (which
    selections, joins and parquet tables keep)."""
    return [f.name for f in df.schema.fields if f.metadata.get("indicator")]


def one_hot(df: DataFrame, exclude: list[str] = ()) -> DataFrame:
    """One-hot every non-numeric, non-boolean column except ``exclude``."""
    columns = [f.name for f in df.schema.fields
               if not isinstance(f.dataType, (T.NumericType, T.BooleanType)) and f.name not in set(exclude)]
    return apply_one_hot(df, fit_one_hot(df, columns))


def label_encode(df: DataFrame, column: str, out_col: str | None = None) -> DataFrame:
    """Code = rank of the value among the sorted distinct values, from 0.
    The distinct values are ranked by a distributed ordered pass and joined
    back, so the vocabulary never goes through the driver."""
    out_col = out_col or column
    values = df.select(F.col(column).alias("_v")).filter(F.col("_v").isNotNull()).distinct()
    codes = running_totals(values, order=["_v"]).select("_v", F.col("n_before").cast("int").alias("_code"))
    joined = df.join(codes, df[column].eqNullSafe(codes["_v"]), "left")
    return joined.drop("_v", *([column] if out_col == column else [])) \
        .withColumnRenamed("_code", out_col)


def equal_width_bins(df: DataFrame, column: str, n_bins: int = 5, out_col: str | None = None,
                     label_prefix: str = "bin") -> DataFrame:
    """Equal-width bins over [min, max], right-closed (O43): a value on an
    inner edge falls in the lower bin; a constant column is widened by 0.1 %
    on both sides first.  The label is ``{label_prefix}{index}`` (0-based);
    a missing value stays missing.  Min and max come from a one-row
    aggregate joined by broadcast, so the whole operator is one plan."""
    out_col = out_col or f"{column}_group"
    x = F.col(column)
    stats = df.agg(F.min(column).alias("_mn0"), F.max(column).alias("_mx0"))
    mn0, mx0 = F.col("_mn0"), F.col("_mx0")
    widen_lo = F.when(mn0 != 0, F.lit(0.001) * F.abs(mn0)).otherwise(F.lit(0.001))
    widen_hi = F.when(mx0 != 0, F.lit(0.001) * F.abs(mx0)).otherwise(F.lit(0.001))
    stats = stats.select(
        F.when(mn0 == mx0, mn0 - widen_lo).otherwise(mn0).cast("double").alias("_mn"),
        F.when(mn0 == mx0, mx0 + widen_hi).otherwise(mx0).cast("double").alias("_mx"))
    step = (F.col("_mx") - F.col("_mn")) / F.lit(float(n_bins))
    expr = None
    for i in range(1, n_bins):
        edge = F.lit(float(i)) * step + F.col("_mn")
        label = F.lit(f"{label_prefix}{i - 1}")
        expr = F.when(x <= edge, label) if expr is None else expr.when(x <= edge, label)
    last = F.lit(f"{label_prefix}{n_bins - 1}")
    expr = last if expr is None else expr.otherwise(last)
    binned = df.crossJoin(F.broadcast(stats)).withColumn(out_col, F.when(x.isNull(), F.lit(None)).otherwise(expr))
    return binned.drop("_mn", "_mx")
