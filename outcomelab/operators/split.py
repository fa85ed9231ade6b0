"""Date filters and the train/dev split.

A split is two scalars, not an id list: dev is every row at or after a
boundary (date, id) pair in the chosen order, so "is this row dev / train"
is a plain predicate that Catalyst can push down and no id list is ever
collected or joined.  Finding the boundary costs one per-date aggregate, an
ordered pass over its rows (timestamps may be as many as the table's rows)
and an ordered pass over the rows of the single boundary date.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelab.functions.columns import scatter
from outcomelab.operators.ordered import running_totals
from outcomelab.session import materialize

_BUCKET_SHIFT = 15      # 31-bit scatter: 65,536 buckets at any input size


def date_floor(df: DataFrame, date_col: str, min_date: str) -> DataFrame:
    """Keep rows on or after ``min_date``; missing dates drop."""
    return df.filter(F.col(date_col) >= F.lit(min_date).cast("date"))


@dataclass(frozen=True)
class Split:
    """Chronological (or hashed) split described by its boundary."""
    id_col: str
    date_col: str
    order: str                 # "date" or "hash"
    boundary: tuple | None     # first dev row in the order, None = no dev rows
    recent_from: str | None = None
    seed: int = 424242
    n_dev: int = 0
    n_total: int = 0

    def key(self) -> list[Column]:
        if self.order == "date":
            return [F.col(self.date_col), F.col(self.id_col)]
        return [scatter(self.id_col, self.seed), F.col(self.id_col)]

    def is_dev(self) -> Column:
        if self.boundary is None:
            return F.lit(False)
        (k1, k2), (b1, b2) = self.key(), self.boundary
        return (k1 > F.lit(b1)) | ((k1 == F.lit(b1)) & (k2 >= F.lit(b2)))

    def is_train(self) -> Column:
        cond = ~self.is_dev()
        if self.recent_from:
            cond = cond & (F.col(self.date_col) >= F.lit(self.recent_from).cast("date"))
        return cond

    def name(self) -> Column:
        """'dev', 'train' or 'old' (train rows removed by the recent cut)."""
        return (F.when(self.is_dev(), F.lit("dev"))
                .when(self.is_train(), F.lit("train"))
                .otherwise(F.lit("old")))

    def rows(self, df: DataFrame, split: str) -> DataFrame:
        """Rows of one split: 'train', 'dev' or 'all' (O18/O19/O65)."""
        if split == "train":
            return df.filter(self.is_train())
        if split == "dev":
            return df.filter(self.is_dev())
        if split == "all":
            return df
        raise ValueError(f"unknown split {split!r}: use 'train', 'dev' or 'all'")


def _dev_count(share: float | int, n: int) -> int:
    if isinstance(share, float) and 0.0 < share < 1.0:
        return min(n, math.ceil(share * n))
    k = int(share)
    if k < 0 or k > n:
        raise ValueError(f"dev size {k} outside 0..{n}")
    return k


def make_split(df: DataFrame, id_col: str = "id", date_col: str = "d",
               dev_share: float | int = 0.2, shuffle: bool = False, seed: int = 424242,
               recent_from: str | None = None) -> Split:
    """Train/dev split (O64): the last ``dev_share`` of rows (fraction, or an
    absolute count) in (date, id) order are dev; with ``shuffle`` the order is
    a seeded integer scatter of the id instead.  ``recent_from`` removes older
    rows from train only (O10)."""
    rows = df.select(id_col, date_col)
    order = "hash" if shuffle else "date"
    if shuffle:
        # one row per bucket of leading hash bits; only the bucket that holds
        # the boundary is ever put in order
        bucket = F.shiftright(scatter(id_col, seed), _BUCKET_SHIFT)
        sizes = {r["b"]: r["c"] for r in
                 rows.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("c")).collect()}
        n = sum(sizes.values())
    else:
        per_date = materialize(rows.groupBy(date_col).agg(F.count(F.lit(1)).alias("_c")), "date_counts")
        n = per_date.agg(F.coalesce(F.sum("_c"), F.lit(0))).first()[0]
    n_dev = _dev_count(dev_share, n)
    base = Split(id_col, date_col, order, None, recent_from, seed, n_dev, n)
    if n_dev == 0:
        return base
    if shuffle:
        need = n_dev
        for edge in sorted(sizes, reverse=True):
            if need <= sizes[edge]:
                break
            need -= sizes[edge]
        inside = rows.filter(bucket == edge).select(scatter(id_col, seed).alias("_h"), id_col)
        ranked = running_totals(inside, order=[F.col("_h").desc(), F.col(id_col).desc()])
        b = ranked.filter(F.col("n_before") == need - 1).select("_h", id_col).first()
        return Split(id_col, date_col, order, (b[0], b[1]), recent_from, seed, n_dev, n)
    # rows per date, counted from the end
    from_end = running_totals(per_date, order=[F.col(date_col).desc()], sum_cols=["_c"])
    before = F.col("before__c")
    b = from_end.filter((before < n_dev) & (before + F.col("_c") >= n_dev)).select(date_col, before.alias("after")).first()
    bd, after = b[date_col], int(b["after"])
    need = n_dev - after            # dev rows taken from the boundary date, largest ids first
    day = rows.filter(F.col(date_col) == F.lit(bd)).select(id_col)
    ranked = running_totals(day, order=[F.col(id_col).desc()])
    bid = ranked.filter(F.col("n_before") == need - 1).select(id_col).first()[0]
    return Split(id_col, date_col, order, (bd, bid), recent_from, seed, n_dev, n)
