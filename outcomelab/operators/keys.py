"""Key audits for join chains.

A join that should keep its left rows fans out when its right side repeats a
key, and pandas-like code never notices.  :func:`audit_keys` reports it for
every side of a chain; :func:`require_unique` fails instead.  A side costs one
aggregate over its key columns: repeated keys are combined map-side, so a key
on a third of all rows is one row by the time anything is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeys(ValueError):
    """A join side repeats its key."""


def audit_keys(sides: dict[str, DataFrame], keys: list[str] | str) -> DataFrame:
    """One row per side: rows, distinct non-null keys, keys that repeat, the rows a
    1:1 join would add to (``extra_rows``), the largest repetition, and rows with a
    missing key (which no equi-join matches)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    out = []
    for name, df in sides.items():
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).withColumn("_missing", missing)
        known = ~F.col("_missing")
        out.append(counts.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
            F.count(F.when(known, 1)).alias("keys"),
            F.count(F.when(known & (F.col("_n") > 1), 1)).alias("repeated_keys"),
            F.coalesce(F.sum(F.when(known, F.col("_n") - 1)), F.lit(0)).alias("extra_rows"),
            F.coalesce(F.max(F.when(known, F.col("_n"))), F.lit(0)).alias("largest"),
            F.coalesce(F.sum(F.when(F.col("_missing"), F.col("_n"))), F.lit(0)).alias("missing_keys"))
            .select(F.lit(name).alias("side"), "*"))
    return reduce(DataFrame.unionByName, out)


def require_unique(sides: dict[str, DataFrame], keys: list[str] | str) -> None:
    """Raise :class:`DuplicateKeys`, naming each side that repeats a key."""
    bad = audit_keys(sides, keys).where("repeated_keys > 0").collect()   # one row per side at most
    if bad:
        raise DuplicateKeys("; ".join(
            f"{r['side']}: {r['repeated_keys']} keys repeat, up to {r['largest']} times, {r['extra_rows']} rows too many"
            for r in sorted(bad, key=lambda r: r["side"])))


def left_join_one(left: DataFrame, right: DataFrame, keys: list[str] | str, name: str = "right") -> DataFrame:
    """Left join that fails when ``right`` repeats a key (strict 1:1 lookup)."""
    require_unique({name: right}, keys)
    return left.join(right, keys, "left")
