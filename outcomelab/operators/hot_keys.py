"""Joining a statistic of groups back to their rows without a hot task.

After ``groupBy(key).agg(...)`` a join on the key sends all rows of a key to one
task, and AQE does not split such a task when an aggregate stands between the
shuffle and the join.  :func:`join_groups` takes the heavy keys apart: a key
with more than 1 / (``HEAVY`` * partitions) of the rows is joined by broadcast
(there are fewer than ``HEAVY`` * partitions of them, whatever the data), all
others by the usual shuffle, where no task can then meet a heavy key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelab.session import materialize

HEAVY = 4
LEAST = 64    # rows a heavy key has at least


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str] | str, size_col: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``groups``, which has one row per key and the number of
    rows of that key as ``size_col``.  ``how`` is inner or left; rows
    with a missing key match nothing, as in any equi-join."""
    if how not in ("inner", "left"):
        raise ValueError(f"join_groups does inner and left joins, not {how!r}")
    keys = [keys] if isinstance(keys, str) else list(keys)
    groups = materialize(groups, "groups")
    slots = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = groups.agg(F.sum(size_col)).first()[0] or 0
    is_heavy = F.col(size_col) > max(total // (HEAVY * slots), LEAST)
    heavy, light = groups.where(is_heavy), groups.where(~is_heavy)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    cold = rows.where(known)
    parts = []
    if heavy.take(1):
        parts.append(cold.join(F.broadcast(heavy), keys, "inner"))
        cold = cold.join(F.broadcast(heavy.select(*keys)), keys, "left_anti")
    parts.append(cold.join(light, keys, how))
    if how == "left":   # rows without a key need no partner: they stay where they are
        extra = [F.lit(None).cast(f.dataType).alias(f.name) for f in groups.schema.fields if f.name not in keys]
        parts.append(rows.where(~known).select("*", *extra))
    cols = [*rows.columns, *[c for c in groups.columns if c not in keys]]
    return reduce(DataFrame.unionByName, [p.select(*cols) for p in parts])
