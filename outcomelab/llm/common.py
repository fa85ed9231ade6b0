"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelab.session import materialize  # noqa: F401  (re-exported)


def text_or_empty(name: str) -> Column:
    """The text column as a string, null counting as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_type(df: DataFrame, name: str) -> str:
    """The id column's type as DDL, for the schema of Arrow passes."""
    return df.schema[name].dataType.simpleString()


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def worker_cache(name: str, make):
    """``make()`` once per Python worker.  The functions here are pickled by
    value, so a module variable would start afresh with every task; a slot in
    ``sys.modules`` lives as long as the worker."""
    slot = sys.modules.setdefault("_outcomelab_worker", types.ModuleType("_outcomelab_worker"))
    if not hasattr(slot, name):
        setattr(slot, name, make())
    return getattr(slot, name)


def null_safe(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Join condition ``left.a <=> right.b and ...``: null keys match null keys."""
    cond = None
    for a, b in pairs:
        c = left[a].eqNullSafe(right[b])
        cond = c if cond is None else cond & c
    return cond
