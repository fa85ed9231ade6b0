"""Running counts and sums in a total order, without a one-task window.

``Window.partitionBy(key).orderBy(...)`` puts every row of a key into one
task, and an unpartitioned window puts the whole table into one task.  Both
break when one key holds a large share of the rows.  ``running_totals``
computes the same numbers (rows before, sums before, restarting per group)
in three distributed steps:

1. range-partition on (group, order) and sort inside partitions; the order
   columns end in a unique id, so equal keys are split across partitions
   like any other range; the result is checkpointed (reliable folder from
   ``spark.checkpoint.dir``) so both passes see identical partitions;
2. one small summary row per partition (count, sums, first group key, the
   trailing run of the last key) is collected: its size is bounded by the
   partition count, not by the data;
3. the driver turns the summaries into the carry-in of every partition and
   a narrow Arrow pass adds per-row offsets.  No further shuffle.

Used by: past entity performance (O35/O36), the chronological split
boundary (O64), exact medians (O28, O51) and top-fraction precision (O69).
Mutual information (O68) uses its sorted partitions.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from outcomelab.session import ensure_checkpoint_dir

PID = "_pid"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _key_of(row_values) -> str:
    out = []
    for v in row_values:
        if hasattr(v, "item"):
            v = v.item()
        out.append(v)
    return json.dumps(out, default=str)


def _runs(pdf: pd.DataFrame, group_cols: list[str], prev_key: str | None):
    """Run index per row (0 = continues ``prev_key``), and the batch's first key."""
    n = len(pdf)
    if not group_cols:
        first = "[]"
        cont = prev_key == first
        run = np.zeros(n, dtype=np.int64) if cont else np.ones(n, dtype=np.int64)
        return run, first
    changed = np.zeros(n, dtype=bool)
    for g in group_cols:
        a = pdf[g].to_numpy()
        changed[1:] |= a[1:] != a[:-1]
    first = _key_of([pdf[g].iloc[0] for g in group_cols])
    changed[0] = first != prev_key
    return np.cumsum(changed), first


def _within_runs(run: np.ndarray, vals: list[np.ndarray]):
    """Position of each row inside its run, and per value array the sum of
    the earlier rows of the run (vectorised: runs are contiguous)."""
    n = len(run)
    pos = np.arange(n)
    is_start = np.ones(n, dtype=bool)
    is_start[1:] = run[1:] != run[:-1]
    start = np.maximum.accumulate(np.where(is_start, pos, 0))
    befores = []
    for v in vals:
        before_all = np.cumsum(v) - v          # sum of all earlier rows of the batch
        befores.append(before_all - before_all[start])
    return pos - start, befores


def _pack(batches):
    options = pa.ipc.IpcWriteOptions(compression="zstd")     # checkpoints are written as they are
    for b in batches:
        if b.num_rows:
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, b.schema, options=options) as stream:
                stream.write_batch(b)
            yield pa.RecordBatch.from_arrays([b.column(PID).slice(0, 1), pa.array([out.getvalue().to_pybytes()], pa.binary())],
                                             [PID, "_rows"])


def unpacked(step):
    """``step`` over the record batches of a packed :func:`sorted_checkpoint`, for ``mapInArrow``."""
    def run(batches):
        return step(b for packed in batches for rows in packed.column("_rows") for b in pa.ipc.open_stream(rows.as_buffer()))
    return run


def sorted_checkpoint(df: DataFrame, order: list, num_partitions: int | None = None, packed: bool = False) -> DataFrame:
    """Range-partition + sort by ``order`` and checkpoint, with the partition
    index materialised as ``_pid``.  With ``packed``, a row of the result is an Arrow
    batch of rows (:func:`unpacked` reads them): a checkpoint writes and reads
    its rows one by one, which for numbers costs more than the work on them."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cols = [_as_col(c) for c in order]
    ranged = (df.repartitionByRange(n, *cols)
              .sortWithinPartitions(*cols)
              .withColumn(PID, F.spark_partition_id()))
    if packed:
        ranged = ranged.mapInArrow(_pack, f"{PID} int, _rows binary")
    return ranged.checkpoint(eager=True)


def running_totals(df: DataFrame, order: list, group_cols: list[str] = (),
                   sum_cols: list[str] = (), count_name: str = "n_before",
                   sum_prefix: str = "before_", num_partitions: int | None = None) -> DataFrame:
    """Add ``count_name`` (rows strictly before, within the group) and
    ``sum_prefix + c`` (sum of ``c`` over those rows) for each ``sum_cols``.

    A NULL in a summed column adds nothing.  ``order`` must make the order
    total (end it with a unique id).  Group
    key columns must be non-null; the order is (group_cols, order).
    """
    group_cols = list(group_cols)
    sum_cols = list(sum_cols)
    src = df.select("*", *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_w{i}") for i, c in enumerate(sum_cols)])
    wcols = [f"_w{i}" for i in range(len(sum_cols))]
    ordered = sorted_checkpoint(src, [*group_cols, *order], num_partitions)

    # -- pass 1: one summary row per partition (JVM aggregate) ------------
    # rows per (partition, group) are combined map-side; each partition then
    # reports its first and last group key (struct order = the sort order),
    # its row count and the count / sums of its last group.
    per_group = ordered.groupBy(PID, *group_cols).agg(
        F.count(F.lit(1)).alias("_gn"), *[F.sum(w).alias(f"_g{w}") for w in wcols])
    key = F.struct(*group_cols) if group_cols else F.struct(F.lit(0).alias("_k"))
    last = F.struct(F.col("_gn"), *[F.col(f"_g{w}") for w in wcols])
    summary = per_group.groupBy(PID).agg(
        F.sum("_gn").alias("n"), F.min(key).alias("first"), F.max(key).alias("lastkey"),
        F.max_by(last, key).alias("last"))
    rows = []
    for r in summary.collect():
        rows.append({"pid": r[PID], "n": r["n"],
                     "first_key": _key_of(list(r["first"])) if group_cols else "[]",
                     "last_key": _key_of(list(r["lastkey"])) if group_cols else "[]",
                     "last_n": r["last"]["_gn"],
                     **{f"last_{w}": float(r["last"][f"_g{w}"] or 0.0) for w in wcols}})
    rows = sorted(rows, key=lambda r: r["pid"])

    # -- driver: carry-in of the open run at the start of each partition ---
    carry = {}
    open_key, open_n, open_sums = None, 0, np.zeros(len(wcols))
    for r in rows:
        last_sums = np.array([r[f"last_{w}"] for w in wcols], dtype=float)
        carry[r["pid"]] = (open_key, open_n, open_sums.tolist())
        single_run = r["first_key"] == r["last_key"] and r["last_n"] == r["n"]
        if single_run and r["first_key"] == open_key:
            open_n, open_sums = open_n + r["last_n"], open_sums + last_sums
        else:
            open_key, open_n, open_sums = r["last_key"], r["last_n"], last_sums

    # -- pass 2: per-row offsets, narrow --------------------------------
    out_fields = list(ordered.schema.fields) + [T.StructField(count_name, T.LongType())] + \
        [T.StructField(sum_prefix + c, T.DoubleType()) for c in sum_cols]
    out_schema = T.StructType(out_fields)

    def assign(batches):
        key, state_n, state_sums = None, 0, None
        started = False
        for pdf in batches:
            if len(pdf) == 0:
                continue
            if not started:
                key, state_n, sums = carry.get(int(pdf[PID].iloc[0]), (None, 0, [0.0] * len(wcols)))
                state_sums = np.array(sums, dtype=float)
                started = True
            run, _ = _runs(pdf, group_cols, key)
            vals = [pdf[w].to_numpy(dtype=float) for w in wcols]
            idx, befores = _within_runs(run, vals)
            cont = run == 0
            pdf[count_name] = idx + np.where(cont, state_n, 0)
            for i, c in enumerate(sum_cols):
                pdf[sum_prefix + c] = befores[i] + np.where(cont, state_sums[i], 0.0)
            key = _key_of([pdf[g].iloc[-1] for g in group_cols]) if group_cols else "[]"
            state_n = int(pdf[count_name].iloc[-1]) + 1
            state_sums = np.array([pdf[sum_prefix + c].iloc[-1] + pdf[w].iloc[-1]
                                   for w, c in zip(wcols, sum_cols)], dtype=float)
            yield pdf

    return ordered.mapInPandas(assign, out_schema).drop(PID, *wcols)
