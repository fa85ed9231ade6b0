"""The neighbour estimator's orders: what they carry, and what they leave on the disk."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from outcomelab.operators import info
from outcomelab.session import ensure_checkpoint_dir

NAMES = ["a", "b", "c"]


def _frame(spark, n=900, twice=False):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, n)
    rows = [(i, bool(y[i]), float(rng.normal() + y[i]), float(rng.integers(0, 3)), float(i % 50)) for i in range(n)]
    return spark.createDataFrame(rows + (rows[::9] if twice else []), "id long, y boolean, a double, b double, c double")


def _values(df):
    return {r.feature: r.mutual_information for r in df.collect()}


def _left(spark):
    """Bytes of the checkpoints and tables in the shared folder."""
    top = ensure_checkpoint_dir(spark).removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(top) for f in files)


@pytest.mark.parametrize("twice", [False, True])
def test_orders_carry_ids_only_where_these_repeat(spark, monkeypatch, twice):
    df = _frame(spark, twice=twice)
    want = _values(info.mi_from_points(info.jittered_points(df, NAMES, "y")))      # with ids, each point by itself
    carried, real = [], info.sorted_checkpoint
    monkeypatch.setattr(info, "sorted_checkpoint", lambda d, *a: carried.append("_id" in d.columns) or real(d, *a))
    assert _values(info.mi_continuous(df, NAMES, "y")) == want      # exactly
    assert carried == [twice, twice]


def test_features_are_taken_some_at_a_time_with_the_same_result(spark, monkeypatch):
    pts = info.jittered_points(_frame(spark), NAMES, "y").drop("_id").checkpoint(eager=True)
    want = _values(info.mi_from_points(pts, repeated=False))
    sizes, real = [], info.sorted_checkpoint
    monkeypatch.setattr(info, "sorted_checkpoint", lambda d, *a: sizes.append((d.count(), a[1])) or real(d, *a))
    assert _values(info.mi_from_points(pts, repeated=False, bucket_rows=100, group_rows=1800)) == want
    assert sizes == [(1800, 18), (1800, 18), (900, 9), (900, 9)]      # and every task's share is bounded, in both orders


def test_ordered_points_do_not_stay_on_the_disk(spark):
    pts = info.jittered_points(_frame(spark, 20_000), NAMES, "y").checkpoint(eager=True)
    before = _left(spark)
    assert info.mi_from_points(pts, repeated=False).count() == 3
    assert _left(spark) - before < 100_000      # 60,000 points of 12 and more bytes were ordered twice


def test_repeats(spark):
    df = spark.createDataFrame([(1, True), (2, False), (2, None), (None, True)], "id long, y boolean")
    assert not info.repeats(df, "y") and info.repeats(df.withColumn("y", F.lit(True)), "y")
    assert info.repeats(df.union(df.where("id IS NULL")), "y")
