"""running_totals against a plain window, on skewed and single-group data."""

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from outcomelab.operators.ordered import running_totals


def _data(spark, n=3000):
    # group 0 holds about a third of the rows (hot key)
    return spark.range(0, n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 11).alias("g"),
        (F.xxhash64("id") % 50).alias("v"),
        (F.col("id") % 4 == 0).cast("int").alias("w"))


def _mismatches(got, ref):
    return got.join(ref, "id").filter(
        (F.col("n_before") != F.col("n_ref")) | (F.col("before_w") != F.col("s_ref"))).count()


def test_grouped_matches_window(spark):
    df = _data(spark)
    got = running_totals(df, order=["v", "id"], group_cols=["g"], sum_cols=["w"], num_partitions=7)
    w = W.partitionBy("g").orderBy("v", "id")
    ref = df.select("id", (F.row_number().over(w) - 1).alias("n_ref"),
                    F.coalesce(F.sum("w").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("s_ref"))
    assert got.count() == df.count()
    assert _mismatches(got, ref) == 0


def test_global_descending_matches_window(spark):
    df = _data(spark)
    got = running_totals(df, order=[F.col("v").desc(), "id"], sum_cols=["w"], num_partitions=5)
    w = W.orderBy(F.col("v").desc(), "id")
    ref = df.select("id", (F.row_number().over(w) - 1).alias("n_ref"),
                    F.coalesce(F.sum("w").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("s_ref"))
    assert _mismatches(got, ref) == 0


def test_one_group_across_all_partitions(spark):
    df = spark.range(0, 2000).withColumn("g", F.lit("only"))
    got = running_totals(df, order=["id"], group_cols=["g"], num_partitions=6)
    assert got.filter(F.col("n_before") != F.col("id")).count() == 0


def test_partition_count_invariance(spark):
    df = _data(spark, 1500)
    a = running_totals(df, order=["v", "id"], group_cols=["g"], sum_cols=["w"], num_partitions=2)
    b = running_totals(df, order=["v", "id"], group_cols=["g"], sum_cols=["w"], num_partitions=9)
    cols = ["id", "n_before", "before_w"]
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0


def test_null_sums_add_nothing_whatever_the_partitioning(spark):
    from outcomelab.operators.ordered import running_totals
    df = spark.createDataFrame([(i, "e", None if i == 2 else 1) for i in range(1, 7)], "id long, e string, y long")
    for n in (1, 2, 7):
        got = running_totals(df, order=["id"], group_cols=["e"], sum_cols=["y"], num_partitions=n).collect()
        assert [r["before_y"] for r in sorted(got, key=lambda r: r["id"])] == [0, 1, 1, 2, 3, 4]


def test_packed_checkpoint_keeps_partitions_and_order(spark):
    """A few rows are checkpointed, not one for each of the 5,000; empty partitions stay empty."""
    from outcomelab.operators.ordered import PID, sorted_checkpoint, unpacked
    df = spark.range(5000).selectExpr("id", "(id * 7919) % 5000 AS x", "if(id % 5 = 0, null, cast(id AS string)) AS s")
    packed = sorted_checkpoint(df, ["x"], 4, True)
    assert packed.count() <= 8 and packed.columns == [PID, "_rows"]
    plain = sorted_checkpoint(df, ["x"], 4)

    def same(batches):
        yield from batches

    got = packed.mapInArrow(unpacked(same), plain.schema)
    rows = got.collect()      # range bounds are sampled anew, so partitions may end elsewhere
    assert [r[:-1] for r in rows] == [r[:-1] for r in plain.collect()]
    assert [r[PID] for r in rows] == sorted(r[PID] for r in rows) and {r[PID] for r in rows} == {0, 1, 2, 3}
    assert got.where("s IS NULL").count() == 1000
    assert sorted_checkpoint(df.where("id < 0"), ["x"], 4, True).mapInArrow(unpacked(same), plain.schema).count() == 0
