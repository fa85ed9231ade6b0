"""Key audits, hot-key joins, bucketed assembly, sparse designs and CSV scans."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from outcomelab.operators import design, keys
from outcomelab.operators.hot_keys import join_groups
from outcomelab.session import materialize, materialize_by_key, release
from outcomelab.sources.csv_scan import scan_csv


# -- keys ------------------------------------------------------------------

def test_audit_reports_every_side(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    clean = spark.createDataFrame([(1,), (3,)], "k int")
    got = {r["side"]: r.asDict() for r in keys.audit_keys({"left": left, "clean": clean, "empty": clean.limit(0)}, "k").collect()}
    assert got["left"] == {"side": "left", "rows": 6, "keys": 2, "repeated_keys": 1, "extra_rows": 2, "largest": 3, "missing_keys": 2}
    assert got["clean"] == {"side": "clean", "rows": 2, "keys": 2, "repeated_keys": 0, "extra_rows": 0, "largest": 1, "missing_keys": 0}
    assert got["empty"]["rows"] == 0 and got["empty"]["largest"] == 0
    two = keys.audit_keys({"left": left}, ["k", "v"]).first()
    assert (two["keys"], two["repeated_keys"], two["missing_keys"]) == (3, 1, 2)


def test_strict_joins_fail_on_repeated_keys(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    once = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    assert sorted((r.k or 0, r.v or "") for r in keys.left_join_one(left, once, "k").collect()) == [(0, ""), (1, "x"), (2, "y"), (2, "y")]
    keys.require_unique({"once": once, "nulls": left.where("k is null")}, "k")
    with pytest.raises(keys.DuplicateKeys, match="right.*1 keys repeat, up to 2 times, 1 rows"):
        keys.left_join_one(once, left, "k")


def test_assembly_can_be_strict(spark):
    from outcomelab.plans import dataset as DS
    from outcomelab.plans.prepare import fixture_study
    st = fixture_study(spark, SF_SMALL)
    one = st.items.select("id", F.col("price").alias("p"))
    sets = {"a": one, "b": one.select("id", F.col("p").alias("q"))}
    n = DS.assemble(st, sets, "train", ("a", "b"), strict=True).count()
    assert n == DS.assemble(st, sets, "train", ("a", "b")).count() > 0
    sets["b"] = sets["b"].unionByName(sets["b"].limit(1))
    with pytest.raises(keys.DuplicateKeys, match="b: 1 keys"):
        DS.assemble(st, sets, "train", ("a", "b"), strict=True)


# -- hot keys ------------------------------------------------------------------

@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_groups_equals_a_plain_join(spark, how):
    rows = spark.range(6000).select(
        "id", F.when(F.col("id") % 10 < 6, 7).when(F.col("id") % 10 == 9, None).otherwise(F.col("id") % 900).alias("k"))
    groups = rows.where("k <> 8").groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("m"))
    want = sorted(map(tuple, rows.join(groups, "k", how).select("id", "k", "n", "m").collect()))
    got = join_groups(rows, groups, "k", "n", how)
    assert got.columns == ["id", "k", "n", "m"] and sorted(map(tuple, got.collect())) == want
    assert join_groups(rows.limit(0), groups.limit(0), "k", "n", how).count() == 0
    with pytest.raises(ValueError):
        join_groups(rows, groups, "k", "n", "full")


def test_heavy_keys_take_no_shuffle(spark):
    rows = materialize(spark.range(6000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k")), "hot")
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = join_groups(rows, groups, "k", "n").withColumn("task", F.spark_partition_id())
        tasks = [r["count"] for r in out.where("k <> 0").groupBy("task").count().collect()]
        hot = out.where("k = 0")
        assert hot.count() == 2000
        assert max(tasks) < 3 * 4000 / len(tasks)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# -- bucketed assembly -----------------------------------------------------------

def _exchanges(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    return final.count("Exchange hashpartitioning"), final


def test_feature_sets_are_assembled_without_an_exchange(spark):
    from outcomelab.plans import dataset as DS
    from outcomelab.plans.prepare import fixture_study
    from outcomelab.plans.sweep import FeatureCache
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    try:
        st = fixture_study(spark, SF_SMALL)
        cache = FeatureCache(st, ["label", "flag_big"])
        n, plan = _exchanges(DS.assemble(st, cache.sets("label"), "train"))
        assert n == 0 and plan.count("SortMergeJoin") >= 4, plan
        train, dev = DS.train_test(st, cache.sets("flag_big"), "flag_big", features=["labor", "school_pct_exciting"])
        for df in (train, dev):
            n, plan = _exchanges(df)
            assert n == 0 and "PushedFilters" in plan, plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_tables_with_a_row_per_item_are_never_broadcast(spark):
    """Also where their estimated size is below Spark's broadcast limit, as here."""
    from outcomelab.plans import dataset as DS
    from outcomelab.plans.prepare import fixture_study
    from outcomelab.plans.sweep import FeatureCache
    st = fixture_study(spark, SF_SMALL)
    sets = FeatureCache(st, ["label"]).sets("label")
    frames = [DS.assemble(st, sets, "train"), DS.labels(st, "dev", "label"),
              *DS.train_test(st, sets, "label", features=["labor", "school_pct_exciting"])]
    for df in frames:
        n, plan = _exchanges(df)
        assert n == 0 and "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan, plan


def test_cache_builds_only_the_sets_that_are_read(spark, monkeypatch):
    from outcomelab.plans import sweep as SW
    from outcomelab.plans.prepare import fixture_study
    built = []
    real = SW.materialize_by_key
    monkeypatch.setattr(SW, "materialize_by_key", lambda df, name, key: built.append(name) or real(df, name, key))
    cache = SW.FeatureCache(fixture_study(spark, SF_SMALL), ["label"])
    assert list(cache.sets("label", ("project",))) == ["project"] and built == ["project_features"]
    assert list(cache.sets("label")) == list(SW.FT.ENTITIES)
    assert sorted(built) == ["geo_features", "project_features", "school_features", "teacher_features"]


def test_released_tables_are_gone(spark):
    import os
    df = spark.range(10)
    plain, bucketed = materialize(df, "t"), materialize_by_key(df, "t", "id")
    assert plain.count() == bucketed.count() == 10
    paths = [p._written_to.removeprefix("file:") for p in (plain, bucketed)]
    assert all(os.path.isdir(p) for p in paths)
    release(plain, bucketed, df)
    assert not any(os.path.exists(p) for p in paths)
    assert not spark.catalog.tableExists(bucketed._table)


# -- sparse designs ---------------------------------------------------------------

def test_sparse_rows_hold_the_cells(spark):
    cells = spark.createDataFrame([(1, "b", 1.0), (1, "a", 2.0), (2, "c", 0.0), (3, "c", 1.5), (3, "c", 1.0), (3, "zz", 9.0),
                                   (4, None, 1.0), (None, "a", 1.0)], "id int, feature string, value double")
    index = design.feature_index(cells.where("feature <> 'zz' OR feature IS NULL"))
    assert sorted(map(tuple, index.collect())) == [("a", 0), ("b", 1), ("c", 2)]
    ids = spark.createDataFrame([(1,), (2,), (3,), (5,)], "id int")
    got = {r.id: r.features for r in design.sparse_rows(cells, index, "id", ids=ids).collect()}
    assert set(got) == {1, 2, 3, 5}
    assert all(v.size == 3 for v in got.values())
    assert got[1].toArray().tolist() == [2.0, 1.0, 0.0] and got[3].toArray().tolist() == [0.0, 0.0, 2.5]
    assert got[2].numNonzeros() == 0 and got[5].numNonzeros() == 0
    empty = design.sparse_rows(cells.limit(0), design.feature_index(cells.limit(0)), "id", ids=ids).collect()
    assert [r.features.size for r in empty] == [0] * 4


def test_a_fit_on_sparse_rows_equals_the_dense_fit(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    rng = np.random.default_rng(2)
    rows = [(i, f"v{rng.integers(0, 40):02d}", int(rng.random() < 0.5)) for i in range(800)]
    df = spark.createDataFrame(rows, "id int, c string, y int").withColumn("y", F.col("y").cast("double"))
    cells = df.select("id", "c").withColumn("feature", F.col("c")).withColumn("value", F.lit(1))
    index = design.feature_index(cells)
    names = [r.feature for r in index.orderBy("index").collect()]
    sparse = design.sparse_rows(cells, index).join(df.select("id", "y"), "id")
    dense = VectorAssembler(inputCols=names, outputCol="features").transform(
        df.select("id", "y", *[(F.col("c") == n).cast("int").alias(n) for n in names]))
    fit = LogisticRegression(labelCol="y", regParam=0.01, standardization=False, maxIter=200, tol=1e-9).fit
    a, b = fit(sparse), fit(dense)
    assert np.allclose(a.coefficients.toArray(), b.coefficients.toArray(), atol=1e-6) and abs(a.intercept - b.intercept) < 1e-6


# -- CSV ------------------------------------------------------------------------------

def _file(tmp_path, name, text):
    (tmp_path / name).write_text(text, encoding="utf-8")
    return str(tmp_path / name)


def test_csv_types_come_from_all_rows(spark, tmp_path):
    body = "i,big,d,day,ts,flag,text,none,mixed\n"
    body += "\n".join(f'{k},{k * 10 ** 12},{k}.5,2020-01-{k:02d},2020-01-01 00:00:{k:02d},{"tf"[k % 2]},"a, ""b"" {k}",,{k}'
                      for k in range(1, 30)) + "\n"
    body += ',,1e-3,,,,"x",,not a number\n' + '5,6,7\n' + '1,2,3,4,5,6,7,8,9,10\n'
    scan = scan_csv(spark, _file(tmp_path, "a.csv", body))
    assert scan.types == {"i": "int", "big": "bigint", "d": "double", "day": "date", "ts": "timestamp", "flag": "boolean",
                          "text": "string", "none": "string", "mixed": "string"}
    rows = scan.rows.collect()
    assert len(rows) == 30 and sorted(r.line for r in scan.quarantine.collect()) == ["1,2,3,4,5,6,7,8,9,10", "5,6,7"]
    one = next(r for r in rows if r.i == 3)
    assert (one.big, one.d, one.day, one.flag, one.text, one.none) == (3 * 10 ** 12, 3.5, dt.date(2020, 1, 3), False, 'a, "b" 3', None)
    assert next(r for r in rows if r.i is None).d == 0.001
    # malformed rows stay out whatever a query selects
    assert scan.rows.select("i").where("i >= 0").count() == 29 and scan.rows.count() == 30 and scan.quarantine.count() == 2


def test_csv_without_a_header_and_odd_files(spark, tmp_path):
    path = _file(tmp_path, "b.csv", "1,007,+5,2020-02-30,99999999999999999999\n2,-3,-6,2020-02-28,1\n")
    scan = scan_csv(spark, path, ["a", "b.c", "d", "day", "huge"])
    assert scan.types == {"a": "int", "b.c": "int", "d": "int", "day": "string", "huge": "double"}
    assert sorted(r["b.c"] for r in scan.rows.collect()) == [-3, 7]
    only = scan_csv(spark, _file(tmp_path, "c.csv", "x,y\n"))
    assert only.types == {"x": "string", "y": "string"} and only.rows.collect() == [] and only.quarantine.count() == 0
