"""Hand-computed edge cases for downsizing, bins, one-hot, label codes and
imputation (FIXTURES.md section 3)."""

import pytest
from pyspark.sql import functions as F

from outcomelab.operators import encode
from outcomelab.operators.entity import exact_median, group_median_ratio
from outcomelab.operators.impute import impute


def _cats(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, c string")


def test_exact_share_is_strict(spark):
    df = _cats(spark, ["a"] * 5 + ["b"] * 4 + ["c"])
    # cumulative shares .5, .9, 1.0; .9 is not below .9
    assert encode.fit_downsize(df, ["c"], 0.9, 10) == {"c": ["a"]}


def test_dominant_value_keeps_nothing(spark):
    df = _cats(spark, ["a"] * 95 + ["b"] * 5)
    kept = encode.fit_downsize(df, ["c"], 0.9, 10)
    assert kept == {"c": []}
    out = encode.apply_downsize(df, kept)
    assert {r.c for r in out.collect()} == {"Other"}


def test_null_becomes_other_and_shares_ignore_nulls(spark):
    df = _cats(spark, ["a"] * 3 + [None] * 2 + ["b"])
    kept = encode.fit_downsize(df, ["c"], 0.9, 10)
    assert kept == {"c": ["a"]}          # a: 3/4 = .75 < .9; b reaches 1.0
    out = {r.id: r.c for r in encode.apply_downsize(df, kept).collect()}
    assert out[3] == "Other" and out[5] == "Other" and out[0] == "a"


def test_max_items_cuts_prefix(spark):
    df = _cats(spark, ["a"] * 4 + ["b"] * 3 + ["c"] * 2 + ["d"] * 1 + ["e"] * 10)
    assert encode.fit_downsize(df, ["c"], 0.99, 2) == {"c": ["e", "a"]}


def test_frequency_ties_by_value(spark):
    df = _cats(spark, ["y", "x", "y", "x", "z"])
    assert encode.fit_downsize(df, ["c"], 0.9, 10) == {"c": ["x", "y"]}


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(6)], "id long, x double")
    out = {r.id: r.g for r in encode.equal_width_bins(df, "x", 5, "g").collect()}
    # edges 0(-), 1, 2, 3, 4, 5: a value on an inner edge goes to the lower bin
    assert out == {0: "bin0", 1: "bin0", 2: "bin1", 3: "bin2", 4: "bin3", 5: "bin4"}


def test_bins_constant_column_and_null(spark):
    df = spark.createDataFrame([(0, 7.0), (1, 7.0), (2, None)], "id long, x double")
    out = {r.id: r.g for r in encode.equal_width_bins(df, "x", 5, "g").collect()}
    assert out == {0: "bin2", 1: "bin2", 2: None}


def test_one_hot_levels_sorted_and_missing_all_zero(spark):
    df = _cats(spark, ["b", "a", None, "b"])
    out = encode.one_hot(df, exclude=["id"])
    assert out.columns == ["id", "c_a", "c_b"]
    rows = {r.id: (r.c_a, r.c_b) for r in out.collect()}
    assert rows == {0: (0, 1), 1: (1, 0), 2: (0, 0), 3: (0, 1)}


def test_one_hot_sparse_keeps_more_than_a_thousand_levels(spark):
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 10 <> 0 THEN concat('v', id) END AS c")
    out = encode.one_hot_sparse(df, "id", ["c"])
    rows = {(r["id"], r["feature"], r["value"]) for r in out.collect()}
    assert rows == {(i, f"c_v{i}", 1) for i in range(3000) if i % 10}


def test_mean_and_median_widen_integer_columns(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (3, None)], "id long, x long")
    for strategy in ("mean", "median"):
        got = {r["id"]: r["x"] for r in impute(df, {"x": {"strategy": strategy}}).collect()}
        assert got == {1: 2.0, 2: 3.0, 3: 2.5}


def test_for_label_keeps_names_with_separators(spark):
    from outcomelab.plans.features import for_label
    df = spark.createDataFrame([(1, 1, 0, 2.0, 3.0)],
                               "id long, metro_a__b int, metro__x int, school_pct_exciting__p__q double, "
                               "school_pct_exciting__r double")
    assert for_label(df, "p__q").columns == ["id", "metro_a__b", "metro__x", "school_pct_exciting"]


def test_label_encode_sorted_codes(spark):
    df = _cats(spark, ["m", "c", "x", "c", None])
    out = {r.id: r.code for r in encode.label_encode(df, "c", "code").collect()}
    assert out == {0: 1, 1: 0, 2: 2, 3: 0, 4: None}


def test_flag_replace(spark):
    df = spark.createDataFrame([(0, "t"), (1, "f"), (2, None)], "id long, f string")
    assert [r.f for r in encode.replace_flags(df, ["f"]).orderBy("id").collect()] == [True, False, None]


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([(0, True), (1, True), (2, False), (3, False), (4, None)], "id long, b boolean")
    out = impute(df, {"b": {"strategy": "most_frequent"}})
    assert out.filter("id = 4").first().b is False


def test_median_even_and_odd(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([5, 1, 3, 9])], "id long, x double")
    assert exact_median(df, "x").first()["median"] == 4.0
    assert exact_median(df.filter("id < 3"), "x").first()["median"] == 3.0


def test_zero_median_ratio_is_null_not_error(spark):
    df = spark.createDataFrame([(0, "z", 0.0), (1, "z", 0.0), (2, "a", 2.0)], "id long, g string, p double")
    out = {r.id: r.ratio for r in group_median_ratio(df, "p", "g", "id").collect()}
    assert out[0] is None and out[2] == 1.0
    filled = impute(group_median_ratio(df, "p", "g", "id").select("id", "ratio"),
                    {"ratio": {"strategy": "median"}})
    assert {r.ratio for r in filled.collect()} == {1.0}


def test_mode_tie_is_numeric_not_text(spark):
    df = spark.createDataFrame([(0, 10), (1, 10), (2, 9), (3, 9), (4, None)], "id long, v int")
    out = impute(df, {"v": {"strategy": "most_frequent"}})
    assert out.filter("id = 4").first().v == 9


def test_top_values_limit_runs_before_the_shuffle(spark):
    import contextlib
    import io

    rows = [(str(i % 97), "ab"[i % 2]) for i in range(2000)]
    df = spark.createDataFrame(rows, "c string, k string")
    top = encode.top_values(encode.value_counts(df, ["c", "k"]), 3)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        top.explain()
    plan = buf.getvalue()
    partial = plan.find("WindowGroupLimit [column")
    assert "Partial" in plan and partial >= 0
    # the partial limit sits below (after, in the printed tree) the exchange on column
    assert plan.find("Exchange hashpartitioning(column", 0) < plan.rfind(", Partial")
    got = sorted((r.column, r.value, r._rank) for r in top.collect())
    assert [g for g in got if g[0] == "k"] == [("k", "a", 1), ("k", "b", 2)]
    assert len([g for g in got if g[0] == "c"]) == 3
