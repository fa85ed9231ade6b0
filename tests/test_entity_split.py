"""Split boundary, overall and past entity performance on hand-made rows."""

import datetime as dt

from pyspark.sql import functions as F

from outcomelab.operators.entity import overall_performance, past_performance
from outcomelab.operators.split import make_split

D = dt.date


def _items(spark, rows):
    return spark.createDataFrame(rows, "id long, d date, e string, y boolean")


def test_chronological_split_boundary_inside_a_day(spark):
    rows = [(i, D(2020, 1, 1 + i // 4), "e", i % 2 == 0) for i in range(20)]
    df = _items(spark, rows)
    s = make_split(df, dev_share=0.3)          # ceil(6.0) = 6 dev rows: the last 6 by (d, id)
    dev = sorted(r.id for r in df.filter(s.is_dev()).collect())
    assert dev == list(range(14, 20))
    assert df.filter(s.is_train()).count() == 14


def test_absolute_dev_count_and_recent_cut(spark):
    rows = [(i, D(2020, 1, 1) + dt.timedelta(days=i), "e", False) for i in range(10)]
    df = _items(spark, rows)
    s = make_split(df, dev_share=3, recent_from="2020-01-04")
    names = {r.id: r.split for r in df.select("id", s.name().alias("split")).collect()}
    assert [names[i] for i in range(10)] == ["old"] * 3 + ["train"] * 4 + ["dev"] * 3


def test_shuffled_split_size_and_union(spark):
    df = _items(spark, [(i, D(2020, 1, 1), "e", False) for i in range(101)])
    s = make_split(df, dev_share=0.2, shuffle=True)
    assert df.filter(s.is_dev()).count() == 21
    assert df.filter(s.is_dev()).count() + df.filter(s.is_train()).count() == 101


def test_overall_unseen_and_single_day(spark):
    rows = [(0, D(2020, 1, 1), "a", True), (1, D(2020, 1, 1), "a", False), (2, D(2020, 1, 1), "a", True),
            (3, D(2020, 1, 1), "b", True), (4, D(2020, 6, 1), "b", False), (5, D(2021, 1, 1), "b", False),
            (6, D(2022, 1, 1), "c", True)]
    df = _items(spark, rows)
    s = make_split(df, dev_share=1)            # id 6 (entity c) is dev: unseen in train
    out = {r.id: r for r in overall_performance(df, s, "e", "x", "y").collect()}
    # priors over entities with >= 3 rows: a (3, 2, 0.0 years), b (3, 1, 1.0 years)
    pn, pk, py = 3.0, 1.5, 0.5
    assert out[0].x_active_years == 0.0
    assert abs(out[0].x_pct_exciting - (2 + pk) / (3 + pn)) < 1e-12
    assert abs(out[3].x_projects_per_year - (3 + pn) / (1.0 + py)) < 1e-12
    assert out[6].x_num_projects == pn
    assert abs(out[6].x_pct_exciting - pk / pn) < 1e-12
    assert abs(out[6].x_projects_per_year - pn / py) < 1e-12


def test_past_performance_zero_outside_train_and_ties_by_id(spark):
    rows = [(3, D(2020, 1, 1), "a", True), (1, D(2020, 1, 1), "a", True), (2, D(2020, 1, 2), "a", False),
            (4, D(2020, 1, 3), None, True), (5, D(2020, 1, 9), "a", True)]
    df = _items(spark, rows)
    s = make_split(df, dev_share=1)            # id 5 is dev
    out = {r.id: r for r in past_performance(df, s, "e", "t", "y").collect()}
    assert (out[1].t_num_prev_projects, out[3].t_num_prev_projects, out[2].t_num_prev_projects) == (0, 1, 2)
    assert (out[1].t_num_prev_exciting_projects, out[3].t_num_prev_exciting_projects,
            out[2].t_num_prev_exciting_projects) == (0, 1, 2)
    # priors over all train entities with a key: one entity a with 3 rows, 2 positives
    assert abs(out[2].t_pct_prev_exciting - (2 + 2.0) / (2 + 3.0)) < 1e-12
    for i in (4, 5):                           # missing entity, dev row
        assert (out[i].t_num_prev_projects, out[i].t_num_prev_exciting_projects, out[i].t_pct_prev_exciting) == (0, 0, 0)


def test_past_counts_equal_self_join(spark):
    df = spark.range(0, 400).select(
        "id", F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 37).cast("int")).alias("d"),
        (F.col("id") % 7).cast("string").alias("e"), (F.col("id") % 3 == 0).alias("y"))
    s = make_split(df, dev_share=0)
    got = past_performance(df, s, "e", "t", "y")
    a, b = df.alias("a"), df.alias("b")
    ref = (a.join(b, (F.col("a.e") == F.col("b.e")) &
                  ((F.col("b.d") < F.col("a.d")) | ((F.col("b.d") == F.col("a.d")) & (F.col("b.id") < F.col("a.id")))),
                  "left")
           .groupBy(F.col("a.id").alias("id"))
           .agg(F.count("b.id").cast("double").alias("n"),
                F.coalesce(F.sum(F.col("b.y").cast("double")), F.lit(0.0)).alias("k")))
    bad = got.join(ref, "id").filter((F.col("t_num_prev_projects") != F.col("n")) |
                                     (F.col("t_num_prev_exciting_projects") != F.col("k")))
    assert bad.count() == 0


def test_multi_label_view_equals_single_label(spark):
    rows = [(i, D(2020, 1, 1) + dt.timedelta(days=i % 9), "abc"[i % 3], i % 2 == 0, i % 5 == 0) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, d date, e string, y boolean, z boolean")
    s = make_split(df, dev_share=0.25)
    from outcomelab.plans.features import for_label
    for fn in (past_performance, overall_performance):
        multi = fn(df, s, "e", "t", ["y", "z"])
        for lb in ("y", "z"):
            one = fn(df, s, "e", "t", lb)
            view = for_label(multi, lb)
            assert sorted(view.columns) == sorted(one.columns)
            assert view.select(one.columns).exceptAll(one).count() == 0


def test_split_predicate_reaches_the_labelled_table_scan(spark):
    import contextlib
    import io

    from conftest import SF_SMALL
    from outcomelab.plans.prepare import fixture_study

    st = fixture_study(spark, SF_SMALL)
    df = st.split.rows(st.items, "dev").select("id", "one_or_more")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue()
    pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters")]
    schema = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")]
    assert len(pushed) == 1 and "GreaterThan(d," in pushed[0] and "id," in pushed[0]
    # the imputing projection keeps column pruning: id, date and the OR-ed parts only
    assert schema == ["ReadSchema: struct<id:bigint,d:date,flag_open:boolean,flag_tax:boolean,flag_ship:boolean>"]
    assert df.count() == st.split.n_dev
