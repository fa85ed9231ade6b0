"""Steps that many queries share: read and computed once, with the results of the plain forms."""

import itertools

import pytest
from pyspark.sql import functions as F

from outcomelab.operators import impute as imp
from outcomelab.plans import features as FT, sweep as SW
from outcomelab.sources import fixtures as fx


def _lines(spark):
    values = itertools.product([None, "R", "N"], [None, 0.05, 0.09], [None, 47.0, 48.0, 150.0], [None, 0.01, 0.08],
                               [None, "F", "O", "P"])
    rows = [(None if i % 97 == 0 else i * i % 211, q, None if i % 5 == 0 else 900.0 * i, d, t, r, s)
            for i, (r, d, q, t, s) in enumerate(values)]
    rows += [(1000 + k, None, None, None, None, None, None) for k in range(40)]
    return spark.createDataFrame(rows, "l_orderkey long, l_quantity double, l_extendedprice double, l_discount double, "
                                       "l_tax double, l_returnflag string, l_linestatus string")


def test_outcomes_in_four_aggregates_equal_their_definition(spark):
    lines = _lines(spark)
    plain = lines.groupBy("l_orderkey").agg(*[F.expr(e) for e in fx.OUTCOME_EXPRS[1:]]).withColumnRenamed("l_orderkey", "id")
    found = fx.outcomes_of(lines)
    assert found.columns == plain.columns and [f.dataType for f in found.schema] == [f.dataType for f in plain.schema]
    assert sorted(map(repr, found.collect())) == sorted(map(repr, plain.collect()))


def test_outcomes_carry_four_buffers(spark, tmp_path):
    _lines(spark).write.parquet(f"{tmp_path}/lineitem.parquet")
    plan = fx.outcomes(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_") == 4


def test_modes_read_the_input_once_per_type(spark, tmp_path):
    rows = [(True, None, 10, "b", None), (False, True, 9, "a", None), (None, True, 10, "a", None), (True, False, 9, "b", None),
            (False, None, None, None, None)]
    spark.createDataFrame(rows, "x boolean, y boolean, n long, `s.t` string, e boolean").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    plain = {"x": "false", "y": "true", "n": "9", "s.t": "a", "e": None}   # ties: the smallest value, as numbers
    assert imp.modes(df, list(plain)) == plain
    reads = []
    real = type(df).collect

    def collect(self):
        reads.append(self._jdf.queryExecution().sparkPlan().toString().count("FileScan"))
        return real(self)
    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(df), "collect", collect)
        imp.modes(df, ["x", "y", "e"])
    assert reads == [1]


@pytest.fixture(scope="module")
def study(spark):
    from outcomelab.plans.prepare import fixture_study
    return fixture_study(spark, "/root/testdata/sf0.001")


def test_fits_of_the_feature_sets_read_written_rows(study, monkeypatch):
    seen = []
    for step in ("downsize", "one_hot"):
        real = getattr(FT, step)
        monkeypatch.setattr(FT, step, lambda df, *a, real=real, **k: seen.append(
            df._jdf.queryExecution().optimizedPlan().toString()) or real(df, *a, **k))
    for build in (FT.project_features, FT.geo_features, lambda s: FT.teacher_features(s, ["label", "flag_r"]),
                  lambda s: FT.school_features(s, "label")):
        build(study)
    assert len(seen) == 8
    assert not [p for p in seen if "Join" in p or "MapInPandas" in p or "Aggregate" in p]


def test_cached_sets_leave_no_intermediate_tables(spark, study):
    def written():
        return {t.name.rsplit("_", 1)[0] for t in spark.catalog.listTables() if "_rows_" in t.name} & \
            {f"outcomelab_{e}_rows" for e in FT.ENTITIES}
    for t in spark.catalog.listTables():
        if "_rows_" in t.name:
            spark.sql(f"DROP TABLE {t.name}")
    sets = SW.FeatureCache(study, ["label"]).sets("label")
    assert not written()
    n = study.items.count()
    assert [sets[e].count() for e in FT.ENTITIES] == [n] * 4      # the sets themselves stay readable
    assert FT.project_features(study).count() == n and written()  # alone, a set is read from its rows


def test_median_makes_its_ordered_pass_once(spark, monkeypatch):
    from outcomelab.operators import entity
    df = spark.createDataFrame([(g, float(v)) for g in "ab" for v in range(9 if g == "a" else 4)] + [(None, 5.0), ("a", None)],
                               "g string, v double")
    runs = spark.sparkContext.accumulator(0)
    real = entity.running_totals

    def counted(*a, **k):
        ranked = real(*a, **k)

        def note(batches):
            for b in batches:
                runs.add(len(b))
                yield b
        return ranked.mapInPandas(note, ranked.schema)
    monkeypatch.setattr(entity, "running_totals", counted)
    assert sorted(tuple(r) for r in entity.exact_median(df, "v", ["g"]).collect()) == [("a", 4.0), ("b", 1.5)]
    assert runs.value == 13
