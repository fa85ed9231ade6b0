"""

Every query reads the test tables of ``sf_dir`` through the fixture mapping
(:mod:`outcomelab.sources.fixtures`) and runs the library's operators over
all rows.  ``oracle_sql`` holds independent DuckDB SQL for each query that
SQL can express; queries built on model fitting have none (rows-only check)
and are checked in ``tests/``.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from outcomelab import oracle as O  # noqa: E402
from outcomelab.functions.columns import concat_strict, product_of, qcol  # noqa: E402
from outcomelab.operators import design, encode, entity, evaluate, impute as imp, info, keys, profile  # noqa: E402
from outcomelab.operators.split import date_floor, make_split  # noqa: E402
from outcomelab.plans import dataset as DS, features as FT, models as M, ranking as RK, sweep as SW, trees  # noqa: E402
from outcomelab.plans.prepare import Study, fixture_items, fixture_study  # noqa: E402
from outcomelab.session import ensure_checkpoint_dir, materialize  # noqa: E402
from outcomelab.sources import csv_scan, fixtures as fx  # noqa: E402
from outcomelab.sources.store import ResultStore  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
R = 6
ABSOLUTE_DEV = 1_000

_STUDIES: dict = {}


def _study(spark: SparkSession, sf_dir: str) -> Study:
    """Labelled items + split, materialised once per session and folder."""
    key = (id(spark), sf_dir)
    if key not in _STUDIES:
        ensure_checkpoint_dir(spark)
        _STUDIES[key] = fixture_study(spark, sf_dir)
    return _STUDIES[key]


def _r(c):
    return F.round(F.col(c).cast("double"), R).alias(c)


def _long(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Wide feature table -> sparse (id, feature, value) rows, value != 0."""
    cols = [c for c in df.columns if c != id_col]
    casted = df.select(id_col, *[qcol(c).cast("double").alias(c) for c in cols])
    return (casted.unpivot([id_col], [qcol(c) for c in cols], "feature", "value")
            .filter(F.col("value").isNotNull() & (F.col("value") != 0))
            .select(id_col, "feature", F.round("value", R).alias("value")))


# -- queries -----------------------------------------------------------------

def q_labelled_join(spark, sf):
    return fixture_items(spark, sf)


def q_date_floor_filter(spark, sf):
    return date_floor(fx.items(spark, sf), "d", fx.DATE_FLOOR).select("id", "d")


def q_projects_by_year(spark, sf):
    return profile.year_counts(fx.items(spark, sf), "d", "id")


def q_label_true_rates(spark, sf):
    return profile.true_rates(_study(spark, sf).items, fx.LABELS) \
        .select("requirement", _r("true_proportion"))


def q_missing_cells(spark, sf):
    return profile.missing_cells(_study(spark, sf).items.drop(*RK.SPARSE))


def q_dropna_rows(spark, sf):
    return profile.drop_missing(_study(spark, sf).items.drop(*RK.SPARSE)).select("id")


def q_chrono_split(spark, sf):
    st = _study(spark, sf)
    return st.items.select("id", st.split.name().alias("split"))


def q_hash_split_counts(spark, sf):
    items = _study(spark, sf).items
    s = make_split(items, "id", "d", fx.DEV_SHARE, shuffle=True)
    return (items.select(F.when(s.is_dev(), "dev").otherwise("rest").alias("split"))
            .groupBy("split").agg(F.count(F.lit(1)).alias("n")))


def q_hash_split(spark, sf):
    """Membership of the hashed split."""
    items = _study(spark, sf).items
    s = make_split(items, "id", "d", fx.DEV_SHARE, shuffle=True)
    return items.select("id", s.name().alias("split"))


def q_absolute_split(spark, sf):
    """The last ABSOLUTE_DEV rows are dev: a size instead of a share."""
    items = _study(spark, sf).items
    s = make_split(items, "id", "d", ABSOLUTE_DEV)
    return items.select("id", s.name().alias("split"))


def q_events_split(spark, sf):
    """Split of a table with timestamps instead of dates."""
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    s = make_split(events, "event_id", "ts", fx.DEV_SHARE)
    return events.select("event_id", s.name().alias("split"))


def q_recent_train(spark, sf):
    st = _study(spark, sf)
    return st.split.rows(st.items, "train").select("id", "d")


def q_entity_rollup(spark, sf):
    st = _study(spark, sf)
    out = entity.entity_rollup(st.split.rows(st.items, "train"), "teacher", "label", "id", "d")
    return out.select("teacher", "num_projects", "num_exciting_projects", "first_project_date",
                      "last_project_date", _r("active_years"))


def q_entity_priors(spark, sf):
    st = _study(spark, sf)
    roll = entity.entity_rollup(st.split.rows(st.items, "train"), "school", "label", "id", "d")
    return entity.entity_priors(roll, 3).select(_r("prior_num"), _r("prior_exciting"), _r("prior_years"))


def q_entity_overall_performance(spark, sf):
    st = _study(spark, sf)
    out = entity.overall_performance(st.items, st.split, "school", "school", "label")
    return out.select("id", *[_r(c) for c in out.columns if c != "id"])


def q_entity_past_performance(spark, sf):
    st = _study(spark, sf)
    out = entity.past_performance(st.items, st.split, "teacher", "teacher", "label")
    return out.select("id", *[_r(c) for c in out.columns if c != "id"])


def q_impute_mode(spark, sf):
    items = _study(spark, sf).items.select("id", "prefix", "area")
    return imp.impute(items, {"prefix": {"strategy": "most_frequent"}, "area": {"strategy": "most_frequent"}})


def _price_with_gaps(spark, sf):
    return _study(spark, sf).items.select(
        "id", F.when(F.col("id") % 13 == 0, F.lit(None)).otherwise(F.col("price")).alias("price"))


def q_impute_median(spark, sf):
    return imp.impute(_price_with_gaps(spark, sf), {"price": {"strategy": "median"}}).select("id", _r("price"))


def q_impute_mean(spark, sf):
    return imp.impute(_price_with_gaps(spark, sf), {"price": {"strategy": "mean"}}).select("id", _r("price"))


def q_impute_constant(spark, sf):
    items = _study(spark, sf).items.select("id", "area")
    return imp.impute(items, {"area": {"strategy": "constant", "fill_value": FT.MISSING}})


def q_fill_zero(spark, sf):
    return imp.fill_missing(_study(spark, sf).items.select("id", "teacher"), 0)


def q_downsize_categorical(spark, sf):
    items = _study(spark, sf).items.select("id", "area")
    return encode.downsize(items, ["area"], 0.9, 10)


DOWNSIZE_ALL = ["subject", "area", "resource", "prefix", "metro", "city", "state"]


def q_downsize_all(spark, sf):
    items = _study(spark, sf).items.select("id", "school", *DOWNSIZE_ALL)
    return encode.downsize(items, None, 0.9, 5, skip=["id", "school"]).select("id", *DOWNSIZE_ALL)


def q_one_hot(spark, sf):
    items = _study(spark, sf).items.select("id", "subject", "resource", "metro")
    return _long(encode.one_hot(items, exclude=["id"]))


def q_part_name_one_hot(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").alias("id"), "p_name")
    return encode.one_hot_sparse(part, "id", ["p_name"])


def q_label_encode(spark, sf):
    items = _study(spark, sf).items.select("id", "state")
    return encode.label_encode(items, "state", "state_code").select("id", "state_code")


def q_equal_width_bins(spark, sf):
    items = _study(spark, sf).items.select("id", "latitude", "longitude")
    out = encode.equal_width_bins(items, "latitude", 5, "latitude_group")
    out = encode.equal_width_bins(out, "longitude", 5, "longitude_group")
    return out.select("id", "latitude_group", "longitude_group")


def q_flag_replace(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    text = orders.select(F.col("o_orderkey").alias("id"),
                         F.expr("CASE o_orderstatus WHEN 'F' THEN 't' WHEN 'O' THEN 'f' END").alias("flag"))
    return encode.replace_flags(text, ["flag"])


def q_relative_days(spark, sf):
    items = _study(spark, sf).items
    first = items.agg(F.min("d").alias("_first"))
    return items.crossJoin(F.broadcast(first)).select(
        "id", F.datediff("d", "_first").alias("date_posted_relative"))


def q_group_median_ratio(spark, sf):
    items = _study(spark, sf).items.select("id", "area", "price")
    out = entity.group_median_ratio(items, "price", "area", "id", "area_median_price",
                                    "price_relative_to_focus_area")
    return out.select("id", _r("area_median_price"), _r("price_relative_to_focus_area"))


def q_city_state_size(spark, sf):
    st = _study(spark, sf)
    rows = st.split.rows(st.items, "train").withColumn("city_state", concat_strict("city", "state"))
    out = entity.group_size(rows, "city_state", "school", "id")
    return out.select("city_state", "city_state_num_schools", "city_state_num_projects",
                      _r("city_state_projects_per_school"))


def q_project_features(spark, sf):
    return _long(FT.project_features(_study(spark, sf)))


def q_teacher_features(spark, sf):
    return _long(FT.teacher_features(_study(spark, sf), "label"))


def q_school_features(spark, sf):
    return _long(FT.school_features(_study(spark, sf), "label"))


def q_geo_features(spark, sf):
    return _long(FT.geo_features(_study(spark, sf)))


def _memo(spark, sf) -> dict:
    """Shared per-session state: feature sets per label and the selection."""
    key = ("memo", id(spark), sf)
    if key not in _STUDIES:
        st = _study(spark, sf)
        _STUDIES[key] = {"cache": SW.FeatureCache(st, fx.LABELS)}
    return _STUDIES[key]


def _ranking(spark, sf) -> DataFrame:
    """Second-pass ranking against the main label, materialised once."""
    m = _memo(spark, sf)
    if "ranking" not in m:
        st = _study(spark, sf)
        m["ranking"] = RK.feature_set_ranking(st, m["cache"].sets("label"), "label").checkpoint(eager=True)
    return m["ranking"]


def _selected(spark, sf) -> list[str]:
    m = _memo(spark, sf)
    if "selected" not in m:
        every = DS.assemble(_study(spark, sf), m["cache"].sets("label"), "train")
        m["selected"] = DS.select_ranked(every, _ranking(spark, sf), 26)
    return m["selected"]


def _dev_scores(spark, sf):
    """Dev rows with a deterministic score: the school's smoothed rate."""
    st = _study(spark, sf)
    perf = entity.overall_performance(st.items, st.split, "school", "school", "label")
    return (st.split.rows(st.items, "dev").select("id", "label")
            .join(perf.select("id", F.col("school_pct_exciting").alias("score")), "id"))


def q_roc_auc(spark, sf):
    return evaluate.roc_auc(_dev_scores(spark, sf), "score", "label").select(_r("roc_auc"))


def q_top_fraction_precision(spark, sf):
    out = evaluate.top_fraction_precision(_dev_scores(spark, sf), "score", "label", "id")
    return out.select(*[_r(c) for c in out.columns])


RAW_DISCRETE = ["city", "state", "prefix", "subject", "area", "resource"]
RAW_CONTINUOUS = ["latitude", "longitude", "labor", "price"]


def q_mi_discrete(spark, sf):
    rows = profile.drop_missing(_study(spark, sf).items.drop(*RK.SPARSE))
    return info.mi_discrete(rows, RAW_DISCRETE, "label").select("feature", _r("mutual_information"))


def q_top_features(spark, sf):
    rows = profile.drop_missing(_study(spark, sf).items.drop(*RK.SPARSE))
    ranked = RK.top_k(info.mi_discrete(rows, RAW_DISCRETE, "label"), 5)
    return ranked.select("feature", _r("mutual_information"), F.col("rank").cast("int").alias("rank"))


def q_mi_continuous(spark, sf):
    rows = profile.drop_missing(_study(spark, sf).items.drop(*RK.SPARSE))
    return info.mi_continuous(rows, RAW_CONTINUOUS, "label").select("feature", _r("mutual_information"))


def q_raw_ranking(spark, sf):
    return RK.raw_ranking(_study(spark, sf), "label").select("feature", _r("mutual_information"), "discrete")


def q_feature_ranking(spark, sf):
    return _ranking(spark, sf).select("entity", "feature", _r("mutual_information"))


def q_best_per_group(spark, sf):
    items = _study(spark, sf).items.select("state", "id", "price")
    return SW.best_per_group(items, "state", "price")


def q_probability_product(spark, sf):
    st = _study(spark, sf)
    out = st.split.rows(st.items, "dev").select("id")
    for lb in fx.LABELS[1:]:
        perf = entity.overall_performance(st.items, st.split, "school", "school", lb)
        out = out.join(perf.select("id", F.col("school_pct_exciting").alias(lb)), "id")
    return out.select("id", F.round(product_of(*fx.LABELS[1:]), R).alias("ensemble"))


STD_COLS = ["price", "labor", "latitude"]


def q_standardize(spark, sf):
    st = _study(spark, sf)
    stats = M.standardize_fit(st.split.rows(st.items, "train"), STD_COLS)
    dev = st.split.rows(st.items, "dev").select("id", *STD_COLS)
    return M.standardize_apply(dev, stats, STD_COLS).select("id", *[_r(c) for c in STD_COLS])


def q_assemble_dataset(spark, sf):
    st = _study(spark, sf)
    return _long(DS.assemble(st, _memo(spark, sf)["cache"].sets("label"), "train"))


def q_split_labels(spark, sf):
    return DS.labels(_study(spark, sf), "dev", "label")


def _scores(spec_name):
    def run(spark, sf):
        st = _study(spark, sf)
        feats = _selected(spark, sf)
        spec = next(s for s in M.CLASSIFIERS if s.name == spec_name)
        train, dev = DS.train_test(st, _memo(spark, sf)["cache"].sets("label"), "label", FT.ENTITIES, feats)
        model = M.fit_pipeline(train, feats, "label", spec)
        return M.score(model, dev, feats, "label")
    return run


def q_confusion_counts(spark, sf):
    scored = _dev_scores(spark, sf).withColumn("hard_prediction", (F.round("score", R) >= 0.5).cast("int"))
    return evaluate.confusion_counts(scored, "label", "hard_prediction")


def _ledger(spark, sf):
    m = _memo(spark, sf)
    if "ledger" not in m:
        m["store"] = SW.Ledger(spark)
        m["ledger"] = SW.sweep(_study(spark, sf), fx.LABELS, M.CLASSIFIERS, features=_selected(spark, sf),
                               parallelism=4, cache=m["cache"], ledger=m["store"]).checkpoint(eager=True)
    return m["ledger"]


def q_label_sweep(spark, sf):
    return _ledger(spark, sf)


def q_sweep_status(spark, sf):
    """Which of the sweep's fits succeeded, read from its ledger: all of them should."""
    _ledger(spark, sf)
    rows = _memo(spark, sf)["store"].rows.read()
    return rows.select("label", "classifier", F.col("error").isNull().alias("fitted"))


def q_sweep_resume(spark, sf):
    """The sweep started once more on its ledger: nothing is fitted or committed again."""
    _ledger(spark, sf)
    store = _memo(spark, sf)["store"]
    SW.sweep(_study(spark, sf), fx.LABELS, M.CLASSIFIERS, features=_selected(spark, sf),
             cache=_memo(spark, sf)["cache"], ledger=SW.Ledger(spark, store.root))
    commits = store.rows.history().groupBy("entry").agg(F.count(F.lit(1)).alias("commits"))
    return store.rows.read().join(commits, "entry").select("label", "classifier", "commits")


def q_sweep_base_rates(spark, sf):
    """The mean dev label that the ledger's one rating pass found for every fit."""
    return _ledger(spark, sf).select("label", "classifier", _r("random"))


def q_best_per_label(spark, sf):
    return SW.best_per_label(_ledger(spark, sf)).select("label", "classifier", "test_roc_auc")


def _ensemble(spark, sf):
    m = _memo(spark, sf)
    if "ensemble" not in m:
        m["ensemble"] = SW.label_ensemble(_study(spark, sf), fx.LABELS, "label", features=_selected(spark, sf),
                                          cache=m["cache"])
    return m["ensemble"]


def q_label_ensemble(spark, sf):
    return _ensemble(spark, sf)[0]


def q_ensemble_metrics(spark, sf):
    """AUC and top-fraction precision of the label ensemble, one row."""
    _, metrics = _ensemble(spark, sf)
    return spark.range(1).select(*[F.round(F.lit(v).cast("double"), R).alias(k) for k, v in metrics.items()])


def q_ensemble_rows(spark, sf):
    """Every dev row once, beside its own label, its score the product of the
    other labels' probabilities."""
    product = product_of(*fx.LABELS[1:])
    return _ensemble(spark, sf)[0].select(
        "id", "actual", ((F.abs(F.col("ensemble") - product) < 1e-12) & F.col("label").between(0, 1)).alias("is_product"))


def q_grouped_metrics(spark, sf):
    """Two deterministic scores rated against all six labels in one pass."""
    st = _study(spark, sf)
    perf = entity.overall_performance(st.items, st.split, "school", "school", "label")
    dev = st.split.rows(st.items, "dev").select("id", F.round("price", 2).alias("price"), *[
        F.col(lb).cast("int").alias(lb) for lb in fx.LABELS])
    dev = dev.join(perf.select("id", _r("school_pct_exciting")), "id")
    long = dev.unpivot(["id", "price", "school_pct_exciting"], fx.LABELS, "label", "actual").unpivot(
        ["id", "label", "actual"], ["price", "school_pct_exciting"], "model", "score")
    out = evaluate.grouped_metrics(materialize(long, "scores"), ["label", "model"], "score", "actual")
    return out.select("label", "model", *[_r(c) for c in out.columns if c not in ("label", "model")])


def q_logistic_calibration(spark, sf):
    """At its optimum a logistic fit with a free intercept predicts, on average
    over the train rows, the share of ones: one row per label."""
    st, feats = _study(spark, sf), _selected(spark, sf)
    cache = _memo(spark, sf)["cache"]
    spec = M.Spec("exact", "logistic", {"maxIter": 500, "tol": 1e-10})

    def one(label):
        train, _ = DS.train_test(st, cache.sets(label), label, FT.ENTITIES, feats)
        train = materialize(train, "calibration")
        model = M.fit_pipeline(train, feats, label, spec)
        return M.score(model, train, feats, label).agg(F.avg("prediction").alias("p")).first()["p"]

    with ThreadPoolExecutor(max_workers=3) as pool:
        means = list(pool.map(one, fx.LABELS))
    return spark.createDataFrame(list(zip(fx.LABELS, [round(m, 4) for m in means])), "label string, mean_probability double")


def q_tree_split_limit(spark, sf):
    """Node counts of a folded forest without row draws and of a boosting run:
    no node of fewer than 500 rows is split, and every tree's leaves hold
    all the rows it was grown on."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    st, feats = _study(spark, sf), _selected(spark, sf)
    train, _ = DS.train_test(st, _memo(spark, sf)["cache"].sets("label"), "label", FT.ENTITIES, feats)
    names = [f"f{i}" for i in range(len(feats))]
    data = materialize(M._prepared(train, feats, "label", "id"), "split-limit")
    grown = RandomForestClassifier(numTrees=20, maxDepth=10, bootstrap=False, subsamplingRate=1.0, featureSubsetStrategy="sqrt",
                                   featuresCol="_vec", labelCol="_label", seed=M.SEED).fit(
        VectorAssembler(inputCols=names, outputCol="_vec").transform(data))
    folded = trees.fold_forest(spark, grown, M.MIN_SPLIT)
    nodes = trees.node_table(spark, trees.saved(spark, folded)).select(
        F.lit("forest").alias("model"), F.col("treeID").alias("tree"), F.col("rawCount").alias("n"),
        (F.col("leftChild") >= 0).cast("int").alias("split"))
    boosted = trees.fit_boosted(data, names, 30, M.MIN_SPLIT)
    rounds = spark.createDataFrame(boosted.nodes(), "tree int, n long, split int").select(
        F.lit("boosting").alias("model"), "tree", "n", "split")
    per_tree = nodes.unionByName(rounds).groupBy("model", "tree").agg(
        F.sum(F.when(F.col("split") == 0, F.col("n"))).alias("in_leaves"),
        F.sum(F.when((F.col("split") == 1) & (F.col("n") < M.MIN_SPLIT), 1).otherwise(0)).alias("small"))
    return per_tree.groupBy("model").agg(F.sum("small").alias("small_splits"), F.min("in_leaves").alias("least_rows"),
                                         F.max("in_leaves").alias("most_rows"))


def q_ranked_dataset(spark, sf):
    """Train and dev bundle of the 26 best features, by key, as (split, id,
    feature, value) rows."""
    st, feats = _study(spark, sf), _selected(spark, sf)
    train, dev = DS.train_test(st, _memo(spark, sf)["cache"].sets("label"), "label", FT.ENTITIES, feats)
    both = train.select(F.lit("train").alias("split"), "*").unionByName(dev.select(F.lit("dev").alias("split"), "*"))
    wide = both.withColumn("label", F.col("label").cast("int")).withColumn("key", F.concat_ws("/", "split", "id"))
    long = _long(wide.drop("split", "id"), "key")
    part = F.split("key", "/")
    return long.select(part[0].alias("split"), part[1].cast("long").alias("id"), "feature", "value")


def q_result_store(spark, sf):
    """The label rates committed per (run, label): first a wrong delivery, then
    the right one, which replaces it."""
    st = _study(spark, sf)
    rates = materialize(profile.true_rates(st.items, fx.LABELS), "rates")
    store = ResultStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/results/{uuid.uuid4().hex}", ["run", "label"])
    for factor in (0.5, 1.0):
        for lb in fx.LABELS:
            own = rates.where(F.col("requirement") == lb)
            store.commit(own.select((F.col("true_proportion") * factor).alias("true_proportion")), run="1", label=lb)
    return store.read(run="1").select("run", "label", _r("true_proportion"))


def q_join_key_audit(spark, sf):
    """Keys of four sides of a join chain, two of them with planted faults."""
    items = _study(spark, sf).items.select("id")
    sides = {"items": items, "project": _memo(spark, sf)["cache"].sets("label", ("project",))["project"].select("id"),
             "twice": items.unionByName(items.where("id % 97 = 0")).unionByName(items.where("id % 970 = 0")),
             "gaps": items.select(F.when(F.col("id") % 13 != 0, F.col("id")).alias("id"))}
    return keys.audit_keys(sides, "id")


def _orders_csv(spark, sf):
    """The orders as CSV files without a schema, with a line of too many and
    one of too few fields for every thousandth order."""
    m = _memo(spark, sf)
    if "csv" not in m:
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv/{uuid.uuid4().hex}"
        orders = spark.read.parquet(f"{sf}/orders.parquet").select(*ORDER_COLS)
        orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date").cast("string")).withColumn(
            "o_orderpriority", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderpriority"))).write.csv(f"{root}/good")
        bad = orders.where("o_orderkey % 1000 = 0").select(F.col("o_orderkey").cast("string").alias("k"))
        ends = F.explode(F.array(F.lit(",1,O,2.5,1997-01-01,x,more,fields"), F.lit(",1")))
        bad.select("k", ends.alias("end")).select(F.concat("k", "end").alias("value")).write.text(f"{root}/bad")
        m["csv"] = csv_scan.scan_csv(spark, [f"{root}/good", f"{root}/bad"], ORDER_COLS)
    return m["csv"]


ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def q_csv_scan(spark, sf):
    return _orders_csv(spark, sf).rows.select(
        *[F.col(c).cast("long").alias(c) for c in ORDER_COLS[:2]], "o_orderstatus", _r("o_totalprice"), "o_orderdate",
        "o_orderpriority")


def q_csv_types(spark, sf):
    """The inferred types and the number of quarantined lines."""
    scan = _orders_csv(spark, sf)
    kinds = spark.createDataFrame(list(scan.types.items()), "column string, type string")
    return kinds.crossJoin(F.broadcast(scan.quarantine.agg(F.count(F.lit(1)).alias("quarantined"))))


PART_COLS = ["p_name", "p_brand", "p_type"]


def _part_cells(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").alias("id"), *PART_COLS)
    return encode.one_hot_sparse(part, "id", PART_COLS)


def q_feature_index(spark, sf):
    return design.feature_index(_part_cells(spark, sf))


def q_sparse_logistic(spark, sf):
    """A fit on the one-hot of columns with unbounded vocabularies (every part name is a
    feature): rows, features, stored cells, and the mean probability."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array
    cells = _part_cells(spark, sf)
    index = materialize(design.feature_index(cells), "feature-index")
    y = spark.read.parquet(f"{sf}/part.parquet").select(F.col("p_partkey").alias("id"),
                                                        (F.col("p_size") > 25).cast("double").alias("y"))
    rows = design.sparse_rows(cells, index, "id", ids=y).join(y, "id")
    model = LogisticRegression(featuresCol="features", labelCol="y", maxIter=300, regParam=0.01, tol=1e-8,
                               standardization=False).fit(rows)
    mean = model.transform(rows).agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg(
        vector_to_array("probability")[1]), 4).alias("mean_probability"))
    size = index.agg(F.count(F.lit(1)).alias("features"))
    stored = cells.agg(F.count(F.lit(1)).alias("cells"))
    return mean.crossJoin(F.broadcast(size)).crossJoin(F.broadcast(stored))


def q_append_ledger(spark, sf):
    """Two ledgers appended, columns united: the label rates and, without a
    rate, the per-label row counts."""
    st = _study(spark, sf)
    rates = profile.true_rates(st.items, fx.LABELS).select("requirement", _r("true_proportion"))
    n = st.items.agg(*[F.count(c).alias(c) for c in fx.LABELS]).unpivot([], fx.LABELS, "requirement", "n")
    return SW.union_all([rates, n])


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "labelled_join": q_labelled_join,
    "date_floor_filter": q_date_floor_filter,
    "projects_by_year": q_projects_by_year,
    "label_true_rates": q_label_true_rates,
    "missing_cells": q_missing_cells,
    "dropna_rows": q_dropna_rows,
    "chrono_split": q_chrono_split,
    "hash_split_counts": q_hash_split_counts,
    "hash_split": q_hash_split,
    "absolute_split": q_absolute_split,
    "events_split": q_events_split,
    "recent_train": q_recent_train,
    "entity_rollup": q_entity_rollup,
    "entity_priors": q_entity_priors,
    "entity_overall_performance": q_entity_overall_performance,
    "entity_past_performance": q_entity_past_performance,
    "impute_mode": q_impute_mode,
    "impute_median": q_impute_median,
    "impute_mean": q_impute_mean,
    "impute_constant": q_impute_constant,
    "fill_zero": q_fill_zero,
    "downsize_categorical": q_downsize_categorical,
    "downsize_all": q_downsize_all,
    "one_hot": q_one_hot,
    "part_name_one_hot": q_part_name_one_hot,
    "label_encode": q_label_encode,
    "equal_width_bins": q_equal_width_bins,
    "flag_replace": q_flag_replace,
    "relative_days": q_relative_days,
    "group_median_ratio": q_group_median_ratio,
    "city_state_size": q_city_state_size,
    "project_features": q_project_features,
    "teacher_features": q_teacher_features,
    "school_features": q_school_features,
    "geo_features": q_geo_features,
    "roc_auc": q_roc_auc,
    "top_fraction_precision": q_top_fraction_precision,
    "mi_discrete": q_mi_discrete,
    "top_features": q_top_features,
    "mi_continuous": q_mi_continuous,
    "raw_ranking": q_raw_ranking,
    "feature_ranking": q_feature_ranking,
    "best_per_group": q_best_per_group,
    "probability_product": q_probability_product,
    "standardize": q_standardize,
    "assemble_dataset": q_assemble_dataset,
    "split_labels": q_split_labels,
    "logistic_scores": _scores("Logistic Regression"),
    "mlp_scores": _scores("FFNN (d=3)"),
    "rf_scores": _scores("Random Forest"),
    "gbt_scores": _scores("Gradient Boost"),
    "confusion_counts": q_confusion_counts,
    "label_ensemble": q_label_ensemble,
    "ensemble_metrics": q_ensemble_metrics,
    "ensemble_rows": q_ensemble_rows,
    "grouped_metrics": q_grouped_metrics,
    "logistic_calibration": q_logistic_calibration,
    "tree_split_limit": q_tree_split_limit,
    "ranked_dataset": q_ranked_dataset,
    "result_store": q_result_store,
    "join_key_audit": q_join_key_audit,
    "csv_scan": q_csv_scan,
    "csv_types": q_csv_types,
    "feature_index": q_feature_index,
    "sparse_logistic": q_sparse_logistic,
    "append_ledger": q_append_ledger,
    "label_sweep": q_label_sweep,
    "sweep_status": q_sweep_status,
    "sweep_resume": q_sweep_resume,
    "sweep_base_rates": q_sweep_base_rates,
    "best_per_label": q_best_per_label,
}


# -- oracle SQL ----------------------------------------------------------------

def _sql() -> dict[str, str]:
    B = O.base
    item_cols = [e.rsplit(" AS ", 1)[1] for e in fx.ITEM_EXPRS]
    out_cols = [e.rsplit(" AS ", 1)[1] for e in fx.OUTCOME_EXPRS]
    # the reference drops its sparse columns before it counts or drops missing values
    all_cols = [c for c in item_cols if c != "metro"] + [c for c in out_cols if c != "id"] + [fx.OR_LABEL]
    rates = " UNION ALL ".join(
        f"SELECT '{c}' AS requirement, round(avg(CAST({c} AS DOUBLE)), {R}) AS true_proportion FROM lab"
        for c in fx.LABELS)
    nulls = " + ".join(f"count(*) - count({c})" for c in all_cols)
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in all_cols)
    ds_all = ",\n".join(O.kept_cte(f"k_{c}", "lab", c) for c in DOWNSIZE_ALL)
    sc = ("sc AS (SELECT sf.id, sf.pct_exciting AS s, CAST(p.label AS INTEGER) AS y "
          "FROM sf JOIN p USING (id) WHERE p.is_dev)")
    rawnn = " AND ".join(f"{c} IS NOT NULL" for c in all_cols)
    disc_long = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS x, CAST(label AS INTEGER) AS y FROM rr" for c in RAW_DISCRETE)
    mi_ctes = (f"rr AS (SELECT * FROM lab WHERE {rawnn}), lg AS ({disc_long}), "
               "c AS (SELECT feature, x, y, CAST(count(*) AS DOUBLE) AS nxy FROM lg GROUP BY ALL), "
               "cx AS (SELECT feature, x, sum(nxy) AS nx FROM c GROUP BY ALL), "
               "cy AS (SELECT feature, y, sum(nxy) AS ny FROM c GROUP BY ALL), "
               "cn AS (SELECT feature, sum(nxy) AS n FROM c GROUP BY ALL), "
               "mi AS (SELECT feature, greatest(sum(nxy / n * ln(n * nxy / (nx * ny))), 0) AS m "
               "FROM c JOIN cx USING (feature, x) JOIN cy USING (feature, y) JOIN cn USING (feature) GROUP BY feature)")
    knn = O.knn_mi_ctes(O.numeric_rows(f"(SELECT * FROM lab WHERE {rawnn})", RAW_CONTINUOUS))
    prod_ctes = ",\n".join(O.school_overall_ctes(lb, "school", f"s{i}") for i, lb in enumerate(fx.LABELS[1:]))
    prod_join = " ".join(f"JOIN s{i}f USING (id)" for i in range(len(fx.LABELS) - 1))
    prod_expr = " * ".join(f"s{i}f.pct_exciting" for i in range(len(fx.LABELS) - 1))
    std_stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in STD_COLS)
    std_sel = ", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1 END, {R}) AS {c}" for c in STD_COLS)
    counts = " UNION ALL ".join(f"SELECT '{c}' AS requirement, CAST(NULL AS DOUBLE) AS true_proportion, "
                                f"count({c}) AS n FROM lab" for c in fx.LABELS)
    part_names = " UNION ".join(f"SELECT '{c}_' || {c} AS feature FROM part WHERE {c} IS NOT NULL" for c in PART_COLS)
    extra = {
        "append_ledger": B() + f" SELECT requirement, true_proportion, CAST(NULL AS BIGINT) AS n FROM ({rates}) UNION ALL {counts}",
        "confusion_counts": B(O.school_overall_ctes()) + f""" SELECT p.label, CAST(round(sf.pct_exciting, {R}) >= 0.5 AS INTEGER)
 AS hard_prediction, count(*) AS n FROM sf JOIN p USING (id) WHERE p.is_dev GROUP BY ALL""",
        "roc_auc": B(O.school_overall_ctes() + ",\n" + sc + """,
agg AS (SELECT s, sum(y) AS pos, count(*) - sum(y) AS neg FROM sc GROUP BY s),
cum AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM agg)""")
        + f" SELECT round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), {R}) AS roc_auc FROM cum",
        "top_fraction_precision": B(O.school_overall_ctes() + ",\n" + sc +
                                    ", r AS (SELECT y, row_number() OVER (ORDER BY s DESC, id) AS rn, count(*) OVER () AS n FROM sc)")
        + f""" SELECT round(avg(CASE WHEN rn <= n // 10 THEN y END), {R}) AS top_10_percentile,
 round(avg(CASE WHEN rn <= n // 5 THEN y END), {R}) AS top_20_percentile,
 round(avg(CASE WHEN rn <= (3 * n) // 10 THEN y END), {R}) AS top_30_percentile,
 round(avg(y), {R}) AS random FROM r""",
        "mi_discrete": B(mi_ctes) + f" SELECT feature, round(m, {R}) AS mutual_information FROM mi",
        "top_features": B(mi_ctes) + f""" SELECT feature, round(m, {R}) AS mutual_information,
 CAST(row_number() OVER (ORDER BY m DESC, feature) AS INTEGER) AS rank FROM mi ORDER BY m DESC, feature LIMIT 5""",
        "mi_continuous": B(knn) + f" SELECT feature, round(m, {R}) AS mutual_information FROM kmi",
        "raw_ranking": B(mi_ctes + ",\n" + knn) + f""" SELECT feature, round(m, {R}) AS mutual_information, true AS discrete FROM mi
 UNION ALL SELECT feature, round(m, {R}), false FROM kmi""",
        "feature_ranking": O.feature_ranking(),
        "best_per_group": B() + " SELECT state, id, price FROM lab JOIN (SELECT state, max(price) AS mp FROM lab GROUP BY state) USING (state) WHERE price = mp",
        "probability_product": B(prod_ctes) + f" SELECT id, round({prod_expr}, {R}) AS ensemble FROM p {prod_join} WHERE p.is_dev",
        "standardize": B(f"st AS (SELECT {std_stats} FROM p WHERE is_train)") + f" SELECT id, {std_sel} FROM p, st WHERE is_dev",
        "assemble_dataset": B(",\n".join([O.project_ctes(), O.teacher_ctes(), O.school_ctes(), O.geo_ctes()]))
        + " SELECT id, feature, value FROM (SELECT * FROM proj_long UNION ALL SELECT * FROM teach_long "
        "UNION ALL SELECT * FROM school_long UNION ALL SELECT * FROM geo_long) WHERE id IN (SELECT id FROM p WHERE is_train)",
        "sweep_status": " UNION ALL ".join(
            f"SELECT '{lb}' AS label, '{s.name}' AS classifier, true AS fitted" for lb in fx.LABELS for s in M.CLASSIFIERS),
        "split_labels": B() + " SELECT id, label FROM p WHERE is_dev",
        "sweep_resume": " UNION ALL ".join(
            f"SELECT '{lb}' AS label, '{s.name}' AS classifier, CAST(1 AS BIGINT) AS commits" for lb in fx.LABELS for s in M.CLASSIFIERS),
        "sweep_base_rates": B() + " SELECT label, classifier, random FROM (" + " UNION ALL ".join(
            f"SELECT '{lb}' AS label, round(avg(CAST({lb} AS DOUBLE)), {R}) AS random FROM p WHERE is_dev" for lb in fx.LABELS)
        + "), (VALUES " + ", ".join(f"('{s.name}')" for s in M.CLASSIFIERS) + ") AS c(classifier)",
        "ensemble_rows": B() + " SELECT id, label AS actual, true AS is_product FROM p WHERE is_dev",
        "grouped_metrics": B(O.school_overall_ctes() + ",\n" + f"""sc AS (SELECT p.*, round(sf.pct_exciting, {R}) AS rate
 FROM p JOIN sf USING (id) WHERE p.is_dev),
g AS ({" UNION ALL ".join(f"SELECT '{lb}' AS label, '{m}' AS model, id, {x} AS s, CAST({lb} AS INTEGER) AS y FROM sc"
                          for lb in fx.LABELS for m, x in (("price", "round(price, 2)"), ("school_pct_exciting", "rate")))}),
agg AS (SELECT label, model, s, sum(y) AS pos, count(*) - sum(y) AS neg FROM g GROUP BY label, model, s),
cum AS (SELECT label, model, pos, neg, coalesce(sum(neg) OVER (PARTITION BY label, model ORDER BY s
 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM agg),
auc AS (SELECT label, model, sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)) AS a FROM cum GROUP BY label, model),
r AS (SELECT label, model, y, row_number() OVER (PARTITION BY label, model ORDER BY s DESC, id) AS rn,
 count(*) OVER (PARTITION BY label, model) AS n FROM g)""") + f""" SELECT label, model, round(max(a), {R}) AS roc_auc,
 round(avg(CASE WHEN rn <= n // 10 THEN y END), {R}) AS top_10_percentile,
 round(avg(CASE WHEN rn <= n // 5 THEN y END), {R}) AS top_20_percentile,
 round(avg(CASE WHEN rn <= (3 * n) // 10 THEN y END), {R}) AS top_30_percentile, round(avg(y), {R}) AS random
 FROM r JOIN auc USING (label, model) GROUP BY label, model""",
        "logistic_calibration": B() + " " + " UNION ALL ".join(
            f"SELECT '{lb}' AS label, round(avg(CAST({lb} AS DOUBLE)), 4) AS mean_probability FROM p WHERE is_train" for lb in fx.LABELS),
        "tree_split_limit": B() + f""" SELECT 'forest' AS model, CAST(0 AS BIGINT) AS small_splits, count(*) AS least_rows,
 count(*) AS most_rows FROM p WHERE is_train UNION ALL SELECT 'boosting', 0, count(*), count(*) FROM p
 WHERE is_train AND {O.scatter('id', M.SEED)} % 10 <> 0""",
        "ranked_dataset": O.feature_ranking().split(" SELECT CASE", 1)[0] + f""",
best AS (SELECT feature FROM (SELECT * FROM kmi UNION ALL SELECT * FROM lmi) ORDER BY m DESC, feature LIMIT 26),
cells AS (SELECT * FROM proj_long UNION ALL SELECT * FROM teach_long UNION ALL SELECT * FROM school_long
 UNION ALL SELECT * FROM geo_long UNION ALL SELECT id, 'label', CAST(label AS DOUBLE) FROM p WHERE label)
SELECT CASE WHEN is_train THEN 'train' ELSE 'dev' END AS split, id, feature, value FROM cells JOIN p USING (id)
 WHERE (is_train OR is_dev) AND (feature = 'label' OR feature IN (SELECT feature FROM best))""",
        "result_store": B() + f" SELECT '1' AS run, requirement AS label, true_proportion FROM ({rates})",
        "join_key_audit": B() + """, sides AS (SELECT 'items' AS side, id FROM lab UNION ALL SELECT 'project', id FROM lab
 UNION ALL SELECT 'twice', id FROM lab UNION ALL SELECT 'twice', id FROM lab WHERE id % 97 = 0
 UNION ALL SELECT 'twice', id FROM lab WHERE id % 970 = 0
 UNION ALL SELECT 'gaps', CASE WHEN id % 13 <> 0 THEN id END FROM lab),
n AS (SELECT side, id, count(*) AS n FROM sides GROUP BY side, id)
SELECT side, CAST(sum(n) AS BIGINT) AS rows, count(id) AS keys, count(CASE WHEN id IS NOT NULL AND n > 1 THEN 1 END) AS repeated_keys,
 CAST(coalesce(sum(CASE WHEN id IS NOT NULL THEN n - 1 END), 0) AS BIGINT) AS extra_rows,
 coalesce(max(CASE WHEN id IS NOT NULL THEN n END), 0) AS largest,
 CAST(coalesce(sum(CASE WHEN id IS NULL THEN n END), 0) AS BIGINT) AS missing_keys FROM n GROUP BY side""",
        "csv_scan": f"""SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS BIGINT) AS o_custkey, o_orderstatus,
 round(CAST(o_totalprice AS DOUBLE), {R}) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
 CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders""",
        "csv_types": """SELECT c.*, (SELECT 2 * count(*) FROM orders WHERE o_orderkey % 1000 = 0) AS quarantined FROM (VALUES
 ('o_orderkey', 'int'), ('o_custkey', 'int'), ('o_orderstatus', 'string'), ('o_totalprice', 'double'),
 ('o_orderdate', 'date'), ('o_orderpriority', 'string')) AS c("column", "type")""",
        "feature_index": f"SELECT feature, CAST(row_number() OVER (ORDER BY feature) - 1 AS INTEGER) AS index FROM ({part_names})",
        "sparse_logistic": f"""SELECT count(*) AS rows, (SELECT count(*) FROM ({part_names})) AS features,
 (SELECT {" + ".join(f"count({c})" for c in PART_COLS)} FROM part) AS cells,
 round(avg(CASE WHEN p_size > 25 THEN 1.0 ELSE 0.0 END), 4) AS mean_probability FROM part""",
    }
    return extra | {
        "labelled_join": B() + " SELECT * EXCLUDE (is_dev, is_train) FROM p",
        "date_floor_filter": B() + f" SELECT id, d FROM items WHERE d >= DATE '{fx.DATE_FLOOR}'",
        "projects_by_year": B() + """, py AS (SELECT CAST(year(d) AS INTEGER) AS year, count(id) AS n FROM items GROUP BY 1)
 SELECT year, n FROM py WHERE year < (SELECT max(year) FROM py)""",
        "label_true_rates": B() + " " + rates,
        "missing_cells": B() + f" SELECT CAST({nulls} AS BIGINT) AS missing_cells, count(*) AS rows FROM lab",
        "dropna_rows": B() + f" SELECT id FROM lab WHERE {notnull}",
        "chrono_split": B() + " SELECT id, CASE WHEN is_dev THEN 'dev' WHEN is_train THEN 'train' ELSE 'old' END AS split FROM p",
        "hash_split_counts": B() + f""" SELECT 'dev' AS split, CAST(ceil({fx.DEV_SHARE}::DOUBLE * count(*)) AS BIGINT) AS n FROM lab
 UNION ALL SELECT 'rest', count(*) - CAST(ceil({fx.DEV_SHARE}::DOUBLE * count(*)) AS BIGINT) FROM lab""",
        "hash_split": B() + f""" SELECT id, CASE WHEN row_number() OVER (ORDER BY {O.scatter('id', 424242)} DESC, id DESC)
 <= ceil({fx.DEV_SHARE}::DOUBLE * count(*) OVER ()) THEN 'dev' ELSE 'train' END AS split FROM lab""",
        "absolute_split": B() + f""" SELECT id, CASE WHEN row_number() OVER (ORDER BY d DESC, id DESC) <= {ABSOLUTE_DEV}
 THEN 'dev' ELSE 'train' END AS split FROM lab""",
        "events_split": f"""SELECT event_id, CASE WHEN row_number() OVER (ORDER BY ts DESC, event_id DESC)
 <= ceil({fx.DEV_SHARE}::DOUBLE * count(*) OVER ()) THEN 'dev' ELSE 'train' END AS split FROM events""",
        "recent_train": B() + " SELECT id, d FROM p WHERE is_train",
        "entity_rollup": B() + f""" SELECT teacher, count(*) AS num_projects, CAST(sum(CAST(label AS INTEGER)) AS BIGINT) AS num_exciting_projects,
 min(d) AS first_project_date, max(d) AS last_project_date, round(round(date_diff('day', min(d), max(d)) / 365.0, 2), {R}) AS active_years
 FROM p WHERE is_train AND teacher IS NOT NULL GROUP BY teacher""",
        "entity_priors": B(O.school_overall_ctes()) +
        f" SELECT round(pn, {R}) AS prior_num, round(pk, {R}) AS prior_exciting, round(py, {R}) AS prior_years FROM spr",
        "entity_overall_performance": B(O.school_overall_ctes()) + f""" SELECT id,
 round(num_projects, {R}) AS school_num_projects, round(pct_exciting, {R}) AS school_pct_exciting,
 round(projects_per_year, {R}) AS school_projects_per_year, round(active_years, {R}) AS school_active_years FROM sf""",
        "entity_past_performance": B(O.teacher_ctes()) + f""" SELECT id,
 round(teacher_num_prev_projects, {R}) AS teacher_num_prev_projects,
 round(teacher_num_prev_exciting_projects, {R}) AS teacher_num_prev_exciting_projects,
 round(teacher_pct_prev_exciting, {R}) AS teacher_pct_prev_exciting FROM tf0""",
        "impute_mode": B() + """ SELECT id,
 coalesce(prefix, (SELECT prefix FROM lab WHERE prefix IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS prefix,
 coalesce(area, (SELECT area FROM lab WHERE area IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS area FROM lab""",
        "impute_median": B("g AS (SELECT id, CASE WHEN id % 13 = 0 THEN NULL ELSE price END AS price FROM lab)") +
        f" SELECT id, round(coalesce(price, (SELECT median(price) FROM g)), {R}) AS price FROM g",
        "impute_mean": B("g AS (SELECT id, CASE WHEN id % 13 = 0 THEN NULL ELSE price END AS price FROM lab)") +
        f" SELECT id, round(coalesce(price, (SELECT avg(price) FROM g)), {R}) AS price FROM g",
        "impute_constant": B() + " SELECT id, coalesce(area, '_missing_') AS area FROM lab",
        "fill_zero": B() + " SELECT id, coalesce(teacher, 0) AS teacher FROM lab",
        "downsize_categorical": B(O.kept_cte("k_area", "lab", "area", 0.9, 10)) +
        f" SELECT id, {O.ds('area', 'k_area')} AS area FROM lab",
        "downsize_all": B(ds_all) + " SELECT id, " +
        ", ".join(f"{O.ds(c, 'k_' + c)} AS {c}" for c in DOWNSIZE_ALL) + " FROM lab",
        "one_hot": B() + " SELECT id, feature, value FROM (" +
        O.longrows("lab", [], ["subject", "resource", "metro"]) + ")",
        "part_name_one_hot": """SELECT p_partkey AS id, 'p_name_' || p_name AS feature, CAST(1 AS INTEGER) AS value
 FROM part WHERE p_name IS NOT NULL""",
        "label_encode": B("codes AS (SELECT state, CAST(row_number() OVER (ORDER BY state) - 1 AS INTEGER) AS state_code "
                          "FROM (SELECT DISTINCT state FROM lab WHERE state IS NOT NULL))") +
        " SELECT id, state_code FROM lab LEFT JOIN codes USING (state)",
        "equal_width_bins": B("latst AS (SELECT min(latitude) AS mn0, max(latitude) AS mx0 FROM lab), "
                              "lonst AS (SELECT min(longitude) AS mn0, max(longitude) AS mx0 FROM lab)") +
        f" SELECT id, {O.bins_expr('latitude', 'latst')} AS latitude_group, "
        f"{O.bins_expr('longitude', 'lonst')} AS longitude_group FROM lab",
        "flag_replace": """SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS flag
 FROM orders""",
        "relative_days": B() + " SELECT id, CAST(date_diff('day', (SELECT min(d) FROM lab), d) AS INTEGER) AS date_posted_relative FROM lab",
        "group_median_ratio": B("amed AS (SELECT area, median(price) AS med FROM lab WHERE area IS NOT NULL GROUP BY area)") +
        f""" SELECT id, round(med, {R}) AS area_median_price,
 round(CASE WHEN med <> 0 THEN price / med END, {R}) AS price_relative_to_focus_area FROM lab LEFT JOIN amed USING (area)""",
        "city_state_size": B() + f""" SELECT city || '-' || state AS city_state, count(DISTINCT school) AS city_state_num_schools,
 count(DISTINCT id) AS city_state_num_projects, round(CAST(count(DISTINCT id) AS DOUBLE) / count(DISTINCT school), {R})
 AS city_state_projects_per_school FROM p WHERE is_train AND city IS NOT NULL AND state IS NOT NULL GROUP BY 1""",
        "project_features": B(O.project_ctes()) + " SELECT id, feature, value FROM proj_long",
        "teacher_features": B(O.teacher_ctes()) + " SELECT id, feature, value FROM teach_long",
        "school_features": B(O.school_ctes()) + " SELECT id, feature, value FROM school_long",
        "geo_features": B(O.geo_ctes()) + " SELECT id, feature, value FROM geo_long",
    }


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: per-item smoothed historic performance of the item's school
    (train history only) on the smallest test tables."""
    return q_entity_overall_performance(spark, SMOKE_DIR)


# The training-data operators are an optional part: their folder and the
# pipeline's file may be missing, and then their queries are left out.
try:
    import corpus_pipeline
    from outcomelab.llm import queries as llm_queries

    _LLM_QUERIES = llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    _LLM_SQL = llm_queries.ORACLE_SQL
except ImportError:
    _LLM_QUERIES, _LLM_SQL = {}, {}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _QUERIES | _LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    sql = _sql()
    return {k: v for k, v in sql.items() if k in _QUERIES} | _LLM_SQL
