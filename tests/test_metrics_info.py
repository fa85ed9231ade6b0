"""AUC, top-fraction precision and mutual information against NumPy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from outcomelab.functions.columns import digamma_np
from outcomelab.operators.evaluate import roc_auc, top_fraction_precision
from outcomelab.operators.info import jittered_points, mi_discrete, mi_from_points


def _scored(spark, n=600, seed=3):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n)
    s = np.round(rng.normal(size=n) + 0.8 * y, 1)       # rounded: many ties
    rows = [(i, float(s[i]), int(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, s double, y int"), s, y


def test_auc_matches_rank_sum(spark):
    df, s, y = _scored(spark)
    pos, neg = s[y == 1], s[y == 0]
    ref = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(roc_auc(df, "s", "y").first()["roc_auc"] - ref) < 1e-12


def test_top_fraction_precision_matches_sort(spark):
    df, s, y = _scored(spark, 613)
    order = sorted(range(len(s)), key=lambda i: (-s[i], i))
    n = len(s)
    got = top_fraction_precision(df, "s", "y", "id").first()
    for name, k in (("top_10_percentile", n // 10), ("top_20_percentile", n // 5),
                    ("top_30_percentile", 3 * n // 10)):
        assert abs(got[name] - np.mean([y[i] for i in order[:k]])) < 1e-12
    assert abs(got["random"] - y.mean()) < 1e-12


def test_mi_discrete_matches_formula(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 4, 500)
    y = (rng.random(500) < 0.2 + 0.15 * x).astype(int)
    df = spark.createDataFrame([(i, str(x[i]), int(y[i])) for i in range(500)], "id long, x string, y int")
    got = mi_discrete(df, ["x"], "y").first()["mutual_information"]
    ref = 0.0
    for a in np.unique(x):
        for b in (0, 1):
            nxy = np.sum((x == a) & (y == b))
            if nxy:
                ref += nxy / 500 * math.log(500 * nxy / (np.sum(x == a) * np.sum(y == b)))
    assert abs(got - ref) < 1e-12


def _brute_mi(x, y, k=3):
    labs, cnt = np.unique(y, return_counts=True)
    nc = np.array([dict(zip(labs, cnt))[v] for v in y])
    keep = nc > 1
    x, y, nc = x[keep], y[keep], nc[keep]
    kk = np.minimum(k, nc - 1)
    m = np.empty(len(x))
    for i in range(len(x)):
        d = np.sort(np.abs(x[y == y[i]] - x[i]))[1:]
        r = d[kk[i] - 1]
        # distance <= nextafter(r, 0): strictly closer, or equal when r = 0
        m[i] = np.sum(np.abs(x - x[i]) < r) if r > 0 else np.sum(x == x[i])
    return max(0.0, digamma_np(len(x)) + digamma_np(kk).mean() - digamma_np(nc).mean() - digamma_np(m).mean())


@pytest.mark.parametrize("bucket_rows", [40, 100_000])   # ranked buckets with halos / one window per class
def test_mi_continuous_matches_brute_force(spark, bucket_rows):
    rng = np.random.default_rng(7)
    n = 700
    y = rng.integers(0, 2, n)
    a = rng.normal(size=n) + y                       # informative
    b = rng.integers(0, 3, n).astype(float)          # heavy ties, broken by the jitter
    rows = [(i, float(a[i]), float(b[i]), int(y[i])) for i in range(n)] + [(n, 0.0, 0.0, 2)]  # label seen once
    df = spark.createDataFrame(rows, "id long, a double, b double, y int")
    pts = jittered_points(df, ["a", "b"], "y", "id").checkpoint(eager=True)
    got = {r.feature: r.mutual_information for r in mi_from_points(pts, 3, bucket_rows=bucket_rows).collect()}
    p = pts.toPandas()
    for f in ("a", "b"):
        sub = p[p.feature == f]
        assert abs(got[f] - _brute_mi(sub._x.to_numpy(), sub._y.to_numpy())) < 1e-9
    assert got["a"] > 0.05


def test_digamma_integers():
    # psi(1) = -gamma, psi(n + 1) = psi(n) + 1/n
    assert abs(digamma_np(1.0) + 0.5772156649015329) < 1e-10
    assert abs(digamma_np(11.0) - digamma_np(10.0) - 0.1) < 1e-12


def test_digamma_column(spark):
    from outcomelab.functions.columns import digamma
    vals = [1.0, 2.0, 3.0, 17.0, 1000.0]
    got = [r.v for r in spark.createDataFrame([(v,) for v in vals], "x double")
           .select(digamma("x").alias("v")).collect()]
    assert np.allclose(got, digamma_np(vals), atol=1e-12)
    _ = F  # functions module used by the column helper


def test_mi_continuous_exact_duplicates(spark):
    # no jitter: many exact duplicates, so some k-th neighbour distances are 0
    rng = np.random.default_rng(5)
    n = 400
    y = rng.integers(0, 2, n)
    x = rng.integers(0, 4, n).astype(float) + 0.5 * y * rng.integers(0, 2, n)
    pts = spark.createDataFrame([("f", i, int(y[i]), float(x[i])) for i in range(n)],
                                "feature string, _id long, _y int, _x double")
    got = mi_from_points(pts, 3, bucket_rows=50).first()["mutual_information"]
    assert abs(got - _brute_mi(x, y)) < 1e-9


def test_mi_is_exactly_the_same_whatever_the_partitioning(spark):
    from outcomelab.operators.info import mi_continuous, mi_discrete

    rng = np.random.default_rng(5)
    n = 1500
    a, b = rng.normal(size=n), rng.integers(0, 4, size=n)
    y = (a + rng.normal(size=n) > 0).astype(int)
    rows = [(i, float(a[i]), float(b[i]), str(b[i] % 3), bool(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, a double, b double, s string, y boolean")

    def run(parts):
        d = df.repartition(parts)
        cont = {r.feature: r.mutual_information for r in mi_continuous(d, ["a", "b"], "y").collect()}
        disc = {r.feature: r.mutual_information for r in mi_discrete(d, ["s"], "y").collect()}
        return cont, disc

    assert run(1) == run(7)      # exact equality, not a tolerance


def test_indicator_columns_keep_their_mark_and_match_the_contingency(spark):
    from outcomelab.operators.encode import indicator_columns, one_hot
    from outcomelab.operators.info import mi_indicators
    from outcomelab.session import materialize

    rng = np.random.default_rng(9)
    rows = [(i, "abc"[rng.integers(0, 3)], float(i % 2), bool(rng.integers(0, 2)), None if i % 9 == 0 else i % 4 == 0)
            for i in range(300)]
    df = spark.createDataFrame(rows, "id long, s string, x double, b boolean, y boolean")
    wide = materialize(one_hot(df, exclude=["id"]), "marked").join(df.select("id", "x"), "id").drop("x")
    flags = indicator_columns(wide)          # written, read, joined: the mark stays
    assert flags == ["s_a", "s_b", "s_c"]
    got = {r.feature: r.mutual_information for r in mi_indicators(wide, flags, "y").collect()}
    ref = {r.feature: r.mutual_information for r in mi_discrete(wide, flags, "y").collect()}
    assert got.keys() == ref.keys() and all(abs(got[f] - ref[f]) < 1e-15 for f in ref)


def test_scatter_is_one_to_one_and_takes_any_id(spark):
    from outcomelab.functions.columns import SCATTER_PRIME, scatter

    ids = spark.range(0, 20000).select(scatter("id", 5).alias("u")).collect()
    u = np.array([r.u for r in ids])
    assert len(set(u)) == 20000 and u.min() >= 0 and u.max() < SCATTER_PRIME
    assert abs(np.corrcoef(u[:-1], u[1:])[0, 1]) < 0.03 and abs(u.mean() / SCATTER_PRIME - 0.5) < 0.02
    odd = spark.createDataFrame([("x1",), (None,), ("-7",)], "id string").select(scatter("id").alias("u")).collect()
    assert all(0 <= r.u < SCATTER_PRIME for r in odd)


def test_neighbour_counts_over_partition_ends(spark):
    """Intervals that reach over many partitions, tied values, a rare label and repeated ids."""
    from outcomelab.operators import info
    rng = np.random.default_rng(5)
    n, k = 240, 3
    x = np.round(rng.normal(size=n), 1) + np.where(np.arange(n) % 3 == 0, 0.0, rng.normal(size=n))
    y = np.where(np.arange(n) % 60 == 0, 2, np.arange(n) % 2)
    f = np.arange(n) // 120
    pts = spark.createDataFrame([(int(a), i, int(b), float(v)) for i, (a, b, v) in enumerate(zip(f, y, x))],
                                "_f int, _id long, _y int, _x double")
    size = {(a, b): int(((f == a) & (y == b)).sum()) for a in (0, 1) for b in (0, 1, 2)}
    of = {key: min(k, v - 1) for key, v in size.items()}
    pts = pts.withColumn("_k", F.when(F.col("_y") == 2, min(of[0, 2], of[1, 2])).otherwise(k))
    want = {}
    for i in range(n):
        own = [j for j in range(n) if f[j] == f[i] and y[j] == y[i] and j != i]
        kk = min(of[0, 2], of[1, 2]) if y[i] == 2 else k
        d, nb = sorted((abs(x[j] - x[i]), x[j]) for j in own)[kk - 1]
        lo, hi = (nb if nb < x[i] else x[i] - d), (nb if nb > x[i] else x[i] + d)
        every = x[f == f[i]]
        want[i] = float((every == x[i]).sum() if d == 0 else ((every > lo) & (every < hi)).sum())
    near = info._intervals(pts, k)
    got = info._counts_inside(near, n, 12).groupBy("_id").agg(F.sum("_m").alias("m"))     # 20 partitions
    assert {r["_id"]: r["m"] for r in got.collect()} == want
    again = info._counts_inside(info._intervals(pts.unionByName(pts.where("_id = 7")), k), n, 12)
    assert again.where("_id = 7").count() >= 2


def test_each_point_is_ordered_twice_not_as_three_events(spark, monkeypatch):
    from outcomelab.operators import info
    sizes = []
    real = info.sorted_checkpoint
    monkeypatch.setattr(info, "sorted_checkpoint", lambda df, *a: sizes.append(df.count()) or real(df, *a))
    df = spark.range(400).select("id", (F.col("id") % 2 == 0).alias("y"), F.sin("id").alias("a"), F.cos("id").alias("b"))
    assert info.mi_continuous(df, ["a", "b"], "y").count() == 2
    assert sizes == [800, 800]


def test_kth_neighbour_equals_the_sorted_list():
    """Ties, values whose distances round alike, rare labels, infinities and NaN; and no full sort for ordinary rows."""
    from outcomelab.operators import info

    def plain(f, y, x, k_of, k):
        n, out = len(x), []
        for i in range(n):
            near = [(x[i] - x[i - j], x[i - j]) for j in range(1, k + 1) if i - j >= 0 and (f[i], y[i]) == (f[i - j], y[i - j])]
            near += [(x[i + j] - x[i], x[i + j]) for j in range(1, k + 1) if i + j < n and (f[i], y[i]) == (f[i + j], y[i + j])]
            near = sorted((p for p in near if p[0] == p[0]))
            out.append(near[k_of[i] - 1] if len(near) >= k_of[i] else (np.nan, None))
        return out

    rng = np.random.default_rng(3)
    with np.errstate(invalid="ignore"):
        for k in (1, 3, 5):
            n = 400
            x = np.concatenate([rng.integers(0, 9, 200) / 4, rng.normal(size=100), 1e6 + rng.integers(0, 5, 50) * 1e-10,
                                rng.integers(0, 5, 44) * 1e-17, [np.inf, np.inf, -np.inf, np.nan, np.nan, -1e6]])
            f, y = rng.integers(0, 2, n), np.where(rng.random(n) < 0.03, 2, rng.integers(0, 2, n))
            order = np.lexsort((x, y, f))
            f, y, x = f[order], y[order], x[order]
            k_of = np.where(rng.random(n) < 0.1, rng.integers(1, k + 1, n), k)
            d, nb = info._kth(f, y, x, k_of, k)
            for i, (wd, wv) in enumerate(plain(f, y, x, k_of, k)):
                assert (np.isnan(d[i]) and np.isnan(wd)) or (d[i] == wd and nb[i] == wv), (k, i)


def test_ordinary_neighbours_are_not_sorted(monkeypatch):
    from outcomelab.operators import info
    x = np.sort(np.random.default_rng(2).normal(size=5000))
    monkeypatch.setattr(info.np, "lexsort", lambda *a, **b: pytest.fail("rows were sorted"))
    one = np.ones(5000, int)
    assert len(info._kth(one, one, x, 3 * one, 3)[0]) == 5000
