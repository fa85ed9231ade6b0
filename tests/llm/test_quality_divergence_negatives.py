"""Quality, source divergence and hard negatives against brute force."""

import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from outcomelab.llm import hard_negatives, labelled, quality, source_divergence


def doc_rows(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


# -- quality ------------------------------------------------------------------

def labelled_texts(spark, n=400, seed=3):
    rnd = random.Random(seed)
    words = ["".join(rnd.choices("abcdefghij", k=rnd.randint(2, 8))) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        text = " ".join(rnd.choices(words, k=rnd.randint(20, 200)))
        bad = i % 3 == 0
        if bad:
            text = text.upper().replace(" ", "!! ") if i % 2 else " ".join([text.split()[0]] * 150)
        rows.append((i, text, "en", "s"))
        labels.append((i, 0 if bad else 1, 0))
    return doc_rows(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_quality_is_learnt_from_the_other_folds(spark):
    docs, labels = labelled_texts(spark)
    got = {r["doc_id"]: r for r in quality.score_quality(docs, labels).collect()}
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    assert len(got) == 400
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [i for i in got if got[i]["held_out"]]
    assert sum(got[i]["predicted"] == truth[i] for i in held) >= 0.97 * len(held)
    # labels of held-out rows change nothing
    flipped = labels.withColumn("quality", F.when(labelled.fold("doc_id") == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    again = {r["doc_id"]: r["score"] for r in quality.score_quality(docs, flipped).collect()}
    assert all(abs(again[i] - got[i]["score"]) < 1e-12 for i in got)


def test_quality_measures_are_those_of_whole_texts():
    good, bad = [b"the quick brown fox " * 20] * 50, [b"!!! BUY !!! " * 30] * 50
    m = quality.Model("t", quality.train_dictionary(good, 4096), quality.train_dictionary(bad, 4096))
    text = "the quick brown fox " * 500 + "!!! BUY !!! " * 500
    g, b = quality.compressor(m.good), quality.compressor(m.bad)
    parts = [text.encode()[i:i + quality.BLOCK] for i in range(0, len(text), quality.BLOCK)]
    sg, sb = sum(len(g.compress(p)) for p in parts), sum(len(b.compress(p)) for p in parts)
    assert m.measures(text) == ((sb - sg) / max(sb, sg), min(1.0, sg / len(text)))
    assert m.measures("the quick brown fox jumps")[0] > 0 > m.measures("!!! BUY !!! BUY")[0]


def test_quality_edge_cases(spark):
    docs, labels = labelled_texts(spark, 120)
    odd = doc_rows(spark, [(1000, None, None, None), (1001, "", "", ""), (None, "abc", "en", "s"), (1002, "é" * 300_000, "en", "s"),
                           (1003, "abc", "en", "s"), (1003, "abc", "en", "s")])
    extra = docs.unionByName(odd).withColumn("score", F.lit("x")).withColumn("__measures", F.lit(1)).withColumn("y", F.lit(2))
    strange = labels.unionByName(spark.createDataFrame([(None, 1, 0), (3, 7, 0), (999, 1, 0), (4, None, 0)], labels.schema))
    got = quality.score_quality(extra, strange).collect()
    assert len(got) == 126 and all(0 <= r["score"] <= 1 for r in got)
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r)
    assert by[1000][0]["score"] == by[1001][0]["score"]
    known = [r["quality"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5]
    known += [1] * (zlib.crc32(b"999") % 5 > 0)     # a label without a document counts in the share only
    assert math.isclose(by[1000][0]["score"], sum(known) / len(known))
    assert len(by[1003]) == 2 and by[1003][0]["score"] == by[1003][1]["score"] and not by[None][0]["held_out"]
    model = quality.fit(extra, strange)
    kept = quality.with_score(extra, model, "text", "quality_score")
    assert set(extra.columns) < set(kept.columns) and kept.count() == 126
    assert quality.score_quality(docs.limit(0), labels).count() == 0
    for none in (labels.limit(0), labels.where("quality = 1"), labels.where("quality = 0")):
        share = {r["score"] for r in quality.score_quality(docs, none).collect()}
        assert share == {1.0 if none.where("quality = 1").count() else 0.0}


def test_quality_bounds_hold(spark):
    docs, labels = labelled_texts(spark, 200)
    drawn, known = labelled.training_draw(labels, "doc_id", "quality", 10)
    assert drawn.count() == 20 and sum(known.values()) == sum(1 for i in range(200) if zlib.crc32(str(i).encode()) % 5)
    blocks = quality._drawn_blocks(docs.select("text", (F.col("doc_id") % 2).cast("int").alias("y")), 7)
    assert {c: len(b) for c, b in blocks.items()} == {0: 7, 1: 7}


# -- source divergence ----------------------------------------------------------

def brute_divergence(rows, min_docs=10, top=10):
    rows = [tuple(v or "" for v in r[1:]) for r in rows]
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, df, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(lower))
        counts[lang, source].update(found)
        df[lang].update(set(found))
        groups.add((lang, source))
    out = []
    for lang, source in groups:
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        v = len(kept)
        peers = [s for g, s in groups if g == lang]

        def share(count, total):
            return 1 + 10 ** 9 * (count + 2) // (total + 2 * v)

        total = {s: sum(counts[lang, s][t] for t in kept) for s in peers}
        every = {t: sum(counts[lang, s][t] for s in peers) for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        pair = [(other, sum(f(share(counts[lang, source][t], total[source]), share(counts[lang, other][t], total[other]))
                            for t in kept)) for other in peers if other != source]
        term = [(t, f(share(counts[lang, source][t], total[source]), share(every[t], sum(every.values())))) for t in kept
                if counts[lang, source][t] > 0 and share(counts[lang, source][t], total[source])
                > share(every[t], sum(every.values()))]
        for part, items, last in (("pair", pair, None), ("term", term, top)):
            ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:last]
            out += [(lang, source, part, item, value, i + 1) for i, (item, value) in enumerate(ranked)]
    return sorted(out)


def divergence_rows(seed=5, n=300):
    rnd = random.Random(seed)
    vocabulary = [*"alpha beta gamma delta EPSILON Zeta été ñandú 東京 x".split(), *(f"w{chr(97 + i)}" for i in range(26))]
    rows = []
    for i in range(n):
        text = "".join(rnd.choice(vocabulary) + rnd.choice([" ", ", ", "1", "\x00", "-"]) for _ in range(rnd.randint(0, 30)))
        rows.append((i, text, rnd.choice(["en", "de"]), rnd.choice(["a", "b", "c", "ab"])))
    rows += [(1000 + i, rows[5][1], "en", rnd.choice(["a", "hot"])) for i in range(200)]  # one text, many copies and sources
    rows += [(2000, None, None, None), (2001, "alpha", None, "z"), (2002, "1 2 3", "en", "silent"), (2003, "solo", "xx", "only"),
             (2004, "one two", "yy", "p"), (2005, "three", "yy", "q"), (None, "beta", "en", "a"), (None, "beta", "en", "a")]
    return rows


@pytest.mark.parametrize("min_docs", [1, 10, 40])
def test_divergence_equals_brute_force(spark, min_docs):
    rows = divergence_rows()
    docs = doc_rows(spark, rows).withColumn("n", F.lit(1)).withColumn("term", F.lit("t")).withColumn("h", F.lit("h"))
    got = sorted(tuple(r) for r in source_divergence.audit(docs.repartition(7), min_docs=min_docs).collect())
    assert got == brute_divergence(rows, min_docs)


def test_divergence_flushes_and_very_long_texts(spark):
    rows = divergence_rows(8, 60) + [(5000, "alpha Beta " * 200_000, "en", "a")]
    docs = doc_rows(spark, rows)
    whole = source_divergence.collapse(docs, "text", "lang", "source")
    want = sorted(tuple(r) for r in source_divergence.term_counts(whole).collect())
    assert sorted(tuple(r) for r in source_divergence.term_counts(whole, flush=3).collect()) == want
    got = sorted(tuple(r) for r in source_divergence.audit(docs).collect())
    assert got == brute_divergence(rows)


def test_divergence_collapses_copies_once(spark):
    rows = divergence_rows()
    whole = source_divergence.collapse(doc_rows(spark, rows), "text", "lang", "source").collect()
    assert len(whole) == len({(r[2] or "", r[1] or "") for r in rows})
    for r in whole:
        want = Counter(x[3] or "" for x in rows if (x[2] or "") == r["lang"] and (x[1] or "") == r["text"])
        assert {c["source"]: c["n"] for c in r["copies"]} == want


def test_divergence_of_nothing(spark):
    assert source_divergence.audit(doc_rows(spark, [])).count() == 0
    one = source_divergence.audit(doc_rows(spark, [(1, "a b", "en", "s")])).collect()
    assert one == []
    two = source_divergence.audit(doc_rows(spark, [(1, "a b", "en", "s"), (2, None, "en", "t")])).collect()
    assert sorted(tuple(r) for r in two) == [("en", "s", "pair", "t", 0, 1), ("en", "t", "pair", "s", 0, 1)]


def test_share_takes_counts_beyond_a_long(spark):
    big = 7 * 10 ** 15
    row = spark.range(1).select(source_divergence.share(F.lit(big), F.lit(3 * big), F.lit(1000)).alias("p")).first()
    assert row["p"] == 1 + 10 ** 9 * (big + 2) // (3 * big + 2000)


# -- hard negatives -------------------------------------------------------------

def brute_negatives(rows, positives=5, negatives=3):
    rows = [(i, v, label) for i, v, label in rows if i is not None and v is not None and label is not None
            and all(x is not None and math.isfinite(x) for x in v)]
    rows = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows]
    out = []
    for a, u, own in rows:
        if a % 50:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(u, v)), i, label) for i, v, label in rows if i != a and len(v) == len(u)),
                        key=lambda r: r[:2])
        for s, p, _ in [r for r in scored if r[2] == own][:positives]:
            fit = [(n, -t) for t, n, label in scored if label != own and 50 * -s <= 100 * -t <= 95 * -s][:negatives]
            out += [(a, p, r + 1, n, -s, t) for r, (n, t) in enumerate(fit)]
    return sorted(out)


def vector_rows(seed, n=600, d=6, spread=0.4, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, d))
    v = centres[rng.integers(0, 5, n)] + spread * rng.normal(size=(n, d))
    return [(int(i), [float(np.float32(x)) for x in v[i]], int(rng.integers(0, labels))) for i in range(n)]


def mined(spark, rows, **kw):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(5)
    table = table.withColumn("id", F.lit("x")).withColumn("vec", F.lit(1)).withColumn("cluster", F.lit(2))
    usable = hard_negatives.usable(table, "vec_id", "embedding", "label")
    return sorted(tuple(r) for r in hard_negatives.mine(usable, F.col("id") % 50 == 0, **kw).collect())


@pytest.mark.parametrize("seed,kw", [(1, {}), (2, {"block": 50, "group": 3, "cluster": 2}), (3, {"block": 100, "group": 1000, "cluster": 1})])
def test_negatives_equal_brute_force(spark, seed, kw):
    rows = vector_rows(seed)
    got = mined(spark, rows, **kw)
    assert got == brute_negatives(rows) and len(got) > 50


def test_negatives_ties_nulls_and_odd_rows(spark):
    rows = vector_rows(4, 150, d=3)
    rows += [(300 + i, [1.0, 0.5, -0.25], i % 2) for i in range(60)]          # equal vectors: ties by id
    rows += [(400, [0.0, 0.0, 0.0], 1), (401, [0.0, 0.0, 0.0], 1), (402, [-0.0, 0.0, 0.0], 0)]
    rows += [(500, [1.0, 2.0], 1), (501, [1.0, 2.0], 1), (502, [0.7, 1.5], 0), (550, [], 1), (551, [], 1), (552, [], 2)]
    rows += [(600, None, 1), (650, [1.0, None, 2.0], 1), (700, [1.0, float("nan"), 0.0], 1), (750, [float("inf"), 0.0, 0.0], 1),
             (800, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1)]
    rows += [(900, [-5.0, -5.0, -5.0], 9), (901, [5.0, 5.0, 4.0], 9), (902, [4.0, 4.0, 4.0], 3)]  # negative positive scores
    assert mined(spark, rows, block=40, group=4, cluster=2) == brute_negatives(rows)
    repeated = rows + [rows[10]] * 3
    assert mined(spark, repeated) == brute_negatives(repeated)
    assert mined(spark, []) == [] and mined(spark, rows[1:2]) == []


def test_negatives_of_huge_components_stay_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.integers(-2 ** 20, 2 ** 20, 3) * 2.0 + i % 3], i % 3) for i in range(120)]
    assert mined(spark, rows, block=30) == brute_negatives(rows)


def test_walk_stops_early_and_is_exact():
    rng = np.random.default_rng(7)
    x = np.floor(256 * (rng.normal(size=(5000, 8)) * np.exp(rng.normal(size=(5000, 1)))))
    members = np.floor(256 * (np.ones(8) + 0.05 * rng.normal(size=(40, 8))))
    units = hard_negatives._unit(members)
    centre = hard_negatives._unit(units.sum(0, keepdims=True))[0]
    order, bounds = hard_negatives.shared_list(x, centre, float(np.arccos(np.clip(units @ centre, -1, 1)).max()))
    assert np.all(members @ x[order].T <= np.linalg.norm(members, axis=1)[:, None] * bounds[None, :] + 1e-6)
    labels, ids = np.zeros(len(x), np.int64), np.arange(len(x)) + 100
    member, asked, low, high = hard_negatives._asked(hard_negatives.pd.Series([[]] * 40), True)
    touched = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray) and key.ndim == 1:
                touched.append(len(key))
            return super().__getitem__(key)

    best = hard_negatives.walk(members, np.arange(40), np.zeros(40, np.int64), member, low, high, True, 5, x.view(Watched), ids,
                               labels, order, bounds)
    scores = members @ x.T
    for m in range(40):
        want = sorted(zip(-scores[m], ids))[:5]
        assert [(-s, i) for s, i in zip(best.score[best.q == m], best.id[best.q == m])] == want
    assert 0 < sum(touched) < len(x)


def test_windows():
    for s in itertools.chain(range(-300, 300), [10 ** 17 + 3]):
        low, high = hard_negatives._window(s)
        assert 50 * s <= 100 * low < 50 * s + 100 and 95 * s - 100 < 100 * high <= 95 * s


def test_registered_negatives_read_the_moved_labels(spark):
    from outcomelab.llm.queries import op13_hard_negatives
    table = spark.read.parquet(f"{SF_ORACLE}/embeddings.parquet").collect()
    rows = [(r["vec_id"], list(r["embedding"]), (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in table]
    assert sorted(tuple(r) for r in op13_hard_negatives(spark, SF_ORACLE).collect()) == brute_negatives(rows)
