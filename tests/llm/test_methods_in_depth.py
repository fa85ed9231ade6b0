"""Operators against brute force where SQL cannot express them: the search
graph, Kneser-Ney models, personal data, secrets, rollups, packing, the
character map, near-copy groups and the pipeline."""

import hashlib
import math
import random
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
from outcomelab.llm import (embedding_graph, packing, pii, queries, repeated_spans, secret_scan, sentencepiece_codec, simhash,
                            token_rollup, toxicity)

BPE = queries.tokenizer("byte_bpe_50k.json")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- embedding graph -------------------------------------------------------------

def family_vectors(seed=1, n=1500, d=16, family=250):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[100:400] = x[:300] + 0.2 * rng.normal(size=(300, d))          # pairs around the threshold
    dense = rng.normal(size=d) + 0.1 * rng.normal(size=(family, d))  # a family of near copies
    return np.concatenate([x, dense, np.repeat(x[:1], 30, axis=0)])


def truth_of(x):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    label = np.arange(len(x))
    while True:
        new = np.array([label[line].min() for line in near])
        if np.array_equal(new, label):
            return near.sum(1) - 1, label
        label = new


@pytest.mark.parametrize("shard,large", [(200, 3200), (200, 400), (60, 10 ** 6)])
def test_graph_finds_the_links_itself(spark, shard, large):
    x = family_vectors()
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = {r["vec_id"]: r for r in embedding_graph.near_duplicates(table, shard=shard, large=large).collect()}
    links, label = truth_of(x)
    found = np.array([got[i]["n_links"] for i in range(len(x))])
    assert np.all(found <= links) and found.sum() >= 0.9 * links.sum()
    assert np.mean([got[i]["component_id"] == label[i] for i in range(len(x))]) >= 0.98
    assert all(label[got[i]["component_id"]] == label[i] for i in range(len(x)))      # never joins too much
    audited = [i for i in range(0, len(x), 50)]
    assert {r["recall"] for r in got.values()} != {None} and got[0]["recall"] >= 0.9
    assert found[audited].sum() >= 0.9 * links[audited].sum()


def test_one_shard_is_exact_and_the_audit_too(spark):
    x = family_vectors(2, 700, family=100)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in embedding_graph.near_duplicates(table, shard=10 ** 6).collect()}
    links, label = truth_of(x)
    assert [got[i]["n_links"] for i in range(len(x))] == links.tolist()
    assert [got[i]["component_id"] for i in range(len(x))] == label.tolist() and got[0]["recall"] == 1.0
    nodes = table.select(F.col("vec_id").alias("node"), F.col("embedding").alias("vec"), F.col("vec_id").alias("least"),
                         F.lit(1).cast("long").alias("copies"))
    for group, block in ((4096, 16384), (3, 100)):
        truth = {r["node"]: r["truth"] for r in embedding_graph.audit(nodes, len(x), 0.95, group, block).collect()}
        assert truth == {i: links[i] for i in range(0, len(x), 50)}


def test_search_widens_until_the_recall_holds(spark, monkeypatch):
    x = family_vectors(3, 400, family=60)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    real, asked = embedding_graph.search, []

    def poor(nodes, count, threshold, overlap, beam, *rest):
        asked.append((overlap, beam))
        out = real(nodes, count, threshold, overlap, beam, *rest)
        return out.withColumn("linked", F.lit(0).cast("long")) if len(asked) < 2 else out

    monkeypatch.setattr(embedding_graph, "search", poor)
    got = embedding_graph.near_duplicates(table).collect()
    assert asked == [(3, 24), (6, 48)] and got[0]["recall"] >= embedding_graph.RECALL
    asked.clear()
    monkeypatch.setattr(embedding_graph, "search", lambda *a: (asked.append(a[3]), real(*a).withColumn("linked", F.lit(0).cast("long")))[1])
    got = embedding_graph.near_duplicates(table).collect()
    assert asked == [3, 6, 12] and got[0]["recall"] == 0.0       # reported, not hidden


def test_vectors_of_two_dimensions(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [1.0, 0.0, 0.0]), (4, [1.0, 0.01, 0.0]), (5, [1.0])]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_graph.near_duplicates(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (1, 3), 4: (1, 3), 5: (0, 5)}


# -- Kneser-Ney models ------------------------------------------------------------

def contexts_of(text):
    """(context, next byte) of every byte of every word and of the blank behind it."""
    for w in toxicity.words(text):
        line = b" " + w + b" "
        for i in range(1, len(line)):
            yield line[max(0, i - toxicity.ORDER + 1):i], line[i]


class PlainKneserNey:
    """Dictionaries and the recursion of the formula, one class."""

    def __init__(self, own, corpus):
        self.counts = Counter(g for t in own for g in contexts_of(t))
        tops = {c + bytes([b]) for c, b in self.counts}
        seen = {c + bytes([b]) for t in corpus for c, b in contexts_of(t)}
        self.shared = {o: self.after(seen, o) for o in range(1, toxicity.SHARED + 1)}
        self.own = {o: self.after(tops, o) for o in range(toxicity.CLASS_FROM, toxicity.ORDER)}

    @staticmethod
    def after(source, order):
        """After how many different bytes each (context, byte) of that order occurs."""
        grams = {g[i:] for g in source for i in range(len(g))}
        # a sequence that begins a word is only ever that long
        longer = {g for g in grams if len(g) == order + 1 and (g[0] != 32 or g in source)}
        return Counter((g[1:-1], g[-1]) for g in longer)

    def smooth(self, table, context, byte, below):
        row = {b: n for (c, b), n in table.items() if c == context}
        total = sum(row.values())
        if not total:
            return below
        d = toxicity.DISCOUNT
        return max(row.get(byte, 0) - d, 0) / total + d * len(row) / total * below

    def lower(self, context, byte):
        table = self.shared[1]
        p = (table[b"", byte] + 0.5) / (sum(table.values()) + 128)
        for tables in (self.shared, self.own):
            for order in sorted(tables):
                if 1 < order <= len(context) + 1:
                    p = self.smooth(tables[order], context[len(context) + 1 - order:], byte, p)
        return p

    def p(self, context, byte):
        return self.smooth(self.counts, context, byte, self.lower(context[1:], byte))


@pytest.fixture(scope="module")
def kneser_ney(spark):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcé") for _ in range(rnd.randint(1, 6))) for _ in range(25)]
    texts = [[" ".join(rnd.choices(words[:15] if y else words[5:], k=8)) for _ in range(12)] for y in (0, 1)]
    corpus = [*texts[0], *texts[1], "unlabelled words abab caca", "", "ccc"]
    train = spark.createDataFrame([(t, y) for y in (0, 1) for t in texts[y]], "text string, y int").repartition(3)
    docs = spark.createDataFrame([(t,) for t in corpus], "text string").repartition(3)
    model = toxicity.build_model(toxicity._count_grams(train), toxicity.shared_continuations(docs, "text"))
    return model, [PlainKneserNey(texts[y], corpus) for y in (0, 1)], corpus


def pack_bytes(raw):
    return int.from_bytes(raw, "big")


def test_model_equals_the_plain_formula(kneser_ney):
    model, plain, corpus = kneser_ney
    rnd = random.Random(9)
    strange = ["".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 7))) for _ in range(40)]
    pairs = sorted({g for t in [*corpus, *strange] for g in contexts_of(t)})
    got = model.probabilities(np.array([pack_bytes(c + bytes([b])) for c, b in pairs], np.int64))
    want = np.array([[k.p(c, b) for k in plain] for c, b in pairs])
    assert np.allclose(got, want, rtol=1e-10), np.abs(got - want).max()
    text = "abab " + strange[0]
    logs = sum(math.log(plain[1].p(c, b) / plain[0].p(c, b)) for c, b in contexts_of(text))
    found = toxicity.words(text)
    assert math.isclose(float(model.of_words(found).sum()), logs, rel_tol=1e-9)
    assert math.isclose(model.difference(text), logs / (sum(map(len, found)) + len(found)), rel_tol=1e-9)


def test_probabilities_of_all_next_bytes_sum_to_one(kneser_ney):
    model, _, corpus = kneser_ney
    some = sorted({c for t in corpus for c, _ in contexts_of(t)})[::3] + [b" zz", b"zzz", b" "]
    for context in some:
        keys = np.array([pack_bytes(context + bytes([b])) for b in range(1, 256)], np.int64)
        rest = model.single[0]      # the zero byte, which no text has, keeps its floor
        total = model.probabilities(keys).sum(0)
        assert np.all(total <= 1 + 1e-12) and np.all(total >= 1 - rest - 1e-12)


def test_unseen_by_both_classes_pulls_to_neither(kneser_ney):
    model, plain, _ = kneser_ney
    # after a context neither class has, both give what the shared orders give
    context = b"zqz"
    keys = np.array([pack_bytes(context + bytes([b])) for b in b"abz "], np.int64)
    p = model.probabilities(keys)
    assert np.array_equal(p[:, 0], p[:, 1])


def test_shared_counts_grow_with_the_corpus(spark):
    rnd = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyzàéïõüß"
    texts = [" ".join("".join(rnd.choices(letters, k=6)) for _ in range(30)) for _ in range(60)]
    sizes = [len(toxicity.shared_continuations(spark.createDataFrame([(t,) for t in texts[:n]], "text string"), "text")[3][0])
             for n in (3, 15, 60)]
    assert sizes[0] < sizes[1] < sizes[2]


def test_toxicity_stage_keeps_clashing_columns(spark):
    rows = [(i, f"word{i % 7} good text {'vexo ' * 9 if i % 4 == 0 else ''}", "s", "d") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __score string, __difference string")
    marks = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int")
    kept = toxicity.keep_ordinary(docs, marks)
    assert kept.columns == docs.columns and {r["doc_id"] % 4 for r in kept.collect()} == {1, 2, 3}
    assert {tuple(r)[2:] for r in kept.collect()} == {("s", "d")}


# -- personal data ------------------------------------------------------------------

def luhn(digits):
    total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
    return total % 10 == 0


def plain_pii(text):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 14 <= len(d := re.sub(r"[^0-9]", "", m.group())) <= 19 and luhn(d)]
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def odd_texts(n=400, seed=12):
    rnd = random.Random(seed)
    parts = ["a@b.co", "x.y+z@host-1.example.org", "@", "1.2.3.4", "300.1.1.1", "10.0.0.255.7", "4111 1111 1111 1111",
             "5500-0000-0000-0004", "1234567890123456", "+1 (555) 010-9999", "+49 30 1234", " ", "-", ".", "é", "٣", "j", "0",
             "12", "@@", "a.b", "..", "+", "(", ")", "\n", "192.168.000.001", " dot ", " at ", "(at)", "one two three "]
    return ["".join(rnd.choices(parts, k=rnd.randint(1, 25))) for _ in range(n)]


def test_base_spans_equal_the_literal_patterns(spark):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    extra = spark.createDataFrame([(10 ** 6 + i, t) for i, t in enumerate(odd_texts())] + [(None, None)], "doc_id long, text string")
    docs = table.unionByName(extra)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = pii.find_pii(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        base = plain_pii(texts[r["doc_id"]])
        line = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert r["base_sha256"] == sha(line), r["doc_id"]
        counts = Counter(k for _, k, _ in base)
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [counts[k] for k in range(4)]
        assert set(filter(None, line.split(","))) <= set(r["spans"].split(","))


@pytest.mark.parametrize("text,masked", [
    ("write jоhn@host.com now", "write [EMAIL] now"),                        # a Cyrillic o inside the name
    ("write john dot smith@host.com now", "write [EMAIL] now"),
    ("john dot smith at host dot org.", "[EMAIL]."),
    ("at one nine two dot one six eight dot one dot one zero now", "at [IP] now"),
    ("IP: one zero.zero.two point one two seven", "IP: [IP]"),
    ("ip ①②③.4.5.6", "ip [IP]"),
    ("mail ⅿax@host.org", "mail [EMAIL]"),
    ("mail ρeter@host.org", "mail [EMAIL]"),
    ("ann@a.org and bob@b.org", "[EMAIL] and [EMAIL]"),
    ("one dot two and three", "one dot two and three"),
    ("plain at host and dot", "plain at host and dot"),
])
def test_disguises_are_masked_as_a_whole(text, masked):
    find = pii.Detector()
    base = find.spans(text)
    assert base == plain_pii(text)
    assert pii.mask(text, base + find.added(text, base)) == masked


def test_added_spans_never_repeat_a_covered_one():
    find = pii.Detector()
    for text in odd_texts(600, 5):
        base = find.spans(text)
        for a, k, b in find.added(text, base):
            assert 0 <= a < b <= len(text) and not any(x <= a and b <= y for x, r, y in base if r == k)


# -- secrets ---------------------------------------------------------------------------

def plain_secrets(text):
    out = [(m.start(), 0, m.end(), "assign") for m in re.finditer(
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m.group(2)) >= 8]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(out)


def test_secrets_equal_the_literal_patterns(spark):
    rnd = random.Random(3)
    parts = ["password", "TOKEN", "api_key", "apikey", "secret", ": ", "=", "'", '"', " ", "abcdefgh", "x1", "AKIA", "ABCDEFGHIJKL",
             "0123456789abcdef", "é", "\n", "AKIAAKIA1234567890", "ffffffffffffffffffffffffffffffff", "-", "."]
    extra = ["".join(rnd.choices(parts, k=rnd.randint(1, 20))) for _ in range(300)]
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    docs = table.unionByName(spark.createDataFrame([(10 ** 6 + i, t) for i, t in enumerate(extra)] + [(None, None)],
                                                   "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    folder = queries._store(spark, "secrets-test")
    ledger = secret_scan.update_ledger(docs, "text", folder, "b")
    got = secret_scan.findings_by_path(docs, "doc_id", "text", ledger).select(
        "doc_id", "n_assign", "n_access", "n_hex", secret_scan.spans_text().alias("spans")).collect()
    assert len(got) == len(texts)
    for r in got:
        found = plain_secrets(texts[r["doc_id"]])
        assert r["spans"] == ",".join(f"{k}:{a}:{b}" for a, _, b, k in found)
        counts = Counter(k for *_, k in found)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(counts[k] for k in ("assign", "access", "hex"))


def test_a_batch_name_used_again_loses_nothing(spark, tmp_path):
    versions = lambda *rows: spark.createDataFrame(list(rows), "blob string, text string")
    key = "AKIA" + "A" * 16
    first, second = versions(("p1", key), ("p2", key + " x")), versions(("p3", "password: abcdefgh1"), ("p1", "nothing"))
    for few in (secret_scan.FEW, 0):        # the plan for few and the one for many unseen blobs
        folder = str(tmp_path / f"l%2F{few}")
        secret_scan.update_ledger(first, "text", folder, "a%2Fb", few=few)
        ledger = secret_scan.update_ledger(second, "text", folder, "a%2Fb", few=few)
        every = first.unionByName(second)
        got = {(r["blob"], r["n_assign"], r["n_access"], r["n_hex"]) for r in
               secret_scan.findings_by_path(every, "blob", "text", ledger).collect()}
        assert got == {("p1", 0, 1, 0), ("p2", 0, 1, 0), ("p3", 1, 0, 0), ("p1", 0, 0, 0)}
        before = ledger.count()
        assert secret_scan.update_ledger(every, "text", folder, "third").count() == before == 12
        # a delivery that died before its commit is invisible
        ledger.select("blob").write.parquet(f"{folder}/rows/dead")
        assert secret_scan.read_ledger(spark, folder).count() == before
        # versions the ledger does not know have counts of zero
        unknown = secret_scan.findings_by_path(versions(("q", key + key)), "blob", "text", ledger).first()
        assert (unknown["n_access"], unknown["spans"]) == (0, [])


def test_only_unseen_pairs_are_scanned(spark, tmp_path):
    folder = str(tmp_path / "ledger")
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "path int, text string")
    secret_scan.update_ledger(docs, "text", folder, "1", secret_scan.RULES[:2])
    secret_scan.update_ledger(docs.unionByName(spark.createDataFrame([(4, "c")], docs.schema)), "text", folder, "2")
    rows = secret_scan.read_ledger(spark, folder).groupBy("batch", "rule").count().collect()
    assert {(r["batch"], r["rule"]): r["count"] for r in rows} == {
        ("1", "assign"): 2, ("1", "access"): 2, ("2", "assign"): 1, ("2", "access"): 1, ("2", "hex"): 3}


# -- token rollup ------------------------------------------------------------------------

SCHEMA = "op string, doc_id long, source string, lang string, tokenizer string, tokens long, bytes long, seq long"


def replay(batches):
    """Totals by a dictionary of documents."""
    state, loose, done = {}, [], set()
    for name, rows in batches:
        if name in done:
            continue
        done.add(name)
        latest = {}
        for op, i, *rest in rows:
            if i is None:
                sign = -1 if op == "delete" else 1
                loose.append((tuple(rest[:3]), (sign, sign * rest[3], sign * rest[4])))
            elif i not in latest or latest[i][2][5] <= rest[5]:
                latest[i] = (op, i, rest)
        for op, i, rest in latest.values():
            state.pop(i, None)
            if op != "delete":
                state[i] = (tuple(rest[:3]), (1, rest[3], rest[4]))
    out = defaultdict(lambda: np.zeros(3, int))
    for key, amounts in [*state.values(), *loose]:
        out[key] += amounts
    return {k: tuple(v) for k, v in out.items() if v.any()}


@pytest.mark.parametrize("compact_every", [3, 100])
def test_rollup_equals_a_replay(spark, tmp_path, compact_every):
    rnd = random.Random(compact_every)
    batches = []
    for b in range(7):
        rows = [(rnd.choice(["insert", "insert", "delete", "revise"]), rnd.choice([None, *range(12)]), rnd.choice(["s", None]), "en",
                 rnd.choice(["v1", "v2"]), rnd.randint(0, 9), rnd.randint(0, 9), n) for n in range(15)]
        batches.append((f"a%2F{b}/..?=ü", rows))
        if b in (2, 5):
            batches.append(batches[rnd.randrange(len(batches))])      # delivered again
    store = str(tmp_path / "store")
    for name, rows in batches:
        token_rollup.apply_batch(spark.createDataFrame(rows, SCHEMA), store, name, compact_every)
    got = {(r["source"], r["lang"], r["tokenizer"]): (r["documents"], r["tokens"], r["bytes"])
           for r in token_rollup.totals(spark, store).collect()}
    assert got == replay(batches)
    assert token_rollup.committed(spark, store) == list(dict.fromkeys(n for n, _ in batches))


def test_rows_without_an_id_count_one_by_one(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = [("insert", None, "s", "en", "v", 5, 20, 0), ("insert", None, "s", "en", "v", 10, 30, 0), ("insert", None, "s", "en", "v", 10, 30, 0)]
    token_rollup.apply_batch(spark.createDataFrame(rows, SCHEMA), store, "x")
    assert tuple(token_rollup.totals(spark, store).first())[3:] == (3, 25, 80)
    token_rollup.apply_batch(spark.createDataFrame([("delete", *rows[1][1:])], SCHEMA), store, "y")
    assert tuple(token_rollup.totals(spark, store).first())[3:] == (2, 15, 50)


def test_a_batch_that_failed_half_way_is_written_again(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "store")
    rows = spark.createDataFrame([("insert", 1, "s", "en", "v", 5, 20, 0)], SCHEMA)
    real = token_rollup._last_states
    monkeypatch.setattr(token_rollup, "_last_states", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        token_rollup.apply_batch(rows, store, "x")
    assert token_rollup.totals(spark, store).count() == 0
    monkeypatch.setattr(token_rollup, "_last_states", real)
    assert token_rollup.apply_batch(rows, store, "x") and token_rollup.totals(spark, store).first()["tokens"] == 5


def test_the_query_totals_all_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    counted = token_rollup.count_tokens(docs, BPE, "byte_bpe_50k@1").collect()
    want = defaultdict(lambda: np.zeros(3, int))
    for r in counted:
        want[r["source"], r["lang"]] += (1, r["tokens"], r["bytes"])
    got = {(r["source"], r["lang"]): (r["documents"], r["tokens"], r["bytes"]) for r in
           queries.op1_token_counts(spark, SF_SMALL).collect()}
    assert got == {k: tuple(v) for k, v in want.items()}
    first = {}
    for r in docs.collect():
        first[r["text"]] = min(first.get(r["text"], r["doc_id"]), r["doc_id"])
    later = {r["doc_id"] for r in token_rollup.later_copies(docs).collect()}
    assert later == {r["doc_id"] for r in docs.collect()} - set(first.values()) and later


# -- packing -----------------------------------------------------------------------------

def best_fit_decreasing(lengths, size):
    """Number of windows when every piece, longest first, goes where least room is left that holds it."""
    rooms, used = Counter(), 0
    for n in sorted(lengths, reverse=True):
        fit = min((r for r, c in rooms.items() if c and r >= n), default=None)
        if fit is None:
            used, fit = used + 1, size
        else:
            rooms[fit] -= 1
        rooms[fit - n] += 1
    return used


def test_packing_uses_as_few_windows_as_best_fit_decreasing(spark):
    rnd = random.Random(8)
    for size in (16, 64):
        for _ in range(40):
            lengths = [rnd.randint(1, size) for _ in range(rnd.randint(0, 200))]
            entries, used = packing.plan(Counter(lengths), size)
            assert used == best_fit_decreasing(lengths, size)
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    packed = packing.pack(table, BPE).collect()
    assert {"ids_crc32", "doc_tokens", "sequence_id", "offset", "start", "length", "doc_id"} == set(packed[0].asDict())
    assert len({r["sequence_id"] for r in packed}) == best_fit_decreasing([r["length"] for r in packed], packing.WINDOW)


# -- the character map ---------------------------------------------------------------------

def double_array(entries):
    """A compiled map in the public file format: every trie node owns a block of 256 units."""
    trie, texts, at = {}, b"", {}
    for source, target in entries.items():
        at[source] = len(texts)
        texts += target + b"\0"
        for i in range(len(source) + 1):
            trie.setdefault(source[:i], set()).update(source[i:i + 1])
    blocks = {node: 256 * (i + 1) for i, node in enumerate(sorted(trie))}
    units = [0] * (256 * (len(blocks) + 1))
    place = {b"": 0}
    for node in sorted(trie):            # parents before children
        for label in trie[node]:
            place[node + bytes([label])] = blocks[node] ^ label
    for node, index in place.items():
        leaf = node in entries
        units[index] = ((index ^ blocks[node]) << 10) | (leaf << 8) | (node[-1] if node else 0)
        if leaf:
            units[blocks[node]] = at[node] | 0x80000000
    raw = struct.pack(f"<{len(units)}I", *units)
    return struct.pack("<I", len(raw)) + raw + texts


ENTRIES = {"ﬁ".encode(): b"fi", "é".encode(): b"e", b"ab": b"X", b"abc": b"YZ", b"abcd": b"", "①".encode(): b"1", b"\t": b" ",
           "é".encode(): "è".encode()}


def rewritten(data):
    """(output, source span of each byte) by trying every entry at every place."""
    out, spans, i = b"", [], 0
    while i < len(data):
        best = max((k for k in ENTRIES if data.startswith(k, i)), key=len, default=None)
        to, n = (data[i:i + 1], 1) if best is None else (ENTRIES[best], len(best))
        out, spans, i = out + to, spans + [(i, i + n)] * len(to), i + n
    return out, spans


def test_character_map_reads_the_longest_prefix():
    found = sentencepiece_codec.CharacterMap(double_array(ENTRIES))
    rnd = random.Random(1)
    for _ in range(300):
        data = b"".join(rnd.choice([*ENTRIES, b"a", b"b", b"abcx", b"e", "中".encode(), b" "]) for _ in range(12))
        for i in range(len(data)):
            best = max((k for k in ENTRIES if data.startswith(k, i)), key=len, default=None)
            assert found.longest(data, i) == (None if best is None else (len(best), ENTRIES[best]))


def test_codec_with_a_map_follows_the_library(spark):
    import sentencepiece as spm
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    with open(queries.tokenizer("piece_bpe_32k.model"), "rb") as f:
        proto.ParseFromString(f.read())
    proto.normalizer_spec.precompiled_charsmap = double_array(ENTRIES)
    model = proto.SerializeToString()
    codec, lib = sentencepiece_codec.Codec(model), spm.SentencePieceProcessor(model_proto=model)
    assert not codec.plain
    rnd = random.Random(2)
    for _ in range(200):
        text = "".join(rnd.choice(["ﬁ", "é", "ab", "abc", "abcd", "①", "\t", "é", "the ", "word", " ", "中", "x", "▁"])
                       for _ in range(rnd.randint(0, 15)))
        out, spans = rewritten(text.encode())
        aligned = codec.normalise(text)
        marked = out.replace(b" ", "▁".encode())
        assert aligned.data == (b"\xe2\x96\x81" + marked if marked else b"")
        assert aligned.data.decode() == lib.normalize(text)
        inner = [s for byte, s in zip(out, spans) for _ in range(3 if byte == 32 else 1)]
        assert list(zip(aligned.start[3:].tolist(), aligned.end[3:].tolist())) == inner


# -- near-copy groups and the pipeline -------------------------------------------------------

def test_keep_one_keeps_one_row_of_each_group(spark):
    a, near = "one two three four five six seven", "nothing alike in this other text at all"
    rows = [(1, a), (5, a), (5, near), (7, near), (None, "third text stands alone here"), (None, "third text stands alone here"),
            (None, "a fourth one without any id either"), (9, None), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("sha", F.lit("x")).withColumn("__n", F.lit(1))
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    want = [(1, a), (5, near), (8, ""), (None, "a fourth one without any id either"), (None, "third text stands alone here")]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(want, key=str)
    assert simhash.keep_one(docs.limit(0)).count() == 0


def plain_near_dedup(rows):
    """Rows kept: one of every component of fingerprints at three bits or fewer."""
    prints = [(i, t, simhash.fingerprint(t)) for i, t in rows]
    distinct = sorted({f for *_, f in prints})
    label = {f: f for f in distinct}

    def root(f):
        while label[f] != f:
            f = label[f]
        return f

    for x, f in enumerate(distinct):
        for g in distinct[x + 1:]:
            if (f ^ g).bit_count() <= 3:
                label[root(g)] = root(f)
    best = {}
    for i, t, f in prints:
        key = (i is None, i if i is not None else 0, sha(t))
        if root(f) not in best or key < best[root(f)][0]:
            best[root(f)] = (key, i)
    return {i for _, i in best.values()}


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    source = {r["doc_id"]: r for r in docs.collect()}
    # toxicity: the stage drops exactly what the operator marks
    marked = {r["doc_id"] for r in toxicity.score_toxicity(docs, labels).where("predicted = 1").collect()}
    left = {i: r["text"] or "" for i, r in source.items() if i not in marked}
    last = {}
    for i, t in left.items():
        last[t] = max(last.get(t, i), i)
    left = {i: left[i] for i in last.values()}
    left = {i: left[i] for i in plain_near_dedup(sorted(left.items()))}
    find = pii.Detector()
    masked = {i: pii.mask(t, find.spans(t) + find.added(t, find.spans(t))) for i, t in left.items()}
    from outcomelab.llm.byte_bpe import ByteBpe, read_vocabulary
    bpe = ByteBpe(read_vocabulary(BPE))
    sizes = {i: len(bpe.encode(t)) + 1 for i, t in masked.items()}
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in got} == sizes
    assert sum(r["length"] for r in got) == sum(sizes.values())
    stage = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        stage = step(spark, stage, SF_SMALL).checkpoint()
    rows = stage.collect()
    assert {r["doc_id"]: r["text"] for r in rows} == masked
    for r in rows:      # all other columns as they were, the length that of the new text
        was = source[r["doc_id"]]
        assert (r["lang"], r["source"], r["n_chars"]) == (was["lang"], was["source"], len(r["text"]))


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_tables(spark, stage):
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "mail a@b.co " * 5, None, None, None),
            (3, "x " * 150_000, "de", "s", 300_000), (4, "same text here", "en", "s", 14), (4, "same text here", "en", "s", 14),
            (5, "same text here", "en", "t", 14)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumn("__id", F.lit("a")).withColumn("bits", F.lit(1)).withColumn("start", F.lit(2)).withColumn("score", F.lit(3))
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, SF_SMALL)
    got = out.collect()
    if stage == "packing":
        assert {r["doc_id"] for r in got} == {None, 1, 2, 3, 4, 5}
        return
    assert out.columns == docs.columns
    n = {"toxicity": 8, "exact_dedup": 4, "simhash_near_dedup": 4, "pii": 8}[stage]
    assert len(got) == n, [r["doc_id"] for r in got]


def test_repeat_lengths_that_the_window_count_cannot_hold(spark):
    docs = spark.createDataFrame([(1, "x" * 900), (2, "y" * 10 + "x" * 900)], "doc_id long, text string")
    with pytest.raises(ValueError):
        repeated_spans.remove_repeats(docs, length=400)
    with pytest.raises(ValueError):
        repeated_spans.remove_repeats(docs, length=20, gram=32)
    got = {r["doc_id"]: r["n_removed"] for r in repeated_spans.remove_repeats(docs, length=286).collect()}
    assert got[2] == 900 and got[1] == 899
