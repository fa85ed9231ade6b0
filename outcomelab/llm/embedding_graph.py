"""Embedding near-duplicates with a robust-pruned flat graph.

Vectors are dealt to overlapping cluster shards (each to its nearest
``OVERLAP`` centres).  In a shard every vector gets a pool of near and of
random vectors, which robust pruning thins: a candidate goes when a chosen
neighbour is nearer to it, by ``ALPHA``, than the vector itself.  The
adjacency lists of all shards are united per vector.  Every vector is then
searched for in its shards: greedy beam search from the shard's medoids, and,
once the beam stands still, expansion of everything within the range until
nothing within it is left unexpanded.  Found pairs are verified by their
cosine in double precision.  The graph answers at every size.

Recall is audited on a stated query set: the vectors whose (least) id is divisible
by ``EVERY``, each compared with all vectors in blocks.  While the share of their true
links that the search has found is below ``RECALL``, the search is repeated wider
(more shards per vector and a longer beam), up to ``WIDEST``.  The measured recall
is a column of the result.

Pairs stay in their shards.  A task sends on, for each of its vectors, the number
of vectors linked to it and one edge to the least vector of its component in the shard,
so a family of n near copies costs rows in proportion to n, not to its n * n
links.  A pair that several shards hold is counted by the first of them.

Bounds.  Equal vectors are one node, so a vector that a third of all rows
share is searched once.  Centres are fitted on at most ``SAMPLE`` vectors and
number at most ``MAX_CENTRES``.  A shard of more than ``LARGE`` vectors, as they appear beyond
some millions of vectors, is dealt once more, to centres drawn from its own members.  A
shard of more than ``SHARD`` vectors is cut into blocks, and every pair of its
blocks becomes a shard, so a task holds a bounded number of vectors and no pair of
vectors loses its common shard; blocks a shard are at most 2 * LARGE / SHARD, unless
most of one drawn centre's vectors crowd around it.

Defined results.  Vectors that are null, empty, zero, or hold null or
non-finite components link with nothing and are their own component.  Vectors
are compared within their own dimension.  Null ids are ignored as names of components unless a
component has no other.  Repeated rows are repeated in the result and count
as links of each other.  An empty table gives an empty result; labels and
extra columns are not read.
"""

from __future__ import annotations

import logging
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelab.llm.common import materialize
from outcomelab.llm.components import connected_components

THRESHOLD = 0.95
SHARD = 3_000
OVERLAP = 3
SAMPLE = 16_384
MAX_CENTRES = 4_096
DEGREE = 24
POOL = 64
ALPHA = 1.2
BEAM = 24
MEDOIDS = 16
LARGE = 16 * SHARD
CHUNK = 32_768         # vectors that meet a large shard's drawn centres in one task
EVERY = 50
AUDIT_GROUP = 4_096    # audited vectors in one task
AUDIT_BLOCK = 16_384   # vectors they meet there
WIDEST = 12
RECALL = 0.97

_log = logging.getLogger(__name__)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def fit_centres(sample: np.ndarray, k: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """Spherical k-means on the sample."""
    x = _unit(sample)
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = np.concatenate([(x[i:i + 4096] @ centres.T).argmax(1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        size = np.sqrt((sums * sums).sum(1))
        centres = np.where(size[:, None] > 0, sums / np.maximum(size, 1e-300)[:, None], centres)
    return centres


def robust_prune(sims: np.ndarray, pools: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """[n, degree] neighbours out of each row's pool (-1: none).  ``sims`` is
    the shard's similarity matrix; distance is 1 - similarity."""
    n = len(pools)
    rows = np.arange(n)
    own = np.where(pools >= 0, sims[rows[:, None], pools], -np.inf)
    order = np.argsort(-own, axis=1, kind="stable")
    pools, own = np.take_along_axis(pools, order, 1), np.take_along_axis(own, order, 1)
    left = (own > -np.inf) & (pools != rows[:, None])
    out = np.full((n, degree), -1, np.int64)
    for r in range(degree):
        first = left.argmax(1)
        live = left[rows, first]
        if not live.any():
            break
        chosen = pools[rows, first]
        out[:, r] = np.where(live, chosen, -1)
        nearer = alpha * (1 - sims[chosen[:, None], pools]) <= 1 - own
        left &= ~(nearer & live[:, None]) & (pools != chosen[:, None])
    return out


def build_graph(x: np.ndarray, seed: int = 7) -> list[np.ndarray]:
    """Adjacency lists of unit vectors ``x``: pruned pools and their reverses."""
    n = len(x)
    if n < 2:
        return [np.zeros(0, np.int64)] * n
    sims = (x @ x.T).astype(np.float32)
    rng = np.random.default_rng(seed)
    k = min(POOL, n - 1)
    near = np.argpartition(-sims, k, axis=1)[:, :k + 1]
    far = rng.integers(0, n, (n, min(POOL // 4, n)))
    pools = np.sort(np.concatenate((near, far), axis=1), axis=1)
    pools[:, 1:][pools[:, 1:] == pools[:, :-1]] = -1
    kept = robust_prune(sims, pools)
    a, r = np.nonzero(kept >= 0)
    b = kept[a, r]
    src, dst = np.concatenate((a, b)), np.concatenate((b, a))
    pairs = np.unique(src * n + dst)
    src, dst = pairs // n, pairs % n
    order = np.lexsort((-sims[src, dst], src))  # a hub keeps its nearest reverse edges
    src, dst = src[order], dst[order]
    starts = np.searchsorted(src, np.arange(n + 1))
    return [np.union1d(dst[starts[i]:starts[i + 1]][:2 * DEGREE], kept[i][kept[i] >= 0]) for i in range(n)]


def medoids(x: np.ndarray, count: int = MEDOIDS) -> np.ndarray:
    """The vector nearest the mean, then each time the one least like those taken."""
    taken = [int((x @ x.mean(0)).argmax())]
    best = x @ x[taken[0]]
    while len(taken) < min(count, len(x)):
        taken.append(int(best.argmin()))
        best = np.maximum(best, x @ x[taken[-1]])
    return np.array(taken)


def range_search(x: np.ndarray, table: np.ndarray, queries: np.ndarray, threshold: float, beam: int,
                 step: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(query, found) index pairs at a similarity of ``threshold`` or more.
    ``table`` holds neighbours, padded with -1."""
    n, q = len(x), len(queries)
    rows = np.arange(q)[:, None]
    seen = np.full((q, n), -2.0)  # similarity once reached
    open_ = np.zeros((q, n), bool)  # reached, not yet expanded
    entry = medoids(x)
    seen[:, entry] = x[queries] @ x[entry].T
    open_[:, entry] = True
    slack = 1e-9
    active = np.arange(q)
    while len(active):
        s = seen[active]
        at = min(beam, n) - 1
        floor = -np.partition(-s, at, axis=1)[:, at]
        rank = np.where(open_[active] & ((s >= floor[:, None]) | (s >= threshold - slack)), s, -3.0)
        pick = np.argpartition(-rank, min(step, n - 1), axis=1)[:, :step] if n > step else np.tile(np.arange(n), (len(active), 1))
        good = np.take_along_axis(rank, pick, 1) > -3.0
        busy = good.any(1)
        active, pick, good = active[busy], pick[busy], good[busy]
        if not len(active):
            break
        r = np.broadcast_to(active[:, None], pick.shape)[good]
        open_[r, pick[good]] = False
        hop = table[pick[good]]
        r = np.repeat(r, table.shape[1])
        hop = hop.ravel()
        ok = hop >= 0
        r, hop = r[ok], hop[ok]
        new = seen[r, hop] == -2.0
        code = np.unique(r[new] * n + hop[new])
        r, hop = code // n, code % n
        for i in range(0, len(r), 1 << 17):
            a, b = r[i:i + (1 << 17)], hop[i:i + (1 << 17)]
            seen[a, b] = np.einsum("ij,ij->i", x[queries[a]], x[b])
            open_[a, b] = True
    a, b = np.nonzero(seen >= threshold - slack)
    return queries[a], b


def _stack(values) -> np.ndarray:
    return np.array(values.tolist(), dtype=np.float64)


def _graph_lists(pdf: pd.DataFrame) -> pd.DataFrame:
    ids = pdf["node"].to_numpy()
    lists = build_graph(_unit(_stack(pdf["vec"])))
    return pd.DataFrame({"node": ids, "near": [ids[v] for v in lists]})


def _components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member's number for each of ``n`` nodes under the edges (a, b)."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _search_shard(threshold: float, beam: int):
    """(node, linked, least): for each member, the weight of the linked members
    this shard counts, and the least member of its component here."""
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node")
        ids, raw, copies = pdf["node"].to_numpy(), _stack(pdf["vec"]), pdf["copies"].to_numpy()
        n, shard = len(ids), int(key[0])
        size = np.sqrt((raw * raw).sum(1))
        x = raw / size[:, None]
        width = max(1, max(map(len, pdf["near"])))
        table = np.full((n, width), -1, np.int64)
        for i, near in enumerate(pdf["near"]):
            near = np.asarray(near, np.int64)
            at = np.minimum(np.searchsorted(ids, near), n - 1)
            at = at[ids[at] == near]
            table[i, :len(at)] = at
        # shards before this one that a member is also in: they count the pairs they share
        before = [[s for s in own if s < shard] for own in pdf["shards"]]
        bit = {s: i for i, s in enumerate(sorted({s for own in before for s in own}))}
        early = np.zeros((n, 64 * math.ceil((len(bit) + 1) / 64)), bool)
        for i, own in enumerate(before):
            early[i, [bit[s] for s in own]] = True
        early = np.packbits(early, axis=1).view(np.uint64)
        linked, label = np.zeros(n, np.int64), np.arange(n)
        ends = [np.zeros((0, 2), np.int64)]
        for start in range(0, n, 512):
            a, b = range_search(x, table, np.arange(start, min(start + 512, n)), threshold, beam)
            exact = np.einsum("ij,ij->i", raw[a], raw[b]) / (size[a] * size[b])
            keep = (a != b) & (exact >= threshold)
            pairs = np.unique(np.minimum(a, b)[keep] * n + np.maximum(a, b)[keep])
            ends.append(np.column_stack((pairs // n, pairs % n)))
        # a pair may have been found from either end
        code = np.unique(np.concatenate(ends) @ np.array([n, 1]))
        a, b = code // n, code % n
        elsewhere = np.zeros(len(a), bool)
        for at in range(0, len(a), 1 << 18):
            part = slice(at, at + (1 << 18))
            elsewhere[part] = (early[a[part]] & early[b[part]]).any(axis=1)
        own = ~elsewhere
        np.add.at(linked, a[own], copies[b[own]])
        np.add.at(linked, b[own], copies[a[own]])
        if len(a):
            label = _components(n, a, b)
        return pd.DataFrame({"node": ids, "linked": linked, "least": ids[label]})
    return run


def _nearest(x: np.ndarray, centres: np.ndarray, overlap: int) -> np.ndarray:
    """[n, overlap] numbers of the nearest centres."""
    k = min(overlap, len(centres))
    sims = _unit(x) @ centres.T
    return np.argpartition(-sims, k - 1, axis=1)[:, :k]


def _deal_again(near: DataFrame, overlap: int, shard: int) -> DataFrame:
    """(c, sub, node, vec) of the members of large shards under the nearest
    ``overlap`` of centres drawn from the shard: about 2 * overlap * n / shard of them, by hash."""
    drawn = F.pmod(F.xxhash64("node", F.lit("centre")), F.col("n")) < F.ceil(F.col("n") * 2 * overlap / shard)
    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    centres = near.where(drawn).select("c", "node", "vec", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk"))
    members = near.withColumn("chunk", F.pmod(F.xxhash64("node"), chunks).cast("int"))

    def run(key, rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        names = ["c", "sub", "node", "vec"]
        if not len(rows):
            return pd.DataFrame({n: [] for n in names})
        own = own.sort_values("node")
        top = _nearest(_stack(rows["vec"]), _unit(_stack(own["vec"])), overlap) if len(own) else np.zeros((len(rows), 1), int)
        k = top.shape[1]
        return pd.DataFrame({"c": np.full(top.size, key[0]), "sub": top.ravel(), "node": np.repeat(rows["node"].to_numpy(), k),
                             "vec": np.repeat(rows["vec"].to_numpy(), k)})

    return members.groupBy("c", "chunk").cogroup(centres.groupBy("c", "chunk")).applyInPandas(
        run, "c long, sub long, node long, vec array<double>")


def deal(nodes: DataFrame, count: int, overlap: int, shard: int = SHARD, large: int = LARGE,
         max_centres: int = MAX_CENTRES) -> DataFrame:
    """(shard, node, vec): each node under its nearest ``overlap`` centres.  A
    shard is a number."""
    sample = _stack(nodes.orderBy(F.xxhash64("node")).limit(SAMPLE).select("vec").toPandas()["vec"])
    centres = fit_centres(sample, max(1, min(max_centres, math.ceil(2 * overlap * count / shard))))

    def nearest(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            top = _nearest(_stack(pdf["vec"]), centres, overlap)
            k = top.shape[1]
            yield pd.DataFrame({"c": top.ravel(), "node": np.repeat(pdf["node"].to_numpy(), k),
                                "vec": np.repeat(pdf["vec"].to_numpy(), k)})

    near = materialize(nodes.select("node", "vec").mapInPandas(nearest, "c long, node long, vec array<double>"), "near")
    sizes = near.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    sized = near.join(F.broadcast(sizes), "c")  # at most ``max_centres`` rows
    small = sized.where(F.col("n") <= large).select("c", F.lit(0).cast("long").alias("sub"), "node", "vec", "n")
    if sizes.where(F.col("n") > large).limit(1).collect():
        again = materialize(_deal_again(sized.where(F.col("n") > large), overlap, shard), "near-again")
        counts = again.groupBy("c", "sub").agg(F.count(F.lit(1)).alias("n"))
        small = small.unionByName(again.join(counts, ["c", "sub"]))
    # blocks of half a shard, dealt by hash; a shard for every pair of blocks
    blocks = F.when(F.col("n") <= shard, 1).otherwise(F.ceil(F.col("n") * 2 / shard)).cast("int")
    cut = small.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    other = F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: j != F.col("own"))))
    cut = cut.withColumn("other", other)
    name = F.xxhash64("c", "sub", F.least("own", "other"), F.greatest("own", "other"))
    return cut.select(F.shiftrightunsigned(name, 1).alias("shard"), "node", "vec")


def search(nodes: DataFrame, count: int, threshold: float, overlap: int, beam: int, shard: int = SHARD,
           large: int = LARGE) -> DataFrame:
    """(node, linked, least) rows of every shard, through the united graph;
    ``nodes`` holds node, vec and the number of copies."""
    placed = materialize(deal(nodes, count, overlap, shard, large), "shards")
    lists = placed.groupBy("shard").applyInPandas(_graph_lists, "node long, near array<long>")
    united = materialize(lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")),
                         "adjacency")
    homes = placed.groupBy("node").agg(F.sort_array(F.collect_list("shard")).alias("shards"))
    members = placed.join(united, "node").join(homes, "node").join(nodes.select("node", "copies"), "node")
    return members.groupBy("shard").applyInPandas(_search_shard(threshold, beam), "node long, linked long, least long")


def audit(nodes: DataFrame, count: int, threshold: float, group: int = AUDIT_GROUP, block: int = AUDIT_BLOCK) -> DataFrame:
    """(node, truth): the weight of all vectors linked to each audited one, by
    brute force over every vector in blocks."""
    asked = nodes.where(F.col("least") % EVERY == 0).select("node", "vec")
    groups, blocks = max(1, math.ceil(count / EVERY / group)), max(1, math.ceil(count / block))

    def over(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    asked = asked.withColumn("grp", F.pmod(F.xxhash64("node"), F.lit(groups)).cast("int")).withColumn("blk", over(blocks))
    every = nodes.select("node", "vec", "copies").withColumn(
        "blk", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int")).withColumn("grp", over(groups))

    def run(key, own: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(own) or not len(rows):
            return pd.DataFrame({"node": np.zeros(0, np.int64), "truth": np.zeros(0, np.int64)})
        x, y = _stack(own["vec"]), _stack(rows["vec"])
        ids, other, weight = own["node"].to_numpy(), rows["node"].to_numpy(), rows["copies"].to_numpy()
        sx, sy = np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1))
        truth = np.zeros(len(ids), np.int64)
        for at in range(0, len(ids), 256):
            cos = (x[at:at + 256] @ y.T) / (sx[at:at + 256, None] * sy[None, :])
            near = (cos >= threshold) & (ids[at:at + 256, None] != other[None, :])
            truth[at:at + 256] = near @ weight
        return pd.DataFrame({"node": ids, "truth": truth})

    cells = asked.groupBy("grp", "blk").cogroup(every.groupBy("grp", "blk")).applyInPandas(run, "node long, truth long")
    return cells.groupBy("node").agg(F.sum("truth").alias("truth"))


def linked_nodes(nodes: DataFrame, count: int, threshold: float, shard: int = SHARD,
                 large: int = LARGE) -> tuple[DataFrame, DataFrame, float | None]:
    """((node, linked), (node, least) edges, recall on the audited vectors; null
    recall where these have no links)."""
    truth = materialize(audit(nodes, count, threshold), "audit")
    wanted = truth.agg(F.sum("truth")).first()[0] or 0
    overlap, beam = OVERLAP, BEAM
    while True:
        found = materialize(search(nodes, count, threshold, overlap, beam, shard, large), "found")
        linked = found.groupBy("node").agg(F.sum("linked").alias("linked"))
        recall = None
        if wanted:
            hit = truth.join(linked, "node", "left").agg(F.sum(F.least("truth", F.coalesce("linked", F.lit(0))))).first()[0]
            recall = hit / wanted
            _log.info("recall %.4f over %d links of the audited vectors", recall, wanted)
        if recall is None or recall >= RECALL or overlap >= WIDEST:
            if recall is not None and recall < RECALL:
                _log.warning("recall %.4f of the widest search is below %.2f", recall, RECALL)
            return linked, found.where("node <> least").select("node", "least").distinct(), recall
        overlap, beam = 2 * overlap, 2 * beam


def near_duplicates(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    threshold: float = THRESHOLD, shard: int = SHARD, large: int = LARGE) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept, recall (of the
    search among vectors of the row's dimension, null where the audit had nothing to find)."""
    vec = F.col(vec_col).cast("array<double>")
    fine = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    useful = F.coalesce(fine & F.exists(vec, lambda v: v != 0), F.lit(False))
    rows = table.select(F.col(id_col).alias("id"), F.when(useful, vec).alias("vec"))
    equal = rows.where(F.col("vec").isNotNull()).groupBy("vec").agg(F.min("id").alias("least"),
                                                                    F.count(F.lit(1)).alias("copies"))
    nodes = materialize(equal.select(F.monotonically_increasing_id().alias("node"), "vec", "least", "copies"), "vectors")
    sizes = nodes.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").orderBy("d").collect()
    linked = edges = None
    recalls = []
    for r in sizes:  # one dimension, as a rule
        own, own_edges, recall = linked_nodes(nodes.where(F.size("vec") == r["d"]), r["n"], threshold, shard, large)
        linked = own if linked is None else linked.unionByName(own)
        edges = own_edges if edges is None else edges.unionByName(own_edges)
        recalls.append(F.when(F.size("vec") == r["d"], F.lit(recall).cast("double")))
    if sizes:
        comp = connected_components(edges, "node", "least")
        nodes = nodes.join(linked, "node", "left").join(comp, "node", "left")
    else:
        nodes = nodes.withColumn("linked", F.lit(0).cast("long")).withColumn("root", F.lit(None).cast("long"))
    nodes = nodes.withColumn("root", F.coalesce("root", "node"))
    names = nodes.groupBy("root").agg(F.min("least").alias("component"))
    nodes = materialize(nodes.join(names, "root").select(
        "vec", "component", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("links")), "vector-classes")
    out = rows.join(nodes, "vec", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"),
                      F.coalesce(F.lit(None).cast("double"), *recalls).alias("recall"))
