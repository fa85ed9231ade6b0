"""Hard negatives from shared candidate lists of anchor clusters.

Anchors are clustered by direction.  For a cluster with centre ``c`` whose
members lie within the angle ``t`` of it, no member ``u`` can score a
candidate ``x`` above ``|u| |x| cos(max(0, angle(c, x) - t))``.  The candidates are
sorted by ``|x| cos(...)`` once for the cluster, and every member walks that one
list from the top.  A member stops when the bound of what is left is below
its k-th best score (or below the least score it asks for): from there on no
candidate can enter its result, so the result is exact.

Two walks are made.  The first finds each anchor's positives, its ``positives``
best other rows of its label.  The second asks, for each distinct positive
score, for the best ``negatives`` rows of other labels between ``low`` and ``high``
percent of it.  The positives' scores are the floor at which the second walk ends.

At scale.  Candidates are dealt evenly over blocks of about ``BLOCK`` rows and
the clusters over groups of about ``GROUP`` anchors.  A task holds one block and
one group: it sorts the block's list for each cluster of the group, the members
walk it, and each brings back at most k rows.  The blocks' rows are merged by a
ranked window per anchor, pruned before the shuffle.  Up to ``GROUP`` anchors
every candidate is shuffled once; beyond it once for each group, while the anchors, a small
share of the rows, are sent to every block.  No task's share grows with the input.

Bounds.  Centres are fitted on at most ``SAMPLE`` anchors and number at most
``MAX_CENTRES``; they and the cluster sizes are all the driver holds.  A cluster
of more than ``GROUP`` anchors (a hot direction) is cut into parts by id hash.
Neither a hot label nor a hot vector gathers rows: blocks are dealt by row
number.

Scores are exact.  Components are whole numbers ``floor(scale * x)``; products
are taken in double precision where every partial sum is below 2^53, and with
Python's integers otherwise.  Scores beyond a long are clipped to it between
the walks, so a window is then taken from the clipped score.

Defined results.  Rows with a null id, label or vector, or a null or
non-finite component, take no part (a row without an id could not be named).
Rows are compared with anchors of the same dimension only.  "Other rows" have
another id; a row repeated under one id is as many candidates, and of
anchors that repeat an id the one with the least (label, vector) is mined.
An anchor without positives, or without rows in a window, gives no rows for it.
Zero vectors score 0 with everything.  Extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outcomelab.llm.common import materialize

POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95       # percent of the positive's score
SCALE = 256
BLOCK = 8_192
GROUP = 8_192
CLUSTER = 64             # anchors a cluster aims at
SAMPLE = 16_384
MAX_CENTRES = 1_024
STRIDE = 1_024           # candidates a walk takes at a time
TOGETHER = 256           # members that walk side by side
EXACT = 2.0 ** 53
LONG = (1 << 63) - 1


def usable(table: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, label, vec) of the rows that take part."""
    vec = F.col(vec_col).cast("array<double>")
    fine = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), vec.alias("vec"),
                        F.coalesce(fine, F.lit(False)).alias("fine"))
    return rows.where("fine AND id IS NOT NULL AND label IS NOT NULL").select("id", "label", "vec")


def whole(values, scale: int) -> np.ndarray:
    """Rows of floor(scale * x), still as doubles: scaling by a power of two
    and rounding down are exact."""
    x = np.array(list(values), dtype=np.float64)
    return np.floor((x if x.ndim == 2 else x.reshape(len(x), 0)) * scale)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True, initial=0), 1e-300)
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, size, out=np.zeros_like(x), where=size > 0)


def fit_centres(x: np.ndarray, k: int, rounds: int = 8, seed: int = 11) -> np.ndarray:
    """Spherical k-means of unit rows."""
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        own = np.concatenate([(x[i:i + 4096] @ centres.T).argmax(1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(np.abs(sums).sum(1, keepdims=True) > 0, _unit(sums), centres)
    return centres


def shared_list(x: np.ndarray, centre: np.ndarray, widest: float) -> tuple[np.ndarray, np.ndarray]:
    """(order, bounds) of candidates ``x`` for members within the angle
    ``widest`` of ``centre``: a member's score is at most its length times the bound."""
    size = np.sqrt((x * x).sum(1))
    cos = np.divide(x @ centre, size, out=np.ones(len(x)), where=size > 0)
    angle = np.arccos(np.clip(cos, -1, 1))
    bound = size * np.cos(np.maximum(0, angle - widest - 1e-6)) + 1e-9 * size
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


class Best:
    """The ``k`` best (score, id) of every query, larger scores and then
    smaller ids first."""

    def __init__(self, queries: int, k: int):
        self.k, self.q = k, np.zeros(0, np.int64)
        self.score, self.id = np.zeros(0, object), np.zeros(0, np.int64)
        self.worst = np.full(queries, -np.inf)  # k-th best score, -inf while fewer

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        q = np.concatenate((self.q, q))
        score, ids = np.concatenate((self.score.astype(score.dtype), score)), np.concatenate((self.id, ids))
        order = np.lexsort((ids, -score, q))
        q, score, ids = q[order], score[order], ids[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < self.k
        last = place == self.k - 1
        self.worst[q[last]] = score[last].astype(np.float64)
        self.q, self.score, self.id = q[keep], score[keep], ids[keep]


def walk(members: np.ndarray, member_ids: np.ndarray, member_labels: np.ndarray, queries: np.ndarray, lowest: np.ndarray,
         highest: np.ndarray, same: bool, k: int, x: np.ndarray, ids: np.ndarray, labels: np.ndarray,
         order: np.ndarray, bounds: np.ndarray) -> Best:
    """Members of one cluster walk the cluster's list of candidates ``x``
    (see :func:`shared_list`).  Query i belongs to member ``queries[i]`` and asks for its best ``k`` rows of
    the same label (or of other ones) scoring from ``lowest[i]`` to ``highest[i]``."""
    best = Best(len(queries), k)
    top = max(np.abs(members).max(initial=0.0), 1.0) * max(np.abs(x).max(initial=0.0), 1.0) * max(1, x.shape[1])
    exact = top < EXACT
    length = np.sqrt((members * members).sum(1))
    active = np.arange(len(queries))
    big = None if exact else [np.array([[int(v) for v in row] for row in m], dtype=object) for m in (members, x)]
    for start in range(0, len(order), STRIDE):
        floor = np.maximum(best.worst[active], lowest[active].astype(np.float64))
        left = length[queries[active]] * bounds[start]
        slack = 1e-9 * np.abs(left) + 0.5 if exact else np.inf
        active = active[~(left + slack < floor)]
        if not len(active):
            break
        part = order[start:start + STRIDE]
        who, row = np.unique(queries[active], return_inverse=True)
        s = members[who] @ x[part].T if exact else big[0][who] @ big[1][part].T
        s = s[row]
        m = queries[active]
        ok = (labels[part][None, :] == member_labels[m][:, None]) == same
        ok &= ids[part][None, :] != member_ids[m][:, None]
        ok &= (s >= lowest[active][:, None]) & (s <= highest[active][:, None]) & (s >= best.worst[active][:, None])
        if exact and ok.shape[1] > 4 * k:  # only the part's own k best can enter
            open_ = np.where(ok, s, -np.inf)
            ok &= s >= -np.partition(-open_, k - 1, axis=1)[:, k - 1:k]
        a, b = np.nonzero(ok)
        if len(a):
            best.add(active[a], s[a, b], ids[part][b])
    return best


def _window(score: int) -> tuple[int, int]:
    """The least and the largest whole score with
    LOW * score <= 100 * s <= HIGH * score."""
    return -((-LOW * score) // 100), (HIGH * score) // 100


def _asked(scores: pd.Series, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(member, asked score, least, largest) of every query: one without limits
    for each member, or one for each positive score with a window."""
    if same:
        n = len(scores)
        return np.arange(n), np.zeros(n, np.int64), np.full(n, -np.inf), np.full(n, np.inf)
    found = [(i, int(v), *_window(int(v))) for i, own in enumerate(scores) for v in own]
    found = [f for f in found if f[2] <= f[3]]
    kind = object if any(abs(w) >= EXACT for f in found for w in f[2:]) else np.float64
    return (np.array([f[0] for f in found], np.int64), np.array([f[1] for f in found], np.int64),
            np.array([f[2] for f in found], kind), np.array([f[3] for f in found], kind))


def _cell(same: bool, k: int, scale: int):
    """One block of candidates under one group of anchors."""
    columns = ["anchor", "asked", "score", "found"]

    def run(key, anchors: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if not len(anchors) or not len(block):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in columns})
        x, ids, labels = whole(block["vec"], scale), block["id"].to_numpy(), block["label"].to_numpy()
        out = [np.zeros((0, 4), np.int64)]
        for _, cluster in anchors.groupby("cluster", sort=False):
            units = _unit(whole(cluster["vec"], scale))
            centre = _unit(units.sum(0, keepdims=True))[0]
            angle = np.where(units.any(axis=1), np.arccos(np.clip(units @ centre, -1, 1)), 0.0)
            order, bounds = shared_list(x, centre, float(angle.max()))
            for at in range(0, len(cluster), TOGETHER):
                part = cluster.iloc[at:at + TOGETHER]
                member, asked, low, high = _asked(part["scores"], same)
                best = walk(whole(part["vec"], scale), part["id"].to_numpy(), part["label"].to_numpy(), member, low, high,
                            same, k, x, ids, labels, order, bounds)
                value = np.array([max(-LONG - 1, min(LONG, int(v))) for v in best.score], np.int64)
                out.append(np.column_stack((part["id"].to_numpy()[member[best.q]], asked[best.q], value, best.id)))
        return pd.DataFrame(np.concatenate(out), columns=columns)
    return run


def clustered(anchors: DataFrame, dimension: int, count: int, scale: int, cluster: int, group: int) -> tuple[DataFrame, int]:
    """(``anchors`` with a cluster and a group, number of groups)."""
    sample = anchors.orderBy(F.xxhash64("id")).limit(SAMPLE).select("vec").toPandas()["vec"]
    centres = fit_centres(_unit(whole(sample, scale)), max(1, min(MAX_CENTRES, math.ceil(count / cluster))))

    def nearest(batches):
        for pdf in batches:
            if len(pdf):
                own = (_unit(whole(pdf["vec"], scale)) @ centres.T).argmax(1)
                yield pd.DataFrame({"id": pdf["id"], "label": pdf["label"], "vec": pdf["vec"], "cluster": own})

    schema = f"id long, label {anchors.schema['label'].dataType.simpleString()}, vec array<double>, cluster long"
    placed = materialize(anchors.mapInPandas(nearest, schema), "anchors")
    sizes = placed.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).orderBy("cluster").collect()  # MAX_CENTRES at most
    table, groups, room = [], 0, 0
    for r in sizes:  # consecutive clusters share a group; a hot one is cut into parts
        parts = math.ceil(r["n"] / group)
        if parts > 1 or r["n"] > room:
            first, groups = groups, groups + parts
            room = 0 if parts > 1 else group - r["n"]
        else:
            first, room = groups - 1, room - r["n"]
        table.append((r["cluster"], first, parts))
    spark = anchors.sparkSession
    dealt = spark.createDataFrame(table or [(0, 0, 1)], "cluster long, first int, parts int")
    part = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    return placed.join(F.broadcast(dealt), "cluster").withColumn("grp", F.col("first") + part).drop("first", "parts"), groups


def _over(span: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(max(1, span) - 1)))


def _mine_dimension(rows: DataFrame, anchors: DataFrame, dimension: int, counts: tuple[int, int], scale: int, positives: int,
                    negatives: int, block: int, group: int, cluster: int) -> DataFrame:
    anchors = anchors.where(F.size("vec") == dimension)
    placed, groups = clustered(anchors, dimension, counts[1], scale, cluster, group)
    placed = materialize(placed, "anchor-groups")
    blocks = max(1, math.ceil(counts[0] / block))
    # consecutive row numbers deal evenly, whatever the rows hold
    candidates = (rows.where(F.size("vec") == dimension)
                  .withColumn("blk", F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).cast("int")))
    candidates = candidates.withColumn("grp", _over(groups))

    def meet(asking: DataFrame, same: bool, k: int) -> DataFrame:
        cells = asking.withColumn("blk", _over(blocks))
        found = (cells.groupBy("grp", "blk").cogroup(candidates.groupBy("grp", "blk"))
                 .applyInPandas(_cell(same, k, scale), "anchor long, asked long, score long, found long"))
        order = W.partitionBy("anchor", "asked").orderBy(F.desc("score"), "found")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    first = meet(placed.withColumn("scores", F.array().cast("array<long>")), True, positives)
    first = materialize(first.select(F.col("anchor").alias("id"), F.col("found").alias("positive"), "score"), "positives")
    scores = first.groupBy("id").agg(F.array_sort(F.collect_set("score")).alias("scores"))  # at most ``positives`` each
    second = meet(placed.join(scores, "id"), False, negatives)
    second = second.select(F.col("anchor").alias("id"), F.col("asked").alias("score"), "rank",
                           F.col("found").alias("negative"), F.col("score").alias("negative_score"))
    return first.join(second, ["id", "score"]).select(
        F.col("id").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("negative").alias("negative_id"), F.col("score").alias("positive_score"), "negative_score")


def mine(rows: DataFrame, is_anchor: Column, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
         block: int = BLOCK, group: int = GROUP, cluster: int = CLUSTER) -> DataFrame:
    """One row per anchor, positive and negative of ``rows`` (id, label, vec;
    see :func:`usable`): anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.  ``is_anchor`` is a condition over ``rows``."""
    anchors = rows.where(is_anchor).groupBy("id").agg(F.min(F.struct("label", "vec")).alias("own"))
    anchors = materialize(anchors.select("id", "own.label", "own.vec"), "anchor-rows")
    sizes = {r["d"]: r["n"] for r in anchors.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
    every = {r["d"]: r["n"] for r in rows.groupBy(F.size("vec").alias("d")).agg(F.count(F.lit(1)).alias("n")).collect()}
    out = None
    for d in sorted(sizes):  # one dimension, as a rule
        got = _mine_dimension(rows, anchors, d, (every[d], sizes[d]), scale, positives, negatives, block, group, cluster)
        out = got if out is None else out.unionByName(got)
    if out is None:
        out = rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                                    "positive_score long, negative_score long")
    return out
