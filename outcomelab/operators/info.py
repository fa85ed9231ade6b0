"""Mutual information of features with a boolean label (O68), in nats.

Discrete features: plug-in estimate from the contingency table,
sum n_xy/N * ln(N n_xy / (n_x n_y)), one grouped aggregate for all features.
0/1 columns: the same estimate from one wide aggregate by label.

Continuous features: the nearest-neighbour estimator of Ross (2014) with
k = 3, as in the usual library implementation:
    psi(N) + <psi(k_i)> - <psi(N_label)> - <psi(m_i)>, floored at 0,
where k_i = min(k, N_label - 1), labels seen once are dropped, and m_i is
the number of points (any label) strictly closer than the k-th nearest
neighbour of the same label, the point itself included.  Values get a
deterministic jitter that breaks ties (integer arithmetic on id and feature,
where the library draws unseeded noise) of about 1e-10 standard deviations;
the estimate itself does not depend on the scale.

Distributed plan (1-D): long (feature, id, label, x) rows ->
 * the k nearest same-label points lie within ranks r-k..r+k, read in one
   narrow pass over rows sorted by (feature, label, x, id); a partition gets
   the k rows beyond either end from the driver, so no class is one task;
 * m_i by binary search among the points of the own partition, sorted by
   (feature, x); only the k points of a label nearest to a partition's end have
   intervals that reach over it, and these are looked up in the other
   partitions too.  The means of
   psi(k) and psi(N_label) follow from the class sizes alone.
Where no id repeats, ids stay out of both orders, and a partition sends how often
each m_i occurs in it instead of a row per point.  Points of one id count as one
point with the sum of their m_i.  Features are taken ``GROUP_ROWS`` points
at a time, and what a step has read is deleted before the next: the disk
holds the orders of one group, however many features there are.
"""

from __future__ import annotations

import math
import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from outcomelab.functions.columns import SCATTER_PRIME, digamma, digamma_np, qcol, scatter
from outcomelab.operators.ordered import PID, sorted_checkpoint, unpacked
from outcomelab.session import clean, materialize, release


BUCKET_ROWS = 1_000_000     # points one task of an ordered pass holds
GROUP_ROWS = 128_000_000    # points put in order at a time (of whole features, at least one)


def _long(df: DataFrame, features: list[str], label_col: str, id_col: str, cast: str) -> DataFrame:
    cols = [qcol(c).cast(cast).alias(c) for c in features]
    return (df.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"), *cols)
            .unpivot(["_id", "_y"], [qcol(c) for c in features], "feature", "_x")
            .filter(F.col("_x").isNotNull() & F.col("_y").isNotNull()))


def mi_of_cells(nxy: DataFrame) -> DataFrame:
    """(feature, mutual_information) from (feature, _x, _y, nxy) cells."""
    nx = nxy.groupBy("feature", "_x").agg(F.sum("nxy").alias("nx"))
    ny = nxy.groupBy("feature", "_y").agg(F.sum("nxy").alias("ny"))
    n = nxy.groupBy("feature").agg(F.sum("nxy").alias("n"))
    cells = nxy.join(nx, ["feature", "_x"]).join(ny, ["feature", "_y"]).join(n, "feature")
    term = (F.col("nxy") / F.col("n")) * F.log(F.col("n") * F.col("nxy") / (F.col("nx") * F.col("ny")))
    # exact decimal sum: the same value whatever the order cells are combined in
    return (cells.groupBy("feature").agg(F.sum(term.cast("decimal(38,18)")).cast("double").alias("_mi"))
            .select("feature", F.greatest(F.col("_mi"), F.lit(0.0)).alias("mutual_information")))


def mi_discrete(df: DataFrame, features: list[str], label_col: str, id_col: str = "id") -> DataFrame:
    """(feature, mutual_information) for discrete features."""
    long = _long(df, features, label_col, id_col, "string")
    # the cells are written once: the three totals read them, not the input rows
    return mi_of_cells(materialize(
        long.groupBy("feature", "_x", "_y").agg(F.count(F.lit(1)).alias("nxy")), "mi_cells"))


def indicator_cells(df: DataFrame, features: list[str], label_col: str) -> DataFrame:
    """(feature, _x, _y, nxy) of 0/1 columns: one aggregate by label over one
    scan, no row is unpivoted."""
    sums = [F.sum(qcol(f)).cast("long").alias(f"one_{i}") for i, f in enumerate(features)]
    sizes = [F.count(qcol(f)).alias(f"all_{i}") for i, f in enumerate(features)]
    wide = (df.filter(F.col(label_col).isNotNull()).groupBy(F.col(label_col).cast("int").alias("_y"))
            .agg(*sums, *sizes))
    cells = [F.struct(F.lit(f).alias("feature"), F.lit(x).alias("_x"), n.alias("nxy"))
             for i, f in enumerate(features)
             for x, n in ((1, F.col(f"one_{i}")), (0, F.col(f"all_{i}") - F.col(f"one_{i}")))]
    return wide.select("_y", F.inline(F.array(*cells))).filter("nxy > 0")


def mi_indicators(df: DataFrame, features: list[str], label_col: str) -> DataFrame:
    """(feature, mutual_information) for 0/1 columns."""
    return mi_of_cells(materialize(indicator_cells(df, features, label_col), "mi_cells"))


def jittered_points(df: DataFrame, features: list[str], label_col: str, id_col: str = "id",
                    jitter: float = 1e-10, seed: int = 0) -> DataFrame:
    """Long (feature, _id, _y, _x) rows, each value with a deterministic jitter.

    Its width is ``jitter`` times the deviation (1 when constant) or the mean
    absolute value, whichever is larger, taken down to a power of two: the
    jitter is then an exact product, and the sum is rounded once, alike in
    every engine.  One wide aggregate gives the widths of all features."""
    rows = df.filter(F.col(label_col).isNotNull())
    x = [qcol(f).cast("double") for f in features]
    stats = rows.agg(*[F.struct(F.stddev_pop(c), F.avg(F.abs(c))).alias(f"s{i}") for i, c in enumerate(x)]).first()
    moved = []
    for i, (f, c) in enumerate(zip(features, x)):
        sd, mean_abs = stats[i] if stats[i][0] is not None else (0.0, 0.0)
        width = jitter * max(sd if sd > 0 else 1.0, mean_abs)
        step = 2.0 ** (math.floor(math.log2(width)) - 29) if 0 < width < math.inf else 0.0
        noise = scatter(id_col, zlib.crc32(f.encode()) + seed) - F.lit(SCATTER_PRIME // 2)
        moved.append((c + noise.cast("double") * F.lit(step)).alias(f))
    return (rows.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"), *moved)
            .unpivot(["_id", "_y"], [qcol(f) for f in features], "feature", "_x")
            .filter(F.col("_x").isNotNull()).select("feature", "_id", "_y", "_x"))


def repeats(df: DataFrame, label_col: str, id_col: str = "id") -> bool:
    """Whether an id, or a missing one, comes twice among the rows with a label."""
    sizes = df.filter(F.col(label_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("_n"))
    return not sizes.filter("_n > 1").isEmpty()


def mi_continuous(df: DataFrame, features: list[str], label_col: str, id_col: str = "id",
                  k: int = 3, jitter: float = 1e-10, bucket_rows: int = BUCKET_ROWS, seed: int = 0) -> DataFrame:
    """(feature, mutual_information) for continuous features."""
    return mi_from_points(jittered_points(df, features, label_col, id_col, jitter, seed), k, bucket_rows,
                          repeats(df, label_col, id_col))


def _class_means(sizes: list[int], k: int) -> tuple[float, float]:
    """Means of psi(min(k, N_label - 1)) and psi(N_label) over all points."""
    if not sizes:
        return 0.0, 0.0
    n = np.array(sorted(sizes), float)
    return tuple(float((n * digamma_np(v)).sum() / n.sum()) for v in (np.minimum(k, n - 1), n))


def _kth(f, y, x, k_of, k):
    """Distance and value of every row's ``k_of``-th nearest neighbour of the
    same feature and label; rows are in (f, y, x) order, ties go to the smaller value.
    Either side's distances come in order, so a neighbour's rank is its place on its own
    side and the number of nearer ones on the other."""
    n = len(x)
    d, nb = np.full((2 * k, n), np.nan), np.full((2 * k, n), np.nan)     # nan: absent, sorts last
    for j in range(1, min(k, n - 1) + 1):
        same = (f[j:] == f[:-j]) & (y[j:] == y[:-j])
        gap = np.where(same, x[j:] - x[:-j], np.nan)
        d[j - 1, j:], nb[j - 1, j:] = gap, np.where(same, x[:-j], np.nan)
        d[k + j - 1, :-j], nb[k + j - 1, :-j] = gap, np.where(same, x[j:], np.nan)
    left, right = d[:k], d[k:]
    dist, value, found = np.full(n, np.nan), np.full(n, np.nan), np.zeros(n, bool)
    for side, (own, other, nearer) in enumerate(((left, right, np.less), (right, left, np.less_equal))):
        for j in range(k):
            rank = j + 1 + sum(nearer(o, own[j]).astype(np.int8) for o in other)
            at = (rank == k_of) & ~np.isnan(own[j])
            dist[at], value[at], found[at] = own[j][at], nb[side * k + j][at], True
    # different values at one rounded distance below, or fewer neighbours than asked for: put in order one by one
    odd = ~found
    for j in range(1, k):
        odd |= (left[j] == left[j - 1]) & (nb[j] != nb[j - 1])
    odd = np.flatnonzero(odd)
    if len(odd):
        some, its = d[:, odd].T, nb[:, odd].T
        at = np.lexsort((its, some), axis=1)[np.arange(len(odd)), k_of[odd] - 1]
        dist[odd], value[odd] = some[np.arange(len(odd)), at], its[np.arange(len(odd)), at]
    return dist, value


def _columns(batch, names):
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in names]


def _below(a, b):
    """a < b as Spark orders doubles: NaN above all."""
    return (a < b) | (np.isnan(b) & ~np.isnan(a))


def _tasks(df: DataFrame, total: int, bucket_rows: int) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // bucket_rows))


def _intervals(pts: DataFrame, k: int, partitions: int | None = None) -> DataFrame:
    """(_f, _id, _x, _lo, _hi): the open interval up to the k-th nearest
    neighbour of the same label; lo = hi = x where that neighbour equals x.
    Points without an ``_id`` give intervals without one."""
    named = ["_id"] if "_id" in pts.columns else []
    ordered = sorted_checkpoint(pts, ["_f", "_y", "_x", *named], partitions, True)
    # the k first and k last rows of every partition: what its neighbours see beyond their ends
    shown = ["_f", "_y", "_x"]

    def outermost(batches):
        pid, seen, first, last = None, 0, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            pid, rows = batch.column(PID)[0].as_py(), pa.Table.from_batches([batch.select(shown)])
            if seen < k:
                first.append(rows.slice(0, k - seen))
            seen += rows.num_rows
            last = rows if last is None else pa.concat_tables([last, rows])
            last = last.slice(max(0, last.num_rows - k))
        if pid is not None:
            for end, rows in ((0, pa.concat_tables(first)), (1, last)):
                kept = [rows.column(c).combine_chunks() for c in shown]
                yield pa.RecordBatch.from_arrays([*[pa.array([v] * rows.num_rows, pa.int32()) for v in (pid, end)],
                                                  pa.array(range(rows.num_rows), pa.int32()), *kept], [PID, "_end", "_at", *shown])

    ends = ordered.mapInArrow(unpacked(outermost), f"{PID} int, _end int, _at int, _f int, _y int, _x double").collect()
    first, last = {}, {}
    for r in sorted(ends, key=lambda r: (r[PID], r["_at"])):
        (last if r["_end"] else first).setdefault(r[PID], []).append((r["_f"], r["_y"], r["_x"]))
    pids = sorted(first)
    before, after, seen = {}, {}, []
    for p in pids:
        before[p], seen = seen, [*seen, *last[p]][-k:]
    seen = []
    for p in reversed(pids):
        after[p], seen = seen, [*first[p], *seen][:k]
    id_type = to_arrow_type(pts.schema["_id"].dataType) if named else None
    names = ["_f", "_y", "_x", "_k", *named]

    def halo(rows):
        f, y, x = (np.array([r[i] for r in rows], t) for i, t in enumerate((np.int32, np.int32, np.float64)))
        return [f, y, x, np.ones(len(rows), np.int64), *[np.full(len(rows), None, object) for _ in named]]

    def emit(rows, start, stop):
        d, nb = _kth(*rows[:3], rows[3].astype(np.int64), k)
        f, x, d, nb, *ids = (a[start:stop] for a in (rows[0], rows[2], d, nb, *rows[4:]))
        lo, hi = np.where(nb < x, nb, x - d), np.where(nb > x, nb, x + d)
        ids = [pa.array(list(i) if i.dtype == object else i, id_type) for i in ids]
        return pa.RecordBatch.from_arrays([pa.array(f, pa.int32()), *ids, *[pa.array(a, pa.float64()) for a in (x, lo, hi)]],
                                          ["_f", *named, "_x", "_lo", "_hi"])

    def assign(batches):
        held, done, pid = None, 0, None      # rows whose neighbours are not all seen, behind k rows already done
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _columns(batch, names)
            if held is None:
                pid = batch.column(PID)[0].as_py()
                held, done = halo(before[pid]), len(before[pid])
            held = [np.concatenate([a, b]) for a, b in zip(held, rows)]
            stop = len(held[0]) - k
            if stop > done:
                yield emit(held, done, stop)
                cut = max(0, stop - k)
                held, done = [a[cut:] for a in held], stop - cut
        if held is not None:
            stop = len(held[0])
            yield emit([np.concatenate([a, b]) for a, b in zip(held, halo(after[pid]))], done, stop)

    id_field = "".join(f"_id {pts.schema[c].dataType.simpleString()}, " for c in named)
    out = ordered.mapInArrow(unpacked(assign), f"_f int, {id_field}_x double, _lo double, _hi double")
    out._reads = ordered
    return out


def _counts_inside(near: DataFrame, total: int, bucket_rows: int) -> DataFrame:
    """(_f, _id, _m) rows that add up, by point, to the points strictly inside
    its interval (those equal to x where the interval is x alone).  Points
    in (feature, value) order are searched inside their own partition.  An interval
    reaches over a partition's end only from the k nearest points of each label on
    either side, so these few rows are collected and looked up in the other partitions too.
    Of intervals without an ``_id`` come (_f, _at, _m, _n) rows instead: ``_n`` points of the
    count ``_m``, or, with ``_at``, a part of the count of the one point of that number."""
    ordered = sorted_checkpoint(near, ["_f", "_x"], _tasks(near, total, bucket_rows), True)
    named = "_id" in near.columns
    key = "_id" if named else "_at"
    key_field = near.schema["_id"].dataType.simpleString() if named else "long"
    key_type = to_arrow_type(near.schema["_id"].dataType) if named else pa.int64()

    def loaded(parts):
        """Feature, value, interval, and which of these reach over an end of the partition."""
        f, x, lo, hi = (np.concatenate(c) for c in zip(*[_columns(b, ["_f", "_x", "_lo", "_hi"]) for b in parts]))
        return f, x, lo, hi, ((f == f[0]) & _below(lo, x[0])) | ((f == f[-1]) & _below(x[-1], hi))

    def keys(parts, rows):
        """The ids of some rows of a partition, or numbers that no other partition gives."""
        if named:
            return pa.chunked_array([b.column("_id") for b in parts], key_type).take(pa.array(rows)).combine_chunks()
        return pa.array((parts[0].column(PID)[0].as_py() << 40) + rows, key_type)

    def reaching(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        f, _, lo, hi, over = loaded(parts)
        rows = np.flatnonzero(over)
        if len(rows):
            pid = pa.array(np.full(len(rows), parts[0].column(PID)[0].as_py()), pa.int32())
            yield pa.RecordBatch.from_arrays([pid, pa.array(f[rows], pa.int32()), keys(parts, rows), pa.array(lo[rows]), pa.array(hi[rows])],
                                             [PID, "_f", key, "_lo", "_hi"])

    wide = ordered.mapInArrow(unpacked(reaching), f"{PID} int, _f int, {key} {key_field}, _lo double, _hi double").collect()

    def out(f, at, m, n=1):
        f, m, at = pa.array(f, pa.int32()), pa.array(m, pa.float64()), at if isinstance(at, pa.Array) else pa.array(at, key_type)
        if named:
            return pa.RecordBatch.from_arrays([f, at, m], ["_f", "_id", "_m"])
        n = np.full(len(f), 1) if isinstance(n, int) else n
        return pa.RecordBatch.from_arrays([f, at, m, pa.array(n, pa.int64())], ["_f", "_at", "_m", "_n"])

    def count(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        pid = parts[0].column(PID)[0].as_py()
        f, x, lo, hi, over = loaded(parts)
        m = np.zeros(len(f))
        starts = [0, *(np.flatnonzero(f[1:] != f[:-1]) + 1).tolist(), len(f)]
        for a, b in zip(starts[:-1], starts[1:]):
            xs, one = x[a:b], lo[a:b] == hi[a:b]
            m[a:b] = np.where(one, np.searchsorted(xs, hi[a:b], "right") - np.searchsorted(xs, lo[a:b], "left"),
                              np.searchsorted(xs, hi[a:b], "left") - np.searchsorted(xs, lo[a:b], "right"))
            others = [r for r in wide if r["_f"] == f[a] and r[PID] != pid]
            if others:
                n = (np.searchsorted(xs, [r["_hi"] for r in others], "left")
                     - np.searchsorted(xs, [r["_lo"] for r in others], "right"))
                found = [(r[key], v) for r, v in zip(others, n.tolist()) if v > 0]
                if found:
                    yield out([int(f[a])] * len(found), [i for i, _ in found], [float(v) for _, v in found])
            if not named:
                seen, often = np.unique(m[a:b][~over[a:b]], return_counts=True)
                if len(seen):
                    yield out([int(f[a])] * len(seen), [None] * len(seen), seen, often)
        if not named:
            rows = np.flatnonzero(over)
            if len(rows):
                yield out(f[rows], keys(parts, rows), m[rows])
            return
        at = 0
        for b in parts:
            yield out(b.column("_f"), b.column("_id"), m[at:at + b.num_rows])
            at += b.num_rows

    counts = ordered.mapInArrow(unpacked(count), f"_f int, {key} {key_field}, _m double" + ("" if named else ", _n long"))
    counts._reads = ordered
    return counts


def _mean_digammas(pts: DataFrame, total: int, k: int, bucket_rows: int) -> DataFrame:
    """(_f, _n, _pm): points and mean of psi(m) of every feature of (_f, _y, _x, _k) points."""
    # a table, not a checkpoint: it is read twice to be ordered anew, once its values alone
    intervals = _intervals(pts, k, _tasks(pts, total, bucket_rows))
    near = materialize(intervals, "mi_intervals")
    clean(intervals._reads)
    inside = _counts_inside(near, total, bucket_rows)
    release(near)
    if "_id" in pts.columns:
        per_point = inside.groupBy("_f", "_id").agg(F.sum("_m").alias("_m")).withColumn("_n", F.lit(1).cast("long"))
    else:
        apart = F.col("_at").isNotNull()
        per_point = inside.where(apart).groupBy("_f", "_at").agg(F.sum("_m").alias("_m"), F.max("_n").alias("_n")).drop(
            "_at").unionByName(inside.where(~apart).drop("_at"))
    # as exact as a sum point by point: 18 decimals, times a whole number
    psi = digamma("_m").cast("decimal(20,18)") * F.col("_n").cast("decimal(12,0)")
    means = materialize(per_point.groupBy("_f").agg(
        F.sum("_n").alias("_n"), (F.sum(psi) / F.sum("_n")).cast("double").alias("_pm")), "mi_means")
    clean(inside._reads)
    return means


def mi_from_points(pts: DataFrame, k: int = 3, bucket_rows: int = BUCKET_ROWS, repeated: bool = True,
                   group_rows: int = GROUP_ROWS) -> DataFrame:
    """Neighbour estimator over long (feature, _id, _y, _x) points; a task of the
    ordered passes holds about ``bucket_rows`` of them.  Points need no ``_id`` where no
    feature has an id twice (``repeated`` false)."""
    # class sizes (one row per feature and label); a label seen once is dropped
    nc = pts.groupBy("feature", "_y").agg(F.count(F.lit(1)).alias("_nc")).collect()
    names = sorted({r["feature"] for r in nc})
    # integer feature codes: the ordered passes below move numbers, not text
    sizes = pts.sparkSession.createDataFrame(
        [(r["feature"], names.index(r["feature"]), r["_y"], r["_nc"]) for r in nc],
        "feature string, _f int, _y int, _nc long")
    def coded(some):
        kept = pts if len(some) == len(names) else pts.where(F.col("feature").isin(some))
        return (kept.join(F.broadcast(sizes), ["feature", "_y"]).filter(F.col("_nc") > 1)
                .select("_f", *(["_id"] if repeated else []), "_y", "_x", F.least(F.lit(k), F.col("_nc") - 1).alias("_k")))

    rows = {n: 0 for n in names}
    for r in nc:
        rows[r["feature"]] += r["_nc"]
    groups, held = [[]], 0
    for n in names:
        if groups[-1] and held + rows[n] > group_rows:
            groups, held = [*groups, []], 0
        groups[-1].append(n)
        held += rows[n]
    mi = reduce(DataFrame.unionByName, [_mean_digammas(coded(g), sum(rows[n] for n in g), k, bucket_rows) for g in groups])
    by_class = {}
    for r in nc:
        if r["_nc"] > 1:
            by_class.setdefault(r["feature"], []).append(r["_nc"])
    codes = pts.sparkSession.createDataFrame(
        [(n, i, *_class_means(by_class.get(n, []), k)) for i, n in enumerate(names)],
        "feature string, _f int, _pk double, _pn double")
    return (mi.join(F.broadcast(codes), "_f")
            .select("feature", F.greatest(F.lit(0.0), digamma("_n") + F.col("_pk") - F.col("_pn") - F.col("_pm"))
                    .alias("mutual_information")))


def mutual_information(df: DataFrame, features: list[str], label_col: str, id_col: str = "id",
                       discrete: list[str] = ()) -> DataFrame:
    """MI of every feature, discrete ones by contingency, the rest by the
    neighbour estimator; (feature, mutual_information, discrete)."""
    disc = [f for f in features if f in set(discrete)]
    cont = [f for f in features if f not in set(discrete)]
    parts = []
    if disc:
        parts.append(mi_discrete(df, disc, label_col, id_col).withColumn("discrete", F.lit(True)))
    if cont:
        parts.append(mi_continuous(df, cont, label_col, id_col).withColumn("discrete", F.lit(False)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def discrete_columns(df: DataFrame, features: list[str]) -> list[str]:
    """Text and boolean columns count as discrete (as object/bool dtypes do)."""
    from pyspark.sql import types as T
    types = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in features if isinstance(types[c], (T.StringType, T.BooleanType))]
