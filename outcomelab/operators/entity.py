"""Entity statistics.

Only the label sums depend on the label; everything else is shared.  Roll-ups
are plain ``groupBy`` aggregates (map-side combined, so a hot entity costs one
partial row per task).  Priors are one-row aggregates cross-joined with a
broadcast (a single row, so the broadcast size is fixed).  Running counts per
entity use :func:`running_totals`, so one entity holding a third of the rows
is spread over many tasks instead of one window partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelab.functions.columns import safe_div, smoothed_rate, years_between
from outcomelab.operators.hot_keys import join_groups
from outcomelab.operators.ordered import running_totals
from outcomelab.operators.split import Split
from outcomelab.session import materialize


def entity_rollup(rows: DataFrame, entity_col: str, label_col: str, id_col: str = "id",
                  date_col: str | None = "d") -> DataFrame:
    """Per entity: rows, label sum, first and last date, active years.
    Rows with a missing entity are left out, as a pandas group-by does."""
    aggs = [F.count(F.lit(1)).alias("num_projects"),
            F.sum(F.col(label_col).cast("long")).alias("num_exciting_projects")]
    if date_col:
        aggs += [F.min(date_col).alias("first_project_date"), F.max(date_col).alias("last_project_date")]
    out = rows.filter(F.col(entity_col).isNotNull()).groupBy(entity_col).agg(*aggs)
    if date_col:
        out = out.withColumn("active_years", years_between("first_project_date", "last_project_date"))
    return out


def entity_priors(rollup: DataFrame, min_count: int | None = 3) -> DataFrame:
    """Data-driven priors: averages over entities with at least ``min_count``
    rows (O11/O31); ``None`` averages all entities.  One row."""
    src = rollup if min_count is None else rollup.filter(F.col("num_projects") >= min_count)
    aggs = [F.avg("num_projects").alias("prior_num"), F.avg("num_exciting_projects").alias("prior_exciting")]
    if "active_years" in rollup.columns:
        aggs.append(F.avg("active_years").alias("prior_years"))
    return src.agg(*aggs)


LABEL_SEP = "__"


def _labels(label_col) -> list[str]:
    return [label_col] if isinstance(label_col, str) else list(label_col)


def overall_performance(items: DataFrame, split: Split, entity_col: str, entity_name: str,
                        label_col: str | list[str], min_count: int = 3) -> DataFrame:
    """Historic, smoothed performance of each row's entity over the train rows
    (O57).  One row per item: id, num_projects, pct_exciting,
    projects_per_year, active_years (prefixed with ``entity_name``).

    With a list of labels, all label sums come from the same aggregate and
    ``pct_exciting`` is emitted once per label as ``pct_exciting__{label}``.
    """
    labels = _labels(label_col)
    multi = not isinstance(label_col, str)
    id_col = split.id_col
    train = split.rows(items, "train").select(id_col, entity_col, split.date_col, *labels)
    live = train.filter(F.col(entity_col).isNotNull())
    stats = live.groupBy(entity_col).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(F.col(lb).cast("long")).alias(f"_k{i}") for i, lb in enumerate(labels)],
        years_between(F.min(split.date_col), F.max(split.date_col)).alias("_y"))
    big = stats.filter(F.col("_n") >= min_count)
    priors = big.agg(F.avg("_n").alias("_pn"), F.avg("_y").alias("_py"),
                     *[F.avg(f"_k{i}").alias(f"_pk{i}") for i in range(len(labels))])
    p = entity_name + "_"
    n, y, pn, py = F.col("_n"), F.col("_y"), F.col("_pn"), F.col("_py")
    joined = (join_groups(items.select(id_col, entity_col), stats, entity_col, "_n", "left")
              .crossJoin(F.broadcast(priors)))
    rates = []
    for i, lb in enumerate(labels):
        name = p + "pct_exciting" + (LABEL_SEP + lb if multi else "")
        k, pk = F.col(f"_k{i}"), F.col(f"_pk{i}")
        rates.append(F.when(n.isNotNull(), smoothed_rate(n, k, pn, pk)).otherwise(safe_div(pk, pn)).alias(name))
    return joined.select(
        id_col,
        F.coalesce(n.cast("double"), pn).alias(p + "num_projects"),
        *rates,
        F.when(n.isNotNull(), smoothed_rate(y, n, py, pn)).otherwise(safe_div(pn, py)).alias(p + "projects_per_year"),
        F.coalesce(y, py).alias(p + "active_years"),
    )


def past_performance(items: DataFrame, split: Split, entity_col: str, entity_name: str,
                     label_col: str | list[str]) -> DataFrame:
    """Performance of the entity before each train row.

    Train rows get the number of earlier rows of their entity in (date, id)
    order, how many of those had the label, and the smoothed rate with
    priors averaged over all train entities.  Every other row (dev, rows cut
    by the recent filter, missing entity) gets 0 in all three columns.
    With a list of labels, one ordered pass carries every label's running
    sum; label columns get the suffix ``__{label}``.
    """
    labels = _labels(label_col)
    multi = not isinstance(label_col, str)
    id_col, date_col = split.id_col, split.date_col
    ys = [f"_y{i}" for i in range(len(labels))]
    train = (split.rows(items, "train").filter(F.col(entity_col).isNotNull())
             .select(id_col, entity_col, date_col,
                     *[F.col(lb).cast("long").alias(y) for lb, y in zip(labels, ys)]))
    per_entity = train.groupBy(entity_col).agg(F.count(F.lit(1)).alias("_n"),
                                               *[F.sum(y).alias(f"_k{i}") for i, y in enumerate(ys)])
    priors = per_entity.agg(F.avg("_n").alias("_pn"), *[F.avg(f"_k{i}").alias(f"_pk{i}") for i in range(len(ys))])
    ranked = running_totals(train, order=[date_col, id_col], group_cols=[entity_col], sum_cols=ys)
    p = entity_name + "_"
    cols = [F.col("n_before").cast("double").alias(p + "num_prev_projects")]
    for i, (lb, y) in enumerate(zip(labels, ys)):
        sfx = LABEL_SEP + lb if multi else ""
        known = F.col(y).isNotNull()  # a row whose own label is missing ends at 0, like unplaced rows
        cols.append(F.when(known, F.col("before_" + y)).alias(p + "num_prev_exciting_projects" + sfx))
        cols.append(F.when(known, smoothed_rate("n_before", "before_" + y, "_pn", f"_pk{i}"))
                    .alias(p + "pct_prev_exciting" + sfx))
    feats = ranked.crossJoin(F.broadcast(priors)).select(id_col, *cols)
    names = [c for c in feats.columns if c != id_col]
    return items.select(id_col).join(feats, id_col, "left").na.fill(0.0, subset=names)


def exact_median(df: DataFrame, value_col: str, group_cols: list[str] = (), id_col: str = "id",
                 out_col: str = "median") -> DataFrame:
    """Exact median of ``value_col`` per group, NULLs ignored.

    Rows are counted by value first; the middle one or two values are found
    by running counts over those, so no group's values are ever gathered in
    one buffer and no id is sorted.  The running counts are written once: their
    totals and the middle values read them, instead of each repeating the pass.
    """
    group_cols = list(group_cols)
    vals = df.filter(F.col(value_col).isNotNull()).select(*group_cols, value_col)
    for g in group_cols:
        vals = vals.filter(F.col(g).isNotNull())
    by_value = vals.groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_c"))
    ranked = materialize(running_totals(by_value, order=[value_col], group_cols=group_cols, sum_cols=["_c"])
                         .select(*group_cols, value_col, "_c", "before__c"), "running_counts")
    upto = F.col("before__c") + F.col("_c")
    counts = ranked.groupBy(*group_cols).agg(F.max(upto).alias("_n"))
    joined = ranked.join(counts, group_cols, "inner") if group_cols else ranked.crossJoin(F.broadcast(counts))
    lo = F.floor((F.col("_n") - 1) / 2)
    hi = F.ceil((F.col("_n") - 1) / 2)
    mid = joined.filter((F.col("before__c") <= hi) & (upto > lo))
    if group_cols:
        return mid.groupBy(*group_cols).agg(F.avg(value_col).alias(out_col))
    return mid.agg(F.avg(value_col).alias(out_col))


def group_median_ratio(items: DataFrame, value_col: str, group_col: str, id_col: str = "id",
                       median_col: str = "group_median", ratio_col: str = "ratio") -> DataFrame:
    """Attach the group median of ``value_col`` and value / median (O23, O28,
    O55); a missing group or a zero median gives NULL."""
    med = exact_median(items, value_col, [group_col], id_col, median_col)
    return (items.join(med, group_col, "left")
            .withColumn(ratio_col, safe_div(value_col, median_col)))


def group_size(rows: DataFrame, group_col: str, member_col: str, id_col: str = "id",
               prefix: str = "city_state") -> DataFrame:
    """Distinct members and distinct items per group and their ratio."""
    return (rows.filter(F.col(group_col).isNotNull()).groupBy(group_col)
            .agg(F.countDistinct(member_col).alias(f"{prefix}_num_schools"),
                 F.countDistinct(id_col).alias(f"{prefix}_num_projects"))
            .withColumn(f"{prefix}_projects_per_school",
                        safe_div(f"{prefix}_num_projects", f"{prefix}_num_schools")))
