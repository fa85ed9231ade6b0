"""Exact de-duplication by deterministic block naming (DataFrame functions only).

Every text is cut into fixed-size blocks of bytes.  The distinct blocks are
sorted and each gets an integer name; the names of adjacent pairs are named
in the same way, round after round, until one name is left per document.
Two documents share (round, name) exactly when their texts are identical:
names stand for whole keys that were compared byte by byte, so there is no
collision to rule out.

Movement.  The blocks cross the network twice (once to be made distinct,
after a map-side combine, and once to fetch their names); later rounds move
two integers for each pair.  A key that holds more than ``1 / (4 P)`` of the
rows (P: shuffle partitions) is heavy; there are fewer than ``4 P`` such keys,
a bound that holds at any size, so they are named apart and broadcast, and
no task receives a hot block's rows.

Defined results.  A null text counts as empty, and empty texts are equal to
each other.  A null doc_id sorts below all others.  Rows equal in doc_id and
text are rows of one group; one of them stays.  Other columns of the input
are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from outcomelab.llm.common import materialize, null_safe, partitions, text_or_empty

BLOCK_BYTES = 4096
_ODD = -1  # second name of a pair whose left half is the document's last block


def _blocks(docs: DataFrame, id_col: str, text_col: str, block: int) -> DataFrame:
    data = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    data = data.select("doc_id", F.sha2("text", 256).alias("sha"), F.encode("text", "UTF-8").alias("bytes"))
    starts = F.sequence(F.lit(0), F.greatest(F.floor((F.length("bytes") - 1) / block).cast("int"), F.lit(0)))
    cut = F.transform(starts, lambda i: F.substring(F.col("bytes"), i * block + 1, F.lit(block)))
    return data.select("doc_id", "sha", F.posexplode(cut).alias("pos", "block"))


def _heavy(rows: DataFrame, key: list[str], slots: int) -> list[int]:
    """Hashes of the keys with more than 1/(4P) of the rows: fewer than 4P."""
    counts = rows.groupBy(F.xxhash64(*key).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    hot = counts.crossJoin(F.broadcast(total)).where((F.col("n") * 4 * slots > F.col("total")) & (F.col("n") > 64))
    return [r["h"] for r in hot.select("h").collect()]


def name_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` with ``key`` replaced by an integer ``name``: equal keys, equal
    names.  Names follow the sorted order of the distinct keys inside each
    hash partition; heavy keys get the negative names of their sorted rank."""
    heavy = _heavy(rows, key, partitions(rows))
    rest = [c for c in rows.columns if c not in key]
    cold = rows
    if heavy:
        is_heavy = F.xxhash64(*key).isin(heavy)
        cold = rows.where(~is_heavy)
        ranked = (rows.where(is_heavy).select(*key).distinct()
                  .withColumn("name", -1 - F.row_number().over(W.orderBy(*key)).cast("long")))
        hot = rows.where(is_heavy).join(F.broadcast(materialize(ranked, "heavy-names")), key).select(*rest, "name")
    names = (cold.select(*key).distinct().sortWithinPartitions(*key)
             .withColumn("name", F.monotonically_increasing_id()))
    named = cold.join(names, key).select(*rest, "name")
    return named.unionByName(hot) if heavy else named


def document_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   block: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """(heads, names): one ``(doc_id, sha)`` row per input row, and one
    ``(doc_id, sha, round, name)`` row per distinct pair.  ``sha`` only tells
    rows of one doc_id apart; equality is decided by ``(round, name)``."""
    level = materialize(name_keys(_blocks(docs, id_col, text_col, block), ["block"]), "blocks-0")
    heads = level.where("pos = 0").select("doc_id", "sha")
    size = level.groupBy("doc_id", "sha").agg(F.max("pos").alias("last"))
    longest = size.agg(F.max("last")).first()[0]
    done, depth = [], 0
    last = 0 if longest is None else longest
    active = level.dropDuplicates(["doc_id", "sha", "pos"])
    while True:
        ends = active.groupBy("doc_id", "sha").agg(F.max("pos").alias("_last"), F.max(
            F.when(F.col("pos") == 0, F.col("name"))).alias("name"))
        done.append(ends.where("_last = 0").select("doc_id", "sha", F.lit(depth).alias("round"), "name"))
        if last == 0:
            break
        more = ends.where("_last > 0").select(F.col("doc_id").alias("_d"), F.col("sha").alias("_s"))
        left = active.join(more, null_safe(active, more, [("doc_id", "_d"), ("sha", "_s")]), "left_semi")
        half = F.col("pos") % 2
        pairs = (left.groupBy("doc_id", "sha", F.floor(F.col("pos") / 2).cast("int").alias("pos"))
                 .agg(F.max(F.when(half == 0, F.col("name"))).alias("a"),
                      F.coalesce(F.max(F.when(half == 1, F.col("name"))), F.lit(_ODD).cast("long")).alias("b")))
        depth, last = depth + 1, last // 2
        # written twice on purpose: the pairs feed three passes of name_keys
        active = materialize(name_keys(materialize(pairs, f"pairs-{depth}"), ["a", "b"]), f"blocks-{depth}")
    names = done[0]
    for d in done[1:]:
        names = names.unionByName(d)
    return heads, names


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.
    Of equal texts the row with the largest doc_id stays."""
    heads, names = document_names(docs, id_col, text_col, block)
    named = names.select(F.col("doc_id").alias("_d"), F.col("sha").alias("_s"), "round", "name")
    rows = heads.join(named, null_safe(heads, named, [("doc_id", "_d"), ("sha", "_s")]))
    twin = F.row_number().over(W.partitionBy("_d", "_s").orderBy("_d"))
    rows = rows.select("doc_id", "sha", "round", "name", twin.alias("twin"))
    groups = rows.groupBy("round", "name").agg(F.max("doc_id").alias("keep_id"),
                                               F.count(F.lit(1)).alias("group_size"))
    out = rows.join(groups, ["round", "name"])
    return out.select("doc_id", "keep_id", "group_size",
                      (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("twin") == 1)).alias("kept"),
                      F.col("sha").alias("text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = exact_dedup(docs, id_col, text_col).where("kept").select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"))
    cols = docs.columns
    tagged = docs.withColumn("__text_sha", F.sha2(text_or_empty(text_col), 256))
    out = tagged.join(kept, null_safe(tagged, kept, [(id_col, "__id"), ("__text_sha", "__sha")]), "left_semi")
    return out.dropDuplicates([id_col, "__text_sha"]).select(*cols)
