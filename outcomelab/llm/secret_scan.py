"""Secret scans over an incremental blob ledger (DataFrame functions only).

Every historical version of a path is addressed by the SHA-256 of its
content, so a blob that many paths or versions share is scanned once.  The
ledger holds one row for each (blob, rule, rule version) that has been
scanned, with its findings.  :func:`update_ledger` scans the pairs it has not
seen and appends them as one batch; :func:`findings_by_path` joins the
findings back to every path that carries the blob.

A rule is a Java pattern; its matches are leftmost and do not overlap.  A
match whose ``group`` is shorter than ``least`` characters is dropped and is
not retried.  Offsets count code points, end exclusive.  They come from the
lengths of the pieces between the matches, summed along the text.

A delivery first compares the narrow list of its blobs with the ledger.  Where
nothing is unseen, no text is moved or scanned; where little is, only these texts
are; otherwise texts move once, after a map-side
combine by content, so a blob that a third of all rows share costs one row
per map task.  Each delivery is a commit of its own (:mod:`outcomelab.sources.store`): one
that failed half way is invisible, and one that comes again, or under
a name used before, adds what it holds of unseen pairs and loses nothing.

Defined results.  A null text is the empty blob, which is scanned like any
other.  Null paths are kept.  Texts of any length are scanned whole; one text is held by
one task.  Repeated rows are repeated in the result.  A version whose blob the ledger lacks
has no findings: counts of 0 and no spans.  An
empty table gives an empty result and an empty delivery.  Only the named columns
are read; a path column may have any name, ``blob`` too (the result then has
no blob column of its own).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from outcomelab.llm.common import materialize, text_or_empty
from outcomelab.operators.hot_keys import join_groups
from outcomelab.sources.store import ResultStore

FEW = 50_000     # unseen blobs that are few: their names, about 100 bytes each, are broadcast
LEDGER_SCHEMA = "blob string, rule string, version string, spans array<struct<start:int,end:int>>, batch string"


def _schema() -> T.StructType:
    return T.StructType.fromDDL(LEDGER_SCHEMA)


@dataclass(frozen=True)
class Rule:
    name: str
    version: str
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


# The three base patterns and their least lengths.
RULES = [
    Rule("assign", "1", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    Rule("access", "1", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", "1", r"[0-9a-f]+", 0, 32),
]


def _narrowed(rule: Rule) -> str:
    """The same matches with the least length inside the pattern, for rules
    that are one run of a class: a run shorter than that fails at its start
    and at every later start in it."""
    if rule.group == 0 and rule.pattern == r"[0-9a-f]+":
        return rf"(?<![0-9a-f])[0-9a-f]{{{rule.least},}}"
    return rule.pattern


def blob_id(text_col: str) -> Column:
    return F.sha2(text_or_empty(text_col), 256)


def _store(spark: SparkSession, folder: str) -> ResultStore:
    return ResultStore(spark, folder, ["batch", "delivery"])


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger, empty when nothing has been delivered yet."""
    rows = _store(spark, folder).read()
    if rows is None:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in _schema()])
    return rows.select(*_schema().names)


def _scan(blobs: DataFrame, rules: list[Rule]) -> DataFrame:
    """(blob, rule, version, spans) for each blob and each of its unseen rules."""
    entries = []
    for r in rules:
        p = F.lit(_narrowed(r))
        hit = F.array_contains("todo", r.key) & F.col("text").rlike(_narrowed(r))
        pieces = F.arrays_zip(F.regexp_extract_all("text", p, F.lit(0)).alias("all"),
                              F.regexp_extract_all("text", p, F.lit(r.group)).alias("judged"),
                              F.split("text", _narrowed(r), -1).alias("gap"))
        matches = F.filter(pieces, lambda x: x["all"].isNotNull())  # the last gap has no match after it
        parts = F.transform(matches, lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(
            x["all"]).alias("size"), F.length(x["judged"]).alias("judged")))
        empty = F.lit(None).cast("array<struct<gap:int,size:int,judged:int>>")
        entries.append(F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version"),
                                F.lit(r.key).alias("key"), F.lit(r.least).alias("least"),
                                F.when(hit, parts).otherwise(empty).alias("parts")))
    each = (blobs.select("blob", "todo", F.explode(F.array(*entries)).alias("e"))
            .where(F.array_contains("todo", F.col("e.key"))).select("blob", "e.*"))
    pieces = each.select("blob", "rule", "version", "least", F.posexplode_outer("parts").alias("i", "p"))
    so_far = W.partitionBy("blob", "rule", "version").orderBy("i")
    ends = pieces.withColumn("end", F.sum(F.col("p.gap") + F.col("p.size")).over(so_far).cast("int"))
    span = F.struct((F.col("end") - F.col("p.size")).alias("start"), F.col("end"))
    spans = F.array_sort(F.collect_list(F.when(F.col("p.judged") >= F.col("least"), span)))
    return ends.groupBy("blob", "rule", "version").agg(spans.alias("spans"))


def update_ledger(versions: DataFrame, text_col: str, folder: str, batch: str,
                  rules: list[Rule] = RULES, few: int = FEW) -> DataFrame:
    """Scan the (blob, rule version) pairs of ``versions`` that the ledger in
    ``folder`` lacks, commit them under ``batch`` and return the ledger."""
    spark = versions.sparkSession
    seen = read_ledger(spark, folder).groupBy("blob").agg(F.collect_set(F.concat_ws("@", "rule", "version")).alias("seen"))
    texts = versions.select(blob_id(text_col).alias("blob"), text_or_empty(text_col).alias("text"))
    every = F.array(*[F.lit(r.key) for r in rules])
    todo = (texts.select("blob").distinct().join(seen, "blob", "left")
            .select("blob", F.array_except(every, F.coalesce("seen", F.array().cast("array<string>"))).alias("todo"))
            .where(F.size("todo") > 0))
    todo = materialize(todo, "unseen-blobs")
    if todo.count() <= few:
        blobs = texts.join(F.broadcast(todo), "blob").groupBy("blob").agg(F.first("text").alias("text"),
                                                                          F.first("todo").alias("todo"))
    else:
        blobs = texts.groupBy("blob").agg(F.first("text").alias("text")).join(todo, "blob")
    _store(spark, folder).commit(_scan(blobs, rules), batch=batch, delivery=uuid.uuid4().hex)
    return read_ledger(spark, folder)


def findings_by_blob(ledger: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """blob, n_<rule> counts and ``spans``, the findings of the given rule
    versions as structs (start, rank, end, kind) in order."""
    rank = {r.key: i for i, r in enumerate(rules)}
    names = F.create_map(*[F.lit(x) for k, i in rank.items() for x in (k, i)])
    key = F.concat_ws("@", "rule", "version")
    mine = ledger.where(key.isin(list(rank))).withColumn("rank", names[key])
    # two deliveries at the same time may both have scanned a pair
    mine = mine.groupBy("blob", "rule", "rank").agg(F.first("spans").alias("spans"))
    each = F.transform("spans", lambda s: F.struct(
        s["start"].alias("start"), F.col("rank"), s["end"].alias("end"), F.col("rule").alias("kind")))
    counts = [F.sum(F.when(F.col("rank") == i, F.size("spans")).otherwise(0)).cast("long").alias(f"n_{r.name}")
              for i, r in enumerate(rules)]
    return mine.groupBy("blob").agg(*counts, F.array_sort(F.flatten(F.collect_list(each))).alias("spans"))


def findings_by_path(versions: DataFrame, path_col: str, text_col: str, ledger: DataFrame,
                     rules: list[Rule] = RULES) -> DataFrame:
    """One row per version: its path, blob, counts and spans.  Blobs of many
    paths meet their findings by broadcast."""
    paths = materialize(versions.select(F.col(path_col).alias("__path"), blob_id(text_col).alias("blob")), "paths")
    sizes = paths.groupBy("blob").agg(F.count(F.lit(1)).alias("__paths"))
    found = sizes.join(findings_by_blob(ledger, rules), "blob", "left")
    counts = [F.coalesce(f"n_{r.name}", F.lit(0)).alias(f"n_{r.name}") for r in rules]
    none = F.array().cast(found.schema["spans"].dataType)
    found = found.select("blob", "__paths", *counts, F.coalesce("spans", none).alias("spans"))
    out = join_groups(paths, found, "blob", "__paths", "left")
    return out.select(F.col("__path").alias(path_col), *[c for c in out.columns if c not in ("__path", "__paths", path_col)])


def spans_text(spans: str = "spans") -> Column:
    """``kind:start:end`` entries, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
