"""Delta-maintained token counts.

Additive totals (documents, tokens, bytes) are kept by source, language and
tokenizer version as a sequence of committed batches of signed deltas.  A
change is an insert, a delete or a revision of one document.  Each batch is
reduced against the last known count of its documents: a delete subtracts
what was added, a revision subtracts the old count under its old keys and
adds the new one under its new keys, an insert of a known document counts as
a revision.  The totals are the sum of all committed deltas, so a rollup is
never recomputed from the texts.

A commit writes the batch's document states and its deltas, and last a marker
row with the batch's name; readers go by the markers.  A batch that has a marker
is skipped, so delivering a batch twice changes nothing, and a batch that failed half
way is written again in overwrite mode.  Folders are named by a hash, so a
batch's name may hold any character.  Batches of one store are applied one
after another.

Old states.  A batch asks for the states of its own documents only: the
history is cut down to them before anything is shuffled.  Every
``COMPACT_EVERY`` batches the last states are written as one snapshot, and later
batches read that and what came after it, so the history read is that of the
living documents, not of all changes ever made.

Defined results.  A null text counts as empty (no tokens); texts of any length
are counted whole.  Null source and language are keys of their own.  A change
without a doc_id has no earlier state to be reduced against and is additive by
itself: an insert or a revision adds the counts it carries, a delete subtracts
them, so equal rows without an id count one by one.  If one batch holds several changes
of a document, the one with the largest ``seq`` counts (of equal ones, the
largest row by operation, source, language and counts); a delete of an
unknown document changes nothing.  Columns not named are ignored.  An empty
batch commits nothing but its marker.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelab.llm.byte_bpe import ByteBpe, read_vocabulary
from outcomelab.llm.common import id_type, materialize, text_or_empty, worker_cache
from outcomelab.operators.hot_keys import join_groups

COMPACT_EVERY = 8
KEYS = ["source", "lang", "tokenizer"]
_TOTALS = "source string, lang string, tokenizer string, documents long, tokens long, bytes long"


def count_tokens(docs: DataFrame, vocabulary_path: str, tokenizer: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, source, lang, tokenizer, tokens, bytes) of whole texts, in one
    narrow Arrow pass."""
    vocabulary = read_vocabulary(vocabulary_path)

    def run(batches):
        bpe = worker_cache("byte_bpe", lambda: ByteBpe(vocabulary))
        for b in batches:
            texts = [t.as_py() for t in b.column(3)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array([len(bpe.encode(t)) for t in texts], pa.int64()),
                 pa.array([len(t.encode("utf-8", "replace")) for t in texts], pa.int64())],
                names=["doc_id", "source", "lang", "tokens", "bytes"])

    counted = docs.select(F.col(id_col).alias("doc_id"), F.col("source").cast("string").alias("source"),
                          F.col("lang").cast("string").alias("lang"), text_or_empty(text_col).alias("__text")
                          ).mapInArrow(run, f"doc_id {id_type(docs, id_col)}, source string, lang string, "
                                            "tokens long, bytes long")
    return counted.withColumn("tokenizer", F.lit(tokenizer))


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


_MARKER = "number long, batch string, folder string"


def _marks(spark: SparkSession, store: str) -> list[tuple[int, str, str]]:
    """(number, batch, folder) of the committed batches, in order; one row per batch."""
    return sorted((r["number"], r["batch"], r["folder"]) for r in _read(spark, f"{store}/commits", _MARKER).collect())


def committed(spark: SparkSession, store: str) -> list[str]:
    """Names of the committed batches, in order of commit number."""
    return [batch for _, batch, _ in _marks(spark, store)]


def _last_states(every: DataFrame) -> DataFrame:
    values = F.struct("source", "lang", "tokenizer", "documents", "tokens", "bytes")
    last = every.groupBy("doc_id").agg(F.max_by(values, "number").alias("v"), F.max("number").alias("number"))
    return last.select("doc_id", "v.*", "number").where("documents > 0")


def _history(spark: SparkSession, store: str, marks: list[tuple[int, str, str]], id_ddl: str) -> DataFrame:
    """States of all changed documents: the latest snapshot and the batches after it."""
    schema = f"doc_id {id_ddl}, {_TOTALS}, number long"
    known = [r["number"] for r in _read(spark, f"{store}/snapshots", "number long").collect()]  # one row per snapshot
    start = max([n for n in known if n < len(marks)], default=-1)
    paths = [f"{store}/compacted/{start}"] * (start >= 0) + [f"{store}/states/{f}" for n, _, f in marks if n > start]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def compact(spark: SparkSession, store: str, id_ddl: str) -> None:
    """Write the last states of all documents as a snapshot."""
    marks = _marks(spark, store)
    if not marks:
        return
    number = marks[-1][0]
    _last_states(_history(spark, store, marks, id_ddl)).write.mode("overwrite").parquet(f"{store}/compacted/{number}")
    mark = spark.createDataFrame([(number,)], "number long").coalesce(1)
    mark.write.mode("overwrite").parquet(f"{store}/snapshots/mark={number}")


def apply_batch(changes: DataFrame, store: str, batch: str, compact_every: int = COMPACT_EVERY) -> bool:
    """Commit a batch of changes (op insert/delete/revise, doc_id, source,
    lang, tokenizer, tokens, bytes, seq).  False: it was committed before."""
    spark = changes.sparkSession
    marks = _marks(spark, store)
    if batch in [b for _, b, _ in marks]:
        return False
    number, folder = len(marks), hashlib.sha256(batch.encode()).hexdigest()[:32]
    gone = F.col("op") == "delete"
    amounts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("tokens", "bytes")]
    value = F.struct("seq", "op", "source", "lang", "tokenizer", "tokens", "bytes")
    now = (changes.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max(value).alias("c")).select("doc_id", "c.*"))
    now = now.select("doc_id", "source", "lang", "tokenizer", F.when(gone, 0).otherwise(1).cast("long").alias("documents"),
                     *[F.when(gone, 0).otherwise(F.coalesce(c, F.lit(0))).cast("long").alias(c) for c in ("tokens", "bytes")],
                     F.lit(number).cast("long").alias("number"))
    now.write.mode("overwrite").parquet(f"{store}/states/{folder}")
    id_ddl = id_type(changes, "doc_id")
    now = spark.read.schema(f"doc_id {id_ddl}, {_TOTALS}, number long").parquet(f"{store}/states/{folder}")
    old = _last_states(_history(spark, store, marks, id_ddl).join(now.select("doc_id"), "doc_id", "left_semi"))
    cols = [*KEYS, "documents", "tokens", "bytes"]
    minus = old.select(*KEYS, *[(-F.col(c)).alias(c) for c in cols[3:]])
    sign = F.when(gone, -1).otherwise(1).cast("long")
    loose = changes.where("doc_id IS NULL").select(*KEYS, sign.alias("documents"), *amounts, sign.alias("sign"))
    loose = loose.select(*KEYS, "documents", *[(F.col(c) * F.col("sign")).alias(c) for c in ("tokens", "bytes")])
    deltas = now.where("documents > 0").select(*cols).unionByName(minus).unionByName(loose)
    deltas = deltas.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in cols[3:]])
    deltas.write.mode("overwrite").parquet(f"{store}/deltas/{folder}")
    mark = spark.createDataFrame([(number, batch, folder)], _MARKER).coalesce(1)
    mark.write.mode("overwrite").parquet(f"{store}/commits/mark={folder}")
    if (number + 1) % compact_every == 0:
        compact(spark, store, id_ddl)
    return True


def totals(spark: SparkSession, store: str) -> DataFrame:
    """The rollup: the sum of all committed deltas, groups of no documents left out."""
    marks = _marks(spark, store)
    if not marks:
        return spark.createDataFrame([], _TOTALS)
    deltas = spark.read.schema(_TOTALS).parquet(*[f"{store}/deltas/{f}" for _, _, f in marks])
    out = deltas.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in ("documents", "tokens", "bytes")])
    return out.where("documents <> 0 OR tokens <> 0 OR bytes <> 0")


def _changes(counted: DataFrame, op: str) -> DataFrame:
    return counted.select(F.lit(op).alias("op"), "doc_id", "source", "lang", "tokenizer", "tokens", "bytes",
                          F.lit(0).cast("long").alias("seq"))


def inserts(counted: DataFrame) -> DataFrame:
    return _changes(counted, "insert")


def revisions(counted: DataFrame) -> DataFrame:
    return _changes(counted, "revise")


def deletes(counted: DataFrame) -> DataFrame:
    return _changes(counted, "delete")


def later_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id) of every document with an id whose text another document with a smaller
    id also has.  Heavy groups of copies meet their least id by broadcast."""
    hashes = materialize(docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.sha2(text_or_empty(text_col), 256).alias("h")), "text-hashes")
    first = hashes.groupBy("h").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return join_groups(hashes, first, "h", "n").where("doc_id <> least").select("doc_id")
