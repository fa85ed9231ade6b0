"""The registered ``opN_*`` queries over the given tables, with production
parameters, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outcomelab.llm import (embedding_graph, exact_dedup, hard_negatives, packing, pii, quality, repeated_spans,
                            secret_scan, sentencepiece_codec, simhash, source_divergence, token_rollup, toxicity)
from outcomelab.llm.common import materialize
from outcomelab.session import ensure_checkpoint_dir


def tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


def _store(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of all documents after six deliveries: all inserted with estimated
    counts, all revised to their true counts, the later copies of a text deleted, these
    inserted again, and the first two batches delivered once more."""
    docs, store = _read(spark, sf, "documents"), _store(spark, "token-rollup")
    counted = materialize(token_rollup.count_tokens(docs, tokenizer("byte_bpe_50k.json"), "byte_bpe_50k@1"), "counted")
    estimated = counted.withColumn("tokens", F.floor(F.col("bytes") / 4))
    copies = materialize(counted.join(token_rollup.later_copies(docs), "doc_id", "left_semi"), "copies")
    for batch, changes in [("load", token_rollup.inserts(estimated)), ("true counts", token_rollup.revisions(counted)),
                           ("copies out", token_rollup.deletes(copies)), ("copies back", token_rollup.inserts(copies)),
                           ("load", token_rollup.inserts(estimated)), ("true counts", token_rollup.revisions(counted))]:
        token_rollup.apply_batch(changes, store, batch)
    return token_rollup.totals(spark, store)


def op2_pii_offsets(spark: SparkSession, sf: str) -> DataFrame:
    return pii.find_pii(_read(spark, sf, "documents"))


def op3_block_names(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_dedup(_read(spark, sf, "documents"))


def op4_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.simhash_groups(_read(spark, sf, "documents"))


def op5_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    return sentencepiece_codec.digests(_read(spark, sf, "documents"), tokenizer("piece_bpe_32k.model"))


def op6_secret_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """All documents are delivered twice; the second delivery finds every pair in
    the ledger and scans nothing."""
    docs, folder = _read(spark, sf, "documents"), _store(spark, "secret-ledger")
    secret_scan.update_ledger(docs, "text", folder, "load")
    ledger = secret_scan.update_ledger(docs, "text", folder, "load again")
    found = secret_scan.findings_by_path(docs, "doc_id", "text", ledger)
    text = secret_scan.spans_text()
    return found.select("doc_id", "n_assign", "n_access", "n_hex",
                        F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))


def op7_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(_read(spark, sf, "documents"), tokenizer("byte_bpe_50k.json"))


def op8_repeated_spans(spark: SparkSession, sf: str) -> DataFrame:
    return repeated_spans.remove_repeats(_read(spark, sf, "documents"))


def op9_embedding_graph(spark: SparkSession, sf: str) -> DataFrame:
    return embedding_graph.near_duplicates(_read(spark, sf, "embeddings"))


def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.score_toxicity(_read(spark, sf, "documents"), _read(spark, sf, "labels"))


def op11_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.score_quality(_read(spark, sf, "documents"), _read(spark, sf, "labels"))


def op12_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return source_divergence.audit(_read(spark, sf, "documents"))


def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    rows = hard_negatives.usable(_read(spark, sf, "embeddings"), "vec_id", "embedding", "label")
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("id") % 50 == 0)


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_pii_offsets, op3_block_names, op4_simhash, op5_sentencepiece, op6_secret_ledger, op7_packing,
    op8_repeated_spans, op9_embedding_graph, op10_toxicity, op11_quality, op12_source_divergence, op13_hard_negatives)}

ORACLE_SQL = {
    "op3_block_names": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)""",
    "op12_source_divergence": r"""
WITH docs AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 10),
size AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
own AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
own_total AS (SELECT lang, source, sum(n) AS total FROM own GROUP BY lang, source),
grp AS (SELECT DISTINCT lang, source FROM docs),
p AS (SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n,
 1 + (1000000000::HUGEINT * (coalesce(o.n, 0) + 2)) // (coalesce(ot.total, 0) + 2 * s.v)::HUGEINT AS p,
 1 + (1000000000::HUGEINT * (k.n + 2)) // (s.total + 2 * s.v)::HUGEINT AS q
 FROM grp g JOIN kept k USING (lang) JOIN size s USING (lang) LEFT JOIN own_total ot USING (lang, source)
 LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
 FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (SELECT lang, source, 'pair' AS part, item, CAST(coalesce(value, 0) AS BIGINT) AS value
 FROM pairs LEFT JOIN sums USING (lang, source, item)),
term AS (SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value
 FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
 FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10""",
    "op13_hard_negatives": """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
 list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
 WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS s
 FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
pos AS (SELECT a, b, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5),
neg AS (SELECT pos.a, pos.b AS p, pos.s AS ps, n.b, n.s,
 row_number() OVER (PARTITION BY pos.a, pos.b ORDER BY n.s DESC, n.b) AS rank
 FROM pos JOIN s n ON n.a = pos.a AND NOT n.same AND 50 * pos.s <= 100 * n.s AND 100 * n.s <= 95 * pos.s)
SELECT a AS anchor_id, p AS positive_id, CAST(rank AS INTEGER) AS rank, b AS negative_id, ps AS positive_score,
 s AS negative_score FROM neg WHERE rank <= 3""",
}
