"""Source divergence: how the vocabularies of a language's sources differ.

Identical texts of a language are collapsed first: one row per (lang, text)
with the number of its copies in each source.  Each such text is tokenized
once, and its term counts are added to every source with the multiplicity as
weight; so a text copied thousands of times costs one pass over its words.  Document
frequencies are weighted in the same way.

A language keeps its terms of at least ``min_docs`` documents.  Every group
(lang, source) and every language gives a kept term the integer share
``p = 1 + floor(10^9 (count + 2) / (N + 2 V))``.  The divergence of two shares
is ``floor((p - q)^2 / (p + q))``, and a pair of sources sums it over all kept
terms.

Sparse pairs.  Most terms are missing from a source, and a missing term has
one share per source, ``p0``.  So each pair starts from ``V f(p0, q0)``, and only
occurring terms change that:

* a term of the source ``s`` alone adds ``f(p, q0) - f(p0, q0)``.  This depends on
  the count only, so a source brings its histogram of counts, not its terms;
* a term of both adds ``f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)`` on top.  These are
  found per term from the sources it occurs in, each unordered pair once, and
  summed in the task before anything is shuffled.

Everything is integer arithmetic (shares through decimals, so counts may
exceed 9 * 10^9); the result does not depend on partitioning.

Bounds.  A task holds the counts of at most ``FLUSH`` distinct (lang, source,
term) keys before it sends them on.  The sources of one term are gathered in
one row, as every one of them is a partner in the result; tables per source
and per pair of sources are as large as the result itself.  No group gathers
its documents, copies or terms.

Defined results.  Null text, lang and source count as ''.  A language
without kept terms gives pairs of value 0 and no term rows; a language with
one source gives no pairs.  Repeated rows count as documents each.  Ties rank
by the item's UTF-8 bytes.  Very long texts are tokenized whole; ids and extra
columns are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from outcomelab.llm.common import materialize, text_or_empty

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
FLUSH = 600_000

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    """Runs of ASCII letters and non-ASCII characters, A-Z in lower case."""
    return text.encode("utf-8", "replace").translate(_LETTERS).split()


def collapse(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """(lang, text, copies): each distinct text of a language with the array
    of (source, n) of its copies.  Texts are known by their SHA-256, so only one
    of a task's copies is shuffled, and its join with the narrow counts finds
    it already in place."""
    text = text_or_empty(text_col)
    plain = docs.select(text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source"),
                        text.alias("text"), F.unhex(F.sha2(text, 256)).alias("h"))
    counted = plain.groupBy("lang", "h", "source").agg(F.count(F.lit(1)).alias("n"))
    copies = counted.groupBy("lang", "h").agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    texts = plain.groupBy("lang", "h").agg(F.first("text").alias("text"))
    return texts.join(copies, ["lang", "h"]).drop("h")


def _packed(lang: str, groups: dict[str, tuple[Counter, Counter]]) -> pa.RecordBatch:
    """One row per term of a language: the term once, its sources, occurrences and documents as lists."""
    codes, names = {}, list(groups)
    at = [np.fromiter((codes.setdefault(t, len(codes)) for t in n), np.int64, len(n)) for n, _ in groups.values()]
    n = np.concatenate([np.fromiter(n.values(), np.int64, len(n)) for n, _ in groups.values()])
    docs = np.concatenate([np.fromiter((docs[t] for t in n), np.int64, len(n)) for n, docs in groups.values()])
    source = np.repeat(np.arange(len(names)), [len(a) for a in at])
    term = np.concatenate(at)
    order = np.argsort(term, kind="stable")
    ends = pa.array(np.concatenate(([0], np.cumsum(np.bincount(term, minlength=len(codes))))), pa.int32())
    lists = [pa.ListArray.from_arrays(ends, v) for v in (
        pa.array(names, pa.string()).take(pa.array(source[order])), pa.array(n[order]), pa.array(docs[order]))]
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(list(codes), pa.binary()), *lists],
                                      names=["lang", "term", "source", "n", "docs"])


def term_counts(collapsed: DataFrame, flush: int = FLUSH) -> DataFrame:
    """(lang, term, source, n, docs): occurrences and documents, by weights.
    The rows lie by (lang, term), so what is asked per term needs no further
    shuffle."""
    def run(batches):
        held, size = defaultdict(lambda: defaultdict(lambda: (Counter(), Counter()))), 0
        for b in batches:
            for lang, text, copies in zip(*(b.column(i) for i in range(3))):
                found = terms(text.as_py())
                copies = copies.as_py()
                if len(copies) > 1 or copies[0]["n"] > 1:
                    found = Counter(found)
                for c in copies:
                    n, docs = held[lang.as_py()][c["source"]]
                    size -= len(n)
                    if isinstance(found, Counter):
                        for term, k in found.items():
                            n[term] += k * c["n"]
                            docs[term] += c["n"]
                    else:
                        n.update(found)
                        docs.update(set(found))
                    size += len(n)
                if size > flush:
                    yield from (_packed(lg, groups) for lg, groups in held.items())
                    held.clear()
                    size = 0
        yield from (_packed(lg, groups) for lg, groups in held.items())

    sent = collapsed.select("lang", "text", "copies").mapInArrow(
        run, "lang string, term binary, source array<string>, n array<long>, docs array<long>")
    each = sent.repartition("lang", "term").select("lang", "term", F.explode(F.arrays_zip("source", "n", "docs")).alias("e"))
    summed = each.groupBy("lang", "term", "e.source").agg(F.sum("e.n").alias("n"), F.sum("e.docs").alias("docs"))
    return summed.select("lang", "term", "source", "n", "docs")


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 kept)), in whole numbers."""
    over = (n + 2).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return 1 + F.call_function("div", over, (total + 2 * kept).cast("decimal(20,0)"))


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); p and q are at most 10^9 + 1."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _ranked(rows: DataFrame, keep: int | None = None) -> DataFrame:
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    return ranked if keep is None else ranked.where(F.col("rank") <= keep)


def pair_values(known: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every ordered pair of a language's
    sources.  ``known`` holds (lang, source, term, n, p) of occurring kept
    terms, ``groups`` (lang, source, kept, p0)."""
    a = groups.select("lang", "source", "kept", F.col("p0").alias("a0"))
    b = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("b0"))
    pairs = a.join(b, "lang").where("source <> item")
    absent = F.col("kept") * divergence(F.col("a0"), F.col("b0"))
    # terms of one side: by the histogram of their counts
    histogram = known.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("terms"))
    one = (histogram.join(pairs, ["lang", "source"])
           .select("lang", "source", "item", (F.col("terms") * (divergence(F.col("p"), F.col("b0"))
                                                                - divergence(F.col("a0"), F.col("b0")))).alias("value")))
    flipped = one.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    # terms of both sides: each unordered pair of a term's sources, then both directions
    sides = known.join(groups.select("lang", "source", "p0"), ["lang", "source"])
    listed = sides.groupBy("lang", "term").agg(F.array_sort(F.collect_list(F.struct("source", "p", "p0"))).alias("s"))
    rest = F.slice(F.col("s"), F.col("at") + 2, F.greatest(F.size("s") - F.col("at") - 1, F.lit(0)))
    both = (listed.select("lang", "s", F.posexplode("s").alias("at", "x"))
            .select("lang", "x", F.explode(rest).alias("y")))
    x, y = F.col("x"), F.col("y")
    joint = (divergence(x["p"], y["p"]) - divergence(x["p"], y["p0"])
             - divergence(x["p0"], y["p"]) + divergence(x["p0"], y["p0"]))
    met = (both.select("lang", x["source"].alias("source"), y["source"].alias("item"), joint.alias("value"))
           .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    every = (pairs.select("lang", "source", "item", absent.alias("value")).unionByName(one).unionByName(flipped)
             .unionByName(met).unionByName(met.select("lang", F.col("item").alias("source"), F.col("source").alias("item"),
                                                      "value")))
    return every.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): every pair of a language's
    sources, and the leading terms of each source against its language."""
    names = (docs.select(text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source")).distinct())
    counts = term_counts(collapse(docs, text_col, lang_col, source_col))
    # the sources of one term: as many as it has partners in the result
    per_term = counts.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "n")).alias("own"),
                                                  F.sum("n").alias("lang_n"), F.sum("docs").alias("d"))
    by_lang = materialize(per_term.where(F.col("d") >= min_docs).select(
        "lang", F.col("term").cast("string").alias("term"), "own", "lang_n"), "kept-terms")
    langs = by_lang.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    occurring = by_lang.select("lang", "term", "lang_n", F.explode("own").alias("o")).select(
        "lang", "o.source", "term", "o.n", "lang_n")
    totals = occurring.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    none = F.lit(0).cast("long")
    groups = (names.join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
              .select("lang", "source", F.coalesce("kept", none).alias("kept"), F.coalesce("total", none).alias("total"),
                      F.coalesce("lang_total", none).alias("lang_total")))
    empty = F.when(F.col("kept") > 0, share(none, F.col("total"), F.greatest(F.col("kept"), F.lit(1)))).otherwise(F.lit(1))
    groups = materialize(groups.withColumn("p0", empty), "source-groups")
    known = materialize(occurring.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q")), "shares")
    pair = _ranked(pair_values(known.drop("q"), groups))
    lead = known.where("p > q").select("lang", "source", F.col("term").alias("item"),
                                       divergence(F.col("p"), F.col("q")).alias("value"))
    term = _ranked(lead, top_terms)
    cols = [F.col("lang"), F.col("source"), F.col("part"), F.col("item"), F.col("value").cast("long").alias("value"),
            F.col("rank").cast("int").alias("rank")]
    return (pair.withColumn("part", F.lit("pair")).select(*cols)
            .unionByName(term.withColumn("part", F.lit("term")).select(*cols)))
