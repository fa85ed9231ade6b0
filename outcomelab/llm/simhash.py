"""SimHash near-duplicates with pigeonring candidate filtering.

A fingerprint is the bitwise majority of the XXH64 hashes (seed 42) of a
document's word shingles.  Two fingerprints link when at most ``TAU`` bits
differ; documents are grouped by the connected components of those links.

Pigeonring.  The 64 bits form a ring of four segments.  When the distance of
two fingerprints is at most 3, there is a segment from which every prefix of
the ring keeps within its proportional budget: the running sums of segment
distances stay at or below 0, 1, 2, 3 (the floors of 3/4, 6/4, 9/4, 12/4).
The first two budgets make an index key of 32 bits: the first segment equal,
the second within one bit.  One side stores its key for each of the four
rotations, the other probes with the key and its 16 one-bit neighbours, so
the join is an equality join on 32 bits.  The third budget prunes what the
join finds, and the full Hamming distance decides.

Scale.  Equal fingerprints are collapsed first, so a group of copies is one
node however large it is.  Probe rows are 68 per distinct fingerprint, and a
32-bit key with random fingerprints meets few others.  Components come from
alternating large-star and small-star rounds over distributed edges.

Defined results.  Texts of any length are read whole; a text is held by one task.
A null text counts as empty; no words give fingerprint
zero, which links like any other.  Null ids count as documents but do not
name a component unless no other id is in it.  Repeated rows are repeated in
the result.  Columns other than the id and the text are not read.  An empty
table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelab.llm.common import id_type, materialize, null_safe, text_or_empty
from outcomelab.llm.components import connected_components

SHINGLE_WORDS = 3
SEED = 42
TAU = 3
SEGMENTS = 4
_WIDTH = 64 // SEGMENTS
_MASK = (1 << _WIDTH) - 1


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint of one text.  Words are runs of anything but
    ASCII white space, which is what ``bytes.split`` cuts at."""
    import xxhash
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    if len(parts) <= words:
        hashes = [xxhash.xxh64_intdigest(line, SEED)]
    else:
        size = np.fromiter(map(len, parts), np.int64, len(parts))
        ends = np.cumsum(size + 1) - 1
        starts = (ends - size)[:1 - words].tolist()
        digest, seed = xxhash.xxh64_intdigest, SEED
        hashes = [digest(line[a:b], seed) for a, b in zip(starts, ends[words - 1:].tolist())]
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = np.array(hashes[i:i + (1 << 16)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = SHINGLE_WORDS, digest: bool = False) -> DataFrame:
    """(id, bits): the fingerprint as a signed long, one row per input row.
    ``digest`` puts the text's SHA-256 (``sha``) in between."""
    text = text_or_empty(text_col)
    own = [F.col(id_col).alias("id"), *([F.sha2(text, 256).alias("sha")] if digest else [])]
    names = [id_col, *(["sha"] if digest else []), "bits"]

    def run(batches):
        for b in batches:
            got = np.array([fingerprint(t.as_py(), words) for t in b.columns[-1]], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(got, pa.int64())], names=names)

    return docs.select(*own, text.alias("__text")).mapInArrow(
        run, f"`{id_col}` {id_type(docs, id_col)}, {'sha string, ' if digest else ''}bits long")


def _segment(bits: Column, i: int) -> Column:
    return F.shiftrightunsigned(bits, _WIDTH * (i % SEGMENTS)).bitwiseAND(F.lit(_MASK).cast("long"))


def _keys(bits: Column, neighbours: bool) -> Column:
    """Per rotation, (rotation, first two segments); with one-bit neighbours
    of the second segment on the probing side."""
    out = []
    for i in range(SEGMENTS):
        first = F.shiftleft(_segment(bits, i), _WIDTH)
        second = _segment(bits, i + 1)
        flips = [0, *[1 << b for b in range(_WIDTH)]] if neighbours else [0]
        out += [F.shiftleft(F.lit(i).cast("long"), 2 * _WIDTH).bitwiseOR(first).bitwiseOR(
            second.bitwiseXOR(F.lit(f).cast("long"))) for f in flips]
    return F.array(*out)


def links(nodes: DataFrame, tau: int = TAU) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints at ``tau`` bits or fewer.
    The segment budgets above are those of tau = 3."""
    if tau != TAU:
        raise ValueError(f"the index keys are built for a distance of {TAU}")
    stored = nodes.select(F.col("bits").alias("b"), F.explode(_keys(F.col("bits"), False)).alias("key"))
    probes = nodes.select(F.col("bits").alias("a"), F.explode(_keys(F.col("bits"), True)).alias("key"))
    diff = F.col("a").bitwiseXOR(F.col("b"))
    turn = F.shiftright(F.col("key"), 2 * _WIDTH)
    # distance of the first three segments of this rotation: budget 2
    prefix = reduce(lambda acc, i: F.when(turn == i, sum(
        F.bit_count(_segment(diff, i + j)) for j in range(3))).otherwise(acc), range(SEGMENTS), F.lit(0))
    found = probes.join(stored, "key").where((F.col("a") < F.col("b")) & (prefix <= 2) & (F.bit_count(diff) <= tau))
    return found.select("a", "b").distinct()


def component_roots(rows: DataFrame, id_col: str, tau: int = TAU) -> DataFrame:
    """(bits, root, component_id) of every distinct fingerprint of ``rows``;
    root names the component, component_id is its smallest id."""
    nodes = materialize(rows.groupBy("bits").agg(F.min(id_col).alias("least")), "simhash-nodes")
    comp = connected_components(links(nodes.select("bits"), tau), "a", "b")  # node, root
    placed = nodes.join(comp, F.col("bits") == F.col("node"), "left").select(
        "bits", "least", F.coalesce("root", "bits").alias("root"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(smallest, "root").select("bits", "root", "component_id")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   words: int = SHINGLE_WORDS, tau: int = TAU) -> DataFrame:
    """One row per input row: id, fingerprint (hex), component_id (smallest id
    of the component)."""
    rows = materialize(fingerprints(docs, id_col, text_col, words), "simhash")
    placed = component_roots(rows, id_col, tau).select("bits", "component_id")
    return rows.join(placed, "bits").select(
        id_col, F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             words: int = SHINGLE_WORDS, tau: int = TAU) -> DataFrame:
    """One row of each group with all its columns: the one with the smallest
    id, null ids last, of rows with one id the one whose text has the least
    SHA-256, of equal rows any one."""
    rows = materialize(fingerprints(docs, id_col, text_col, words, digest=True), "simhash")
    rows = rows.select(F.col(id_col).alias("__id"), F.col("sha").alias("__sha"), "bits")
    # rows of one id and text are counted first: the choice below is among distinct ones
    rows = materialize(rows.groupBy("__id", "__sha", "bits").agg(F.count(F.lit(1)).alias("__n")), "simhash-rows")
    roots = component_roots(rows.select("__id", "bits"), "__id", tau).select("bits", "root")
    least = F.min(F.struct(F.col("__id").isNull(), F.col("__id"), F.col("__sha"), F.col("__n"))).alias("first")
    by_bits = rows.groupBy("bits").agg(least)   # copies of a text meet here, map-side first
    stay = materialize(by_bits.join(roots, "bits").groupBy("root").agg(F.min("first").alias("first"))
                       .select("first.__id", "first.__sha", "first.__n"), "simhash-kept")
    tagged = docs.withColumn("__text_sha", F.sha2(text_or_empty(text_col), 256))
    keys = [(id_col, "__id"), ("__text_sha", "__sha")]
    once, more = stay.where("__n = 1"), stay.where("__n > 1")
    single = tagged.join(once, null_safe(tagged, once, keys), "left_semi")
    twin = tagged.join(more, null_safe(tagged, more, keys), "left_semi").dropDuplicates([id_col, "__text_sha"])
    return single.unionByName(twin).select(*docs.columns)
