"""Best-fit-decreasing packing of token sequences.

Documents longer than a window are first cut into full windows.  What is left
of each document is placed, longest first, in the open window with the least
room that still holds it.  A segment tree over the remaining capacities
1..size finds that window class in a logarithmic number of steps.

At scale the pieces never meet in one place.  Best fit sees only lengths, and
there are at most ``size`` of them, so the plan is made from the histogram of
lengths: pieces of equal length are interchangeable, and windows of equal
capacity are kept as ranges of sequence ids.  The plan for length l says that
its pieces of rank a..b take the windows from first on, so many in each, from some offset on.
The number of such entries depends on the window size, not on the number of
documents, since every entry either ends a length or uses up a range.  Each
piece then finds its place from (length, rank); ranks are counted in salted
groups, so a length that a third of all rows share is no hot key.

A sequence is padded to the window size unless its length is a power of two.

Defined results.  A null text counts as empty and has one id, the end id.
Repeated rows and null ids are packed like any other.  Only the id and the
text are read.  An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from outcomelab.llm.byte_bpe import ByteBpe, read_vocabulary
from outcomelab.llm.common import id_type, materialize, partitions, text_or_empty, worker_cache

WINDOW = 2048
END_ID = 1


class CapacityTree:
    """Which remaining capacities have open windows: ``least(n)`` is the
    smallest open capacity of at least ``n``, or None."""

    def __init__(self, size: int):
        self.base = 1
        while self.base <= size:
            self.base *= 2
        self.open = [0] * (2 * self.base)

    def add(self, capacity: int, change: int) -> None:
        i = self.base + capacity
        while i:
            self.open[i] += change
            i //= 2

    def least(self, n: int) -> int | None:
        i = self.base + n
        if i >= 2 * self.base:
            return None
        if self.open[i]:
            return n
        while i > 1:
            if i % 2 == 0 and self.open[i + 1]:
                i += 1
                while i < self.base:
                    i = 2 * i if self.open[2 * i] else 2 * i + 1
                return i - self.base
            i //= 2
        return None


def plan(histogram: dict[int, int], size: int = WINDOW) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """(entries, windows used).  An entry (length, rank, first, offset, each) holds
    from that rank of that length up to the next entry's: the piece of rank
    ``rank + i`` goes to sequence ``first + i // each``, ``i % each`` lengths behind ``offset``.

    A piece leaves its window as the tightest one for the next piece of its
    length as long as that still fits, so a window takes ``room // length`` of them in a row."""
    tree, ranges, entries, used = CapacityTree(size), defaultdict(list), [], 0

    def give(room: int, first: int, n: int) -> None:
        if room and n:
            ranges[room].append((first, n))
            tree.add(room, 1)

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = tree.least(length)
            if room is None:
                room, first, count = size, used, -(-left // (size // length))
                used += count
            else:
                first, count = ranges[room].pop()
                tree.add(room, -1)
            each = room // length
            full = min(count, left // each)
            if full:
                entries.append((length, rank, first, size - room, each))
                give(room - each * length, first, full)
                rank, left, first, count = rank + full * each, left - full * each, first + full, count - full
            if count and left:  # fewer than ``each`` are left: they share one window
                entries.append((length, rank, first, size - room, left))
                give(room - left * length, first, 1)
                rank, left, first, count = rank + left, 0, first + 1, count - 1
            give(room, first, count)
    return entries, used


def pieces(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
           size: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """(id, start, length, ids_crc32, doc_tokens): each document's ids cut into
    full windows and a rest."""
    vocabulary = read_vocabulary(vocabulary_path)

    def run(batches):
        bpe = worker_cache("byte_bpe", lambda: ByteBpe(vocabulary))
        for b in batches:
            take, cols = [], [[], [], [], []]
            for i, t in enumerate(b.column(1)):
                ids = np.append(bpe.encode(t.as_py()), np.array([end_id], "<u4"))
                for start in range(0, len(ids), size):
                    part = ids[start:start + size]
                    take.append(i)
                    for c, v in zip(cols, (start, len(part), zlib.crc32(part.tobytes()), len(ids))):
                        c.append(v)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(take, pa.int64())), *[pa.array(c, pa.int64()) for c in cols]],
                names=[id_col, "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(id_col, text_or_empty(text_col).alias("__text")).mapInArrow(
        run, f"`{id_col}` {id_type(docs, id_col)}, start long, length long, ids_crc32 long, doc_tokens long")


def assign(cut: DataFrame, id_col: str = "doc_id", size: int = WINDOW) -> DataFrame:
    """``cut`` with sequence_id and offset.  Pieces of one length are ranked
    by salted counts: (length, salt) groups numbered inside, their first
    ranks from the small table of group sizes."""
    salts = partitions(cut)
    salted = cut.withColumn("__salt", F.pmod(F.xxhash64(id_col, "start", "ids_crc32"), F.lit(salts)))
    sizes = salted.groupBy("length", "__salt").agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy("length").orderBy("__salt").rowsBetween(W.unboundedPreceding, -1)
    firsts = sizes.select("length", "__salt", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"))
    inside = F.row_number().over(W.partitionBy("length", "__salt").orderBy(id_col, "start", "ids_crc32"))
    ranked = (salted.withColumn("__i", inside).join(firsts, ["length", "__salt"])
              .withColumn("__rank", F.col("__first") + F.col("__i") - 1).drop("__first", "__i", "__salt"))
    histogram = {r["length"]: r["n"] for r in
                 cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``size`` rows
    entries, _ = plan(histogram, size)
    table = np.array(entries, np.int64).reshape(-1, 5)
    shift = 1 + max([0, *histogram.values()])
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    keys = table[:, 0] * shift + table[:, 1]

    def place(batches):
        for b in batches:
            at = {n: b.column(n).to_numpy(zero_copy_only=False) for n in ("length", "__rank")}
            k = np.searchsorted(keys, at["length"] * shift + at["__rank"], side="right") - 1
            i = at["__rank"] - table[k, 1]
            seq, offset = table[k, 2] + i // table[k, 4], table[k, 3] + i % table[k, 4] * at["length"]
            cols = [b.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(seq, pa.int64()), pa.array(offset, pa.int64())],
                                             names=[*names, "sequence_id", "offset"])

    names = cut.columns
    schema = ", ".join(f"`{c}` {id_type(cut, c)}" for c in names) + ", sequence_id long, offset long"
    return ranked.select(*names, "__rank").mapInArrow(place, schema)


def pack(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text",
         size: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset."""
    cut = materialize(pieces(docs, vocabulary_path, id_col, text_col, size, end_id), "pieces")
    return assign(cut, id_col, size)


def padding(packed: DataFrame, size: int = WINDOW) -> DataFrame:
    """(sequence_id, used, padding) of each sequence."""
    used = packed.groupBy("sequence_id").agg(F.sum("length").alias("used"))
    power = F.col("used").bitwiseAND(F.col("used") - 1) == 0
    return used.withColumn("padding", F.when(power, F.lit(0)).otherwise(size - F.col("used")))
