"""Removal of repeated byte strings by threshold-bounded interval expansion.

A byte goes when it lies in a ``LENGTH``-byte string that also starts earlier,
in a document with a smaller id or earlier in its own.

Which strings repeat is decided on a Burrows-Wheeler transform: a breadth-first
search extends intervals of suffixes backward by one byte at a time and so
finds the common-prefix lengths 0, 1, 2, ... of neighbouring suffixes in this
order; it stops at ``LENGTH``.  Neighbours whose length is still unknown then
share at least ``LENGTH`` bytes.

No suffix array of the whole corpus is needed, since equal windows can be
brought together beforehand.  Each window (every start position of ``LENGTH``
bytes) is keyed by its anchor, the leftmost least hash of its ``GRAM``-byte
substrings, which depends on the window's bytes alone.  Consecutive windows
with one anchor occurrence form a chunk of at most ``LENGTH - GRAM + 1``
windows.  The steps:

1. a narrow pass emits a row (anchor hash, content hash, document, place) per chunk;
2. rows meet by anchor.  Copies of one chunk content are settled there: every
   occurrence but the first is repeated in full, and a content alone under its
   anchor needs nothing more.  The first occurrence of each content whose
   anchor has other contents goes on;
3. the bytes of those chunks, a small part of
   the text, are cut out and meet by anchor in blocks of bounded size, on
   which the transform decides window by window;
4. the repeated windows go back to their documents.

Skew.  Of the copies of a content that one part of a task meets, all but the
first are settled there and then.  Anchors that are frequent in a sample of documents are dealt by anchor
and content instead of anchor alone; the list has at most ``HEAVY`` entries,
and which anchors are on it changes no result.  An anchor with more than
``SPLIT`` contents is dealt further by two more minima of its windows, under
other hashes.  Texts travel compressed.

Defined results.  A null text counts as empty.  Null ids sort before all
others.  Rows that share id and text are one document and get the same
result; of rows that share only the id, the order follows a hash of the text.
A document is known by its id and the first 128 bits of its text's SHA-256, so
null and repeated ids are no limit on the number of different texts under them.
Ids must be integers.  Texts shorter than ``LENGTH`` bytes lose nothing and
hide nothing.  An empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from outcomelab.llm.common import materialize, partitions, text_or_empty, worker_cache

LENGTH = 100
GRAM = 32
SEGMENT = 1 << 21      # bytes hashed at a time
BLOCK = 1 << 18        # bytes of chunks in one transform
SPLIT = 8_000
HEAVY = 512
SAMPLE_OF = 64         # one document in so many is looked at for frequent anchors
_BASE = 0x9E3779B97F4A7C15
_NW_BITS, _POS_BITS = 8, 55
_DOC = ["doc", "text_a", "text_b"]  # a document: its id and two longs of its text's hash
_DOC_DDL = "doc long, text_a long, text_b long"


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64; one per worker."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            up, down = np.full(2 * n, _BASE, np.uint64), np.full(2 * n, pow(_BASE, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up[:n], self.down[:n]


def _mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    x = x ^ np.uint64(seed * 0x632BE59BD9B4E019 % (1 << 64))
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _prefix_hash(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    up, down = worker_cache("powers", Powers).to(len(b) + 1)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:len(b)], out=sums[1:])
    return sums, down


def _gram_hash(sums: np.ndarray, down: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    return _mix((sums[k:] - sums[:-k]) * down[:len(sums) - k], seed)


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    have = 1
    while have * 2 <= w:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (w - have)], x[w - have:]) if have < w else x


def chunks(b: np.ndarray, doc_end: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(start, windows, anchor hash, content hash) of the chunks of
    concatenated documents; ``doc_end[i]`` is the end of the document of byte i."""
    none = np.zeros(0, np.int64)
    if len(b) < length:
        return none, none, none, none
    sums, down = _prefix_hash(b)
    h = _gram_hash(sums, down, gram)
    least = _sliding_min(h, length - gram + 1)
    at = np.arange(len(least))
    valid = doc_end[:len(least)] - at >= length
    new = np.ones(len(least), bool)
    # the anchor changes when a lesser hash comes in or the leftmost least one goes out
    new[1:] = (least[1:] != least[:-1]) | (h[:len(least) - 1] == least[:-1]) | ~valid[:-1]
    start = np.flatnonzero(new & valid)
    edges = np.flatnonzero(new | ~valid)
    stop = np.append(edges, len(least))[np.searchsorted(edges, start) + 1]
    content = _mix((sums[stop + length - 1] - sums[start]) * down[start], 1) ^ (stop - start).astype(np.uint64)
    return start, stop - start, least[start].view(np.int64), content.view(np.int64)


def _segments(texts: list[bytes], length: int):
    """Lists of (document number, offset, bytes) of about SEGMENT bytes; a long
    document is cut so that every window lies whole in one part."""
    group, size = [], 0
    for i, t in enumerate(texts):
        for a in range(0, max(1, len(t) - length + 1), SEGMENT):
            part = t[a:a + SEGMENT + length - 1]
            group.append((i, a, part))
            size += len(part)
            if size >= SEGMENT:
                yield group
                group, size = [], 0
    if group:
        yield group


def _changes(columns: list[np.ndarray], before: tuple | None = None) -> np.ndarray:
    """Rows that differ from the row above (``before``: above the first)."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([x[1:] != x[:-1] for x in columns], axis=0)
    if before is not None and len(new):
        new[0] = tuple(x[0] for x in columns) != before
    return new


def _emit_chunks(length: int, gram: int):
    def run(batches):
        for b in batches:
            keys = [b.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            # documents of the batch in order of their keys; repeated rows share a rank
            by_key = np.lexsort(keys[::-1])
            rank = np.empty(len(by_key), np.int64)
            rank[by_key] = np.cumsum(_changes([x[by_key] for x in keys]))
            for group in _segments([t.as_py().encode("utf-8", "replace") for t in b.column(3)], length):
                sizes = np.array([len(p) for _, _, p in group])
                ends = np.cumsum(sizes)
                data = np.frombuffer(b"".join(p for _, _, p in group), np.uint8)
                start, windows, anchor, content = chunks(data, np.repeat(ends, sizes), length, gram)
                part = np.searchsorted(ends, start, side="right")
                doc = np.array([i for i, _, _ in group])[part]
                pos = start - (ends - sizes)[part] + np.array([a for _, a, _ in group])[part]
                rows = [x.astype(np.int64) for x in (anchor, content, rank[doc], (pos << _NW_BITS) | windows)]
                order = np.lexsort(rows[::-1])
                rows, doc = [x[order] for x in rows], doc[order]
                own = _changes(rows)  # repeated rows of one document count once
                rows, doc = [x[own] for x in rows], doc[own]
                copy = np.zeros(len(rows[0]), bool)  # later occurrences of a content met in this very part
                copy[1:] = (rows[0][1:] == rows[0][:-1]) & (rows[1][1:] == rows[1][:-1])
                cols = [*rows[:2], *[x[doc] for x in keys], rows[3], copy]
                yield pa.RecordBatch.from_arrays([*map(pa.array, cols)], names=["anchor", "content", *_DOC, "place", "copy"])
    return run


def _settle(heavy: np.ndarray):
    """Step 2 over rows sorted by (anchor, content, document, place): copies settled
    before pass through as kind 0; of the rest, kind 0 for a chunk that repeats an earlier one in full, kind 1 for the first of its
    content under an anchor with other contents."""
    names = ["anchor", *_DOC, "place", "kind", "contents"]

    def finish(rows, last):
        own = _changes(rows, last)  # repeated rows of one document count once
        a, c, *doc, p = (x[own] for x in rows)
        first = _changes([a, c], last[:2] if last else None)
        group = np.cumsum(_changes([a])) - 1
        contents = np.bincount(group, first)[group] if len(a) else np.zeros(0)
        hot = np.isin(a, heavy)
        contents = np.where(hot, SPLIT + 1, contents)
        out = ~first | (contents > 1)
        kind = first[out].astype(np.int64)
        cols = (a[out], *[x[out] for x in doc], p[out], kind, contents[out].astype(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], names=names)

    def run(batches):
        hold = [np.zeros(0, np.int64)] * 6
        last = None
        for b in batches:
            *new, copy = [b.column(i).to_numpy(zero_copy_only=False) for i in range(7)]
            copy = copy.astype(bool)
            if copy.any():
                zero = np.zeros(int(copy.sum()), np.int64)
                done = [new[0][copy], *[x[copy] for x in new[2:]], zero, zero]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in done], names=names)
            hold = [np.concatenate((x, y[~copy])) for x, y in zip(hold, new)]
            a = hold[0]
            # rows of the last anchor wait for the rest of it, unless it is heavy
            cut = len(a) if not len(a) or a[-1] in heavy else int(np.searchsorted(a, a[-1]))
            if cut:
                yield finish([x[:cut] for x in hold], last)
                last = tuple(x[cut - 1] for x in hold)
                hold = [x[cut:] for x in hold]
        if len(hold[0]):
            yield finish(hold, last)
    return run


def suffix_order(t: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by their next ``depth`` or more bytes (prefix doubling
    from 8 bytes)."""
    n = len(t)
    padded = np.concatenate((t, np.zeros(8, np.uint8))).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i:i + n]
    known = 8
    order = np.argsort(key, kind="stable")
    while True:
        s = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], s[1:] != s[:-1])))
        if known >= depth or rank[order[-1]] == n - 1:
            return order
        key = rank * (n + 1)
        key[:n - known] += rank[known:] + 1
        known *= 2
        order = np.argsort(key, kind="stable")


def bounded_lcp(t: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """[n] bool: suffix i of the order shares fewer than ``length`` bytes with
    the one before it.  Breadth-first backward extension on the transform."""
    n = len(t)
    bwt = t[order - 1]  # the byte before each suffix, cyclic
    by_byte = np.argsort(bwt, kind="stable")
    lf = np.empty(n, np.int64)
    lf[by_byte] = np.arange(n)
    first = bwt[by_byte]
    known = np.zeros(n + 1, bool)  # common prefix with the suffix before is known
    known[0] = known[n] = True
    lo, hi = np.array([0]), np.array([n])
    for _ in range(length):  # the common prefixes of length 0, 1, 2, ...
        if not len(lo):
            break
        size = hi - lo
        owner = np.repeat(np.arange(len(lo)), size)
        rows = np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)
        to = lf[rows]
        o = np.argsort(to)
        to, owner = to[o], owner[o]
        # rows of one interval with one preceding byte land on neighbouring places
        begin = np.ones(len(to), bool)
        begin[1:] = (to[1:] != to[:-1] + 1) | (owner[1:] != owner[:-1]) | (first[to[1:]] != first[to[:-1]])
        at = np.flatnonzero(begin)
        new_lo, new_hi = to[at], to[np.append(at[1:], len(to)) - 1] + 1
        fresh = ~known[new_hi]
        lo, hi = new_lo[fresh], new_hi[fresh]
        known[hi] = True
    return known[:n]


def repeated_windows(strings: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For strings in order of precedence: the starts of the windows of each
    that also occur in an earlier string or earlier in the same."""
    sizes = np.array([len(s) for s in strings])
    t = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    order = suffix_order(t, length)
    group = np.cumsum(bounded_lcp(t, order, length)) - 1
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    owner = np.searchsorted(begin, order, side="right") - 1
    inside = order - begin[owner]
    whole = inside + length <= sizes[owner]
    order, group, owner, inside = order[whole], group[whole], owner[whole], inside[whole]
    earliest = np.full(group.max() + 1 if len(group) else 0, len(t))
    np.minimum.at(earliest, group, order)  # earlier strings stand first in t
    again = order > earliest[group]
    owner, inside = owner[again], inside[again]
    o = np.lexsort((inside, owner))
    owner, inside = owner[o], inside[o]
    edges = np.searchsorted(owner, np.arange(len(strings) + 1))
    return [inside[edges[i]:edges[i + 1]] for i in range(len(strings))]


def _runs(x: np.ndarray) -> list[tuple[int, int]]:
    """Sorted integers as (first, count) runs."""
    if not len(x):
        return []
    cut = np.flatnonzero(np.diff(x) != 1) + 1
    begin = np.concatenate(([0], cut))
    end = np.concatenate((cut, [len(x)]))
    return [(int(x[a]), int(b - a)) for a, b in zip(begin, end)]


def _split_keys(s: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Window starts where the pair of further minima changes, and a hash of
    the pair from there on."""
    sums, down = _prefix_hash(np.frombuffer(s, np.uint8))
    key = np.zeros(len(s) - length + 1, np.uint64)
    for seed, k in ((2, 16), (3, 24)):
        key = _mix(key ^ _sliding_min(_gram_hash(sums, down, k, seed), length - k + 1), seed)
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return at, key[at]


def _cut_out(length: int):
    """Step 3, first half: (document, text, chunks) -> chunk bytes by key."""
    def run(batches):
        import zstandard
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            out = [[], [], [], [], [], []]
            for i in range(b.num_rows):
                text = unpack.decompress(b.column(3)[i].as_py())
                doc = [b.column(k)[i].as_py() for k in range(3)]
                for c in b.column(4)[i].as_py():
                    a, n = c["pos"], c["windows"]
                    s = text[a:a + n + length - 1]
                    parts = [(c["anchor"], 0, n)]
                    if c["contents"] > SPLIT:
                        at, keys = _split_keys(s, length)
                        more = _mix(keys ^ np.uint64(c["anchor"] & (1 << 64) - 1), 4).view(np.int64).tolist()
                        stops = [*at[1:].tolist(), n]
                        parts = [(k, x, y - x) for k, x, y in zip(more, at.tolist(), stops)]
                    for k, x, m in parts:
                        for col, v in zip(out, (k, *doc, a + x, s[x:x + m + length - 1])):
                            col.append(v)
            types = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                             names=["key", *_DOC, "pos", "bytes"])
    return run


def _transform(length: int):
    """Step 3, second half, over rows sorted by key: whole keys are gathered
    to blocks of about BLOCK bytes; (document, pos, windows) of repeats."""
    def decide(rows):
        rows = sorted({r[1:5]: r for r in rows}.values(), key=lambda r: r[1:5])
        out = []
        for (_, *doc, pos, _), again in zip(rows, repeated_windows([r[5] for r in rows], length)):
            out += [(*doc, pos + a, n) for a, n in _runs(again)]
        cols = list(zip(*out)) if out else [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=[*_DOC, "pos", "windows"])

    def run(batches):
        block, size, one, one_size, key = [], 0, [], 0, None
        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                if row[0] != key:
                    if len(one) > 1:  # a key alone in its group has no repeat
                        block += one
                        size += one_size
                        if size >= BLOCK:
                            yield decide(block)
                            block, size = [], 0
                    one, one_size, key = [], 0, row[0]
                one.append(row)
                one_size += len(row[5]) + 1
        block += one if len(one) > 1 else []
        if block:
            yield decide(block)
    return run


def _finish(length: int, id_col: str, id_ddl: str):
    def run(batches):
        import zstandard
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            rows = []
            for i in range(b.num_rows):
                text = unpack.decompress(b.column(1)[i].as_py())
                spans, kept, at = [], hashlib.sha256(), 0
                for r in sorted((r["pos"], r["windows"]) for r in b.column(2)[i].as_py() or []):
                    a, e = r[0], r[0] + r[1] + length - 1
                    if spans and a <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], e)
                    else:
                        spans.append([a, e])
                for a, e in spans:
                    kept.update(text[at:a])
                    at = e
                kept.update(text[at:])
                rows.append((len(text), sum(e - a for a, e in spans), len(spans), kept.hexdigest()))
            cols = list(zip(*rows)) if rows else [()] * 4
            types = [pa.int64()] * 3 + [pa.string()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(cols, types)]],
                                             names=[id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return run


def _packed(docs: DataFrame) -> DataFrame:
    """(id, document, packed): texts compressed for the way to their spans."""
    def run(batches):
        import zstandard
        pack = zstandard.ZstdCompressor(level=3)
        for b in batches:
            z = [pack.compress(t.as_py().encode("utf-8", "replace")) for t in b.column(4)]
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(z, pa.binary())], names=["id", *_DOC, "packed"])
    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", *_DOC, "text").mapInArrow(run, f"id {kind}, {_DOC_DDL}, packed binary")


def _heavy_anchors(docs: DataFrame, length: int, gram: int) -> np.ndarray:
    """Anchors that hold more than 1/(8P) of a sample's chunks (P: shuffle
    partitions), at most HEAVY: a hint for dealing rows only."""
    sample = docs.where(F.pmod(F.xxhash64(*_DOC), F.lit(SAMPLE_OF)) == 0)
    counts = (sample.select(*_DOC, "text").mapInArrow(_emit_chunks(length, gram), _CHUNK_ROW).where("NOT copy")
              .groupBy("anchor").agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n").alias("total"))
    top = (counts.crossJoin(F.broadcast(total)).where((F.col("n") * 8 * partitions(docs) > F.col("total")) & (F.col("n") > 32))
           .orderBy(F.desc("n"), "anchor").limit(HEAVY).collect())
    return np.array(sorted(r["anchor"] for r in top), np.int64)


_CHUNK_ROW = f"anchor long, content long, {_DOC_DDL}, place long, copy boolean"


def _bits(place: Column, skip: int, width: int) -> Column:
    return F.shiftrightunsigned(place, skip).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def _half(digest: Column, start: int) -> Column:
    """16 hexadecimal digits as a long."""
    return F.conv(F.substring(digest, start, 16), 16, -10).cast("long")


def remove_repeats(table: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256.
    ``length`` is at least ``gram`` and less than ``gram`` + 255: a chunk's windows
    are counted in 8 bits."""
    if not 0 < gram <= length < gram + (1 << _NW_BITS) - 1:
        raise ValueError(f"a length of {length} does not go with grams of {gram}: {gram} to {gram + (1 << _NW_BITS) - 2} do")
    text = text_or_empty(text_col)
    docs = table.select(F.col(id_col).alias("id"),
                        F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)).cast("long")).alias("doc"),
                        _half(F.sha2(text, 256), 1).alias("text_a"), _half(F.sha2(text, 256), 17).alias("text_b"),
                        text.alias("text"))
    heavy = _heavy_anchors(docs, length, gram)
    n = partitions(table)
    rows = docs.select(*_DOC, "text").mapInArrow(_emit_chunks(length, gram), _CHUNK_ROW)
    deal = F.when(F.col("copy"), F.xxhash64(*_DOC, "place"))
    if len(heavy):
        deal = deal.when(F.col("anchor").isin(heavy.tolist()), F.xxhash64("anchor", "content"))
    deal = deal.otherwise(F.col("anchor"))
    settled = materialize(
        rows.withColumn("deal", deal).repartition(n, "deal").drop("deal")
        .sortWithinPartitions("anchor", "content", *_DOC, "place")
        .mapInArrow(_settle(heavy), f"anchor long, {_DOC_DDL}, place long, kind long, contents long"), "chunks")
    place = F.col("place")
    settled = settled.select("anchor", *_DOC, "kind", "contents",
                             _bits(place, _NW_BITS, _POS_BITS).alias("pos"), _bits(place, 0, _NW_BITS).alias("windows"))
    packed = _packed(docs)
    asked = settled.where("kind = 1").groupBy(*_DOC).agg(
        F.collect_set(F.struct("anchor", "pos", "windows", "contents")).alias("chunks"))
    cut = packed.join(asked, _DOC).select(
        *_DOC, "packed", "chunks").mapInArrow(
        _cut_out(length), f"key long, {_DOC_DDL}, pos long, bytes binary")
    again = materialize(cut.repartition(n, "key").sortWithinPartitions("key").mapInArrow(
        _transform(length), f"{_DOC_DDL}, pos long, windows long"), "repeats")
    every = settled.where("kind = 0").select(*_DOC, "pos", "windows").unionByName(again)
    spans = every.groupBy(*_DOC).agg(F.collect_set(F.struct("pos", "windows")).alias("spans"))
    id_ddl = docs.schema["id"].dataType.simpleString()
    return packed.join(spans, _DOC, "left").select("id", "packed", "spans").mapInArrow(
        _finish(length, id_col, id_ddl),
        f"`{id_col}` {id_ddl}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
