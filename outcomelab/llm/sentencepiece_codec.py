"""SentencePiece encoding and decoding with source offsets.

Normalisation is done here once more beside the library, in order to know
where every normalised byte came from: at each byte of the source the longest
prefix found in the model's compiled character map (a double-array trie of
prefixes and their replacements) is rewritten, anything else passes through
character by character; white space becomes the marker U+2581 and the dummy
prefix belongs to no source byte.  Each output byte remembers the source
bytes of its rule.  The pieces of the library's encoding cover the normalised
bytes from left to right, so their lengths alone project every piece to a
span of source bytes.  Where a model's map is empty and white space stays, as
with ``piece_bpe_32k``, the spans of texts without a marker of their own follow
from the lengths directly; all other texts are aligned.

Ids are the library's own: encoding runs the library on the whole text, with
begin and end ids and no sampling, and decoding runs its ``decode``.

Defined results.  A null text counts as empty: begin and end id, no piece.
Very long texts are encoded whole.  Null and repeated ids are kept, one
result row per input row; columns other than the id and the text are not
read.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from outcomelab.llm.common import id_type, text_or_empty, worker_cache

MARKER = "▁".encode()


class CharacterMap:
    """The compiled map of a model: longest-prefix rewriting of UTF-8 bytes."""

    def __init__(self, blob: bytes):
        self.units, self.texts = (), b""
        if blob:
            size = struct.unpack_from("<I", blob)[0]
            self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
            self.texts = blob[4 + size:]

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes read, replacement) of the longest prefix of ``data[at:]``."""
        if not self.units:
            return None
        node, best = 0, None
        node ^= _offset(self.units[0])
        for i in range(at, len(data)):
            node ^= data[i]
            unit = self.units[node]
            if unit & 0x800000FF != data[i]:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                best = (i + 1 - at, self.units[node] & 0x7FFFFFFF)
        if best is None:
            return None
        return best[0], self.texts[best[1]:self.texts.index(b"\0", best[1])]


def _offset(unit: int) -> int:
    """Where a double-array unit keeps its children, by the public file format."""
    return (unit >> 10) << ((unit & (1 << 9)) >> 6)


@dataclass
class Aligned:
    """Normalised bytes; ``start[i]:end[i]`` are the source bytes of byte i."""
    data: bytes
    start: np.ndarray
    end: np.ndarray


class Codec:
    """A model with its normaliser; one per Python worker."""

    def __init__(self, model: bytes):
        import sentencepiece as spm
        from sentencepiece import sentencepiece_model_pb2 as pb
        self.sp = spm.SentencePieceProcessor(model_proto=model)
        proto = pb.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy, self.squeeze, self.escape = (spec.add_dummy_prefix, spec.remove_extra_whitespaces,
                                                 spec.escape_whitespaces)
        kinds = pb.ModelProto.SentencePiece
        self.width = np.array([1 if p.type == kinds.BYTE else 0 if p.type == kinds.CONTROL else len(p.piece.encode())
                               for p in proto.pieces], np.int64)
        markers = np.array([p.piece.count("\u2581") for p in proto.pieces], np.int64)
        self.source_width = self.width - (len(MARKER) - 1) * markers
        self.plain = not self.map.units and not self.squeeze and self.escape
        self.unknown = self.sp.unk_id()

    def normalise(self, text: str) -> Aligned:
        src = text.encode("utf-8", "replace")
        if not self.map.units:
            at = np.arange(len(src))
            return self._squeezed(src, at, at + 1)
        out, start, end, at = bytearray(), [], [], 0
        while at < len(src):
            hit = self.map.longest(src, at)
            if hit is None:
                hit = 1, src[at:at + 1]
            out += hit[1]
            start += [at] * len(hit[1])
            end += [at + hit[0]] * len(hit[1])
            at += hit[0]
        return self._squeezed(bytes(out), np.array(start, np.int64), np.array(end, np.int64))

    def _squeezed(self, data: bytes, s: np.ndarray, e: np.ndarray) -> Aligned:
        if self.squeeze:
            b = np.frombuffer(data, np.uint8)
            space = b == 32
            lead = np.concatenate(([True], space[:-1])) if len(b) else space
            keep = ~(space & lead)
            while len(b) and keep.any() and space[last := np.flatnonzero(keep)[-1]]:
                keep[last] = False
            data, s, e = b[keep].tobytes(), s[keep], e[keep]
        return self._spaces(data, s, e)

    def _spaces(self, data: bytes, start: np.ndarray, end: np.ndarray) -> Aligned:
        if not data:
            return Aligned(b"", start, end)
        if self.escape:
            reps = np.where(np.frombuffer(data, np.uint8) == 32, len(MARKER), 1)
            data, start, end = data.replace(b" ", MARKER), np.repeat(start, reps), np.repeat(end, reps)
        if self.dummy:
            mark = MARKER if self.escape else b" "
            data = mark + data
            zero = np.zeros(len(mark), np.int64)
            start, end = np.concatenate((zero, start)), np.concatenate((zero, end))
        return Aligned(data, start, end)

    def encode(self, text: str) -> tuple[list[int], np.ndarray]:
        """(ids with begin and end, source byte offsets): id i covers the
        source bytes ``offsets[i, 0]:offsets[i, 1]``; the begin and end ids
        have the empty spans at either end."""
        ids = self.sp.encode(text, add_bos=True, add_eos=True)
        inner = np.array(ids, np.int64)[1:-1]
        spans = np.zeros((len(ids), 2), np.int64)
        size = len(text) if text.isascii() else len(text.encode("utf-8", "replace"))
        spans[-1] = size
        if len(inner) and self.plain and "\u2581" not in text and not (inner == self.unknown).any():
            # identity map: every byte is its own source and a marker is one space,
            # as no marker comes from the text itself
            stop = np.cumsum(self.source_width[inner]) - int(self.dummy)
            spans[1:-1, 1] = stop
            spans[2:-1, 0] = stop[:-1]
            if stop[-1] != size:
                raise ValueError("pieces do not cover the text")
        elif len(inner):
            norm = self.normalise(text)
            width = self._unknown_widths(norm, inner, self.width[inner])
            stop = np.cumsum(width)
            if stop[-1] != len(norm.data):
                raise ValueError("pieces do not cover the normalised text")
            spans[1:-1, 0] = norm.start[stop - width]
            spans[1:-1, 1] = norm.end[stop - 1]
        return ids, spans

    def _unknown_widths(self, norm: Aligned, ids: np.ndarray, width: np.ndarray) -> np.ndarray:
        """Without byte pieces, an unknown id stands for the run of characters
        up to where the next known piece is found."""
        width, at = width.copy(), 0
        for i, t in enumerate(ids):
            if t == self.unknown:
                rest = ids[i + 1:]
                known = rest[0] if len(rest) else None
                piece = self.sp.id_to_piece(int(known)).encode() if known is not None else None
                nxt = norm.data.find(piece, at + 1) if piece else len(norm.data)
                width[i] = nxt - at
            at += width[i]
        return width

    def decode(self, ids) -> str:
        return self.sp.decode([int(i) for i in ids])


def _codec(model: bytes) -> Codec:
    return worker_cache("sentencepiece", lambda: Codec(model))


def _model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``ids`` and the source byte spans of each
    (``starts``, ``ends``).  The model file (under 1 MB) is read on the driver
    and travels with the task."""
    model = _model(model_path)

    def run(batches):
        codec = _codec(model)
        for b in batches:
            for k in range(0, b.num_rows, 64):  # bounded output batches, also for long texts
                part = b.slice(k, 64)
                got = [codec.encode(t.as_py()) for t in part.column(1)]
                ids = pa.array([g[0] for g in got], pa.list_(pa.int32()))
                s = pa.array([g[1][:, 0] for g in got], pa.list_(pa.int64()))
                e = pa.array([g[1][:, 1] for g in got], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), ids, s, e], names=[id_col, "ids", "starts", "ends"])

    return docs.select(id_col, text_or_empty(text_col).alias("__text")).mapInArrow(
        run, f"`{id_col}` {id_type(docs, id_col)}, ids array<int>, starts array<bigint>, ends array<bigint>")


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text): the library's decoding of each row's ids; null ids are an
    empty list."""
    model = _model(model_path)

    def run(batches):
        codec = _codec(model)
        for b in batches:
            texts = [codec.decode(x.as_py() or []) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[id_col, "text"])

    return encoded.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {id_type(encoded, id_col)}, text string")


def digests(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode in one narrow pass, keeping digests in place of the
    ids: id, n_tokens, ids_sha256, decoded_sha256, n_bytes and
    ``covered_bytes``, the source bytes under the projected pieces."""
    model = _model(model_path)
    names = ["n_tokens", "ids_sha256", "decoded_sha256", "n_bytes", "covered_bytes"]

    def run(batches):
        codec = _codec(model)
        for b in batches:
            rows = []
            for t in b.column(1):
                ids, spans = codec.encode(t.as_py())
                back = codec.sp.decode(ids)
                from_, to = spans[1:-1, 0], spans[1:-1, 1]
                covered = int(np.maximum(to[1:] - np.maximum(from_[1:], to[:-1]), 0).sum() + to[:1].sum())
                rows.append((len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                             hashlib.sha256(back.encode()).hexdigest(), int(spans[-1, 1]), covered))
            cols = list(zip(*rows)) if rows else [()] * 5
            types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, t) for c, t in zip(cols, types)]],
                                             names=[id_col, *names])

    return docs.select(id_col, text_or_empty(text_col).alias("__text")).mapInArrow(
        run, f"`{id_col}` {id_type(docs, id_col)}, n_tokens long, ids_sha256 string, decoded_sha256 string, "
             "n_bytes long, covered_bytes long")
