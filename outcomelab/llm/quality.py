"""Quality scores from compression with class dictionaries.

Two zstandard dictionaries are trained, one on blocks of good and one on
blocks of bad labelled text.  A text is cut into blocks of ``BLOCK`` bytes and
every block is compressed with either dictionary, so that a text's own history
never outgrows what the dictionary says about it.  With ``G`` and ``B`` the summed
sizes,

* ``(B - G) / max(B, G)`` is the normalised difference: above zero the text is
  more like the good texts;
* ``min(1, G / bytes)`` is what the better-known dictionary leaves of the text.  A
  text that repeats itself compresses to next to nothing with any dictionary,
  and only this second ratio shows it.

A logistic curve over the two, fitted on training rows that the dictionaries
have not seen, is the score.

Bounds.  At most ``PER_CLASS`` labelled texts a class (those with the smallest
id hash) are read, and of their blocks at most ``BLOCKS`` a class (the smallest
block hash) reach the driver, ``BLOCKS * BLOCK`` bytes whatever the input.
The dictionaries take ``DICTIONARY`` bytes each in every task.  Scoring is one
narrow pass over every whole text.

Labels are read only from rows with crc32(id as text) mod 5 other than 0; of
these, remainder 1 fits the curve and the rest trains the dictionaries.
Scores use the text alone.

Defined results.  A null text counts as empty; an empty text gets the share
of ones among the training labels.  Labels other than 0 and 1 and null ids in
``labels`` are ignored, labels of unknown documents count in that share only; of
contradicting labels of a document 1 counts.  Without labels of both classes every score is
their share of ones (0 without any); with both, but none of one class in the
curve's fold, the curve is fitted on all training rows.  Where the blocks are too few to
train on, the blocks themselves are the dictionary.  Very long texts pass
block by block.  Repeated rows and null ids of documents are kept, one result
row each; ``score_quality`` ignores extra columns, ``with_score`` keeps them.
An empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from outcomelab.llm.common import materialize, text_or_empty, worker_cache
from outcomelab.llm.labelled import fit_logistic, fold, prior_shift, training_draw

PER_CLASS = 6_000
BLOCK = 1_024
BLOCKS = 20_000
DICTIONARY = 256 * 1024
LEVEL = 3
KEPT_FROM = 0.3


def blocks_of(text: str | None, size: int = BLOCK) -> list[bytes]:
    data = (text or "").encode("utf-8", "replace")
    return [data[i:i + size] for i in range(0, len(data), size)]


def train_dictionary(blocks: list[bytes], size: int = DICTIONARY) -> bytes:
    """A trained dictionary of at most ``size`` bytes, or the blocks
    themselves where they are too few to train on."""
    try:
        return zstandard.train_dictionary(size, blocks, k=64, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[:size]


def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    """Frames carry no check sum, size or dictionary id: only the text counts."""
    plain = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL, **plain)
    known = zstandard.ZstdCompressionDict(dictionary)
    known.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, **plain)


@dataclass
class Model:
    key: str
    good: bytes = b""
    bad: bytes = b""
    slopes: tuple[float, float] = (0.0, 0.0)
    offset: float = 0.0
    base: float = 0.0            # share of ones among the training labels
    constant: bool = False

    def measures(self, text: str | None) -> tuple[float, float]:
        """(normalised difference, what the good dictionary leaves); zeros
        for an empty text."""
        good, bad = worker_cache(f"quality_{self.key}", lambda: (compressor(self.good), compressor(self.bad)))
        found = blocks_of(text)
        if not found:
            return 0.0, 0.0
        g = sum(len(good.compress(b)) for b in found)
        b = sum(len(bad.compress(b)) for b in found)
        size = BLOCK * (len(found) - 1) + len(found[-1])
        return (b - g) / max(b, g), min(1.0, g / size)


def _drawn_blocks(train: DataFrame, count: int) -> dict[int, list[bytes]]:
    """At most ``count`` blocks of either class's texts, by block hash."""
    def run(batches):
        for b in batches:
            cut = [blocks_of(t.as_py()) for t in b.column(0)]
            sizes = [len(c) for c in cut]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(b.column(1).to_numpy(zero_copy_only=False), sizes), pa.int32()),
                 pa.array([x for c in cut for x in c], pa.binary())], names=["y", "block"])

    every = train.select("text", "y").mapInArrow(run, "y int, block binary")
    order = [F.xxhash64("block"), F.col("block")]
    return {c: [bytes(r["block"]) for r in
                every.where(F.col("y") == c).select("block").orderBy(*order).limit(count).collect()] for c in (0, 1)}


def with_measures(docs: DataFrame, model: Model, text_col: str, out: str) -> DataFrame:
    """``docs`` with the struct ``out`` of both measures of each whole text."""
    @F.pandas_udf("difference double, left double")
    def measured(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.measures(t) for t in texts], columns=["difference", "left"], dtype="float64")
    return docs.withColumn(out, measured(text_or_empty(text_col)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id",
        label: str = "quality", per_class: int = PER_CLASS, blocks: int = BLOCKS) -> Model:
    """Dictionaries and curve from the labelled texts (see the module's
    bounds).  The curve weighs the classes as they occur among all training labels."""
    drawn, known = training_draw(labels, label_id, label, per_class)
    drawn = materialize(drawn, "quality-draw")
    named = docs.select(F.col(id_col).alias("__doc"), text_or_empty(text_col).alias("text"))
    # the draw has at most 2 * per_class narrow rows
    train = materialize(named.join(F.broadcast(drawn), F.col("__doc") == F.col("__id")).select("text", "y", "part"),
                        "quality-train")
    sizes = {r["y"]: r["n"] for r in train.where("part > 1").groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    base = float(known.get(1, 0) / max(1, sum(known.values())))
    if len(sizes) < 2:
        return Model(uuid.uuid4().hex, base=base, constant=True)
    sample = _drawn_blocks(train.where("part > 1"), blocks)
    model = Model(uuid.uuid4().hex, train_dictionary(sample[1]), train_dictionary(sample[0]), base=base)
    every = with_measures(train.where("text != ''"), model, "text", "m").select("part", "y", "m.*").toPandas()
    held = every[every["part"] == 1]
    if held["y"].nunique() < 2:
        held = every
    if held["y"].nunique() < 2:  # one class has empty texts only
        model.constant = True
        return model
    slopes, model.offset = fit_logistic(held[["difference", "left"]].to_numpy(float), held["y"].to_numpy(float))
    model.slopes = (slopes[0], slopes[1])
    model.offset += prior_shift(known, per_class)
    return model


def with_score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text, 0 to 1, as column ``out``."""
    if model.constant:
        return docs.withColumn(out, F.lit(model.base))
    m = "__measures"
    while m in docs.columns:
        m += "_"
    z = (F.lit(model.slopes[0]) * F.col(m)["difference"] + F.lit(model.slopes[1]) * F.col(m)["left"] + F.lit(model.offset))
    scored = with_measures(docs, model, text_col, m)
    return scored.withColumn(out, F.when(text_or_empty(text_col) == "", F.lit(model.base))
                             .otherwise(1 / (1 + F.exp(-z)))).drop(m)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    model = fit(docs, labels, id_col, text_col, label_id, label)
    slim = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    scored = with_score(slim, model, "__text", "score")
    return scored.select(F.col("__id").alias(id_col), F.coalesce(fold("__id") == 0, F.lit(False)).alias("held_out"), "score",
                         F.when(F.col("score") >= KEPT_FROM, 1).otherwise(0).alias("predicted"))
