"""The corpus pipeline: toxicity, exact copies, near copies, personal data,
packing.

Each stage is a function (spark, docs, sf_dir) -> DataFrame over all documents
that the stage before it kept.  All but the last return the columns of
``documents``; the last returns the packed pieces.  :func:`run` writes every
stage's result as Parquet in the checkpoint folder and reads it back for the
next, so a lost executor never costs more than the stage at hand.

Defined results.  The stages take over those of their operators: null texts
count as empty and are kept by the first stage, one of all empty texts stays
after the second; null ids, ties and repeated rows follow the operators'
docstrings; extra columns travel along; empty tables give empty results.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from outcomelab.llm import exact_dedup, packing, pii, simhash, toxicity  # noqa: E402
from outcomelab.llm.common import materialize  # noqa: E402
from outcomelab.llm.queries import tokenizer  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models reject go (operator 10)."""
    return toxicity.keep_ordinary(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays (operator 3)."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component the smallest doc_id stays (operator 4)."""
    return simhash.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes a bracketed kind; n_chars follows (operator 2)."""
    return pii.mask_pii(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces packed into windows (operator 7)."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

# Language models, SimHash and tokenizers are beyond SQL; tests/llm compares
# the pipeline with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
