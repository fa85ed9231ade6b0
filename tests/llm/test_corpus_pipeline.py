"""The pipeline on the smallest table: each stage against its operator."""

import corpus_pipeline
from outcomelab.llm import pii

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns, seen = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns, name
        if name == "exact_dedup":
            assert docs.count() == before.select("text").distinct().count()
            assert docs.join(before, columns, "left_semi").count() == docs.count()
        if name == "pii":
            find = pii.Detector()
            assert docs.count() == before.count()
            assert not any(find.spans(r["text"]) for r in docs.collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count() <= seen
    assert corpus_pipeline.run(spark, SF).count() == packed.count()


def test_empty(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
