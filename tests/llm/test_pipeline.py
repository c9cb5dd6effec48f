"""The pipeline's quality stage: cutoffs from labelled rows alone give what all measured rows give."""

import corpus_pipeline
from waybill.llm import quality_rules

SF = "/root/testdata/sf0.001"


def test_quality_stage_keeps_what_the_rules_keep(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    features = quality_rules.measured(docs)
    want = quality_rules.judged(features, quality_rules.cutoffs(features, labels)).where("kept").select("doc_id")
    got = corpus_pipeline.quality(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in want.collect())
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_join", "substring_dedup", "decontaminate", "packing"]
