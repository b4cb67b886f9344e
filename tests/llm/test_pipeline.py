"""The stages of the pipeline: what each keeps of its own input."""

import corpus_pipeline
from ratelens.llm import decontaminate, quality
from ratelens.llm.common import staged, table


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    names, functions = zip(*corpus_pipeline.STAGES, strict=True)
    assert len(names) == 5
    kept = staged(functions[0](spark, docs, sf_dir))
    judged = quality.judged(docs, table(spark, sf_dir, "labels"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in judged.where("kept").collect())
    one = staged(functions[1](spark, kept, sf_dir))
    clean = staged(functions[2](spark, one, sf_dir))
    bad = decontaminate.scanned(one, table(spark, sf_dir, "benchmark")).where("contaminated")
    assert {r.doc_id for r in one.collect()} - {r.doc_id for r in clean.collect()} == {r.doc_id for r in bad.collect()}
    mixed = staged(functions[3](spark, clean, sf_dir))
    assert kept.columns == one.columns == clean.columns == mixed.columns == docs.columns
    last = functions[4](spark, mixed, sf_dir)
    assert last.count() == mixed.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_table(spark, nothing, sf_dir):
    docs = nothing
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, sf_dir))
    assert docs.count() == 0
