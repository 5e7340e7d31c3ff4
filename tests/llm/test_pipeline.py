"""The pipeline's stages, each against what it was given."""

from __future__ import annotations

import corpus_pipeline
from strata.llm import decontam, minhash
from strata.llm.common import stored, table

TABLES = "/root/testdata/sf0.001"


def test_stages_take_effect_on_what_they_are_given(spark):
    docs = table(spark, TABLES, "documents")
    columns, sizes = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        given, docs = docs, stored(spark, stage(spark, docs, TABLES), name)
        sizes.append(docs.count())
        assert docs.columns[: len(columns)] == columns
        assert docs.select("doc_id").subtract(given.select("doc_id")).count() == 0
        if name == "lines":
            assert docs.where("n_chars <> char_length(text)").count() == 0
        if name == "near_duplicates":
            assert minhash.near_duplicates(docs).where("not kept").count() == 0
        if name == "decontamination":
            assert decontam.contaminated(docs, table(spark, TABLES, "benchmark")).count() == 0
    assert docs.where("decoded <> text or n_tokens <> size(ids)").count() == 0
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 100
    assert corpus_pipeline.run(spark, TABLES).count() == sizes[-1]
