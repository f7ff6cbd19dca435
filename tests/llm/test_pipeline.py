"""The pipeline's stages, one after the other, and what they may drop."""

import collections

from test_operators import CLASHING, ODD, SCHEMA, links_of  # noqa: F401

import corpus_pipeline
from veritally.llm import decontamination, ngram_join
from veritally.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def test_stages_in_order(spark):
    docs = table(spark, SF_DIR, "documents").unionByName(spark.createDataFrame(ODD, SCHEMA))
    docs, seen = corpus_pipeline.written(docs), []
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, SF_DIR))
        seen.append((name, before, docs))
    (_, raw, good), (_, _, single), (_, _, clean), (_, _, mixed), (_, _, encoded) = seen
    for rows in (good, single, clean, mixed):
        assert rows.columns == raw.columns
    assert good.count() > single.count() >= clean.count() > 0
    left = [(r.doc_id, r.text, None) for r in single.collect()]
    assert not any(links_of(left).values())
    assert decontamination.contamination(clean, table(spark, SF_DIR, "benchmark")).where("contaminated").count() == 0
    copies = collections.Counter(r.doc_id for r in mixed.collect())
    assert max(copies.values()) <= 3 and set(copies) <= {r.doc_id for r in clean.collect()}
    assert collections.Counter(r.doc_id for r in encoded.collect()) == copies
    assert ngram_join.near_duplicates(single).where("class_id <> doc_id").count() == 0


def test_stages_over_nothing(spark):
    docs = table(spark, SF_DIR, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF_DIR))
    assert docs.count() == 0
