"""From raw documents to encoded training shards, as five stages written one after the other.

Each stage takes (spark, docs, sf_dir), where docs are the documents its predecessor kept. All
but the last return the columns of ``documents``. Rows that repeat an id, or have none, are judged by their
own texts in every stage; a table without rows gives a result without rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from veritally.llm import decontamination, mixing, ngram_join, quality, token_shards
from veritally.llm.common import prepare, table
from veritally.llm.queries import word_pieces
from veritally.session import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept; NULL and empty texts have no words and go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the least id of equals; NULL and wordless texts are copies of nothing
    but of rows with their own id."""
    prepare(spark)
    return ngram_join.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by ``benchmark``; NULL and wordless texts are clean, items without words hit nothing."""
    return decontamination.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once, or up to three times. NULL is a source of its own; ties
    of equal rows make no difference."""
    prepare(spark)
    return mixing.mixed_rows(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix encoded and written as grammar blocks; returned is what reading them back gives. A NULL text is the end id
    alone, and rows with equal ids stand next to each other."""
    prepare(spark)
    return token_shards.encode_documents(docs, word_pieces())


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mix),
    ("token-ID output", token_output),
]

#: No stage is expressible as a whole in DuckDB SQL (hashes, MinHash, Newton steps, tokenizer).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
