"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veritally.llm import bottom_sketches, conversation_trie, decontamination, duck_statements, licenses, mixing, ngram_join, quality, sharding, spelling_variants, suffix_dedup, token_shards, toxicity, warc_bundles
from veritally.llm.common import table
from veritally.session import written

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its base counts and verdict; NULL and empty texts have no words and fail the base rules, repeated rows are judged alike."""
    scored = quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "__quality.*")


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words the mix takes of it; NULL is a source of its own, NULL and empty texts have size 0 and take nothing."""
    sized = mixing.with_size(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text")
    mixed = mixing.mix_documents(written(sized))
    return mixed.selectExpr("doc_id", "size", "source_size", "target", "copies * size AS taken", "source", "copies")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its toxicity score; NULL and empty texts get the score of a text without sentences, rows without a label are scored too."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs, model)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"),
                         "n_sentences", "n_offending", "worst_start", "worst_end")


def op4_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its shard and slot by law ``bytes``; NULL and empty texts are equal texts of size 1, rows that repeat an id stand for themselves."""
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op5_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as the archives give it back; a NULL html is an empty payload, rows that repeat an id are records of their own."""
    return warc_bundles.archive(table(spark, sf_dir, "pages"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class and links; NULL and wordless texts are linked with nothing, copies count as links."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what was removed; NULL and empty texts have no bytes, equal rows remove each other."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``source/lang/thousand/id``; one that is a licence as a whole states its directory's.

    A NULL part is empty; a row without an id is a file named by its text.
    """
    docs = table(spark, sf_dir, "documents")
    name = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text-"), F.md5(F.coalesce("text", F.lit("")))))
    parts = ["source", "lang", F.floor(F.col("doc_id") / 1000).cast("string")]
    path = F.concat_ws("/", *[F.coalesce(part, F.lit("")) for part in parts], name)
    found = licenses.scan_files(docs.select(path.alias("path"), "text"))
    return found.withColumn("doc_id", F.expr("try_cast(substring_index(path, '/', -1) AS bigint)"))


def word_pieces() -> token_shards.Encoding:
    import public_tokenizers

    return token_shards.Encoding(public_tokenizers.path("word_bpe_49k.json"))


def op7_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as the token files give it back, NULL ids first; a NULL or empty text is the end id alone."""
    return token_shards.encode_documents(table(spark, sf_dir, "documents"), word_pieces())


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its hits; NULL and wordless texts have none, rows that repeat an id are judged by their own texts."""
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words with the more frequent word one edit away; NULL texts have no words."""
    return spelling_variants.variant_groups(table(spark, sf_dir, "documents"))


def op12_bottom_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's component of near copies; NULL and wordless texts are alone."""
    return bottom_sketches.near_duplicates(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of rebuilt conversations; rows without conv_id are left out."""
    return conversation_trie.trie_nodes(table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_quality_rules, op2_source_mix, op3_toxicity, op4_balanced_shards, op5_warc_bundles, op6_ngram_jaccard_join, op7_token_shards, op8_suffix_dedup, op9_license_scan, op10_benchmark_decontamination, op11_spelling_variants, op12_bottom_sketches, op13_conversation_trie)}


def oracle_sql() -> dict[str, str]:
    return duck_statements.statements()
