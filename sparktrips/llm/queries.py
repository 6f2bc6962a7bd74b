"""The registered queries of the operators: each one over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sparktrips.llm import decontaminate, jaccard_join, language_id, lm_scoring, minhash_dedup, packing, quality_classifier, quality_rules, ranked_search, \
    secret_scan, token_counts, url_filters, whitening
from sparktrips.llm.common import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(read_table(spark, sf_dir, "documents")))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(read_table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(read_table(spark, sf_dir, "documents"))


def page_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9's operator on web pages, with all four kinds of evidence: text, markup, host and suffix."""
    pages = language_id.page_evidence(read_table(spark, sf_dir, "pages"))
    return language_id.identify(pages, id_col="page_id", host_col="host", suffix_col="suffix")


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(read_table(spark, sf_dir, "pages"))


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, QueryFn]:
    return {f.__name__: f for f in (
        op1_secret_scan, op2_token_counts, op3_quality_classifier, op4_packing, op5_quality_rules, op6_lm_scoring,
        op7_jaccard_join, op8_decontaminate, op9_language_id, op10_url_filters, op11_minhash_dedup, op12_ranked_search, op13_embedding_whitening, page_language_id, pipeline)}


def oracle_sql() -> dict[str, str]:
    return {"op1_secret_scan": secret_scan.oracle(), "op12_ranked_search": ranked_search.oracle()}
