"""The registered queries of the training-data operators, with their production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chroniq.llm import (
    decontaminate,
    hard_negatives,
    license_scan,
    lm,
    mtree,
    ngram_join,
    packing,
    quality,
    simhash,
    token_alignment,
    token_counts,
    toxicity,
    url_filter,
)
from chroniq.llm import sql
from chroniq.llm.common import fold, table


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.similarity_classes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_copies", "n_links")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_counts.count_tokens(docs, tokenizer_file("word_bpe_49k.json"), token_counts.fresh_cache(spark))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold("doc_id", 5) == 0
    return toxicity.score_toxicity(docs, toxicity.learn(docs, labels, ~held_out), held_out)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold("doc_id", 4) == 2
    return quality.score_quality(docs, quality.learn(docs, labels, ~held_out), held_out)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"), wrapped=True)
    return found.drop("blocks")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).drop("words")


def op8_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings")).drop("computed")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"), fold("doc_id", 5) == 1)


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.document_fingerprints(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    return token_alignment.align(table(spark, sf_dir, "documents"), *files).documents()


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(vectors.withColumn("label", moved)).drop("scored")


QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_token_counts": op2_token_counts,
    "op3_toxicity": op3_toxicity,
    "op4_packing": op4_packing,
    "op5_quality": op5_quality,
    "op6_license_scan": op6_license_scan,
    "op7_url_filter": op7_url_filter,
    "op8_mtree": op8_mtree,
    "op9_decontamination": op9_decontamination,
    "op10_lm_scores": op10_lm_scores,
    "op11_simhash": op11_simhash,
    "op12_token_alignment": op12_token_alignment,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES = {
    "op1_ngram_join": sql.OP1,
    "op6_license_scan": sql.OP6,
    "op8_mtree": sql.OP8,
    "op9_decontamination": sql.OP9,
    "op13_hard_negatives": sql.OP13,
}
