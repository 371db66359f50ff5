"""From raw documents to packed windows of tokens: quality, toxicity, near copies, benchmark passages, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept; its result is written as Parquet and
reread as the next one's ``docs``. All but the last return the columns of documents. Labels and benchmark items are read from
``sf_dir``; models are learned from the labels of documents that are still there. Null and empty texts, repeated rows, empty
tables and further columns are handled as each operator says; a document whose text is null or empty is judged like any other.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chroniq.llm import decontaminate, ngram_join, packing, quality, toxicity
from chroniq.llm.common import DOCUMENT_COLUMNS, discard, fold, scratch, table
from chroniq.llm.queries import tokenizer_file
from chroniq.operators.lookup import lookup_join
from chroniq.session import stage

ROW = "__row"
BATCH_KEY, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def small_batches(step: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage whose Python workers get at most ``BATCH_ROWS`` whole texts at a time while it runs."""

    @wraps(step)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        before = spark.conf.get(BATCH_KEY)
        spark.conf.set(BATCH_KEY, str(min(int(before) if int(before) > 0 else BATCH_ROWS, BATCH_ROWS)))
        try:
            return step(spark, docs, sf_dir)
        finally:
            spark.conf.set(BATCH_KEY, before)

    return run


def without(docs: DataFrame, judged: DataFrame, rejected: str) -> DataFrame:
    """``docs`` without the rows that were rejected. ``judged`` bears the row's hash as ``doc_id``."""
    spark = docs.sparkSession
    losers = judged.where(rejected).select(F.col("doc_id").alias(ROW)).distinct()
    losers = stage(losers, scratch(spark, "rejected"), "rows")
    return lookup_join(docs.select(*DOCUMENT_COLUMNS, row_hash()), losers, [ROW], "left_anti").select(*DOCUMENT_COLUMNS)


def row_hash(name: str = ROW) -> Column:
    """A hash of identifier and text: rows that are equal in both are judged alike."""
    return F.xxhash64("doc_id", "text").alias(name)


@small_batches
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose lines the field finds good, by at least 0.7 of their length. Learned outside the fold that the query holds out."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    rows = docs.select(row_hash("doc_id"), "text")
    return without(docs, quality.score_quality(rows, model, F.lit(False)), "predicted = 0")


@small_batches
def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine scores below 0.5. Learned outside the fold that the query holds out."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), fold("doc_id", 5) != 0)
    rows = docs.select(row_hash("doc_id"), "text")
    return without(docs, toxicity.score_toxicity(rows, model, F.lit(False)), "predicted = 1")


@small_batches
def one_per_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts with a Jaccard similarity of 0.8 or more: the one with the lowest identifier."""
    return ngram_join.one_of_each(docs).select(*DOCUMENT_COLUMNS)


@small_batches
def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold less than 0.8 of every benchmark item's shingles."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*DOCUMENT_COLUMNS)


@small_batches
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows of 2,048 tokens, each source at its share of every window."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES = [
    ("quality", good_quality),
    ("toxicity", not_toxic),
    ("near_copies", one_per_class),
    ("decontamination", no_benchmark),
    ("packing", packed),
]

#: The stages learn models, so SQL can't express the rows; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    before = None
    for name, step in STAGES[:-1]:
        folder = scratch(spark, f"pipeline-{name}")
        docs = stage(step(spark, docs, sf_dir), folder, "docs")
        if before:
            discard(spark, before)
        before = folder
    return STAGES[-1][1](spark, docs, sf_dir)
