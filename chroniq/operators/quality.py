"""Corpus and page quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chroniq.functions.text import invalid_percentage, is_missing


def with_invalid_percentage(df: DataFrame) -> DataFrame:
    return df.withColumn("invalid_percentage", invalid_percentage(F.col("full_text")))


def max_invalid_percentage(df: DataFrame, lang: str) -> DataFrame:
    """Highest share of foreign characters in one language, in percent with two decimals."""
    rows = df.where(F.col("lang") == lang)
    return rows.agg(F.round(F.max(invalid_percentage(F.col("full_text"))), 2).alias("max_invalid_pct"))


def missing_counts(df: DataFrame) -> DataFrame:
    missing = is_missing(F.col("full_text"))
    return df.agg(F.count_if(missing).alias("missing"), F.count_if(~missing).alias("present"))


def valid_totals(df: DataFrame, valid: Column) -> DataFrame:
    return df.agg(
        F.count_if(valid).alias("valid_count"),
        F.count_if(~F.coalesce(valid, F.lit(False))).alias("filtered_count"),
    )


def element_audit(topics: Column, dates: Column, hrefs: Column) -> Column:
    """Verdict on the number of elements found on one page; the arguments are counts."""
    return (
        F.when(topics == 0, "no_topics_found")
        .when((dates != topics) | (hrefs != topics), "element_count_mismatch")
        .otherwise("elements_found")
    )


def rows_per_language(df: DataFrame) -> DataFrame:
    return df.groupBy("lang").agg(F.count("*").alias("n"))
