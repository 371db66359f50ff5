"""Monthly term trend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chroniq import constants as K
from chroniq.functions.dates import month_key
from chroniq.functions.text import count_matches


def term_counts(df: DataFrame, terms: dict[str, str], text: str = "full_text") -> DataFrame:
    """One column of match counts per term."""
    return df.withColumns({label: count_matches(F.col(text), pattern) for label, pattern in terms.items()})


def drop_last_bucket(df: DataFrame, bucket: str) -> DataFrame:
    """Without the last bucket, which is still being filled.

    The last bucket is a scalar subquery over the bucket column alone, so the filter reaches the
    scan and the rows it drops are never read for their text.
    """
    return df.where(F.col(bucket) < df.agg(F.max(bucket)).scalar())


def term_trend(
    df: DataFrame,
    terms: dict[str, str] = K.TREND_TERMS,
    lang: str | None = None,
    bucket: str = "month",
    bucket_format: str = "yy-MM",
) -> DataFrame:
    """Sum of term matches per month, months ascending as text, last month left out.

    ``yyyy-MM`` sorts over a change of century as well. Rows with no date fall out; missing
    text adds nothing.
    """
    rows = df if lang is None else df.where(F.col("lang") == lang)
    keyed = rows.withColumn(bucket, month_key(F.col("date"), bucket_format)).where(F.col(bucket).isNotNull())
    counted = term_counts(keyed, terms)
    sums = [F.coalesce(F.sum(label), F.lit(0)).alias(label) for label in terms]
    return drop_last_bucket(counted.groupBy(bucket).agg(*sums), bucket).orderBy(bucket)


def columnar(df: DataFrame, bucket: str, labels: list[str]) -> DataFrame:
    """A trend as one row of arrays, all in bucket order. The input has one row per month."""
    rows = df.agg(F.array_sort(F.collect_list(F.struct(bucket, *labels))).alias("rows"))

    def field(name: str) -> Column:
        return F.transform("rows", lambda row: row[name]).alias(name)

    return rows.select(*[field(name) for name in [bucket, *labels]])
