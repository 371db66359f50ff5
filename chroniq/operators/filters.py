"""Row filters over the corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chroniq.functions.text import is_missing, looks_english
from chroniq.operators.lookup import key_lookup_join, lookup_join


def by_language(df: DataFrame, lang: str) -> DataFrame:
    return df.where(F.col("lang") == lang)


def missing_text(df: DataFrame) -> DataFrame:
    return df.where(is_missing(F.col("full_text")))


def english_looking(df: DataFrame) -> DataFrame:
    return df.where(looks_english(F.col("full_text")))


def without_links(df: DataFrame, deny: DataFrame) -> DataFrame:
    """Drop the rows whose link is on the deny list."""
    return lookup_join(df, deny.select("link"), ["link"], "left_anti")


def newer_than_mark(df: DataFrame, marks: DataFrame, force: bool = False) -> DataFrame:
    """Rows dated after their language's mark; ``force`` keeps all."""
    if force:
        return df
    joined = key_lookup_join(df, marks.select("lang", "high_water"), ["lang"], "inner")
    return joined.where(F.col("date") > F.col("high_water")).drop("high_water")
