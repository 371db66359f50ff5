"""Most frequent words."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chroniq import constants as K
from chroniq.functions.text import words

_POSITION_DIGITS = 10


def top_words(
    df: DataFrame,
    lang: str | None = None,
    limit: int = K.TOP_WORDS,
    min_chars: int = K.MIN_WORD_CHARS,
    tie: str = "word",
) -> DataFrame:
    """The ``limit`` most frequent words. Ties go by the word, or by first appearance (``tie="first"``).

    Words are counted on the map side, so a common word costs one row per task in the shuffle.
    """
    if tie not in ("word", "first"):
        raise ValueError(f"unknown tie rule: {tie}")
    rows = df if lang is None else df.where(F.col("lang") == lang)
    found = words(F.col("full_text"), min_chars)
    if tie == "word":
        counts = rows.select(F.explode(found).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
        return counts.orderBy(F.desc("n"), "word").limit(limit)
    # Row and position in one number: a decimal stays in the hash aggregate, a struct would not.
    place = (F.col("ord").cast("decimal(20,0)") * (10**_POSITION_DIGITS) + F.col("pos")).cast("decimal(38,0)")
    tokens = rows.select("ord", F.posexplode(found).alias("pos", "word"))
    counts = tokens.groupBy("word").agg(F.count("*").alias("n"), F.min(place).alias("first_seen"))
    return counts.orderBy(F.desc("n"), "first_seen").limit(limit).select("word", "n")
