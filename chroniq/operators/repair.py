"""Filling in and patching article text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chroniq.functions.text import is_missing
from chroniq.operators.dedup import has_repeats
from chroniq.operators.lookup import lookup_join, skew_join
from chroniq.sources.articles import article_texts


def repair_missing(corpus: DataFrame, pages: DataFrame, **article: str) -> DataFrame:
    """Missing text is taken from the newest crawl of the row's link; all other rows stay as they are.

    Only the rows with missing text take part in the join. ``was_missing`` tells them apart.
    A page without an article leaves its row missing, to be reported and tried again.
    """
    missing = is_missing(F.col("full_text"))
    complete = corpus.where(~missing).withColumn("was_missing", F.lit(False))
    gaps = corpus.where(missing)
    texts = article_texts(pages, gaps.select("link"), **article).select(
        F.col("url").alias("link"), F.col("article_text")
    )
    filled = skew_join(gaps, texts, ["link"], "left").select(
        *[c for c in corpus.columns if c != "full_text"],
        F.coalesce("article_text", "full_text").alias("full_text"),
        F.lit(True).alias("was_missing"),
    )
    return complete.unionByName(filled)


def repair_counts(repaired: DataFrame) -> DataFrame:
    """Rows that were missing, were fixed, and still are missing."""
    still = is_missing(F.col("full_text"))
    return repaired.agg(
        F.count_if("was_missing").alias("missing"),
        F.count_if(F.col("was_missing") & ~still).alias("fixed"),
        F.count_if(still).alias("remaining"),
    )


def one_patch(patches: DataFrame, newest: str | None = None) -> DataFrame:
    """The patch of each link that counts; see :func:`patch_text`."""
    if newest:
        return patches.groupBy("link").agg(F.max_by(F.struct("full_text"), newest).alias("p")).select("link", "p.full_text")
    if has_repeats(patches.where("link IS NOT NULL"), ["link"]):
        raise ValueError("a link has several patches; name the column that orders them")
    return patches


def patch_text(corpus: DataFrame, patches: DataFrame, newest: str | None = None) -> DataFrame:
    """Set ``full_text`` for the links listed in ``patches(link, full_text)``.

    A patch may set null; links that are not listed keep their text. Of several patches of a link the one that is highest in the column
    ``newest`` counts; without such a column they are refused, as nothing says which one is meant.
    """
    listed = one_patch(patches, newest).select("link", F.col("full_text").alias("__new"), F.lit(True).alias("__listed"))
    joined = lookup_join(corpus, listed, ["link"], "left")
    text = F.when(F.col("__listed"), F.col("__new")).otherwise(F.col("full_text"))
    return joined.withColumn("full_text", text).select(*corpus.columns)
