"""Maintenance runs over the published corpus."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chroniq.functions.text import is_missing
from chroniq.operators.dedup import dedup_first, has_repeats
from chroniq.operators.filters import without_links, missing_text
from chroniq.operators.lookup import skew_join
from chroniq.operators.repair import one_patch, patch_text
from chroniq.session import remove_path, stage, work_folder
from chroniq.sinks.tables import publish, published, rewrite_touched
from chroniq.sources.articles import article_texts
from chroniq.sources.corpus import path_exists


@dataclass(frozen=True)
class RepairReport:
    missing: int
    fixed: int
    remaining: int
    version: int | None


def run_cleanup(spark: SparkSession, root: str, files_per_language: int | None = None) -> tuple[bool, int]:
    """Remove later rows of equal date and language, and publish. Says whether any date repeated."""
    corpus = published(spark, root)
    repeated = has_repeats(corpus)
    rows = dedup_first(corpus) if repeated else corpus
    return repeated, publish(rows, root, files_per_language)


def run_patch(spark: SparkSession, root: str, patches: DataFrame, newest: str | None = None) -> int:
    """Set the texts of the patched links; only files that hold one are written anew."""
    chosen = one_patch(patches, newest)
    return rewrite_touched(spark, root, chosen, ["link"], lambda rows: patch_text(rows, chosen))


def run_deny(spark: SparkSession, root: str, links: DataFrame) -> int:
    """Delete the rows of ``links(link)``; only files that hold one are written anew."""
    return rewrite_touched(spark, root, links, ["link"], lambda rows: without_links(rows, links))


def working_corpus(corpus: DataFrame, stage_path: str) -> DataFrame:
    """The corpus with the staged repairs of an unfinished run, if there are any."""
    if not path_exists(corpus.sparkSession, stage_path):
        return corpus
    repairs = corpus.sparkSession.read.schema("ord BIGINT, new_text STRING").parquet(stage_path)
    missing = is_missing(F.col("full_text"))
    # A repair is joined by row number, which has no hot value; complete rows take no part.
    filled = corpus.where(missing).join(repairs, "ord", "left")
    filled = filled.withColumn("full_text", F.coalesce("new_text", "full_text")).select(*corpus.columns)
    return corpus.where(~missing).unionByName(filled)


def run_repair(
    spark: SparkSession, root: str, pages: DataFrame, stage_path: str, **article: str
) -> RepairReport:
    """Repair missing text from crawled pages and publish; only files with a repaired row are written anew.

    Repaired texts alone are staged. If a run ends before it has published, the next one keeps
    them and goes on with the rows that are still missing.
    """
    corpus = published(spark, root)
    missing = missing_text(corpus).count()
    stage_repairs(working_corpus(corpus, stage_path), pages, stage_path, **article)

    repairs = spark.read.schema("ord BIGINT, new_text STRING").parquet(stage_path).where("new_text <> ''").select("ord")
    fixable = missing_text(corpus).select("ord").join(repairs, "ord", "left_semi")
    fixable = stage(fixable, work_folder(spark, "repair"), "rows")
    fixed = fixable.count()
    version = None
    if fixed:
        version = rewrite_touched(spark, root, fixable, ["ord"], lambda rows: working_corpus(rows, stage_path))
    remove_path(spark, stage_path)
    return RepairReport(missing, fixed, missing - fixed, version)


def stage_repairs(corpus: DataFrame, pages: DataFrame, stage_path: str, **article: str) -> None:
    """Add the texts found for the corpus's missing ones to the staged repairs."""
    gaps = missing_text(corpus).select("ord", "link")
    texts = article_texts(pages, gaps, **article).select(F.col("url").alias("link"), "article_text")
    found = skew_join(gaps, texts, ["link"], "inner").where("article_text <> ''")
    found.select("ord", F.col("article_text").alias("new_text")).write.mode("append").parquet(stage_path)
