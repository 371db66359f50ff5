"""Crawled article pages."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chroniq import constants as K
from chroniq.functions.html import container_text
from chroniq.functions.text import is_blocked_page
from chroniq.operators.lookup import MAX_BROADCAST_BYTES, lookup_join, measured_bytes
from chroniq.schemas import PAGES
from chroniq.session import stage, work_folder


MAX_FILES = 10_000  # of more files with chosen pages the names are not sent along; the join finds the rows alone


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Crawl results. ``status`` is 200 and ``seen`` 0 where the crawl did not record them."""
    return complete_pages(spark.read.parquet(path))


def complete_pages(pages: DataFrame) -> DataFrame:
    defaults = {"status": F.lit(200), "seen": F.lit(0)}
    columns = [
        F.coalesce(F.col(f.name), defaults.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
        if f.name in pages.columns
        else defaults[f.name].cast(f.dataType).alias(f.name)
        for f in PAGES.fields
    ]
    return pages.select(*columns)


def addressed_pages(pages: DataFrame) -> DataFrame:
    """Complete pages with the file and row that each comes from, ``__file`` and ``__row``.

    Only rows that come straight from Parquet files have such an address. Any other frame is written to the shared folder once.
    """
    plan = pages._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    address = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")]
    crawled = complete_pages(pages)
    if plan.nodeName() == "LogicalRelation" and "_metadata" not in pages.columns:
        try:
            return crawled.select("*", *address)
        except AnalysisException:  # files of another format have no row numbers
            pass
    return stage(crawled, work_folder(pages.sparkSession, "crawls"), "pages", "zstd").select("*", *address)


def _row_bits(rows: DataFrame) -> DataFrame:
    """``__file, __block, __bits``: the addressed rows as bitmaps, one for each run of rows of a file that holds any."""
    row = F.col("__row") + 1
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(row)).alias("__bits")
    return rows.groupBy("__file", F.bitmap_bucket_number(row).alias("__block")).agg(bits)


def _in_bits() -> Column:
    place = F.bitmap_bit_position(F.col("__row") + 1)
    byte = F.conv(F.hex(F.substr("__bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int")) == 1


def _rows_at(crawled: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows of ``crawled`` that ``chosen(url, __file, __row)`` names. As bitmaps their addresses take a bit of each crawled row, so
    pages are not shuffled; only where few of very many files' rows are chosen are bitmaps too many, and rows are joined."""
    bits = stage(_row_bits(chosen), work_folder(crawled.sparkSession, "crawls"), "bits", "zstd")
    if measured_bytes(bits) > MAX_BROADCAST_BYTES:
        return lookup_join(crawled, chosen, ["url", "__file", "__row"], "left_semi")
    blocks = crawled.withColumn("__block", F.bitmap_bucket_number(F.col("__row") + 1))
    return blocks.join(F.broadcast(bits), ["__file", "__block"]).where(_in_bits())


def newest_pages(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """``url, html``: of each address in ``wanted(url)`` the crawl seen last. A block page counts only if there is no other.

    One pass over the HTML chooses the crawls, of which narrow columns and the rows' places in the files are kept. A second one
    fetches the HTML of the chosen rows, from files that hold one.
    """
    crawled = addressed_pages(pages)
    # Usable crawls rank above all block pages; `seen` is a time far below 2**61. Of different pages seen at one time, one is taken by its hash.
    usable = F.coalesce(is_blocked_page(F.col("html")), F.lit(False)) == F.lit(False)
    rank = (F.shiftleft(usable.cast("bigint"), 61) + F.col("seen")).alias("__rank")
    told = crawled.select("url", rank, F.xxhash64("html").alias("__page"), "__file", "__row")
    asked = lookup_join(told, wanted, ["url"], "left_semi")
    best = asked.groupBy("url").agg(F.max(F.struct("__rank", "__page", "__file", "__row")).alias("b"))
    chosen = stage(best.select("url", "b.__file", "b.__row"), work_folder(pages.sparkSession, "crawls"), "chosen")
    files = [r[0] for r in chosen.select("__file").distinct().limit(MAX_FILES + 1).collect()]
    if len(files) <= MAX_FILES:  # the join alone would open all files
        crawled = crawled.where(F.col("__file").isin(files))
    return _rows_at(crawled, chosen).select("url", "html")


def article_texts(
    pages: DataFrame, links: DataFrame, tag: str = "div", class_part: str | None = K.ARTICLE_CLASS
) -> DataFrame:
    """``url, html, article_text`` for the wanted ``links``; text is null where there is no article, else ``html`` is.

    Pages nobody asked for are not parsed, and each address is parsed once, however many items link to it.
    """
    wanted = links.select(F.col("link").alias("url")).where("url IS NOT NULL").distinct()
    wanted = stage(wanted, work_folder(pages.sparkSession, "crawls"), "wanted")
    text = container_text(F.col("html"), tag, class_part)
    # As a generated column the text is computed once, even where a filter on it follows.
    parsed = newest_pages(pages, wanted).select("url", "html", F.explode_outer(F.array(text)).alias("article_text"))
    return parsed.select("url", F.when(F.col("article_text").isNull(), F.col("html")).alias("html"), "article_text")
