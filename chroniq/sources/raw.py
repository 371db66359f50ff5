"""Crawled files as they were fetched: one feed, listing page or article page per file, read whole.

What is known of a file besides its text lies in its folders, in Spark's own layout, or in its name::

    feeds/lang=en/2024-05-01.xml             status=404 folders may follow; without them the status is 200
    listings/lang=en/page=3/anything.html
    pages/any/folders/https%3A%2F%2Fexample.org%2Fa%3Fb%3D1.html

A page's address is its file's name without the ending, percent-encoded. When it was seen is the file's time of modification. Texts
are read as UTF-8. A file without any bytes gives no row, as if nothing had been fetched: Spark doesn't open such files. Each reader gives the rows that the Parquet way gives, so what follows is the same; files are read by tasks, many
small ones to a task, and never by the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chroniq.functions.urls import set_page_param
from chroniq.operators.lookup import key_lookup_join
from chroniq.schemas import FEEDS, LISTINGS, PAGES

_FILE = T.StructType([T.StructField("value", T.StringType())])
_NULL = "__HIVE_DEFAULT_PARTITION__"


def _whole_files(reader, pattern: str):
    # Folders are told from the files' paths: discovering them as partitions would guess their types and list them once more.
    return reader.format("text").schema(_FILE).option("wholetext", True).option("pathGlobFilter", pattern).option("recursiveFileLookup", True)


def _decoded(name: Column) -> Column:
    """What a name stands for. Spark gives names percent-encoded, so it is decoded twice; a plus sign stays one."""
    plus = lambda c: F.replace(c, F.lit("+"), F.lit("%2B"))
    return F.try_url_decode(plus(F.try_url_decode(plus(name))))


def _folder(name: str) -> Column:
    """The value of a folder ``name=value`` on a file's path; null without one."""
    value = F.regexp_extract("_metadata.file_path", f"/{name}=([^/]*)/", 1)
    return F.when(~value.isin("", _NULL), _decoded(value))


def _status() -> Column:
    return F.coalesce(_folder("status").try_cast("int"), F.lit(200)).alias("status")


def _seen() -> Column:
    return F.unix_seconds("_metadata.file_modification_time").alias("seen")


def read_feed_files(spark: SparkSession, path: str, pattern: str = "*.xml") -> DataFrame:
    """``lang, status, body`` of the newest file of each language: a run takes one poll of a language.

    Files of one time are told apart by their names.
    """
    rows = _whole_files(spark.read, pattern).load(path)
    file = F.col("_metadata.file_path").alias("__file")
    polls = rows.select(_folder("lang").alias("lang"), _status(), F.col("value").alias("body"), file, _seen())
    newest = polls.groupBy("lang").agg(F.max(F.struct("seen", "__file")).alias("p")).select("p.__file")
    return key_lookup_join(polls, newest, ["__file"], "left_semi").select(*FEEDS.names)


def feed_file_stream(spark: SparkSession, path: str, pattern: str = "*.xml", files_per_batch: int = 1) -> DataFrame:
    """``lang, status, body`` of feed files as they arrive; with one file per batch a batch has one poll of one language."""
    rows = _whole_files(spark.readStream, pattern).option("maxFilesPerTrigger", files_per_batch).load(path)
    return rows.select(_folder("lang").alias("lang"), _status(), F.col("value").alias("body"))


def read_listing_files(spark: SparkSession, path: str, sources: DataFrame, pattern: str = "*.html") -> DataFrame:
    """``lang, page, url, status, html``; a page's address is that of its language's listing in ``sources`` with the page's number."""
    rows = _whole_files(spark.read, pattern).load(path)
    page = _folder("page").try_cast("int").alias("page")
    rows = rows.select(_folder("lang").alias("lang"), page, _status(), F.col("value").alias("html"))
    joined = key_lookup_join(rows, sources.select("lang", "listing_url"), ["lang"], "left")
    return joined.withColumn("url", set_page_param(F.col("listing_url"), F.col("page"))).select(*LISTINGS.names)


def read_page_files(spark: SparkSession, path: str, pattern: str = "*.html") -> DataFrame:
    """``url, html, status, seen`` of every file below ``path``."""
    rows = _whole_files(spark.read, pattern).load(path)
    address = _decoded(F.regexp_replace("_metadata.file_name", r"\.[^.]*$", "")).alias("url")
    return rows.select(address, F.col("value").alias("html"), _status(), _seen()).select(*PAGES.names)
