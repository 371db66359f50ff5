"""Incremental ingest: feeds or listings -> new items -> article text -> corpus and marks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chroniq import constants as K
from chroniq.operators.lookup import key_lookup_join, lookup_join, skew_join
from chroniq.operators.takewhile import before_stop, latest_marks, page_stops, take_while_newer
from chroniq.schemas import QUARANTINE, RECORD_COLUMNS
from chroniq.session import stage, work_folder
from chroniq.sinks.commits import check_new, last_commit
from chroniq.sinks.tables import AppendReport, append_rows, published, remove_path, write_quarantine
from chroniq.sources.articles import article_texts
from chroniq.sources.feeds import feed_items, parse_feeds
from chroniq.sources.listings import listing_items, parse_listings
from chroniq.sources.registry import with_addresses
from chroniq.sources.state import marks_to_commit, read_marks

_SAVED_FEED_ERRORS = r"\Arss_(?:fetch_failed_.*|parse_error|no_channel)\z"


class IngestError(Exception):
    """No language could be processed."""


@dataclass(frozen=True)
class IngestPlan:
    new_rows: DataFrame  # lang, page, idx and the record columns
    marks: DataFrame  # lang, latest: languages that were processed
    failures: DataFrame  # lang, error_context: languages that were not
    rejects: DataFrame  # url, lang, error_context, html, and date and topic of an item
    folder: str  # staged files that the frames read; to be removed after use


@dataclass(frozen=True)
class IngestReport:
    old_rows: int
    new_rows: int
    processed: int
    failed: int
    committed: bool


def feed_position(page: Column, idx: Column) -> Column:
    """Place in the feed as one number, so that minima stay in the hash aggregate."""
    return F.shiftleft(page.cast("bigint"), 31) + idx


def fallback_pages(listings: DataFrame, parsed_feeds: DataFrame) -> DataFrame:
    """Listing pages of the languages without a usable feed."""
    # Decided in an aggregate, which no filter passes: the parse runs once and where it was put.
    verdicts = parsed_feeds.groupBy("lang").agg(F.bool_or(F.col("error_context").isNull()).alias("usable"))
    return key_lookup_join(listings, verdicts.where("usable").select("lang"), ["lang"], "left_anti")


def scan_ends(parsed: DataFrame) -> DataFrame:
    """First page of each language at which a listing scan ends at the latest.

    That is a page with another status than 200, one without items, or one whose predecessor
    was not crawled. ``bad`` is true for the first two.
    """
    bad = (F.col("status") != 200) | (F.size("items") == 0)
    pages = parsed.select("lang", "page", F.coalesce(bad, F.lit(True)).alias("bad"))
    after = pages.select("lang", (F.col("page") + 1).alias("page"))
    orphans = pages.where("page > 1").join(after, ["lang", "page"], "left_anti").select("lang", "page", F.lit(False).alias("bad"))
    return (
        pages.where("bad")
        .unionByName(orphans)
        .groupBy("lang")
        .agg(F.min("page").alias("stop_page"), F.min_by("bad", "page").alias("bad"))
    )


def collect_items(parsed_feeds: DataFrame, parsed_listings: DataFrame) -> DataFrame:
    """Items of all languages; a feed counts as page 0."""
    rss = feed_items(parsed_feeds).select(
        "lang", F.lit(0).alias("page"), F.col("pos").cast("int").alias("idx"), "date", "link", "topic"
    )
    listed = before_stop(listing_items(parsed_listings), scan_ends(parsed_listings))
    items = rss.unionByName(listed)
    return items.withColumn("pos", feed_position(F.col("page"), F.col("idx")))


def latest_dates(parsed_feeds: DataFrame, items: DataFrame) -> DataFrame:
    """Newest date per processed language: that of the first item, of the feed or of page 1."""
    rss = parsed_feeds.where("error_context IS NULL").select("lang", "latest")
    return rss.unionByName(latest_marks(items.where("page = 1")))


def plan_ingest(
    feeds: DataFrame,
    listings: DataFrame,
    pages: DataFrame,
    marks: DataFrame,
    site_domain: str,
    force: bool = False,
    tz: str = "UTC",
    tag: str = "div",
    class_part: str | None = K.ARTICLE_CLASS,
    sources: DataFrame | None = None,
) -> IngestPlan:
    """What one run adds. ``feeds`` has one poll per language, ``listings`` one crawl per page.

    With ``sources`` (``lang, feed_url, listing_url``) rejected feeds carry their address.

    Parsed pages and the joined articles are written once to the shared folder, because each
    feeds several results.
    """
    folder = work_folder(feeds.sparkSession, "ingest")
    parsed_feeds = parse_feeds(feeds, tz)
    # Only the bodies of unusable feeds are kept.
    body = F.when(F.col("error_context").isNotNull(), F.col("body"))
    parsed_feeds = stage(parsed_feeds.withColumn("body", body), folder, "feeds", "zstd")
    candidates_for_listing = fallback_pages(listings, parsed_feeds)
    parsed_listings = stage(parse_listings(candidates_for_listing, site_domain, tz), folder, "listings", "zstd")

    items = collect_items(parsed_feeds, parsed_listings)
    latest = latest_dates(parsed_feeds, items)
    unmarked = items.select("lang").distinct()
    unmarked = unmarked.limit(0) if force else unmarked.join(marks.select("lang"), "lang", "left_anti")
    processed = latest.join(unmarked, "lang", "left_anti")

    fresh = stage(items if force else take_while_newer(items, marks), folder, "fresh", "zstd")
    texts = article_texts(pages, fresh.select("link"), tag, class_part).withColumnRenamed("url", "link")
    joined = skew_join(fresh, texts.withColumn("crawled", F.lit(True)), ["link"], "left")
    # Only the pages of rejected items are kept whole.
    joined = joined.withColumn("html", F.when(F.col("article_text").isNull(), F.col("html")))
    joined = stage(joined, folder, "articles", "zstd")

    # A listing page of which no article could be read ends the scan.
    per_page = joined.where("page > 0").groupBy("lang", "page").agg((F.count("article_text") == 0).alias("empty"))
    empty_stops = page_stops(per_page, "empty")
    reached = before_stop(joined, empty_stops.withColumn("stop_page", F.col("stop_page") + 1))

    new_rows = reached.where("article_text IS NOT NULL").select(
        "lang", "page", "idx", "date", "link", "topic", F.col("article_text").alias("full_text")
    )
    rejected_items = reached.where("article_text IS NULL").select(
        F.col("link").alias("url"),
        "lang",
        F.when(F.col("crawled"), "no_article_content").otherwise("page_not_crawled").alias("error_context"),
        "html",
        "date",
        "topic",
    )
    failed_feeds = parsed_feeds.where(F.rlike("error_context", F.lit(_SAVED_FEED_ERRORS)))
    if sources is None:
        failed_feeds = failed_feeds.withColumn("feed_url", F.lit(None).cast("string"))
    else:
        failed_feeds = with_addresses(failed_feeds, sources)
    rejected_feeds = failed_feeds.select(F.col("feed_url").alias("url"), "lang", "error_context", F.col("body").alias("html"))
    rejected_pages = _rejected_listing_pages(candidates_for_listing, parsed_listings, items, fresh, empty_stops)
    failures = _failures(parsed_feeds, listings, processed, unmarked)
    rejects = rejected_items.unionByName(rejected_feeds.unionByName(rejected_pages), allowMissingColumns=True)
    return IngestPlan(new_rows, processed, failures, rejects, folder)


def _rejected_listing_pages(
    listings: DataFrame, parsed: DataFrame, items: DataFrame, fresh: DataFrame, empty_stops: DataFrame
) -> DataFrame:
    """Bad pages that a scan ended at: any failed fetch, and a first page without items."""
    # A scan that met an old item, or a page without one readable article, ended before.
    halted = (
        items.where("page > 0").join(fresh.select("lang", "pos"), ["lang", "pos"], "left_anti").select("lang")
        .unionByName(empty_stops.select("lang"))
        .distinct()
    )
    ends = scan_ends(parsed).where("bad").join(halted, "lang", "left_anti")
    ends = ends.select("lang", F.col("stop_page").alias("page"))
    failed = F.when(
        F.col("status") != 200, F.concat(F.lit("html_listing_fetch_failed_"), F.col("status"))
    ).when(F.col("page") == 1, "html_listing_no_items")
    rows = listings.join(ends, ["lang", "page"], "left_semi")
    return rows.select("url", "lang", failed.alias("error_context"), "html").where("error_context IS NOT NULL")


def _failures(
    parsed_feeds: DataFrame, listings: DataFrame, processed: DataFrame, unmarked: DataFrame
) -> DataFrame:
    known = parsed_feeds.select("lang").unionByName(listings.select("lang")).distinct()
    failed = known.join(processed.select("lang"), "lang", "left_anti")
    reasons = failed.join(unmarked.withColumn("unmarked", F.lit(True)), "lang", "left")
    context = F.when(F.col("unmarked"), "no_saved_mark").otherwise("no_usable_source")
    return reasons.select("lang", context.alias("error_context"))


def strict_marks(processed: DataFrame, rejects: DataFrame) -> DataFrame:
    """Marks held below the oldest failed item of ``rejects(lang, date)``, so that it is tried again.

    Rejects without a date are no items.
    """
    oldest = rejects.where("date IS NOT NULL").groupBy("lang").agg(F.min("date").alias("oldest"))
    held = key_lookup_join(processed, oldest, ["lang"], "left")
    return held.select("lang", F.least("latest", F.col("oldest") - 1).alias("latest"))


def number_rows(new_rows: DataFrame, last_ord: int, folder: str) -> DataFrame:
    """Give new rows their place in the corpus: after all others, by language and feed order, without gaps.

    Only the keys, which are unique, are sorted; the numbers are attached to the rows by them.
    """
    keys = ["lang", "page", "idx"]
    placed = new_rows.select(*keys).orderBy(*keys).select(*keys, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"))
    placed = stage(placed, folder, "keys")
    # One row per task of the sort.
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("part", "first", before.alias("before"))
    number = (F.lit(last_ord + 1) + F.col("before") + F.col("place") - F.col("first")).alias("ord")
    numbers = placed.join(F.broadcast(starts), "part").select(*keys, number)
    return lookup_join(new_rows, numbers, keys, "inner").select("ord", *RECORD_COLUMNS)


def run_ingest(
    spark: SparkSession,
    feeds: DataFrame,
    listings: DataFrame,
    pages: DataFrame,
    root: str,
    site_domain: str,
    batch_id: int | None = None,
    force: bool = False,
    strict: bool = False,
    source: str = "batch",
    **options: str | DataFrame,
) -> IngestReport:
    """One run: new rows and the marks they lead to are committed together.

    Without a ``batch_id`` every call is a run of its own. With one, a batch of ``source`` that was committed is refused
    with :class:`BatchCommitted`, and nothing is lost or doubled. A crash before the commit leaves rows and marks
    as they were. With ``strict``, marks stay below the oldest item whose article could not be read.
    """
    check_new(spark, root, source, batch_id)
    plan = plan_ingest(feeds, listings, pages, read_marks(spark, root), site_domain, force, **options)
    try:
        return _commit(spark, plan, root, source, batch_id, strict)
    finally:
        remove_path(spark, plan.folder)


def _commit(
    spark: SparkSession, plan: IngestPlan, root: str, source: str, batch_id: int | None, strict: bool
) -> IngestReport:
    processed, failed = plan.marks.count(), plan.failures.count()
    run = uuid.uuid4().hex if batch_id is None else f"{source}-{batch_id}"
    write_quarantine(plan.rejects, f"{root}/quarantine", run)
    if processed == 0:
        raise IngestError("no language could be processed")
    rows = number_rows(plan.new_rows, last_commit(spark, root).max_ord, plan.folder)
    marks = strict_marks(plan.marks, plan.rejects) if strict else plan.marks
    report = append_rows(rows, root, source, batch_id, marks)
    return IngestReport(report.old_rows, report.new_rows, processed, failed, report.new_rows > report.old_rows)


def replay_rejected(
    spark: SparkSession, root: str, pages: DataFrame, tag: str = "div", class_part: str | None = K.ARTICLE_CLASS
) -> AppendReport:
    """Append quarantined items whose article can be read by now, and that the corpus does not have. Marks stay."""
    saved = spark.read.schema(QUARANTINE).parquet(f"{root}/quarantine").where("date IS NOT NULL AND url IS NOT NULL")
    items = saved.groupBy("lang", F.col("url").alias("link"), "date").agg(F.max("topic").alias("topic"))
    items = skew_join(items, published(spark, root).select("lang", "link", "date"), ["lang", "link", "date"], "left_anti")
    folder = work_folder(spark, "replay")
    try:
        items = stage(items, folder, "items")
        texts = article_texts(pages, items.select("link"), tag, class_part).where("article_text IS NOT NULL")
        found = skew_join(items, texts.select(F.col("url").alias("link"), F.col("article_text").alias("full_text")), ["link"], "inner")
        found = stage(found, folder, "found")
        # Within a language by date and link, newest first, as in a feed.
        keyed = found.select("lang", (-F.col("date")).alias("page"), F.col("link").alias("idx"), *[c for c in RECORD_COLUMNS if c != "lang"])
        return append_rows(number_rows(keyed, last_commit(spark, root).max_ord, folder), root, "replay")
    finally:
        remove_path(spark, folder)


@contextmanager
def backfill(feeds: DataFrame, listings: DataFrame, pages: DataFrame, site_domain: str, **options: str) -> Iterator[DataFrame]:
    """All items whatever the marks, for export inside the ``with`` block; no mark is read or written.

    The staged files that the frame reads are removed at the end of the block.
    """
    spark = feeds.sparkSession
    marks = spark.createDataFrame([], "lang STRING, high_water BIGINT")
    plan = plan_ingest(feeds, listings, pages, marks, site_domain, True, **options)
    try:
        yield plan.new_rows
    finally:
        remove_path(spark, plan.folder)
