"""The registered queries: every operator over whole driver tables.

``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``. The SQL that checks each of them is
in :mod:`chroniq.plans.catalog_sql`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chroniq import constants as K
from chroniq.functions import dates, html, text, urls
from chroniq.operators import dedup, filters, quality, repair, takewhile, trend, words
from chroniq.plans import driver_tables as D
from chroniq.plans import ingest, maintenance
from chroniq.session import stage, work_folder
from chroniq.sinks import exports, tables
from chroniq.sources import corpus as corpus_source
from chroniq.sources import feeds as feed_source
from chroniq.sources import listings as listing_source
from chroniq.sources import raw
from chroniq.sources.articles import article_texts, complete_pages
from chroniq.sources.registry import with_addresses
from chroniq.sources.state import marks_to_commit, read_marks
from chroniq.streaming.ingest_stream import dedup_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Terms that occur in the driver's languages: plain strings and patterns.
TERMS = {"the": "the", "tion": "tion", "que": "que", "und": "[Uu]nd", "vowels": "[aeiou]{3}", "o_c": "ó[nc]"}
LANG = "en"
PAGE = 7
MIRROR = "https://mirror.example.net/start?x=1"


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# --- corpus: scans, filters, projections ------------------------------------------------------


@query
def corpus_scan(spark, sf_dir):
    return D.speeches(spark, sf_dir)


@query
def language_filter(spark, sf_dir):
    return filters.by_language(D.speeches(spark, sf_dir), "fr").select("ord", "date", "lang", "topic")


@query
def missing_text(spark, sf_dir):
    return exports.missing_links(D.speeches_with_gaps(spark, sf_dir))


@query
def missing_counts(spark, sf_dir):
    return quality.missing_counts(D.speeches_with_gaps(spark, sf_dir))


@query
def deny_list(spark, sf_dir):
    rows = filters.without_links(D.speeches(spark, sf_dir), D.deny_list(spark, sf_dir))
    return rows.select("ord", "link", "lang")


@query
def export_text(spark, sf_dir):
    return exports.text_entries(D.speeches(spark, sf_dir), LANG)


@query
def jsonl_round_trip(spark, sf_dir):
    path = work_folder(spark, "jsonl")
    exports.write_jsonl(D.speeches(spark, sf_dir), path)
    return corpus_source.read_jsonl(spark, path)


# --- corpus: analytics ------------------------------------------------------------------------


@query
def term_trend(spark, sf_dir):
    return trend.term_trend(D.speeches(spark, sf_dir), TERMS, LANG)


@query
def term_trend_full_years(spark, sf_dir):
    return trend.term_trend(D.speeches(spark, sf_dir), TERMS, LANG, bucket_format="yyyy-MM")


@query
def trend_columnar(spark, sf_dir):
    report = trend.term_trend(D.speeches(spark, sf_dir), TERMS, LANG, bucket=K.MONTH_COLUMN)
    return exports.json_line(trend.columnar(report, K.MONTH_COLUMN, list(TERMS)))


@query
def top_words(spark, sf_dir):
    return words.top_words(D.speeches(spark, sf_dir), LANG)


@query
def top_words_first_seen(spark, sf_dir):
    return words.top_words(D.speeches(spark, sf_dir), LANG, tie="first")


@query
def invalid_percentage(spark, sf_dir):
    return quality.with_invalid_percentage(D.speeches(spark, sf_dir)).select("ord", "invalid_percentage")


@query
def max_invalid_pct(spark, sf_dir):
    return quality.max_invalid_percentage(D.speeches(spark, sf_dir), LANG)


@query
def looks_english(spark, sf_dir):
    return filters.english_looking(D.speeches(spark, sf_dir)).select("ord", "lang")


@query
def valid_totals(spark, sf_dir):
    return quality.valid_totals(D.speeches(spark, sf_dir), text.looks_english(F.col("full_text")))


@query
def rows_per_language(spark, sf_dir):
    return quality.rows_per_language(D.speeches(spark, sf_dir))


# --- corpus: maintenance ----------------------------------------------------------------------


@query
def dedup_first(spark, sf_dir):
    return dedup.dedup_first(D.speeches(spark, sf_dir), ["date", "lang"]).select("ord", "date", "lang", "link")


@query
def duplicate_dates(spark, sf_dir):
    return dedup.repeated_keys(D.speeches(spark, sf_dir), ["date"])


@query
def duplicate_members(spark, sf_dir):
    return dedup.duplicate_members(D.speeches(spark, sf_dir), ["date"]).select("ord", "date", "lang")


@query
def repair_text(spark, sf_dir):
    rows = repair.repair_missing(D.speeches_with_gaps(spark, sf_dir), D.repair_pages(spark, sf_dir))
    return rows.select("ord", "full_text", "was_missing")


@query
def repair_counts(spark, sf_dir):
    return repair.repair_counts(repair.repair_missing(D.speeches_with_gaps(spark, sf_dir), D.repair_pages(spark, sf_dir)))


@query
def patch_text(spark, sf_dir):
    return repair.patch_text(D.speeches(spark, sf_dir), D.patches(spark, sf_dir)).select("ord", "full_text")


# --- corpus: written and read back ------------------------------------------------------------

SECOND = 1_000_000_000  # what the second batch adds to the row numbers


@query
def append_union(spark, sf_dir):
    root = work_folder(spark, "corpus")
    rows = D.speeches(spark, sf_dir)
    tables.append_rows(rows, root)
    tables.append_rows(filters.by_language(rows, LANG).withColumn("ord", -F.col("ord") - 1), root)
    return tables.published(spark, root).select("ord", "date", "lang")


@query
def append_counts(spark, sf_dir):
    _, report = _two_batches(spark, sf_dir)
    return spark.createDataFrame([(report.old_rows, report.new_rows)], "old_rows bigint, new_rows bigint")


def _two_batches(spark: SparkSession, sf_dir: str) -> tuple[str, tables.AppendReport]:
    """A corpus of all records, and those of one language once more as a second batch."""
    root = work_folder(spark, "corpus")
    rows = D.speeches(spark, sf_dir)
    tables.append_rows(rows, root)
    more = filters.by_language(rows, LANG).withColumn("ord", F.col("ord") + SECOND)
    return root, tables.append_rows(more, root)


@query
def append_published(spark, sf_dir):
    root, _ = _two_batches(spark, sf_dir)
    return tables.published(spark, root)


@query
def append_report(spark, sf_dir):
    _, report = _two_batches(spark, sf_dir)
    return spark.createDataFrame([(report.old_rows, report.new_rows)], "old_rows bigint, new_rows bigint")


@query
def published_language(spark, sf_dir):
    root, _ = _two_batches(spark, sf_dir)
    return filters.by_language(tables.published(spark, root), "fr")


@query
def cleanup_published(spark, sf_dir):
    root, _ = _two_batches(spark, sf_dir)
    maintenance.run_cleanup(spark, root, files_per_language=4)
    return tables.published(spark, root)


@query
def patch_published(spark, sf_dir):
    root = work_folder(spark, "corpus")
    tables.append_rows(D.speeches(spark, sf_dir), root)
    maintenance.run_patch(spark, root, D.patches(spark, sf_dir))
    return tables.published(spark, root).select("ord", "full_text")


@query
def deny_published(spark, sf_dir):
    root, _ = _two_batches(spark, sf_dir)
    maintenance.run_patch(spark, root, D.patches(spark, sf_dir))
    maintenance.run_deny(spark, root, D.deny_list(spark, sf_dir))
    return tables.published(spark, root).select("ord", "link", "full_text")


@query
def repair_published(spark, sf_dir):
    """Repaired in two runs, the first of which ended after staging a part of the texts."""
    root, staged = work_folder(spark, "corpus"), f"{work_folder(spark, 'repair')}/texts"
    tables.append_rows(D.speeches_with_gaps(spark, sf_dir), root)
    pages = D.repair_pages(spark, sf_dir)
    maintenance.stage_repairs(tables.published(spark, root).where("lang = 'fr'"), pages, staged)
    maintenance.run_repair(spark, root, pages, staged)
    return tables.published(spark, root).select("ord", "full_text")


@query
def jsonl_with_language(spark, sf_dir):
    path = work_folder(spark, "jsonl")
    exports.write_jsonl(filters.by_language(D.speeches(spark, sf_dir), "fr"), path)
    return corpus_source.read_jsonl(spark, path, "de")


@query
def csv_round_trip(spark, sf_dir):
    path = work_folder(spark, "csv")
    report = term_trend(spark, sf_dir)
    exports.write_csv(report, path, "month")
    return spark.read.schema(report.schema).option("header", True).csv(path)


@query
def url_list(spark, sf_dir):
    path = work_folder(spark, "links")
    exports.write_missing_links(D.speeches_with_gaps(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("value").alias("link"))


# --- pages ------------------------------------------------------------------------------------


@query
def blocked_pages(spark, sf_dir):
    return D.pages(spark, sf_dir).select("page_id", text.is_blocked_page(F.col("html")).alias("blocked"))


@query
def crawl_scan(spark, sf_dir):
    pages = complete_pages(D.pages(spark, sf_dir))
    return pages.select("url", "status", "seen", F.length("html").alias("html_chars"))


@query
def article_text(spark, sf_dir):
    body = html.container_text(F.col("html"), "article")
    return D.pages(spark, sf_dir).select("page_id", body.alias("article_text"))


@query
def page_text(spark, sf_dir):
    whole = text.collapse_whitespace(html.text_content(F.col("html")))
    return D.pages(spark, sf_dir).select("page_id", whole.alias("page_text"))


@query
def nested_article_text(spark, sf_dir):
    pages = D.article_pages(spark, sf_dir)
    return pages.select(
        "url", "seen", html.container_text(F.col("html"), "div", K.ARTICLE_CLASS).alias("article_text")
    )


@query
def soup_article_text(spark, sf_dir):
    body = html.container_text(F.col("html"), "div", K.ARTICLE_CLASS)
    return D.soup_pages(spark, sf_dir).select("url", body.alias("article_text"))


@query
def newest_articles(spark, sf_dir):
    pages = article_texts(D.article_pages(spark, sf_dir), D.items(spark, sf_dir).select("link"))
    return pages.select("url", "article_text")


@query
def listing_links(spark, sf_dir):
    rows = D.pages(spark, sf_dir).select("page_id", "url", F.posexplode(html.anchors(F.col("html"))).alias("idx", "a"))
    link = urls.normalize_link(F.col("a.href"), F.col("url"), D.SITE)
    return rows.select("page_id", "idx", link.alias("link"), F.col("a.title").alias("title"))


@query
def page_param(spark, sf_dir):
    changed = urls.set_page_param(F.col("url"), F.lit(PAGE))
    return D.pages(spark, sf_dir).select("page_id", changed.alias("url"))


@query
def normalize_link(spark, sf_dir):
    link = urls.normalize_link(F.col("url"), F.lit(MIRROR), "example.org")
    return D.pages(spark, sf_dir).select("page_id", link.alias("link"))


@query
def listing_url(spark, sf_dir):
    feed = F.when(F.endswith("url", F.lit(".html")), F.regexp_replace("url", "html$", "rss")).otherwise(F.col("url"))
    return D.pages(spark, sf_dir).select("page_id", urls.listing_url(feed, F.lit(MIRROR)).alias("url"))


@query
def element_audit(spark, sf_dir):
    pages = listing_source.listing_elements(D.listings(spark, sf_dir))
    addresses = F.size(F.filter("links", lambda a: F.coalesce(a["href"] != "", F.lit(False))))
    verdict = quality.element_audit(F.size("links"), F.size("date_texts"), addresses)
    return pages.select("lang", "page", verdict.alias("verdict"))


# --- dates and scalars ------------------------------------------------------------------------


@query
def epoch_buckets(spark, sf_dir):
    date = F.col("date")
    return D.speeches(spark, sf_dir).select(
        "ord", dates.month_key(date).alias("month"), dates.day_key(date).alias("day")
    )


@query
def parse_dates_rfc(spark, sf_dir):
    rows = D.lines(spark, sf_dir).select("doc_id", "i", D._item_fields(F.col("line"), F.col("i"))["date"].alias("d"))
    return rows.select("doc_id", "i", dates.parse_rfc_date(D.rfc_text(F.col("d"))).alias("date"))


@query
def parse_dates_listing(spark, sf_dir):
    rows = D.lines(spark, sf_dir).select(
        "doc_id", "i", "doc_lang", D._item_fields(F.col("line"), F.col("i"))["date"].alias("d")
    )
    shown = D.listing_date_text(F.col("d"), F.col("doc_lang") == "fr")
    return rows.select("doc_id", "i", dates.parse_listing_date(shown).alias("date"))


@query
def parse_dates_iso(spark, sf_dir):
    shown = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    spaced = F.when(F.col("event_type") == "click", F.replace(shown, F.lit("T"), F.lit(" "))).otherwise(shown)
    return D.table(spark, sf_dir, "events").select("event_id", dates.parse_iso_date(spaced).alias("date"))


@query
def whitespace(spark, sf_dir):
    padded = F.concat(F.lit("  \n"), F.replace("text", F.lit(","), F.lit("\t ")), F.lit(" \u0085"))
    return D.documents(spark, sf_dir).select(
        "doc_id", text.collapse_whitespace(padded).alias("collapsed"), text.strip(padded).alias("stripped")
    )


@query
def words_per_document(spark, sf_dir):
    found = words.words(F.col("full_text"))
    return D.speeches(spark, sf_dir).select("ord", F.size(found).alias("n_words"), F.get(found, F.lit(0)).alias("first_word"))


# --- feeds and listings -----------------------------------------------------------------------


@query
def source_registry(spark, sf_dir):
    polled = D.feeds(spark, sf_dir).select("lang", "status")
    return with_addresses(polled, D.registry(spark, sf_dir))


@query
def feed_status(spark, sf_dir):
    parsed = feed_source.parse_feeds(D.feeds(spark, sf_dir))
    return parsed.select("lang", "latest", "error_context")


@query
def rss_items(spark, sf_dir):
    return feed_source.feed_items(feed_source.parse_feeds(D.feeds(spark, sf_dir)))


@query
def rss_items_of_files(spark, sf_dir):
    """The feeds as single files, one folder for each language and status."""
    path = work_folder(spark, "feed-files")
    feeds = D.feeds(spark, sf_dir).where("body <> ''")
    feeds.select("lang", "status", "body").write.partitionBy("lang", "status").text(path)
    return feed_source.feed_items(feed_source.parse_feeds(raw.read_feed_files(spark, path, "*.txt")))


@query
def rss_first_children(spark, sf_dir):
    return feed_source.feed_items(feed_source.parse_feeds(D.odd_feeds(spark, sf_dir)))


@query
def rss_odd_status(spark, sf_dir):
    return feed_source.parse_feeds(D.odd_feeds(spark, sf_dir)).select("lang", "latest", "error_context")


@query
def listing_items(spark, sf_dir):
    return listing_source.listing_items(listing_source.parse_listings(D.listings(spark, sf_dir), D.SITE))


@query
def page_stops(spark, sf_dir):
    parsed = listing_source.parse_listings(D.listings(spark, sf_dir), D.SITE)
    return ingest.scan_ends(parsed).select("lang", "stop_page")


@query
def feed_fallback(spark, sf_dir):
    parsed = feed_source.parse_feeds(D.feeds(spark, sf_dir))
    return ingest.fallback_pages(D.listings(spark, sf_dir), parsed).select("lang", "page")


# --- marks and incremental reading ------------------------------------------------------------


@query
def newer_than_mark(spark, sf_dir):
    rows = filters.newer_than_mark(D.polls(spark, sf_dir), D.poll_marks(spark, sf_dir))
    return rows.select("event_id", "lang", "date")


@query
def newer_forced(spark, sf_dir):
    rows = filters.newer_than_mark(D.polls(spark, sf_dir), D.poll_marks(spark, sf_dir), force=True)
    return rows.select("event_id", "lang", "date")


@query
def take_while_newer(spark, sf_dir):
    rows = takewhile.take_while_newer(D.polls(spark, sf_dir), D.poll_marks(spark, sf_dir))
    return rows.select("event_id", "lang", "date")


@query
def take_while_newer_per_feed(spark, sf_dir):
    rows = takewhile.take_while_newer(D.items(spark, sf_dir), D.feed_marks(spark, sf_dir))
    return rows.select("lang", "pos", "date")


@query
def latest_mark(spark, sf_dir):
    return takewhile.latest_marks(D.polls(spark, sf_dir))


@query
def commit_state(spark, sf_dir):
    polls = D.polls(spark, sf_dir)
    fresh = takewhile.take_while_newer(polls, D.poll_marks(spark, sf_dir))
    return marks_to_commit(fresh, takewhile.latest_marks(polls))


@query
def article_join(spark, sf_dir):
    rows = D.items(spark, sf_dir).where("link <> ''")
    texts = article_texts(D.article_pages(spark, sf_dir), rows.select("link"))
    texts = texts.where("article_text IS NOT NULL").select(F.col("url").alias("link"), "article_text")
    return ingest.skew_join(rows, texts, ["link"], "inner").select("lang", "pos", "link", "article_text")


def _plan(spark: SparkSession, sf_dir: str) -> ingest.IngestPlan:
    return ingest.plan_ingest(
        D.feeds(spark, sf_dir),
        D.listings(spark, sf_dir),
        D.article_pages(spark, sf_dir),
        D.feed_marks(spark, sf_dir),
        D.SITE,
    )


@query
def ingest_new_rows(spark, sf_dir):
    return _plan(spark, sf_dir).new_rows


@query
def ingest_marks(spark, sf_dir):
    plan = _plan(spark, sf_dir)
    return marks_to_commit(plan.new_rows, plan.marks)


@query
def ingest_rejects(spark, sf_dir):
    return _plan(spark, sf_dir).rejects.select("lang", "url", "error_context")


@query
def ingest_failures(spark, sf_dir):
    return _plan(spark, sf_dir).failures


@query
def backfill(spark, sf_dir):
    inputs = D.feeds(spark, sf_dir), D.listings(spark, sf_dir), D.article_pages(spark, sf_dir)
    with ingest.backfill(*inputs, D.SITE) as rows:
        return stage(rows.select("lang", "page", "idx", "link"), work_folder(spark, "backfill"), "rows")


@query
def ingest_published(spark, sf_dir):
    return tables.published(spark, _ingested(spark, sf_dir)).select("date", "link", "topic", "full_text", "lang")


@query
def marks_written(spark, sf_dir):
    return read_marks(spark, _ingested(spark, sf_dir))


@query
def ingest_marks_strict(spark, sf_dir):
    return read_marks(spark, _ingested(spark, sf_dir, strict=True))


@query
def usable_articles(spark, sf_dir):
    """Addresses of which the newest crawl is a block page, over an older good one."""
    pages = D.article_pages(spark, sf_dir)
    blocked = pages.where("seen = 1").withColumns({"seen": F.lit(2).cast("bigint"), "html": F.lit("<html>Access Denied</html>")})
    texts = article_texts(pages.unionByName(blocked), D.items(spark, sf_dir).select("link"))
    return texts.select("url", "article_text")


def _ingested(spark: SparkSession, sf_dir: str, strict: bool = False) -> str:
    root = work_folder(spark, "ingested")
    tables.seed_marks(spark, root, D.feed_marks(spark, sf_dir))
    inputs = D.feeds(spark, sf_dir), D.listings(spark, sf_dir), D.article_pages(spark, sf_dir)
    ingest.run_ingest(spark, *inputs, root, D.SITE, strict=strict)
    return root


# --- streams ----------------------------------------------------------------------------------


@query
def stream_dedup(spark, sf_dir):
    # The table may be a file or a folder of files. A stream takes a single file by a pattern only; this one fits that name alone.
    documents = spark.readStream.schema(D.table(spark, sf_dir, "documents").schema).parquet(f"{sf_dir}/documents.parque[t]")
    unique = dedup_stream(documents.selectExpr(*D.SPEECH_SELECT)).select("date", "lang")
    folder = work_folder(spark, "stream")
    writer = unique.writeStream.option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    writer.format("parquet").start(f"{folder}/rows").awaitTermination()
    return spark.read.schema(unique.schema).parquet(f"{folder}/rows")
