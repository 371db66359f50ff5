"""Crawled files give the rows of the Parquet way."""

import os
from urllib.parse import quote

from pyspark.sql import functions as F

from chroniq.schemas import PAGES
from chroniq.sources import articles, feeds, raw
from chroniq.sources.registry import registry

FEED = "<rss><channel><item><title>{0}</title><link>http://x/{0}</link><pubDate>Wed, 01 May 2024 10:00:00 +0000</pubDate></item></channel></rss>"


def put(path, text, seen=1_000):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    os.utime(path, (seen, seen))


def test_feed_files(spark, tmp_path):
    put(tmp_path / "lang=en" / "old.xml", FEED.format("old"), 1)
    put(tmp_path / "lang=en" / "new.xml", FEED.format("newé\n"), 2)
    put(tmp_path / "lang=01" / "a.xml", FEED.format("zero"), 1)
    put(tmp_path / "lang=uk" / "notes.txt", "no feed")
    read = raw.read_feed_files(spark, str(tmp_path))
    assert {tuple(r) for r in read.collect()} == {("en", 200, FEED.format("newé\n")), ("01", 200, FEED.format("zero"))}
    items = feeds.feed_items(feeds.parse_feeds(read))
    assert {(r.lang, r.topic) for r in items.collect()} == {("en", "newé"), ("01", "zero")}


def test_feed_files_with_status(spark, tmp_path):
    put(tmp_path / "lang=en" / "status=404" / "a.xml", "gone")
    put(tmp_path / "lang=uk" / "status=200" / "a.xml", FEED.format("a"))
    assert {(r.lang, r.status) for r in raw.read_feed_files(spark, str(tmp_path)).collect()} == {("en", 404), ("uk", 200)}


def test_feed_file_stream_gives_the_files(spark, tmp_path):
    for i in range(3):
        put(tmp_path / "in" / "lang=en" / f"{i}.xml", FEED.format(i), i + 1)
    batches = []
    stream = raw.feed_file_stream(spark, str(tmp_path / "in")).writeStream.trigger(availableNow=True)
    stream = stream.option("checkpointLocation", str(tmp_path / "c")).foreachBatch(lambda df, i: batches.append([tuple(r) for r in df.collect()]))
    stream.start().awaitTermination()
    assert batches == [[("en", 200, FEED.format(i))] for i in range(3)]


def test_listing_files(spark, tmp_path):
    put(tmp_path / "lang=en" / "page=1" / "x.html", "one")
    put(tmp_path / "lang=en" / "page=12" / "x.html", "\n")
    put(tmp_path / "lang=en" / "page=13" / "x.html", "")  # nothing was fetched
    put(tmp_path / "lang=xx" / "page=1" / "x.html", "unknown")
    sources = registry(spark, {"en": ("http://s/rss/", "http://s/news?a=1&page=9#top")})
    got = {(r.lang, r.page): (r.url, r.status, r.html) for r in raw.read_listing_files(spark, str(tmp_path), sources).collect()}
    assert got[("en", 1)] == ("http://s/news?a=1&page=1#top", 200, "one")
    assert got[("en", 12)][:2] == ("http://s/news?a=1&page=12#top", 200)
    assert ("en", 13) not in got
    assert got[("xx", 1)] == (None, 200, "unknown")


def test_page_files_equal_the_parquet_way(spark, tmp_path):
    page = '<div class="article_content">{}\n</div>'
    rows = [
        ("https://x.org/a?b=1&c=d+e%20f", page.format("plus"), 200, 5), ("https://x.org/пример", page.format("текст"), 200, 6),
        ("https://x.org/n.m.html", page.format("dots"), 200, 7), ("https://x.org/none", "<p>no article</p>", 200, 8),
    ]
    for url, html, _, seen in rows:
        put(tmp_path / "raw" / "day" / (quote(url, safe="") + ".html"), html, seen)
    put(tmp_path / "raw" / "older" / (quote(rows[0][0], safe="") + ".html"), page.format("older"), 4)
    read = raw.read_page_files(spark, str(tmp_path / "raw"))
    assert {tuple(r) for r in read.where("seen > 4").collect()} == set(rows)
    spark.createDataFrame([*rows, (rows[0][0], page.format("older"), 200, 4)], PAGES).write.parquet(str(tmp_path / "parquet"))
    links = spark.createDataFrame([(r[0],) for r in rows], "link string")
    texts = lambda pages: sorted(map(tuple, articles.article_texts(pages, links).collect()), key=repr)
    assert texts(read) == texts(articles.read_pages(spark, str(tmp_path / "parquet")))
    assert {t for _, _, t in texts(read)} == {"plus", "текст", "dots", None}
    assert read.where(F.col("html").isNull()).count() == 0
