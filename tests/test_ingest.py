"""The ingest run, batch and streamed, on small fixtures."""

import re

import pytest
from pyspark.sql import functions as F

from chroniq.plans import ingest
from chroniq.schemas import CORPUS, FEEDS, LISTINGS, PAGES
from chroniq.sinks.commits import BatchCommitted, log
from chroniq.sinks.tables import publish, published, seed_marks
from chroniq.sources import articles
from chroniq.sources import feeds as feed_source
from chroniq.sources import listings as listing_source
from chroniq.sources.registry import registry, with_addresses
from chroniq.sources.state import marks_to_commit, read_marks
from chroniq.streaming.ingest_stream import feed_stream, start_ingest

SITE = "site.example"
DAY = 86400


def rfc(day):
    return f"{day:02d} Jan 2024 00:00:00 +0000"


def epoch(day):
    return 1704067200 + (day - 1) * DAY


def rss(*items):
    body = "".join(
        f"<item><title> t{k} </title><link>{link}</link><pubDate>{date}</pubDate></item>"
        for k, (link, date) in enumerate(items)
    )
    return f'<?xml version="1.0"?><rss><channel><title>c</title>{body}</channel></rss>'


def listing(*items):
    rows = "".join(
        f'<div class="item_stat"><div class="item_stat_headline"><h3><a href="{href}">T {href}</a></h3>'
        f'<p class="date">{date}</p></div></div>'
        for href, date in items
    )
    return f'<html><body><div class="cat_list">{rows}</div></body></html>'


def article(text):
    return f'<html><div class="x article_content"><p>{text}</p></div></html>'


def frames(spark, feeds, listings=(), pages=()):
    return (
        spark.createDataFrame(feeds, FEEDS),
        spark.createDataFrame(list(listings), LISTINGS),
        spark.createDataFrame([(u, h, 200, 0) for u, h in pages], PAGES),
    )


def marks(spark, **values):
    return spark.createDataFrame(list(values.items()) or [], "lang string, high_water bigint")


def links(plan):
    return {(r.lang, r.link) for r in plan.new_rows.collect()}


def errors(plan):
    return {(r.lang, r.error_context) for r in plan.rejects.collect()}


@pytest.mark.parametrize(
    ("body", "status", "error"),
    [
        (rss(("http://l/1", rfc(9))), 200, None),
        (rss(("http://l/1", rfc(9))), 500, "rss_fetch_failed_500"),
        ("<html><br>", 200, "rss_parse_error"),
        ("", 200, "rss_parse_error"),
        (None, 200, "rss_parse_error"),
        (rss(("http://l/1", rfc(9))) + "junk", 200, "rss_parse_error"),
        ("<rss/>", 200, "rss_no_channel"),
        ("<channel><item><title>t</title></item></channel>", 200, "rss_no_channel"),
        ("<rss><channel><title>x</title></channel></rss>", 200, "rss_no_items"),
        (rss(("http://l/1", "soon"), ("http://l/2", rfc(8))), 200, "rss_bad_first_date"),
        ("<a><b><channel><item><pubDate>" + rfc(9) + "</pubDate></item></channel></b></a>", 200, None),
    ],
)
def test_feed_verdicts(spark, body, status, error):
    frame = spark.createDataFrame([("en", status, body)], FEEDS)
    row = feed_source.parse_feeds(frame).first()
    assert row.error_context == error
    if error:
        assert row["items"] == []


def test_feed_items_skip_without_stopping(spark):
    body = rss(("http://l/1", rfc(9)), ("", rfc(8)), ("http://l/3", "bad"), ("http://l/4", rfc(7)))
    items = feed_source.feed_items(feed_source.parse_feeds(spark.createDataFrame([("en", 200, body)], FEEDS)))
    rows = [tuple(r) for r in items.select("pos", "date", "link", "topic").orderBy("pos").collect()]
    assert rows == [(0, epoch(9), "http://l/1", "t0"), (3, epoch(7), "http://l/4", "t3")]


def test_first_of_two_channels(spark):
    item = "<item><title>{}</title><link>l</link><pubDate>" + rfc(9) + "</pubDate></item>"
    body = f"<rss><channel>{item.format('a')}</channel><channel>{item.format('b')}</channel></rss>"
    items = feed_source.feed_items(feed_source.parse_feeds(spark.createDataFrame([("en", 200, body)], FEEDS)))
    assert [r.topic for r in items.collect()] == ["a"]


def test_listing_pairs_are_cut_to_the_shorter_list(spark):
    html = listing(("/1", "9 January 2024 - 00:00"), ("/2", "8 січня 2024 року - 00:00")).replace(
        "</div></body>", '<div class="item_stat_headline"><h3><a href="/3">no date</a></h3></div></div></body>'
    )
    frame = spark.createDataFrame([("en", 1, f"https://{SITE}/list", 200, html)], LISTINGS)
    items = listing_source.listing_items(listing_source.parse_listings(frame, SITE))
    rows = [tuple(r) for r in items.select("idx", "date", "link", "topic").orderBy("idx").collect()]
    assert rows == [(0, epoch(9), f"https://{SITE}/1", "T /1"), (1, epoch(8), f"https://{SITE}/2", "T /2")]


def test_take_while_stops_at_first_old_item(spark):
    body = rss(*[(f"http://l/{d}", rfc(d)) for d in (9, 7, 3, 8)])
    pages = [(f"http://l/{d}", article(d)) for d in (9, 7, 3, 8)]
    plan = ingest.plan_ingest(*frames(spark, [("en", 200, body)], pages=pages), marks(spark, en=epoch(5)), SITE)
    assert links(plan) == {("en", "http://l/9"), ("en", "http://l/7")}
    assert [tuple(r) for r in plan.marks.collect()] == [("en", epoch(9))]
    with ingest.backfill(*frames(spark, [("en", 200, body)], pages=pages), SITE) as forced:
        assert forced.count() == 4


def test_fallback_and_page_stops(spark):
    date = lambda d: f"{d} January 2024 - 00:00"
    lists = [
        ("en", 1, "https://site.example/l", 200, listing(("/20", date(20)), ("/19", date(19)))),
        ("en", 2, "https://site.example/l?page=2", 200, listing(("/18", date(18)), ("/17", date(17)))),
        # no article of page 3 can be read, so page 4 is not reached
        ("en", 3, "https://site.example/l?page=3", 200, listing(("/16", date(16)))),
        ("en", 4, "https://site.example/l?page=4", 200, listing(("/15", date(15)))),
        # a usable feed: its listing is not looked at
        ("uk", 1, "https://site.example/u", 200, listing(("/99", date(20)))),
        # page 2 is missing, so page 3 is not reached
        ("de", 1, "https://site.example/d", 200, listing(("/d1", date(20)))),
        ("de", 3, "https://site.example/d?page=3", 200, listing(("/d3", date(18)))),
        ("fr", 1, "https://site.example/f", 503, "down"),
        ("es", 1, "https://site.example/e", 200, "<html></html>"),
    ]
    feeds = [(lang, 200, "<rss/>") for lang in ("en", "de", "fr", "es")] + [
        ("uk", 200, rss(("https://site.example/u1", rfc(9))))
    ]
    pages = [(f"https://site.example/{n}", article(n)) for n in ("20", "19", "17", "15", "u1", "d1", "d3")]
    pages += [("https://site.example/18", "<html>empty</html>")]
    state = marks(spark, en=0, uk=0, de=0, fr=0, es=0)
    plan = ingest.plan_ingest(*frames(spark, feeds, lists, pages), state, SITE)
    assert links(plan) == {
        ("en", "https://site.example/20"), ("en", "https://site.example/19"), ("en", "https://site.example/17"),
        ("uk", "https://site.example/u1"), ("de", "https://site.example/d1"),
    }
    assert {(r.lang, r.latest) for r in plan.marks.collect()} == {("en", epoch(20)), ("uk", epoch(9)), ("de", epoch(20))}
    assert {r.lang for r in plan.failures.collect()} == {"fr", "es"}
    assert errors(plan) == {
        ("en", "rss_no_channel"), ("de", "rss_no_channel"), ("fr", "rss_no_channel"), ("es", "rss_no_channel"),
        ("en", "no_article_content"), ("en", "page_not_crawled"),
        ("fr", "html_listing_fetch_failed_503"), ("es", "html_listing_no_items"),
    }


def test_language_without_mark_fails(spark):
    feeds = [(lang, 200, rss((f"http://{lang}/1", rfc(9)))) for lang in ("en", "uk")]
    pages = [("http://en/1", article("a")), ("http://uk/1", article("b"))]
    plan = ingest.plan_ingest(*frames(spark, feeds, pages=pages), marks(spark, en=0), SITE)
    assert links(plan) == {("en", "http://en/1")}
    assert [tuple(r) for r in plan.failures.collect()] == [("uk", "no_saved_mark")]


def test_same_item_twice_is_kept_twice_and_newest_crawl_wins(spark):
    body = rss(("http://l/1", rfc(9)), ("http://l/1", rfc(9)))
    feeds, lists, _ = frames(spark, [("en", 200, body)])
    pages = spark.createDataFrame(
        [("http://l/1", article("old"), 200, 0), ("http://l/1", article("new"), 200, 5)], PAGES
    )
    plan = ingest.plan_ingest(feeds, lists, pages, marks(spark, en=0), SITE)
    assert [r.full_text for r in plan.new_rows.collect()] == ["new", "new"]


def test_a_block_page_never_hides_an_older_good_crawl(spark):
    feeds, lists, _ = frames(spark, [("en", 200, rss(("http://l/1", rfc(9)), ("http://l/2", rfc(8))))])
    denied = "<html>Access Denied</html>"
    rows = [("http://l/1", article("old"), 200, 0), ("http://l/1", article("good"), 200, 5), ("http://l/1", denied, 200, 9)]
    rows += [("http://l/2", denied, 200, 1), ("http://l/2", denied, 200, 1), ("http://l/3", article("unasked"), 200, 1)]
    plan = ingest.plan_ingest(feeds, lists, spark.createDataFrame(rows, PAGES), marks(spark, en=0), SITE)
    assert [(r.link, r.full_text) for r in plan.new_rows.collect()] == [("http://l/1", "good")]
    assert [(r.url, r.error_context, r.html, r.date) for r in plan.rejects.collect()] == [("http://l/2", "no_article_content", denied, epoch(8))]


def test_rejected_feed_carries_its_address(spark):
    known = registry(spark, {"en": ("https://h/en/rss/a.rss", "https://h/en/a"), "uk": ("https://h/uk", "https://h/x")})
    feeds = [("en", 500, None), ("uk", 200, rss(("http://uk/1", rfc(9)))), ("de", 500, None)]
    inputs = frames(spark, feeds, pages=[("http://uk/1", article("x"))])
    plan = ingest.plan_ingest(*inputs, marks(spark, uk=0), SITE, sources=known)
    assert {(r.lang, r.url) for r in plan.rejects.collect()} == {("en", "https://h/en/rss/a.rss"), ("de", None)}
    both = {r.lang: r.listing_url for r in with_addresses(inputs[0].select("lang"), known).collect()}
    assert both == {"en": "https://h/en/a", "uk": "https://h/uk", "de": None}


def test_marks_commit_rule(spark):
    none = spark.createDataFrame([], CORPUS)
    some = spark.createDataFrame([(1, 1, "l", "t", "x", "uk")], CORPUS)
    processed = spark.createDataFrame([("en", 5), ("uk", 7)], "lang string, latest bigint")
    assert marks_to_commit(none, processed).count() == 0
    assert marks_to_commit(some, processed).count() == 2


def test_strict_marks(spark):
    processed = spark.createDataFrame([("en", 50), ("uk", 70)], "lang string, latest bigint")
    failed = spark.createDataFrame([("uk", 60), ("uk", 65)], "lang string, date bigint")
    assert {tuple(r) for r in ingest.strict_marks(processed, failed).collect()} == {("en", 50), ("uk", 59)}


def test_runs_are_incremental_and_repeatable(spark, tmp_path):
    root = str(tmp_path / "corpus")
    seed_marks(spark, root, {"en": epoch(5), "uk": epoch(5)})
    feed = lambda lang, *days: (lang, 200, rss(*[(f"http://{lang}/{d}", rfc(d)) for d in days]))
    pages = [(f"http://{lang}/{d}", article(f"{lang}{d}")) for lang in ("en", "uk") for d in range(5, 12)]

    def run(batch, *feeds):
        return ingest.run_ingest(spark, *frames(spark, list(feeds), pages=pages), root, SITE, batch)

    first = run(0, feed("en", 7, 6, 5), feed("uk", 5))
    assert (first.old_rows, first.new_rows, first.committed) == (0, 2, True)
    # both marks are written though only one language had new rows
    assert {tuple(r) for r in read_marks(spark, root).collect()} == {("en", epoch(7)), ("uk", epoch(5))}

    again = run(1, feed("en", 7, 6, 5), feed("uk", 5))
    assert (again.old_rows, again.new_rows, again.committed) == (2, 2, False)

    second = run(2, feed("en", 8, 7), feed("uk", 9, 6, 5))
    assert (second.old_rows, second.new_rows) == (2, 5)
    before = [tuple(r) for r in published(spark, root).orderBy("ord").collect()]
    # the batch comes again, and earlier ones do
    for batch in (2, 0):
        with pytest.raises(BatchCommitted):
            run(batch, feed("en", 11, 10, 9))
    after = [tuple(r) for r in published(spark, root).orderBy("ord").collect()]
    assert before == after
    assert [r[2] for r in after] == ["http://en/7", "http://en/6", "http://en/8", "http://uk/9", "http://uk/6"]

    with pytest.raises(ingest.IngestError):
        run(3, ("en", 500, None), ("uk", 500, None))
    assert {tuple(r) for r in read_marks(spark, root).collect()} == {("en", epoch(8)), ("uk", epoch(9))}


def test_failed_language_keeps_its_mark(spark, tmp_path):
    root = str(tmp_path / "corpus")
    seed_marks(spark, root, {"en": 1, "uk": 1})
    feeds = [("en", 500, None), ("uk", 200, rss(("http://uk/9", rfc(9))))]
    report = ingest.run_ingest(
        spark, *frames(spark, feeds, pages=[("http://uk/9", article("x"))]), root, SITE, 0
    )
    assert (report.processed, report.failed, report.committed) == (1, 1, True)
    assert {tuple(r) for r in read_marks(spark, root).collect()} == {("en", 1), ("uk", epoch(9))}
    saved = spark.read.parquet(f"{root}/quarantine")
    assert {(r.lang, r.error_context) for r in saved.collect()} == {("en", "rss_fetch_failed_500")}


def test_stream_equals_batch(spark, tmp_path):
    pages = [(f"http://en/{d}", article(f"en{d}")) for d in range(1, 15)]
    polls = [(9, 8, 7, 6), (12, 11, 10, 9)]
    _, lists, crawled = frames(spark, [("en", 200, "")], pages=pages)
    roots = {kind: str(tmp_path / kind) for kind in ("batch", "stream")}
    for root in roots.values():
        seed_marks(spark, root, {"en": epoch(6)})
    polled = str(tmp_path / "polls")
    for n, days in enumerate(polls):
        frame = spark.createDataFrame([("en", 200, rss(*[(f"http://en/{d}", rfc(d)) for d in days]))], FEEDS)
        frame.coalesce(1).write.mode("append").parquet(f"{polled}/n={n}")
        ingest.run_ingest(spark, frame, lists, crawled, roots["batch"], SITE, n)
    stream = feed_stream(spark, f"{polled}/n=*")
    query = start_ingest(stream, lambda s: (lists, crawled), roots["stream"], SITE, str(tmp_path / "check"))
    query.awaitTermination()
    assert query.exception() is None
    batch, streamed = (
        [tuple(r) for r in published(spark, roots[kind]).orderBy("date").select("date", "link", "full_text").collect()]
        for kind in ("batch", "stream")
    )
    assert len(batch) == 6 and batch == streamed
    assert read_marks(spark, roots['stream']).first().high_water == epoch(12)


def test_rerun_adds_nothing(spark, sf_dir, tmp_path):
    from chroniq.plans import driver_tables as D

    root = str(tmp_path / "corpus")
    marks_now = {r.lang: r.high_water for r in D.feed_marks(spark, sf_dir).collect()}
    seed_marks(spark, root, marks_now)
    inputs = (D.feeds(spark, sf_dir), D.listings(spark, sf_dir), D.article_pages(spark, sf_dir))
    first = ingest.run_ingest(spark, *inputs, root, D.SITE, 0)
    assert first.new_rows > 0
    rows = published(spark, root)
    assert rows.select("ord").distinct().count() == rows.count() == first.new_rows
    # Feeds are not in date order, so a first item may be older than those behind it.
    sorted_feeds = rows.groupBy("lang").agg(F.max("date").alias("top"))
    settled = sorted_feeds.join(read_marks(spark, root), "lang").where("top <= high_water").select("lang")
    plan = ingest.plan_ingest(*inputs, read_marks(spark, root), D.SITE)
    assert plan.new_rows.join(settled, "lang", "left_semi").count() == 0


def test_a_run_needs_no_number_and_keeps_all_rows(spark, tmp_path):
    root = str(tmp_path / "corpus")
    seed_marks(spark, root, {"en": epoch(5)})
    pages = [(f"http://en/{d}", article(f"en{d}")) for d in range(5, 15)]
    run = lambda *days, **o: ingest.run_ingest(
        spark, *frames(spark, [("en", 200, rss(*[(f"http://en/{d}", rfc(d)) for d in days]))], pages=pages), root, SITE, **o
    )
    run(7, 6)
    run(9, 8, 7)
    run(10, 9)
    publish(published(spark, root), root)
    run(11, 10)
    with pytest.raises(BatchCommitted):
        for _ in range(2):  # a rewrite does not make a batch new
            run(12, 11, batch_id=4)
            publish(published(spark, root), root)
    rows = published(spark, root).orderBy("ord").collect()
    assert [(r.ord, r.link) for r in rows] == [(i, f"http://en/{d}") for i, d in enumerate([7, 6, 9, 8, 10, 11, 12])]
    assert [(r.kind, r.rows, r.total_rows) for r in log(spark, root).orderBy("seq").collect()] == [
        ("seed", 0, 0), ("append", 2, 2), ("append", 2, 4), ("append", 1, 5), ("rewrite", 5, 5), ("append", 1, 6), ("append", 1, 7), ("rewrite", 7, 7),
    ]


def test_an_attempt_that_was_not_committed_is_invisible(spark, tmp_path):
    root = str(tmp_path / "corpus")
    seed_marks(spark, root, {"en": epoch(5)})
    inputs = frames(spark, [("en", 200, rss(("http://en/7", rfc(7))))], pages=[("http://en/7", article("seven"))])
    spark.createDataFrame([(99, 1, "l", "t", "x", "en")], CORPUS).write.partitionBy("lang").parquet(f"{root}/data/version=0/commit=1")
    spark.createDataFrame([("en", epoch(30))], "lang string, high_water bigint").write.parquet(f"{root}/marks/commit=1")
    assert published(spark, root).count() == 0
    ingest.run_ingest(spark, *inputs, root, SITE)
    assert [r.link for r in published(spark, root).collect()] == ["http://en/7"]
    assert read_marks(spark, root).first().high_water == epoch(7)


def test_new_checkpoint_and_batches_share_a_root(spark, tmp_path):
    root, polled = str(tmp_path / "corpus"), str(tmp_path / "polls")
    seed_marks(spark, root, {"en": epoch(5)})
    pages = [(f"http://en/{d}", article(f"en{d}")) for d in range(5, 15)]
    _, lists, crawled = frames(spark, [("en", 200, "")], pages=pages)

    def stream(days, checkpoint):
        feed = spark.createDataFrame([("en", 200, rss(*[(f"http://en/{d}", rfc(d)) for d in days]))], FEEDS)
        feed.coalesce(1).write.mode("overwrite").parquet(f"{polled}/{checkpoint}")
        start_ingest(feed_stream(spark, f"{polled}/{checkpoint}"), lambda s: (lists, crawled), root, SITE, str(tmp_path / checkpoint)).awaitTermination()

    stream((7, 6), "one")
    ingest.run_ingest(spark, *frames(spark, [("en", 200, rss(("http://en/8", rfc(8)), ("http://en/7", rfc(7))))], pages=pages), root, SITE, 0)
    stream((9, 8), "two")
    assert sorted(r.link for r in published(spark, root).collect()) == [f"http://en/{d}" for d in (6, 7, 8, 9)]


def test_stream_fails_if_all_languages_fail(spark, tmp_path):
    root, polled = str(tmp_path / "corpus"), str(tmp_path / "polls")
    seed_marks(spark, root, {"en": epoch(5)})
    _, lists, crawled = frames(spark, [("en", 500, None)])
    spark.createDataFrame([("en", 500, None)], FEEDS).write.parquet(polled)
    query = start_ingest(feed_stream(spark, polled), lambda s: (lists, crawled), root, SITE, str(tmp_path / "c"))
    with pytest.raises(Exception, match="no language"):
        query.awaitTermination()
    query = start_ingest(feed_stream(spark, polled), lambda s: (lists, crawled), root, SITE, str(tmp_path / "d"), skip_failed_batches=True)
    query.awaitTermination()
    assert published(spark, root).count() == 0


def test_strict_run_and_replay(spark, tmp_path):
    feeds = [("en", 200, rss(*[(f"http://en/{d}", rfc(d)) for d in (9, 8, 7)]))]
    some = [(f"http://en/{d}", article(f"en{d}")) for d in (9, 7)]
    for strict, mark in ((False, epoch(9)), (True, epoch(8) - 1)):
        root = str(tmp_path / f"corpus-{strict}")
        seed_marks(spark, root, {"en": epoch(5)})
        ingest.run_ingest(spark, *frames(spark, feeds, pages=some), root, SITE, strict=strict)
        assert read_marks(spark, root).first().high_water == mark
    root = str(tmp_path / "corpus-False")
    _, _, later = frames(spark, feeds, pages=[("http://en/8", article("at last")), ("http://en/9", article("again"))])
    for expected in ((2, 3), (3, 3)):
        report = ingest.replay_rejected(spark, root, later)
        assert (report.old_rows, report.new_rows) == expected
    assert published(spark, root).where("link = 'http://en/8'").first().full_text == "at last"


def test_one_language_is_read_alone(spark, tmp_path):
    root = str(tmp_path / "corpus")
    from chroniq.sinks.tables import append_rows

    append_rows(spark.createDataFrame([(i, 1, "l", "t", "x", lang) for i, lang in enumerate(["en", "uk", "en"])], CORPUS), root)
    rows = published(spark, root).where("lang = 'en'")
    assert rows.count() == 2
    assert re.search(r"PartitionFilters: \[[^\]]*lang#\d+ = en", rows._jdf.queryExecution().executedPlan().toString())


def scans_of_html(plan):
    return sum("html" in line for line in plan.splitlines() if line.startswith("ReadSchema"))


def plan_of(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def files_opened(df):
    """Number of files that the scans of HTML open, after a run."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()

    def walk(node):
        own = [node.metrics().apply("numFiles").value()] if "html" in node.toString().split("ReadSchema")[-1] and node.metrics().contains("numFiles") else []
        node = node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else node
        kids = node.children()
        return own + [n for i in range(kids.size()) for n in walk(kids.apply(i))]

    return max(walk(plan))


def test_newest_pages_reads_the_html_twice(spark, tmp_path, monkeypatch):
    """Once to choose the crawls, once to fetch them, and then only from files that hold a chosen one."""
    page = '<div class="article_content">{}</div>'
    rows = [(f"u{i}", page.format(f"{i} of {t}"), 200, t) for i in range(40) for t in (1, 2)]
    for part in range(8):
        frame = spark.createDataFrame(rows[part * 10 : part * 10 + 10], PAGES)
        frame.coalesce(1).write.mode("append").parquet(str(tmp_path / "pages"))
    staged, stage = [], articles.stage
    monkeypatch.setattr(articles, "stage", lambda df, *args: staged.append(plan_of(df)) or stage(df, *args))
    pages = articles.read_pages(spark, str(tmp_path / "pages"))
    links = spark.createDataFrame([("u3",), ("u4",), ("u4",), (None,), ("nobody",)], "link string")
    texts = articles.article_texts(pages, links)
    assert sum(map(scans_of_html, staged)) + scans_of_html(plan_of(texts)) == 2
    assert {(r.url, r.article_text) for r in texts.collect()} == {("u3", "3 of 2"), ("u4", "4 of 2")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert files_opened(articles.article_texts(pages, links)) == 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("source", ["parquet", "json", "exploded", "union", "local"])
def test_newest_pages_of_any_frame(spark, tmp_path, source):
    """Frames without row addresses give the same pages: other formats, rows made by explode, unions, local rows."""
    blocked = "<p>Access Denied</p>"
    data = [
        ("a", "old", 200, 1), ("a", "new", 200, 2), ("a", blocked, 200, 3), ("b", blocked, 200, 1), ("b", blocked, 200, 1),
        ("c", "x", 200, 5), ("c", "y", 200, 5), ("c", "x", 200, 5), (None, "n", 200, 1), ("d", None, 200, 1), ("e", "unasked", 200, 1),
    ]
    pages = spark.createDataFrame(data, PAGES)
    if source == "json":
        pages.write.json(str(tmp_path / "p"))
        pages = spark.read.schema(PAGES).json(str(tmp_path / "p"))
    elif source != "local":
        pages.write.parquet(str(tmp_path / "p"))
        pages = spark.read.parquet(str(tmp_path / "p"))
    if source == "exploded":
        pages = pages.withColumn("seen", F.explode(F.array(F.col("seen"), F.col("seen") - 1)))
    if source == "union":
        pages = pages.unionByName(pages.withColumn("seen", F.col("seen") - 1))
    wanted = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("z",)], "url string")
    got = [(r.url, r.html) for r in articles.newest_pages(pages, wanted).collect()]
    assert len(got) == 4
    assert dict(got)["a"] == "new" and dict(got)["b"] == blocked and dict(got)["c"] in "xy" and dict(got)["d"] is None


@pytest.mark.parametrize("bound", [None, 0])
def test_chosen_rows_are_found_by_bitmaps(spark, tmp_path, monkeypatch, bound):
    """Rows at the ends of a bitmap's run, of several files; beyond the bound the rows are joined."""
    if bound is not None:
        monkeypatch.setattr(articles, "MAX_BROADCAST_BYTES", -1)
    columns = ["concat('u', id) AS url", "concat('h', id) AS html", "200 AS status", "0L AS seen"]
    for part in range(2):
        spark.range(part * 70_000, part * 70_000 + 70_000, 1, 1).selectExpr(*columns).write.mode("append").parquet(str(tmp_path / "p"))
    pages = spark.read.schema(PAGES).parquet(str(tmp_path / "p"))
    ids = [0, 7, 8, 32767, 32768, 65535, 65536, 69999, 70000, 70001, 102767, 102768, 139999]
    wanted = spark.createDataFrame([(f"u{i}",) for i in ids], "url string")
    frame = articles.newest_pages(pages, wanted)
    assert sorted((r.url, r.html) for r in frame.collect()) == sorted((f"u{i}", f"h{i}") for i in ids)


def test_large_choices_shuffle_no_html(spark, tmp_path, monkeypatch):
    """Where the chosen addresses are too many for a broadcast, their bitmaps are not."""
    columns = ["concat('u', id) AS url", "concat('h', id) AS html", "200 AS status", "0L AS seen"]
    spark.range(1000).selectExpr(*columns).write.parquet(str(tmp_path / "p"))
    pages = spark.read.schema(PAGES).parquet(str(tmp_path / "p"))
    monkeypatch.setattr(articles.lookup_join, "__defaults__", (0,))
    frame = articles.newest_pages(pages, pages.select("url"))
    assert frame.count() == 1000
    assert "hashpartitioning" not in plan_of(frame)
