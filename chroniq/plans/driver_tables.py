"""The engine's inputs, derived from the driver's tables.

Everything is a projection, or an explode, of whole tables, so the work grows with them and no
derived input needs a shuffle of its own:

* corpus: one record per document;
* feeds, listings, article pages: every document is a feed of its own whose items are its lines;
* polls: the events, as newest-first items of one feed per event type.

What varies between feeds (failed fetches, broken XML, missing articles, ...) goes by the source
of the document or by the text of the line. The SQL text of a projection serves both engines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chroniq import constants as K
from chroniq.functions.dates import utc_date
from chroniq.operators.lookup import lookup_join

SITE = "corpus.example.org"
ITEMS_PER_PAGE = 10
HOUR = 3600

DATE_SQL = "788918400 + ((doc_id * 7919 + n_chars) % 2400) * 86400"
LINK_SQL = f"concat('https://{SITE}/doc/', doc_id)"
SPEECH_COLUMNS = {
    "ord": "doc_id",
    "date": DATE_SQL,
    "link": LINK_SQL,
    "topic": "split_part(text, chr(10), 1)",
    "full_text": "text",
    "lang": "lang",
}
SPEECH_SELECT = [f"{expression} AS {name}" for name, expression in SPEECH_COLUMNS.items()]
SPEECHES_SQL = f"SELECT {', '.join(SPEECH_SELECT)} FROM documents"

# For repairs: documents labelled as bad lost their text, some to an empty one.
GAP_SQL = "CASE WHEN quality = 0 THEN CASE WHEN toxic = 0 THEN '' END ELSE full_text END"

# Line 0 is the newest; some items are dated later than their place says.
ITEM_DATE_SQL = """base - i * 3600 + CASE WHEN substr(line, 1, 1) IN ('A', 'E', 'I', 'O', 'U') THEN 9000 ELSE 0 END"""
MARK_SQL = "base - 20 * 3600"
NO_LINK_SQL = "line LIKE 'W%'"
NO_DATE_SQL = "line LIKE '%|%'"
NO_ARTICLE_SQL = "line LIKE 'D%'"
NOT_CRAWLED_SQL = "line LIKE 'N%'"
CRAWLED_TWICE_SQL = "line LIKE 'T%'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages")


def speeches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).selectExpr(*SPEECH_SELECT)


def speeches_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("ord"), "quality", "toxic")
    rows = lookup_join(speeches(spark, sf_dir), labels, ["ord"], "left")
    return rows.withColumn("full_text", F.expr(GAP_SQL)).select(*SPEECH_COLUMNS)


def escape(text: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def _two(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def _clock(epoch: Column) -> tuple[Column, Column, Column]:
    second = F.pmod(epoch, F.lit(86400))
    return (
        _two(F.floor(second / 3600)),
        _two(F.floor(second / 60) % 60),
        _two(second % 60),
    )


def rfc_text(epoch: Column) -> Column:
    clock = F.concat_ws(":", *_clock(epoch))
    return F.concat(F.date_format(utc_date(epoch), "EEE, d MMM yyyy "), clock, F.lit(" +0000"))


def listing_date_text(epoch: Column, ukrainian: Column) -> Column:
    hour, minute, _ = _clock(epoch)
    clock = F.concat(F.lit(" - "), hour, F.lit(":"), minute)
    day = utc_date(epoch)
    names = F.array(*[F.lit(name) for name in K.UKRAINIAN_MONTHS])
    return F.when(
        ukrainian,
        F.concat(F.day(day), F.lit(" "), F.element_at(names, F.month(day)), F.lit(" "), F.year(day), F.lit(" року"), clock),
    ).otherwise(F.concat(F.date_format(day, "d MMMM yyyy"), clock))


def _item_fields(line: Column, i: Column) -> dict[str, Column]:
    """Parts of one item; ``doc_id``, ``base``, ``source`` and ``lang`` are columns of the row."""
    late = F.when(F.substring(line, 1, 1).isin("A", "E", "I", "O", "U"), 9000).otherwise(0)
    no_date = F.contains(line, F.lit("|"))
    address = F.concat(F.lit(f"https://{SITE}/doc/"), F.col("doc_id"), F.lit("/"), i)
    return {
        "date": F.col("base") - i * HOUR + late,
        "no_date": no_date,
        "link": F.when(F.startswith(line, F.lit("W")), "").otherwise(address),
    }


def _feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select(
        "doc_id",
        "source",
        F.col("lang").alias("doc_lang"),
        F.concat(F.lit("feed-"), F.col("doc_id")).alias("lang"),
        F.expr(DATE_SQL).alias("base"),
        F.split("text", "\n").alias("lines"),
    )


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lang, status, body``: an RSS document per document of the corpus."""

    def item(line: Column, i: Column) -> Column:
        fields = _item_fields(line, i)
        unreadable = fields["no_date"] | ((F.col("source") == "src4") & (i == 0))
        date = F.when(unreadable, "soon").otherwise(rfc_text(fields["date"]))
        return F.concat(
            F.lit("<item><title> "), escape(line), F.lit("</title><link>"), fields["link"],
            F.lit("</link><pubDate>"), date, F.lit("</pubDate></item>"),
        )

    rows = _feed_rows(spark, sf_dir)
    items = F.array_join(F.transform("lines", item), "")
    channel = F.concat(F.lit("<channel><title>all</title>"), items, F.lit("</channel>"))
    source = F.col("source")
    body = (
        F.when(source == "src1", F.concat(F.lit("<html><br>"), items))
        .when(source == "src2", "<rss></rss>")
        .when(source == "src3", "<rss><channel><title>none</title></channel></rss>")
        .when(source == "src5", F.concat(F.lit("<feed><box>"), channel, F.lit("</box></feed>")))
        .otherwise(F.concat(F.lit('<?xml version="1.0"?><rss version="2.0">'), channel, F.lit("</rss>")))
    )
    return rows.select("lang", F.when(source == "src0", 500).otherwise(200).alias("status"), body.alias("body"))


def odd_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lang, status, body``: a feed per document, odd in one of five ways: repeated children, markup in titles, a second root
    element, names in upper case beside the right ones, and empty first titles."""

    def item(line: Column, i: Column) -> Column:
        title, link = escape(line), F.concat(F.lit(f"https://{SITE}/doc/"), F.col("doc_id"), F.lit("/"), i)
        plain = F.concat(F.lit("<title>"), title, F.lit("</title><link>"), link, F.lit("</link>"))
        kind = F.col("doc_id") % 5
        fields = (
            F.when(kind == 0, F.concat(plain, F.lit("<title>second</title><link>second</link>")))
            .when(kind == 1, F.concat(F.lit("<title>"), title, F.lit(" <b>bold</b> tail</title><link>"), link, F.lit("<i/></link>")))
            .when(kind == 3, F.concat(F.lit("<TITLE>upper</TITLE><Link>upper</Link>"), plain))
            .when(kind == 4, F.concat(F.lit("<title/>"), plain))
            .otherwise(plain)
        )
        date = rfc_text(F.col("base") - i * HOUR)
        own = F.concat(F.lit("<item>"), fields, F.lit("<pubDate>"), date, F.lit("</pubDate></item>"))
        return F.when(kind == 3, F.concat(F.lit("<ITEM><title>upper</title></ITEM>"), own)).otherwise(own)

    items = F.array_join(F.transform("lines", item), "")
    behind = F.when(F.col("doc_id") % 5 == 2, "<rss><channel></channel></rss>").otherwise("<!-- end -->")
    body = F.concat(F.lit("<rss><channel>"), items, F.lit("</channel></rss>"), behind)
    return _feed_rows(spark, sf_dir).select("lang", F.lit(200).alias("status"), body.alias("body"))


def soup_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``url, html``: pages of the lines whose article is closed by an element around it, holds void and unclosed elements, or is
    never closed, and that have character references without ``;``."""
    text, kind = escape(F.col("line")), F.col("i") % 3
    body = (
        F.when(kind == 0, F.concat(F.lit('<section><div class="article_content">'), text, F.lit("<div> inner</section><p>after</p><div>more</div>")))
        .when(kind == 1, F.concat(F.lit('<ul><li><div class="a article_content"><p>'), text, F.lit("<br><img src='x'><p> two</i></div>behind<li>next</ul>after")))
        .otherwise(F.concat(F.lit('<article><span><div class="article_content"><b>'), text, F.lit(" &copy 2020 &notit; &amp<script>a</div>b</script></article></div>after")))
    )
    url = F.concat(F.lit(f"https://{SITE}/soup/"), F.col("doc_id"), F.lit("/"), F.col("i"))
    return lines(spark, sf_dir).select(url.alias("url"), F.concat(F.lit("<html><body>"), body, F.lit("</body></html>")).alias("html"))


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lang, feed_url, listing_url``; one source has a listing in place of a feed."""
    listing = F.concat(F.lit(f"https://{SITE}/list/"), F.col("doc_id"))
    feed = F.concat(F.lit(f"https://{SITE}/rss/"), F.col("doc_id"), F.lit(".rss"))
    feed_url = F.when(F.col("source") == "src6", F.concat(listing, F.lit("?all=1"))).otherwise(feed)
    return _feed_rows(spark, sf_dir).select("lang", feed_url.alias("feed_url"), listing.alias("listing_url"))


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lang, page, url, status, html``: listing pages of ten items for every document."""

    def item(line: Column, i: Column) -> Column:
        fields = _item_fields(line, i)
        date = F.when(fields["no_date"], "soon").otherwise(
            listing_date_text(fields["date"], F.col("doc_lang") == "fr")
        )
        href = F.regexp_replace(fields["link"], f"^https://{SITE}", "")
        return F.concat(
            F.lit('<div class="item_stat cat_stat"><div class="item_stat_headline"><h3><a href="'), href,
            F.lit('">\n '), escape(line), F.lit(' </a></h3><div><p class="date"> '), date,
            F.lit("</p></div></div><p class=\"date\">outside</p></div>"),
        )

    rows = _feed_rows(spark, sf_dir)
    last = F.ceil(F.size("lines") / ITEMS_PER_PAGE).cast("int")
    paged = rows.withColumn("page", F.explode(F.sequence(F.lit(1), last)))
    first = (F.col("page") - 1) * ITEMS_PER_PAGE
    items = F.transform(
        F.slice("lines", first + 1, F.lit(ITEMS_PER_PAGE)), lambda line, k: item(line, k + first)
    )
    empty = (F.col("source") == "src1") & (F.col("doc_lang") == "de")
    html = F.concat(
        F.lit('<html><!-- <div class="cat_list"> --><body><div class="all">'),
        F.when(empty, "").otherwise(F.concat(F.lit('<div class="cat_list">'), F.array_join(items, ""), F.lit("</div>"))),
        F.lit('<div class="item_stat_headline"><h3><a href="/x">no</a></h3></div></div></body></html>'),
    )
    failed = (F.col("source") == "src3") & (F.col("page") == 2)
    return paged.select(
        "lang",
        "page",
        F.concat(F.lit(f"https://{SITE}/list/"), F.col("doc_id"), F.lit("?page="), F.col("page")).alias("url"),
        F.when(failed, 503).otherwise(200).alias("status"),
        html.alias("html"),
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _feed_rows(spark, sf_dir)
    return rows.select("doc_id", "source", "doc_lang", "lang", "base", F.posexplode("lines").alias("i", "line"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lang, pos, date, link, topic`` of every line, as a parsed feed would give them."""
    fields = _item_fields(F.col("line"), F.col("i"))
    return lines(spark, sf_dir).select(
        "lang", F.col("i").cast("bigint").alias("pos"), fields["date"].alias("date"),
        fields["link"].alias("link"), F.col("line").alias("topic"),
    )


def _article_html(text: Column, css: Column) -> Column:
    return F.concat(
        F.lit('<html><body><div class="head">h</div><div class="'), css, F.lit('"><p>'), text,
        F.lit("</p><div>inner </div>\n tail</div><div>side</div></body></html>"),
    )


def article_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``url, html, status, seen``: crawled pages of the items; some addresses were crawled twice."""
    rows = lines(spark, sf_dir).where(~F.expr(NOT_CRAWLED_SQL))
    crawls = F.when(F.expr(CRAWLED_TWICE_SQL), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(1)))
    rows = rows.withColumn("seen", F.explode(crawls))
    text = F.when(F.col("seen") == 0, "old").otherwise(escape(F.col("line")))
    css = F.when(F.expr(NO_ARTICLE_SQL), "text other").otherwise("text article_content")
    url = F.concat(F.lit(f"https://{SITE}/doc/"), F.col("doc_id"), F.lit("/"), F.col("i"))
    return rows.select(
        url.alias("url"), _article_html(text, css).alias("html"), F.lit(200).alias("status"),
        F.col("seen").cast("bigint").alias("seen"),
    )


def feed_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mark per feed; those of one source have none yet."""
    rows = _feed_rows(spark, sf_dir).where("source <> 'src7'")
    return rows.select("lang", F.expr(MARK_SQL).alias("high_water"))


def repair_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawled pages of whole documents: none in German, without an article in Spanish."""
    rows = documents(spark, sf_dir).where("lang <> 'de'")
    css = F.when(F.col("lang") == "es", "text other").otherwise("text article_content")
    return rows.select(
        F.expr(LINK_SQL).alias("url"), _article_html(escape(F.col("text")), css).alias("html"),
        F.lit(200).alias("status"), F.lit(0).cast("bigint").alias("seen"),
    )


def patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit(f"https://{SITE}/doc/"), F.col("item_id")).alias("link"), F.col("text").alias("full_text")
    )


def deny_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").where("toxic = 1").selectExpr(f"{LINK_SQL} AS link")


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as newest-first items, keyed by event type; dates are not strictly in feed order."""
    ts = F.col("ts")
    seconds = (
        F.unix_date(F.to_date(ts)).cast("bigint") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.floor(F.second(ts))
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("event_type").alias("lang"),
        (-F.col("event_id")).alias("pos"),
        (seconds + F.floor("value") * 60).alias("date"),
    )


def poll_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mark half-way through each event type's dates."""
    middle = F.floor((F.min("date") + F.max("date")) / 2).alias("high_water")
    return polls(spark, sf_dir).groupBy("lang").agg(middle)
