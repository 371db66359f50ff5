"""RSS feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chroniq.functions.dates import parse_rfc_date
from chroniq.functions.text import keep_by_walk, let, strip
from chroniq.schemas import FEEDS

# Every child is kept, so that the first can be taken. `_corrupt_record` must come last.
_ITEM = "struct<title: array<string>, link: array<string>, pubDate: array<string>>"
_DOCUMENT = f"channel array<struct<item: array<{_ITEM}>>>, _corrupt_record string"
_OPTIONS = {"mode": "PERMISSIVE", "ignoreSurroundingSpaces": "false"}

_FIELDS = ["title", "link", "pubDate"]
_NAMES = "|".join(["channel", "item", *_FIELDS])
_CDATA = r"<!\[CDATA\[(?:[^\]]++|\](?!\]>))*+\]\]>"
_ASIDE = r"<!--.*?-->|<\?.*?\?>"
_TAG = r"""</?[A-Za-z_:](?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
#: Names in another case, and fields with more in them than text: the parser reads these otherwise than they are meant.
_OTHER_CASE = rf"/?(?i:{_NAMES})(?=[\s/>])(?<![</](?:{_NAMES}))"
_MIXED = rf"(?:{'|'.join(_FIELDS)})(?:\s[^>]*+)?(?<!/)>(?:[^<]++|{_CDATA})*+<(?!/)"
_ODD = rf"(?s)<(?:{_OTHER_CASE}|{_MIXED})"
#: A field with nothing but text in it, as one token.
_PLAIN_FIELD = "|".join(rf"<{name}(?:\s[^<>\"']*+)?(?<!/)>(?:[^<]++|{_CDATA})*+</{name}\s*+>" for name in _FIELDS)
_PROLOG = rf"\A(?:\s++|{_ASIDE}|<!DOCTYPE(?:[^\[>]*+(?:\[.*?\]\s*+)?)>)*+"


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FEEDS).parquet(path)


_NO_ITEMS = "array<struct<pos: bigint, date: bigint, link: string, topic: string>>"


def _parse(body: Column) -> Column:
    return F.from_xml(body, _DOCUMENT, _OPTIONS)


def _own_texts(body: Column) -> Column:
    """The document with names of other case renamed, and fields cut down to the text before their first child."""
    tokens = F.regexp_extract_all(body, F.lit(rf"(?s){_CDATA}|{_ASIDE}|{_PLAIN_FIELD}|{_TAG}|[^<]++|<"), F.lit(0))
    rename = lambda t: F.regexp_replace(t, rf"\A(</?)(?=(?i:{_NAMES})[\s/>])(?!(?:{_NAMES})[\s/>])", "$1other-")
    renamed = F.when(F.rlike(body, F.lit(rf"<{_OTHER_CASE}")), F.transform(tokens, rename)).otherwise(tokens)
    aside, text, end, child, field, start = range(6)

    def kind_of(token: Column) -> Column:
        # A tag that is an element by itself, or a plain field, which is a child where it lies in another field.
        alone = F.endswith(token, F.lit("/>")) | F.contains(token, F.lit("</"))
        opens = F.when(alone, child).when(F.rlike(token, F.lit(rf"\A<(?:{'|'.join(_FIELDS)})[\s/>]")), field).otherwise(start)
        return (
            F.when(~F.startswith(token, F.lit("<")), text)
            .when(F.startswith(token, F.lit("</")), end)
            .when(F.rlike(token, F.lit(r"\A<[A-Za-z_:]")), opens)
            .when(F.rlike(token, F.lit(r"\A<[!?](?!\[CDATA)")), aside)
            .otherwise(text)
        )

    def step(state: Column, token: Column) -> Column:
        return let(kind_of(token), lambda kind: move(state, kind))

    def move(state: Column, kind: Column) -> Column:
        # 0 outside of fields, else the number of open elements from the field on.
        inside = state["inside"]
        after = (
            F.when(inside == 0, F.when(kind == field, 1).otherwise(0))
            .when(kind == end, inside - 1)
            .when(kind >= field, inside + 1)
            .otherwise(inside)
        )
        in_child = F.when(inside == 0, False).otherwise(state["child"] | (kind >= child))
        kept = (inside == 0) | (inside == 1) & ((kind == end) | (kind == text) & ~state["child"])
        return F.struct(F.struct(after.alias("inside"), in_child.alias("child")).alias("at"), kept.alias("kept"))

    return F.array_join(keep_by_walk(renamed, {"inside": F.lit(0), "child": F.lit(False)}, step), "")


def _is_odd(body: Column) -> Column:
    return F.coalesce(F.rlike(body, F.lit(_ODD)), F.lit(False))


def _has_one_root(body: Column) -> Column:
    """Whether the last end tag is that of the first element, with nothing but comments behind it.

    Together with :func:`_named_apart` this tells a second root element, which the parser overlooks.
    """
    around = rf"(?s){_PROLOG}<([^\s/>!?]++)(?:(?=[\s>]).*</\1\s*+>|(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+(?<=/)>)(?:\s++|{_ASIDE})*+\z"
    return F.coalesce(F.rlike(body, F.lit(around)), F.lit(False))


def _named_apart(body: Column) -> Column:
    """The first start tag and the last end tag under a name of their own, which fit only if they are one element's."""
    return F.regexp_replace(body, rf"(?s)({_PROLOG})<([^\s/>!?]++)(?=[\s>])(.*)</\2\s*+>((?:\s++|{_ASIDE})*+)\z", "$1<root-$2$3</root-$2>$4")


def _channels(body: Column, document: Column) -> Column:
    """The document's channels: direct children of the root, else the first at any depth."""
    nested = F.regexp_extract(body, r"(?s)(<channel(?=[\s/>]).*</channel\s*>)", 1)
    deep = _parse(F.concat(F.lit("<rss>"), nested, F.lit("</rss>")))["channel"]
    # The root itself is not searched.
    root_is_channel = F.rlike(body, F.lit(r"(?s)\A\s*(?:<[?!][^>]*>\s*)*<channel[\s/>]"))
    return F.coalesce(document["channel"], F.when((nested != "") & ~root_is_channel, deep))


def _first(values: Column) -> Column:
    return F.get(values, F.lit(0))


def _read_items(raw: Column, tz: str) -> Column:
    """Items with their place in the feed."""
    return F.transform(
        raw,
        lambda item, pos: F.struct(
            pos.cast("bigint").alias("pos"),
            parse_rfc_date(_first(item["pubDate"]), tz).alias("date"),
            _first(item["link"]).alias("link"),
            strip(F.coalesce(_first(item["title"]), F.lit(""))).alias("topic"),
        ),
    )


def _is_complete(item: Column) -> Column:
    return (item["date"] != 0) & (item["link"] != "")


def parse_feeds(feeds: DataFrame, tz: str = "UTC") -> DataFrame:
    """Adds ``items``, ``latest`` (date of the first item) and ``error_context`` to each feed.

    A feed is usable if ``error_context`` is null: status 200, well-formed, with a channel, with
    items, and with a readable date in the first item. Otherwise ``items`` is empty. ``latest``
    is the first item's date before items are left out. Names count in their own case; of several ``title``, ``link`` or ``pubDate``
    of an item the first counts, with the text before its first child element.
    """
    body = F.col("body")

    def judge(plain: Column, documents: Column) -> Column:
        document = documents[0]
        # What was cut out has to be well-formed too.
        sound = document["_corrupt_record"].isNull() & documents[1]["_corrupt_record"].isNull() & _has_one_root(body)
        return let(F.coalesce(sound, F.lit(False)), lambda sound: found_in(plain, document, sound))

    def found_in(plain: Column, document: Column, well_formed: Column) -> Column:
        # Elements in a namespace of their own have other names.
        channels = F.when(~F.rlike(body, F.lit(rf"(?s){_PROLOG}<[^>]*\sxmlns\s*=")), _channels(plain, document))
        channel = F.when(well_formed, F.get(channels, F.lit(0)))
        return let(F.struct(well_formed.alias("well_formed"), channel.alias("channel")), read)

    def read(found: Column) -> Column:
        items = _read_items(found["channel"]["item"], tz)
        return let(F.coalesce(items, F.array().cast(_NO_ITEMS)), lambda items: verdict(found, items))

    def verdict(found: Column, items: Column) -> Column:
        first_date = F.get(items, F.lit(0))["date"]
        error = (
            F.when(F.col("status") != 200, F.concat(F.lit("rss_fetch_failed_"), F.col("status")))
            .when(~found["well_formed"], "rss_parse_error")
            .when(found["channel"].isNull(), "rss_no_channel")
            .when(F.size(items) == 0, "rss_no_items")
            .when(first_date.isNull(), "rss_bad_first_date")
        )
        kept = F.when(error.isNull(), F.filter(items, _is_complete)).otherwise(F.array().cast(_NO_ITEMS))
        return F.struct(kept.alias("items"), first_date.alias("latest"), error.alias("error_context"))

    # One expression, so that the optimizer has no intermediate column to copy the parse into.
    def parse(odd: Column, plain: Column) -> Column:
        texts = F.array(_named_apart(plain), F.when(odd, _named_apart(body)))
        return let(F.transform(texts, _parse), lambda documents: judge(plain, documents))

    # Each part is computed once, as nothing shares equal parts of an expression inside a lambda.
    found = let(_is_odd(body), lambda odd: let(F.when(odd, _own_texts(body)).otherwise(body), lambda plain: parse(odd, plain)))
    parsed = feeds.withColumn("__feed", found)
    fields = [F.col(f"__feed.{name}") for name in ("items", "latest", "error_context")]
    return parsed.select(*feeds.columns, *fields)


def feed_items(parsed: DataFrame) -> DataFrame:
    """Items of the usable feeds in feed order."""
    # With the outer form no filter on the array is inferred, which would parse the feed twice.
    rows = parsed.select("lang", F.explode_outer("items").alias("item")).where("item IS NOT NULL")
    return rows.select("lang", "item.pos", "item.date", "item.link", "item.topic")
