"""HTML listing pages, the fallback for unusable feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chroniq import constants as K
from chroniq.functions.dates import parse_listing_date
from chroniq.functions.html import anchors, element_texts, elements, inside_nested
from chroniq.functions.text import let
from chroniq.functions.urls import normalize_link
from chroniq.schemas import LISTINGS


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LISTINGS).parquet(path)


def _elements(html: Column) -> Column:
    """``STRUCT<links, date_texts>``: the two lists a page's items are made of."""
    return let(
        inside_nested(html, "div", K.LISTING_CLASS, K.HEADLINE_CLASS),
        lambda headlines: F.struct(
            anchors(F.array_join(elements(headlines, "h3"), "")).alias("links"),
            element_texts(headlines, "p", K.DATE_CLASS).alias("date_texts"),
        ),
    )


def listing_elements(listings: DataFrame) -> DataFrame:
    """Adds the lists ``links`` and ``date_texts`` to each page."""
    found = listings.withColumn("__found", _elements(F.col("html")))
    return found.select(*listings.columns, "__found.links", "__found.date_texts")


def parse_listings(listings: DataFrame, site_domain: str, tz: str = "UTC") -> DataFrame:
    """``lang, page, url, status, items`` with the valid items of each page.

    Links and dates are paired by position, up to the shorter list; pairs with no address, title
    or readable date are left out.
    """

    def pair(found: Column) -> Column:
        # arrays_zip pads the shorter list; both are cut to its length first.
        both = F.least(F.size(found["links"]), F.size(found["date_texts"]))
        pairs = F.arrays_zip(
            F.slice(found["links"], F.lit(1), both).alias("link"),
            F.slice(found["date_texts"], F.lit(1), both).alias("date"),
        )
        items = F.transform(
            pairs,
            lambda p: F.struct(
                parse_listing_date(p["date"], tz).alias("date"),
                F.when(p["link"]["href"] != "", normalize_link(p["link"]["href"], F.col("url"), site_domain)).alias("link"),
                p["link"]["title"].alias("topic"),
            ),
        )
        return F.filter(items, lambda i: i["date"].isNotNull() & i["link"].isNotNull() & (i["topic"] != ""))

    items = let(_elements(F.col("html")), pair)
    return listings.select("lang", "page", "url", "status", items.alias("items"))


def listing_items(parsed: DataFrame) -> DataFrame:
    """Items of parsed listing pages; ``idx`` counts them per page."""
    # With the outer form no filter on the array is inferred, which would parse the page twice.
    rows = parsed.select("lang", "page", F.posexplode_outer("items").alias("idx", "item"))
    rows = rows.where("item IS NOT NULL")
    return rows.select("lang", "page", "idx", "item.date", "item.link", "item.topic")
