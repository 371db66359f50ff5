"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chroniq.functions.text import let

_URL = r"(?s)\A(https?)://([^/?#]*)(.*)\z"
_BASE = r"(?s)\A([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*).*\z"


def _form_decode(value: Column) -> Column:
    # A `%` with no two hex digits after it stands for itself.
    return F.url_decode(F.regexp_replace(value, "%(?![0-9A-Fa-f]{2})", "%25"))


def _form_encode(value: Column) -> Column:
    # Spark leaves `*` and escapes `~`; form encoding by RFC 3986 does the opposite.
    return F.replace(F.replace(F.url_encode(value), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def set_page_param(url: Column, page: Column) -> Column:
    """Set the query parameter ``page``.

    Other parameters keep their order and blanks; a repeated key keeps its first place and its
    last value; values are encoded anew; the fragment stays behind the query.
    """
    path = F.regexp_extract(url, r"(?s)\A([^?#]*)", 1)
    query = F.regexp_extract(url, r"(?s)\A[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(url, r"(?s)\A[^#]*(#.+)\z", 1)

    pieces = F.filter(F.split(query, "&"), lambda piece: piece != "")
    pairs = F.transform(
        pieces,
        lambda piece: F.struct(
            _form_decode(F.substring_index(piece, "=", 1)).alias("key"),
            _form_decode(F.regexp_extract(piece, r"(?s)\A[^=]*=(.*)\z", 1)).alias("value"),
        ),
    )
    page_pair = F.struct(F.lit("page").alias("key"), page.cast("string").alias("value"))

    def render(all_pairs: Column) -> Column:
        keys = F.array_distinct(F.transform(all_pairs, lambda pair: pair["key"]))

        def last_value(key: Column) -> Column:
            same = F.filter(all_pairs, lambda pair: pair["key"] == key)
            return F.concat(_form_encode(key), F.lit("="), _form_encode(F.element_at(same, -1)["value"]))

        return F.array_join(F.transform(keys, last_value), "&")

    encoded = let(F.concat(pairs, F.array(page_pair)), render)
    return F.concat(path, F.lit("?"), encoded, fragment)


def normalize_link(href: Column, base_url: Column, site_domain: str) -> Column:
    """Absolute link with the base's scheme and host for links of the site itself.

    A link that is not absolute is put behind the base's scheme and host as it is. An absolute
    link whose host part ends with ``site_domain`` takes the base's scheme and host. Other
    absolute links are left alone.
    """
    root = F.concat(
        F.lower(F.regexp_extract(base_url, _BASE, 1)), F.lit("://"), F.regexp_extract(base_url, _BASE, 2)
    )
    absolute = F.rlike(href, F.lit(r"\Ahttps?://"))
    own = F.endswith(F.regexp_extract(href, _URL, 2), F.lit(site_domain))
    # An empty query or fragment is dropped when a link is put together again.
    rest = F.regexp_replace(F.regexp_replace(F.regexp_extract(href, _URL, 3), r"#\z", ""), r"\?(?=#|\z)", "")
    foreign = absolute & ~own
    return F.when(foreign, href).otherwise(F.concat(root, F.when(absolute, rest).otherwise(href)))


def listing_url(url: Column, registered: Column) -> Column:
    """A feed address stands for its registered listing; any other address is a listing already."""
    is_feed = F.contains(url, F.lit("/rss/")) | F.endswith(url, F.lit(".rss"))
    return F.when(is_feed, registered).otherwise(url)
