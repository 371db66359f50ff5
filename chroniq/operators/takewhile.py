"""Order-dependent reading of newest-first feeds.

Everything is a minimum per language, combined on the map side, and a lookup join: no window
gathers a language in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chroniq.operators.lookup import key_lookup_join


def take_while_newer(items: DataFrame, marks: DataFrame, pos: str = "pos") -> DataFrame:
    """Items before the first one, in feed order, that is not newer than its language's mark.

    That item and all after it are left out, newer ones among them as well. Items of a language
    without a mark are left out; give it a mark to start with.
    """
    marked = key_lookup_join(items, marks.select("lang", "high_water"), ["lang"], "inner")
    old = marked.where(F.col("date") <= F.col("high_water"))
    stops = old.groupBy("lang").agg(F.min(pos).alias("__stop"))
    kept = key_lookup_join(marked, stops, ["lang"], "left")
    return kept.where(F.col("__stop").isNull() | (F.col(pos) < F.col("__stop"))).drop("__stop", "high_water")


def latest_marks(items: DataFrame, pos: str = "pos") -> DataFrame:
    """Date of each language's first item, which need not be its highest date."""
    return items.groupBy("lang").agg(F.min_by("date", pos).alias("latest"))


def page_stops(pages: DataFrame, ended: str) -> DataFrame:
    """First page of each language for which the flag ``ended`` holds."""
    return pages.where(ended).groupBy("lang").agg(F.min("page").alias("stop_page"))


def before_stop(rows: DataFrame, stops: DataFrame) -> DataFrame:
    """Rows on the pages before their language's ``stop_page``; all if it has none."""
    joined = key_lookup_join(rows, stops.select("lang", "stop_page"), ["lang"], "left")
    keep = F.col("stop_page").isNull() | (F.col("page") < F.col("stop_page"))
    return joined.where(keep).drop("stop_page")
