"""The registered addresses of each language: its feed and its listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chroniq.functions.urls import listing_url
from chroniq.operators.lookup import key_lookup_join
from chroniq.schemas import SOURCES


def registry(spark: SparkSession, addresses: dict[str, tuple[str, str]]) -> DataFrame:
    """``{lang: (feed address, listing address)}`` as a table."""
    return spark.createDataFrame([(lang, *pair) for lang, pair in addresses.items()], SOURCES)


def with_addresses(df: DataFrame, sources: DataFrame) -> DataFrame:
    """Adds ``feed_url`` and the ``listing_url`` to fall back to; null for unknown languages.

    A source whose feed address is a listing already, as for a backfill, falls back to itself.
    """
    joined = key_lookup_join(df, sources.select(*SOURCES.names), ["lang"], "left")
    return joined.withColumn("listing_url", listing_url(F.col("feed_url"), F.col("listing_url")))
