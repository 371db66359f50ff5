"""Fixed schemas of the engine's tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"BIGINT": T.LongType(), "INT": T.IntegerType(), "STRING": T.StringType(), "TIMESTAMP": T.TimestampType(), "STRINGS": T.ArrayType(T.StringType())}


def _schema(columns: str) -> T.StructType:
    """Fields from ``name TYPE, ...``. Spark's own parser would need a running session on import."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Row order is explicit (`ord`): a Spark table has none of its own.
CORPUS = _schema("ord BIGINT, date BIGINT, link STRING, topic STRING, full_text STRING, lang STRING")
RECORD_COLUMNS = ["date", "link", "topic", "full_text", "lang"]

FEEDS = _schema("lang STRING, status INT, body STRING")
LISTINGS = _schema("lang STRING, page INT, url STRING, status INT, html STRING")
PAGES = _schema("url STRING, html STRING, status INT, seen BIGINT")
INGEST_STATE = _schema("lang STRING, high_water BIGINT")
SOURCES = _schema("lang STRING, feed_url STRING, listing_url STRING")
QUARANTINE = _schema("url STRING, lang STRING, error_context STRING, ts TIMESTAMP, html STRING, date BIGINT, topic STRING")
COMMITS = _schema(
    "seq BIGINT, source STRING, source_batch BIGINT, kind STRING, version BIGINT, rows BIGINT, total_rows BIGINT, max_ord BIGINT, folder STRING, marks STRING, dropped STRINGS, at TIMESTAMP"
)
