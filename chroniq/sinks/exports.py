"""Exports of the corpus and of reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chroniq.functions.dates import day_key
from chroniq.operators.filters import missing_text
from chroniq.schemas import RECORD_COLUMNS


def write_jsonl(df: DataFrame, path: str) -> None:
    """Append records as JSON lines; text stays unescaped and nulls are written."""
    df.select(*RECORD_COLUMNS).write.mode("append").option("ignoreNullFields", "false").json(path)


def text_entry(tz: str = "UTC") -> Column:
    """One record as text. The line end that the text writer adds gives the blank line."""
    return F.concat(
        F.lit("date: "), F.coalesce(day_key(F.col("date"), tz), F.lit("")),
        F.lit("\ntopic: "), F.coalesce("topic", F.lit("")),
        F.lit("\ntext: "), F.coalesce("full_text", F.lit("")),
        F.lit("\n"),
    )


def text_entries(df: DataFrame, lang: str, tz: str = "UTC") -> DataFrame:
    rows = df.where(F.col("lang") == lang).drop("lang", "link")
    return rows.select("ord", text_entry(tz).alias("value"))


def write_text(df: DataFrame, path: str, lang: str, tz: str = "UTC") -> None:
    """Text export of one language; the files, read by name, are in corpus order."""
    text_entries(df, lang, tz).orderBy("ord").select("value").write.mode("overwrite").text(path)


def write_csv(report: DataFrame, path: str, order: str) -> None:
    """A finished report as one CSV file with a header. For reports only, which have a row per month."""
    report.coalesce(1).sortWithinPartitions(order).write.mode("overwrite").option("header", True).csv(path)


def json_line(columnar: DataFrame) -> DataFrame:
    """The one-row columnar report as one compact JSON object."""
    return columnar.select(F.to_json(F.struct(*columnar.columns)).alias("value"))


def write_columnar_json(columnar: DataFrame, path: str) -> None:
    json_line(columnar).write.mode("overwrite").text(path)


def missing_links(df: DataFrame) -> DataFrame:
    return missing_text(df).select("ord", "link")


def write_missing_links(df: DataFrame, path: str) -> None:
    """One address per line, in corpus order. Every line ends with a line feed, the last too."""
    missing_links(df).orderBy("ord").select("link").write.mode("overwrite").text(path)
