"""High-water marks: one per language and commit, the newest committed one holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chroniq.schemas import INGEST_STATE
from chroniq.sinks.commits import folders


def read_marks(spark: SparkSession, root: str) -> DataFrame:
    """Current marks of a corpus."""
    paths = [f"{root}/marks/{folder}" for folder in folders(spark, root, "marks")]
    if not paths:
        return spark.createDataFrame([], INGEST_STATE)
    log = spark.read.schema("lang STRING, high_water BIGINT, commit BIGINT").option("basePath", f"{root}/marks").parquet(*paths)
    return log.groupBy("lang").agg(F.max_by("high_water", "commit").alias("high_water"))


def marks_to_commit(new_rows: DataFrame, processed: DataFrame) -> DataFrame:
    """Marks to write: those of every processed language if there is any new row, else none."""
    any_new = new_rows.agg((F.count("*") > 0).alias("any")).scalar()
    return processed.where(any_new)


def write_marks(marks: DataFrame, root: str, attempt: str) -> None:
    """Write marks into an attempt's folder; they hold once a commit names it."""
    marks.select("lang", F.col("latest").alias("high_water")).write.mode("error").parquet(f"{root}/marks/{attempt}")
