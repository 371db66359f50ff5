"""The corpus table and older forms of it."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chroniq.schemas import CORPUS, RECORD_COLUMNS


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CORPUS).parquet(path).select(*CORPUS.names)


def empty_corpus(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CORPUS)


def read_jsonl(spark: SparkSession, path: str, lang: str | None = None) -> DataFrame:
    """Exported records; ``lang`` sets the language of all of them."""
    schema = T.StructType([f for f in CORPUS.fields if f.name in RECORD_COLUMNS])
    rows = spark.read.schema(schema).json(path).select(*RECORD_COLUMNS)
    return rows if lang is None else rows.withColumn("lang", F.lit(lang))


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True
