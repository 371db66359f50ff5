"""Ingest and deduplication as streams."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chroniq.plans.ingest import IngestError, run_ingest
from chroniq.schemas import FEEDS
from chroniq.sinks.commits import BatchCommitted


def feed_stream(spark: SparkSession, path: str, polls_per_batch: int = 1) -> DataFrame:
    """Polled feeds as they arrive, one poll file per batch: a batch has one feed per language."""
    return spark.readStream.schema(FEEDS).option("maxFilesPerTrigger", polls_per_batch).parquet(path)


def start_ingest(
    feeds: DataFrame,
    crawl: Callable[[SparkSession], tuple[DataFrame, DataFrame]],
    root: str,
    site_domain: str,
    checkpoint: str,
    skip_failed_batches: bool = False,
    **options: str,
) -> StreamingQuery:
    """Run the batch ingest on every micro-batch until the input is used up.

    ``crawl`` gives the listings and pages as of now. A batch is known by the stream's own id, which lies in the checkpoint, and its
    number: one that comes again after it was committed is passed over, and a stream with a new checkpoint is another source. A batch
    in which no language can be processed fails the stream, unless ``skip_failed_batches``; it changes nothing but the quarantine.
    """

    def ingest(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = spark.read.text(f"{checkpoint}/metadata").first().value
        listings, pages = crawl(spark)
        try:
            source = f"stream {json.loads(stream)['id']}"
            run_ingest(spark, batch, listings, pages, root, site_domain, batch_id, source=source, **options)
        except BatchCommitted:
            pass
        except IngestError:
            if not skip_failed_batches:
                raise

    return (
        feeds.writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def dedup_stream(records: DataFrame, delay: str = "7 days") -> DataFrame:
    """Records without the repeats of equal date and language that arrive within ``delay``.

    The watermark follows the time of arrival. With the record's own date, old records that
    arrive late would be dropped although they repeat nothing.
    """
    timed = records.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", delay)
    return timed.dropDuplicatesWithinWatermark(["date", "lang"])
