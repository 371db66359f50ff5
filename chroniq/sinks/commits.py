"""The commit log of a corpus: one entry per finished change of rows or marks.

The engine gives out the numbers. What an attempt writes lies in folders of its own name below the next number. The entry names them,
and readers take the folders from the entries; so rows and marks become visible together, no attempt touches what another
wrote, and what an attempt left that ended early is never read. Of two that want one number the first to claim it writes the entry. The
outside's own numbers (a stream's id and its batch) are only noted, to refuse a batch that was committed before.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chroniq.schemas import COMMITS
from chroniq.sources.corpus import path_exists

CLAIM_SECONDS = 600  # after which a claim without an entry counts as that of an attempt that ended


class ConcurrentCommit(Exception):
    """Another writer committed, or is committing, under this number. Nothing of either is lost: run again."""


class BatchCommitted(Exception):
    """The source's batch, or a later one, was committed before."""


@dataclass(frozen=True)
class Commit:
    seq: int = -1
    version: int = 0
    total_rows: int = 0
    max_ord: int = -1


def attempt_name(seq: int) -> str:
    """A folder that no other attempt has."""
    return f"commit={seq}/attempt={uuid.uuid4().hex}"


def log(spark: SparkSession, root: str) -> DataFrame:
    """All entries. Reading it costs one small file per run, whatever the size of the corpus."""
    path = f"{root}/commits"
    return spark.read.schema(COMMITS).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], COMMITS)


def last_commit(spark: SparkSession, root: str) -> Commit:
    newest = F.max_by(F.struct("seq", "version", "total_rows", "max_ord"), "seq").alias("c")
    row = log(spark, root).agg(newest).first().c
    return Commit() if row is None else Commit(row.seq, row.version, row.total_rows, row.max_ord)


def check_new(spark: SparkSession, root: str, source: str, source_batch: int | None) -> None:
    """Refuse a batch at or below the last committed one of its source."""
    if source_batch is None:
        return
    last = log(spark, root).where(F.col("source") == source).agg(F.max("source_batch").alias("b")).first().b
    if last is not None and source_batch <= last:
        raise BatchCommitted(f"batch {source_batch} of {source}: batch {last} is committed")


def folders(spark: SparkSession, root: str, column: str, condition: str = "true") -> list[str]:
    """Folders named in the ``folder`` or ``marks`` column of the entries, oldest first."""
    rows = log(spark, root).where(f"{column} IS NOT NULL AND {condition}").select("seq", column)
    return [r[1] for r in sorted(rows.collect())]


def live_folders(spark: SparkSession, root: str) -> tuple[list[str], list[str]]:
    """Folders that the corpus consists of, below ``data``, and the files in them that later commits replaced.

    A full rewrite starts anew; appends and rewrites of some files add to what was there.
    """
    entries = log(spark, root)
    start = entries.where("kind = 'rewrite'").agg(F.max("seq").alias("s")).first().s
    if start is not None:
        entries = entries.where(F.col("seq") >= start)
    rows = sorted(entries.select("seq", "version", "folder", "dropped").where("folder IS NOT NULL OR dropped IS NOT NULL").collect())
    dropped = [file for r in rows for file in r.dropped or []]
    return [f"version={r.version}/{r.folder}" for r in rows if r.folder], dropped


def _claim(spark: SparkSession, root: str, seq: int) -> None:
    """Take a number: a file that only one writer can create."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/commits/_claims/{seq}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for again in (True, False):
        try:
            files.create(path, False).close()
            return
        except Py4JJavaError as error:
            if not files.exists(path):
                raise
            old = time.time() - files.getFileStatus(path).getModificationTime() / 1000 > CLAIM_SECONDS
            if not (again and old) or path_exists(spark, f"{root}/commits/seq={seq}"):
                raise ConcurrentCommit(f"commit {seq} of {root} is another writer's") from error
            files.delete(path, False)


def commit(
    spark: SparkSession,
    root: str,
    kind: str,
    entry: Commit,
    rows: int,
    source: str = "batch",
    source_batch: int | None = None,
    folder: str | None = None,
    marks: str | None = None,
    dropped: list[str] | None = None,
) -> None:
    """Write the entry. Where another writer was faster, nothing is written."""
    if path_exists(spark, f"{root}/commits/seq={entry.seq}"):
        raise ConcurrentCommit(f"commit {entry.seq} of {root} is there")
    _claim(spark, root, entry.seq)
    values = [(source, source_batch, kind, entry.version, rows, entry.total_rows, entry.max_ord, folder, marks, dropped)]
    columns = (
        "source string, source_batch bigint, kind string, version bigint, rows bigint, total_rows bigint, max_ord bigint, folder string, marks string, dropped array<string>"
    )
    one = spark.createDataFrame(values, columns).withColumn("at", F.current_timestamp())
    one.coalesce(1).write.mode("error").parquet(f"{root}/commits/seq={entry.seq}")
