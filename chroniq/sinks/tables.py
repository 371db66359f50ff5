"""The published corpus: appended to by runs, rewritten as a new version, partitioned by language.

``<root>/data/version=V/commit=N/attempt=A/lang=L`` holds rows, or ``.../attempt=A/layout=mixed`` those of a commit with more than
``MAX_LANGUAGES`` languages, and ``<root>/commits`` the log that makes them visible. Every attempt
writes into a folder of its own, so nothing that was committed or is being read is overwritten. Null and empty language codes are read back as null.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chroniq.operators.lookup import lookup_join
from chroniq.schemas import CORPUS, QUARANTINE
from chroniq.session import remove_path
from chroniq.sinks.commits import Commit, ConcurrentCommit, attempt_name, check_new, commit, last_commit, live_folders
from chroniq.sources.corpus import empty_corpus
from chroniq.sources.state import marks_to_commit, write_marks

MAX_LANGUAGES = 100  # that a commit has folders for; every task writes a file for each language it holds
MIXED = "/layout=mixed"
_FILE = "__file"


@dataclass(frozen=True)
class AppendReport:
    old_rows: int
    new_rows: int


def current_version(spark: SparkSession, root: str) -> int:
    return last_commit(spark, root).version


def version_path(root: str, version: int) -> str:
    return f"{root}/data/version={version}"


def published(spark: SparkSession, root: str) -> DataFrame:
    """The corpus as last committed. A filter on ``lang`` prunes folders, and pages of files of mixed languages."""
    return _published_files(spark, root).select(*CORPUS.names)


def _published_files(spark: SparkSession, root: str) -> DataFrame:
    """The corpus with the file of each row, as ``__file``. Both layouts are read, each with the columns of its own folders."""
    found, dropped = live_folders(spark, root)
    if not found:
        return empty_corpus(spark).withColumn(_FILE, F.lit(None).cast("string"))
    base = f"{root}/data"
    parts = []
    for mixed in (False, True):
        paths = [f"{base}/{folder}" for folder in found if folder.endswith(MIXED) == mixed]
        if paths:
            rows = spark.read.schema(CORPUS).option("basePath", base).parquet(*paths)
            if dropped:
                rows = rows.where(~file_name().isin(dropped))
            parts.append(rows.select(*CORPUS.names, file_name().alias(_FILE)))
    return reduce(DataFrame.unionByName, parts)


def file_name() -> Column:
    """The file of a row of the published corpus, below ``data``. A filter on it alone prunes files before any is read."""
    return F.element_at(F.split("_metadata.file_path", "/data/(?=version=)"), -1)


def _layout(rows: DataFrame) -> str:
    """What a commit's folder is followed by: nothing where each language gets a folder, ``MIXED`` where they are too many."""
    return MIXED if rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES else ""


def _write(rows: DataFrame, path: str) -> DataFrame:
    """Write rows and give back what was written, without the texts. Rows lie by language: in folders, or in order within a file."""
    out = rows.select(*CORPUS.names)
    if path.endswith(MIXED):
        out.withColumn("lang", F.nullif("lang", F.lit(""))).sortWithinPartitions("lang").write.mode("error").parquet(path)
    else:
        out.write.mode("error").partitionBy("lang").parquet(path)
    return rows.sparkSession.read.schema("ord bigint").parquet(path)


@contextmanager
def _cleared(spark: SparkSession, *paths: str) -> Iterator[None]:
    """Remove an attempt's folders if another writer was faster."""
    try:
        yield
    except ConcurrentCommit:
        for path in paths:
            remove_path(spark, path)
        raise


def append_rows(
    rows: DataFrame, root: str, source: str = "batch", source_batch: int | None = None, marks: DataFrame | None = None
) -> AppendReport:
    """Add rows, and with them ``marks``, as one commit; no duplicates are looked for.

    Nothing is committed for zero rows. With a ``source_batch`` the batch is refused if the source's batch of that number, or a
    later one, was committed; without one every call is a run of its own. Old counts come from the log. Where another writer commits
    meanwhile, :class:`ConcurrentCommit` is raised, and nothing of this attempt stays.
    """
    spark = rows.sparkSession
    check_new(spark, root, source, source_batch)
    last = last_commit(spark, root)
    seq = last.seq + 1
    attempt = attempt_name(seq)
    path, layout = f"{version_path(root, last.version)}/{attempt}", _layout(rows)
    written = _write(rows, path + layout)
    found = written.agg(F.count("*").alias("n"), F.max("ord").alias("top")).first()
    if found.n == 0:
        remove_path(spark, path)
        return AppendReport(last.total_rows, last.total_rows)
    if marks is not None:
        write_marks(marks_to_commit(written, marks), root, attempt)
    entry = Commit(seq, last.version, last.total_rows + found.n, max(last.max_ord, found.top))
    with _cleared(spark, path, f"{root}/marks/{attempt}"):
        commit(spark, root, "append", entry, found.n, source, source_batch, attempt + layout, attempt if marks is not None else None)
    return AppendReport(last.total_rows, entry.total_rows)


def publish(rows: DataFrame, root: str, files_per_language: int | None = None) -> int:
    """Write ``rows`` as the next version and make it the current one.

    With ``files_per_language`` small files are compacted: rows are spread over that many files
    per language, so that a common language is no single task.
    """
    spark = rows.sparkSession
    last = last_commit(spark, root)
    seq, version = last.seq + 1, last.version + 1
    out = rows.select(*CORPUS.names)
    if files_per_language:
        part = F.pmod(F.xxhash64("ord"), F.lit(files_per_language))
        out = out.withColumn("__part", part).repartition("lang", "__part").drop("__part")
    attempt = attempt_name(seq)
    path, layout = f"{version_path(root, version)}/{attempt}", _layout(rows)
    found = _write(out, path + layout).agg(F.count("*").alias("n"), F.max("ord").alias("top")).first()
    with _cleared(spark, path):
        commit(spark, root, "rewrite", Commit(seq, version, found.n, max(last.max_ord, found.top or -1)), found.n, folder=attempt + layout)
    return version


def rewrite_touched(
    spark: SparkSession, root: str, keys: DataFrame, on: list[str], change: Callable[[DataFrame], DataFrame]
) -> int:
    """Publish the next version with ``change`` applied to those files that hold a row of ``keys``.

    ``change`` leaves all rows alone that ``keys`` does not name. The touched files are found by the columns ``on`` alone; the others are
    carried over unread, by their names. The entry lists the files that were replaced, of which there are never more than the corpus has.
    Without a touched file the version has no rows of its own.
    """
    last = last_commit(spark, root)
    seq, version = last.seq + 1, last.version + 1
    corpus = _published_files(spark, root)
    touched = []
    if last.total_rows:
        found = lookup_join(corpus.select(*on, _FILE), keys.select(*on), on, "left_semi")
        touched = sorted(r[0] for r in found.select(_FILE).distinct().collect())
    attempt = attempt_name(seq)
    path, layout, before, after, top = f"{version_path(root, version)}/{attempt}", "", 0, 0, None
    if touched:
        rows = corpus.where(F.col(_FILE).isin(touched)).select(*CORPUS.names)
        before, changed = rows.count(), change(rows)
        layout = _layout(changed)
        found = _write(changed, path + layout).agg(F.count("*").alias("n"), F.max("ord").alias("top")).first()
        after, top = found.n, found.top
    if not after:
        remove_path(spark, path)
    entry = Commit(seq, version, last.total_rows - before + after, max(last.max_ord, -1 if top is None else top))
    with _cleared(spark, path):
        commit(spark, root, "files", entry, after, folder=attempt + layout if after else None, dropped=touched)
    return version


def seed_marks(spark: SparkSession, root: str, marks: dict[str, int] | DataFrame) -> None:
    """First marks of new languages, as a commit of their own: a dict, or a frame ``lang, high_water``."""
    last = last_commit(spark, root)
    if isinstance(marks, dict):
        marks = spark.createDataFrame(list(marks.items()), "lang STRING, high_water BIGINT")
    attempt = attempt_name(last.seq + 1)
    write_marks(marks.withColumnRenamed("high_water", "latest"), root, attempt)
    with _cleared(spark, f"{root}/marks/{attempt}"):
        commit(spark, root, "seed", replace(last, seq=last.seq + 1), 0, marks=attempt)


def write_quarantine(rejects: DataFrame, path: str, run: str) -> None:
    """Rejected pages and items with the reason, one folder per run; a run that is tried again replaces its own."""
    stamped = rejects.withColumn("ts", F.current_timestamp()).select(*QUARANTINE.names)
    name = re.sub(r"[^A-Za-z0-9_.-]", "_", run)
    stamped.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={name}")

