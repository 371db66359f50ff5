"""Sinks and maintenance runs: what is written is read back."""

import json
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chroniq.operators import trend
from chroniq.plans import maintenance
from chroniq.schemas import CORPUS, PAGES
from chroniq.session import shared_dir, stage, work_folder
from chroniq.sinks import commits, exports, tables
from chroniq.sinks.commits import BatchCommitted, ConcurrentCommit, last_commit
from chroniq.sources.corpus import path_exists, read_jsonl
from chroniq.sources.state import read_marks
from chroniq.streaming.ingest_stream import dedup_stream


def lines(path, pattern="part-*"):
    return [line for file in sorted(Path(path).glob(pattern)) for line in file.read_text("utf-8").splitlines()]


@pytest.fixture
def rows(spark):
    data = [
        (0, 0, "http://l/0", "тема", "текст «a»", "uk"),
        (1, 86400, "http://l/1", "t1", None, "en"),
        (2, 86400, "http://l/2", "t2", "two", "en"),
        (3, 86400 * 40, "http://l/3", "t3", "", "en"),
    ]
    return spark.createDataFrame(data, CORPUS)


def test_jsonl(spark, rows, tmp_path):
    path = str(tmp_path / "j")
    exports.write_jsonl(rows, path)
    exports.write_jsonl(rows.where("ord = 0"), path)
    text = sorted(lines(path))
    assert len(text) == 5
    record = json.loads(text[0])
    assert list(record) == ["date", "link", "topic", "full_text", "lang"]
    assert any("текст «a»" in t for t in text) and any('"full_text":null' in t for t in text)
    assert {r.lang for r in read_jsonl(spark, path, "xx").collect()} == {"xx"}
    assert read_jsonl(spark, path).count() == 5


def test_text_csv_json_and_links(spark, rows, tmp_path):
    exports.write_text(rows, str(tmp_path / "t"), "en")
    assert lines(tmp_path / "t")[:8] == [
        "date: 1970-01-02", "topic: t1", "text: ", "", "date: 1970-01-02", "topic: t2", "text: two", "",
    ]
    report = trend.term_trend(rows, {"w": "w", "к": "к"}, bucket="місяць")
    exports.write_csv(report, str(tmp_path / "c"), "місяць")
    assert lines(tmp_path / "c") == ["місяць,w,к", "70-01,1,1"]
    exports.write_columnar_json(trend.columnar(report, "місяць", ["w", "к"]), str(tmp_path / "o"))
    assert lines(tmp_path / "o") == ['{"місяць":["70-01"],"w":[1],"к":[1]}']
    exports.write_missing_links(rows, str(tmp_path / "m"))
    assert lines(tmp_path / "m") == ["http://l/1", "http://l/3"]


def test_append_and_publish(spark, rows, tmp_path):
    root = str(tmp_path / "corpus")
    assert tables.append_rows(rows, root) == tables.AppendReport(0, 4)
    assert tables.append_rows(rows.limit(0), root) == tables.AppendReport(4, 4)
    assert not path_exists(spark, f"{root}/data/version=0/commit=1")
    assert tables.append_rows(rows, root, "s", 1) == tables.AppendReport(4, 8)
    assert tables.publish(tables.published(spark, root).where("ord < 2"), root, files_per_language=2) == 1
    assert tables.published(spark, root).count() == 4
    with pytest.raises(BatchCommitted):
        tables.append_rows(rows, root, "s", 1)
    assert tables.append_rows(rows, root, "s", 2) == tables.AppendReport(4, 8)
    assert tables.append_rows(rows, root, "t", 1) == tables.AppendReport(8, 12)


@pytest.mark.parametrize("change", ["append", "publish", "seed"])
def test_a_slower_writer_loses_nothing_of_the_faster(spark, rows, tmp_path, monkeypatch, change):
    """One writer commits between another's look at the log and its commit."""
    root = str(tmp_path / "corpus")
    tables.append_rows(rows.limit(1), root)
    write, marks = tables.commit, spark.createDataFrame([("en", 7)], "lang string, latest bigint")

    def late(*args, **kwargs):
        monkeypatch.setattr(tables, "commit", write)
        assert tables.append_rows(rows, root, marks=marks) == tables.AppendReport(1, 5)
        return write(*args, **kwargs)

    monkeypatch.setattr(tables, "commit", late)
    slower = {
        "append": lambda: tables.append_rows(rows.limit(2), root, marks=marks.withColumn("latest", F.lit(9))),
        "publish": lambda: tables.publish(rows.limit(2), root),
        "seed": lambda: tables.seed_marks(spark, root, {"en": 9}),
    }[change]
    with pytest.raises(ConcurrentCommit):
        slower()
    assert tables.published(spark, root).count() == last_commit(spark, root).total_rows == 5
    assert [tuple(r) for r in read_marks(spark, root).collect()] == [("en", 7)]
    slower()  # run again, it commits
    assert tables.published(spark, root).count() == last_commit(spark, root).total_rows == {"append": 7, "publish": 2, "seed": 5}[change]


def test_a_claim_without_an_entry(spark, rows, tmp_path, monkeypatch):
    """Of a writer that is at work the claim stands; that of one that ended is taken over."""
    root = str(tmp_path / "corpus")
    commits._claim(spark, root, 0)
    with pytest.raises(ConcurrentCommit):
        tables.append_rows(rows, root)
    assert not path_exists(spark, f"{root}/data/version=0")
    monkeypatch.setattr(commits, "CLAIM_SECONDS", -1)
    assert tables.append_rows(rows, root) == tables.AppendReport(0, 4)


def test_cleanup_and_patch(spark, rows, tmp_path):
    root = str(tmp_path / "corpus")
    tables.append_rows(rows, root)
    assert maintenance.run_cleanup(spark, root) == (True, 1)
    assert sorted(r.ord for r in tables.published(spark, root).collect()) == [0, 1, 3]
    assert maintenance.run_cleanup(spark, root) == (False, 2)
    patches = spark.createDataFrame([("http://l/1", "patched")], "link string, full_text string")
    assert maintenance.run_patch(spark, root, patches) == 3
    assert tables.published(spark, root).where("ord = 1").first().full_text == "patched"


def files_of(root):
    return {p: p.stat().st_size for p in Path(root, "data").rglob("*.parquet")}


def test_a_patch_writes_touched_files_only(spark, tmp_path):
    """Of 30 files the one with the patched link is written anew; all others are the same files as before."""
    root = str(tmp_path / "corpus")
    columns = ["ord", "ord AS date", "concat('l', ord) AS link", "'t' AS topic", "repeat(uuid(), 300) AS full_text", "'en' AS lang"]
    corpus = spark.range(300).withColumnRenamed("id", "ord").repartition(30, "ord").selectExpr(*columns)
    tables.append_rows(corpus, root)
    before = files_of(root)
    old = {r.ord: r.full_text for r in tables.published(spark, root).collect()}
    patches = spark.createDataFrame([("l7", "new"), ("nobody", "x"), (None, "y")], "link string, full_text string")
    assert maintenance.run_patch(spark, root, patches) == 1
    written = {p: n for p, n in files_of(root).items() if p not in before}
    assert len(written) == 1
    assert sum(written.values()) < sum(before.values()) / 10
    assert {r.ord: r.full_text for r in tables.published(spark, root).collect()} == {**old, 7: "new"}
    assert last_commit(spark, root).total_rows == 300

    # A second change of the same file, a change of no file, an append and a deletion follow on it.
    assert maintenance.run_patch(spark, root, patches.withColumn("full_text", F.lit(None).cast("string"))) == 2
    assert maintenance.run_patch(spark, root, patches.where("link = 'nobody'")) == 3
    assert tables.append_rows(corpus.where("ord = 7").withColumn("ord", F.lit(900)), root) == tables.AppendReport(300, 301)
    assert tables.published(spark, root).where("full_text IS NULL").first().ord == 7
    assert maintenance.run_deny(spark, root, patches.select("link")) == 4
    assert sorted(r.ord for r in tables.published(spark, root).select("ord").collect()) == [i for i in range(300) if i != 7]
    last = last_commit(spark, root)
    assert (last.total_rows, last.max_ord, last.version) == (299, 900, 4)
    # A full rewrite leaves none of the older files in use.
    assert tables.publish(tables.published(spark, root), root) == 5
    assert all("version=5" in name for name in tables.published(spark, root).inputFiles())
    assert maintenance.run_deny(spark, root, tables.published(spark, root).select("link")) == 6
    assert tables.published(spark, root).count() == last_commit(spark, root).total_rows == 0
    assert tables.append_rows(corpus.limit(2), root) == tables.AppendReport(0, 2)
    assert tables.published(spark, root).count() == 2


def test_many_languages_lie_in_few_files(spark, tmp_path):
    """Each task wrote a file for every language it held. Both layouts are read, patched and deleted from together."""
    root = str(tmp_path / "corpus")
    langs = "CASE WHEN id = 0 THEN NULL WHEN id = 1 THEN '' ELSE concat('f/=', id % 150) END"
    many = spark.range(600).repartition(4).selectExpr("id AS ord", "id AS date", "concat('l', id) AS link", "'t' AS topic", "'x' AS full_text", f"{langs} AS lang")
    assert tables.append_rows(many, root) == tables.AppendReport(0, 600)
    assert len(files_of(root)) <= 4
    few = many.where("ord < 5").selectExpr("ord + 1000 AS ord", "date", "link", "topic", "full_text", "'en' AS lang")
    assert tables.append_rows(few, root) == tables.AppendReport(600, 605)
    assert any("lang=en" in str(p) for p in files_of(root))
    want = {r.ord: r.lang or None for r in many.unionByName(few).collect()}
    assert {r.ord: r.lang for r in tables.published(spark, root).collect()} == want
    assert sorted(r.ord for r in tables.published(spark, root).where("lang = 'f/=7'").collect()) == [7, 157, 307, 457]
    assert tables.published(spark, root).where("lang = 'en'").count() == 5
    patches = spark.createDataFrame([("l3", "new")], "link string, full_text string")
    assert maintenance.run_patch(spark, root, patches) == 1
    assert sorted(r.ord for r in tables.published(spark, root).where("full_text = 'new'").collect()) == [3, 1003]
    assert maintenance.run_deny(spark, root, patches.select("link")) == 2
    del want[3], want[1003]
    assert {r.ord: r.lang for r in tables.published(spark, root).collect()} == want
    assert tables.publish(tables.published(spark, root), root, 2) == 3
    assert {r.ord: r.lang for r in tables.published(spark, root).collect()} == want
    assert last_commit(spark, root).total_rows == len(want)


def test_a_patch_that_meets_another_writer(spark, rows, tmp_path, monkeypatch):
    root, write = str(tmp_path / "corpus"), tables.commit
    tables.append_rows(rows, root)
    patches = spark.createDataFrame([("http://l/1", "patched")], "link string, full_text string")

    def late(*args, **kwargs):
        monkeypatch.setattr(tables, "commit", write)
        tables.append_rows(rows.limit(1), root)
        return write(*args, **kwargs)

    monkeypatch.setattr(tables, "commit", late)
    with pytest.raises(ConcurrentCommit):
        maintenance.run_patch(spark, root, patches)
    assert not path_exists(spark, f"{root}/data/version=1/commit=1")
    assert tables.published(spark, root).count() == 5
    assert maintenance.run_patch(spark, root, patches) == 1
    assert tables.published(spark, root).where("full_text = 'patched'").count() == 1


def test_patches_of_an_empty_corpus_and_repeated_patches(spark, rows, tmp_path):
    root = str(tmp_path / "corpus")
    patches = spark.createDataFrame([("http://l/1", "a", 1), ("http://l/1", "b", 2)], "link string, full_text string, at int")
    assert maintenance.run_patch(spark, root, patches, "at") == 1
    assert tables.published(spark, root).count() == 0
    with pytest.raises(ValueError):
        maintenance.run_patch(spark, root, patches)
    tables.append_rows(rows, root)
    assert maintenance.run_patch(spark, root, patches, "at") == 2
    assert tables.published(spark, root).where("ord = 1").first().full_text == "b"


def test_repair_resumes_from_staged_texts(spark, rows, tmp_path):
    root, staged = str(tmp_path / "corpus"), str(tmp_path / "stage")
    tables.append_rows(rows, root)
    # An earlier run ended after it had staged row 1.
    spark.createDataFrame([(1, "staged")], "ord bigint, new_text string").write.parquet(staged)
    page = '<div class="article_content">{}</div>'
    pages = spark.createDataFrame([("http://l/1", page.format("later"), 200, 0), ("http://l/3", page.format("three"), 200, 0)], PAGES)
    report = maintenance.run_repair(spark, root, pages, staged)
    assert report == maintenance.RepairReport(2, 2, 0, 1)
    texts = {r.ord: r.full_text for r in tables.published(spark, root).collect()}
    assert texts == {0: "текст «a»", 1: "staged", 2: "two", 3: "three"}
    assert not path_exists(spark, staged)
    assert maintenance.run_repair(spark, root, pages, staged) == maintenance.RepairReport(0, 0, 0, None)


def test_stage_uses_the_shared_folder(spark):
    staged = stage(spark.range(3), work_folder(spark, "test"), "x")
    assert staged.count() == 3
    assert all(shared_dir(spark) in file for file in staged.inputFiles())


def test_dedup_stream(spark, rows, tmp_path):
    source = str(tmp_path / "in")
    rows.unionByName(rows).write.parquet(source)
    stream = dedup_stream(spark.readStream.schema(CORPUS).parquet(source))
    writer = stream.writeStream.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
    writer.format("parquet").start(str(tmp_path / "out")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).select("date", "lang").collect()
    assert sorted(tuple(r) for r in got) == sorted({(r.date, r.lang) for r in rows.select(F.col("date"), "lang").collect()})


@pytest.mark.parametrize("stop", [True, False])
def test_shared_folder_is_empty_after_the_driver_ends(tmp_path, sf_dir, stop):
    shared = tmp_path / "shared"
    script = f"""
import sys
sys.path.insert(0, {str(Path(__file__).parents[1])!r})
from chroniq.plans.catalog import QUERIES
from chroniq.session import build_session
spark = build_session("t", master="local[2]", **{{"spark.checkpoint.dir": {str(shared)!r}, "spark.ui.enabled": "false"}})
for name in ("jsonl_round_trip", "dedup_first", "append_published", "newest_articles"):
    QUERIES[name](spark, {sf_dir!r}).count()
import os
assert any(files for _, _, files in os.walk({str(shared)!r}))
{"spark.stop()" if stop else ""}
"""
    subprocess.run([sys.executable, "-c", script], check=True, timeout=300)
    assert not [f for f in shared.rglob("*") if f.is_file()]
