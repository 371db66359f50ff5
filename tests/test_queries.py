"""All registered queries against their SQL, and the plans that matter at scale."""

import pytest
from oracle import compare, connect

import __spark_entry__ as driver
from chroniq.operators import dedup, lookup, words
from chroniq.plans import driver_tables as D
from chroniq.plans.catalog import QUERIES
from chroniq.plans.catalog_sql import ORACLES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert compare(driver.queries()[name](spark, sf_dir), con, driver.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["term_trend", "top_words", "rss_items", "listing_items", "article_text", "page_param"])
def test_no_python_in_plans(spark, sf_dir, name):
    text = plan(driver.queries()[name](spark, sf_dir))
    assert "PythonUDF" not in text and "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_language_filter_is_pushed_and_columns_are_pruned(spark, sf_dir):
    text = plan(driver.queries()["language_filter"](spark, sf_dir))
    assert "EqualTo(lang,fr)" in text
    text = plan(driver.queries()["rows_per_language"](spark, sf_dir))
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in text or "ReadSchema: struct<lang:string>" in text


def test_top_words_never_sorts_all_words(spark, sf_dir):
    for tie in ("word", "first"):
        text = plan(words.top_words(D.speeches(spark, sf_dir), "en", tie=tie))
        assert "TakeOrderedAndProject" in text
        assert "SortAggregate" not in text


@pytest.mark.parametrize("name", ["corpus_scan", "language_filter", "term_trend", "top_words", "page_text", "rss_items", "listing_items", "element_audit"])
def test_scans_are_not_dealt_anew(spark, sf_dir, name):
    text = plan(driver.queries()[name](spark, sf_dir))
    assert "REPARTITION" not in text and "RoundRobin" not in text


@pytest.mark.parametrize("bound", [None, 0])
def test_article_html_is_chosen_by_narrow_columns(spark, sf_dir, monkeypatch, bound):
    if bound is not None:
        monkeypatch.setattr(lookup.lookup_join, "__defaults__", (bound,))
    text = plan(driver.queries()["newest_articles"](spark, sf_dir))
    assert "SortAggregate" not in text


def test_feed_is_parsed_once(spark, sf_dir):
    for name in ("rss_items", "feed_status"):
        # one parse of the body, one of a nested channel
        assert plan(driver.queries()[name](spark, sf_dir)).count("from_xml") == 2


def test_dedup_shuffles_no_text(spark, sf_dir):
    text = plan(dedup.dedup_first(D.speeches(spark, sf_dir)))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_stream_reads_a_table_of_several_files(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"t{i % 7}", "en" if i % 2 else "fr", "s", i % 5) for i in range(40)], "doc_id long, text string, lang string, source string, n_chars long")
    want = D.SPEECH_SELECT[1], D.SPEECH_SELECT[5]
    for case, files in (("one", 1), ("many", 3)):
        path = f"{tmp_path}/{case}"
        rows.repartition(files).write.parquet(f"{path}/documents.parquet")
        got = QUERIES["stream_dedup"](spark, path)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.selectExpr(*want).distinct().collect()))
    rows.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert QUERIES["stream_dedup"](spark, f"{tmp_path}/none").count() == 0
