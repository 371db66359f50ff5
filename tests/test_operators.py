"""Operators against brute force on small fixtures, on both sides of every size check."""

import re
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from chroniq import constants as K
from chroniq.operators import dedup, filters, lookup, quality, repair, takewhile, trend, words
from chroniq.schemas import CORPUS, PAGES


def corpus(spark, rows):
    """Rows of ``(date, lang, full_text)``; the rest is filled in."""
    full = [(n, date, f"http://l/{n}", f"t{n}", text, lang) for n, (date, lang, text) in enumerate(rows)]
    return spark.createDataFrame(full, CORPUS)


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.fixture
def skewed(spark):
    """One key holds a third of the rows; spread over several partitions."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50)
    return spark.range(0, 3000, 1, 6).select("id", key.cast("bigint").alias("k"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_join(spark, skewed, how):
    right = spark.range(5, 40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    right = right.unionByName(right.where("k = 7"))
    plain = sorted(values(skewed.join(right, "k", how), "*"), key=str)
    assert sorted(values(lookup.skew_join(skewed, right, ["k"], how, salts=4), "*"), key=str) == plain
    assert sorted(values(lookup.lookup_join(skewed, right, ["k"], how), "*"), key=str) == plain
    assert sorted(values(lookup.lookup_join(skewed, right, ["k"], how, max_bytes=1), "*"), key=str) == plain
    assert sorted(values(lookup.key_lookup_join(skewed, right, ["k"], how, max_rows=3), "*"), key=str) == plain


def test_skew_join_handles_null_and_composite_keys(spark):
    left = spark.createDataFrame([(None, 1), ("a", 1), ("a", 2)], "x string, y int")
    right = spark.createDataFrame([("a", 1, "p"), (None, 1, "q")], "x string, y int, v string")
    got = lookup.skew_join(left, right, ["x", "y"], "left")
    assert sorted(values(got, "x", "y", "v"), key=str) == sorted([(None, 1, None), ("a", 1, "p"), ("a", 2, None)], key=str)


def test_hot_key_is_spread(skewed, spark):
    right = spark.range(0, 50).select(F.col("id").alias("k"))
    joined = lookup.skew_join(skewed, right, ["k"], "inner", salts=4)
    plan = joined._jdf.queryExecution().analyzed().toString()
    assert "__salt" in plan


def test_unique_keys_are_not_salted(spark):
    left = spark.range(0, 3000, 1, 6).select(F.col("id").alias("k"))
    assert lookup.hot_keys(left, ["k"], 64) == {}
    assert "__salt" not in lookup.skew_join(left, left, ["k"], "inner")._jdf.queryExecution().analyzed().toString()


def test_a_hot_key_in_one_partition_is_split(spark):
    left = spark.range(0, 4000, 1, 4).select("id", F.when(F.col("id") < 1500, 7).otherwise(F.col("id")).alias("k")).coalesce(1)
    (tasks,) = lookup.hot_keys(left, ["k"], 64).values()
    assert tasks == 2  # 1,500 of 4,000 rows at four tasks
    joined = lookup.skew_join(left, spark.range(8).select(F.col("id").alias("k")), ["k"], "inner", salts=64)
    assert joined.count() == 1500
    spread = left.where("k = 7").select(F.pmod(F.xxhash64("id", "k") + F.spark_partition_id(), F.lit(tasks)).alias("s"))
    assert min(r["count"] for r in spread.groupBy("s").count().collect()) > 600


def test_several_patches_of_a_link(spark):
    rows = corpus(spark, [(1, "en", "a"), (2, "en", "b")])
    patches = spark.createDataFrame([("http://l/0", "one", 1), ("http://l/0", None, 3), ("http://l/0", "two", 2)], "link string, full_text string, at int")
    with pytest.raises(ValueError):
        repair.patch_text(rows, patches)
    assert sorted(values(repair.patch_text(rows, patches, "at"), "ord", "full_text")) == [(0, None), (1, "b")]


def test_dedup_in_slices_never_shuffles_text(spark, tmp_path):
    rows = spark.range(3000).selectExpr("id AS ord", "id % 700 AS date", "'l' AS link", "'t' AS topic", "'x' AS full_text", "'en' AS lang")
    rows.write.parquet(str(tmp_path / "c"))
    once = dedup.dedup_first(spark.read.parquet(str(tmp_path / "c")), max_losers=500)
    assert once.count() == 700
    text = once._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") == 5 and "SortMergeJoin" not in text and "hashpartitioning" not in text


def test_small_table(spark):
    assert lookup.small_table(spark.range(5), 5).count() == 5
    assert lookup.small_table(spark.range(6), 5) is None
    assert lookup.small_table(spark.range(0), 5).count() == 0


def test_measured_bytes_never_below_text(spark):
    frame = spark.createDataFrame([("я" * 500,), (None,)], "x string")
    assert lookup.measured_bytes(frame) >= 1000


@pytest.mark.parametrize("max_losers", [0, 1000])
def test_dedup_keeps_first(spark, max_losers):
    rows = corpus(spark, [(1, "en", "a"), (1, "uk", "b"), (1, "en", "c"), (None, "en", "d"), (None, "en", "e"), (2, "en", "f")])
    once = dedup.dedup_first(rows, max_losers=max_losers)
    assert sorted(values(once, "ord")) == [(0,), (1,), (3,), (5,)]
    assert sorted(values(dedup.dedup_first(once, max_losers=max_losers), "ord")) == [(0,), (1,), (3,), (5,)]
    pdf = pd.DataFrame([r.asDict() for r in rows.collect()])
    kept = pdf.drop_duplicates(subset=["date", "lang"], keep="first")
    assert sorted(r[0] for r in values(once, "ord")) == list(kept["ord"])


def test_dedup_with_one_hot_group(spark):
    rows = spark.range(3000).selectExpr(
        "id AS ord", "IF(id % 3 = 0, 1, id) AS date", "'l' AS link", "'t' AS topic", "'x' AS full_text", "'en' AS lang"
    )
    assert dedup.dedup_first(rows).count() == dedup.dedup_first(rows, max_losers=0).count() == 2000
    assert dedup.duplicate_members(rows).count() == 1001


def test_duplicate_members_and_gate(spark):
    rows = corpus(spark, [(1, "en", "a"), (1, "uk", "b"), (2, "en", "c")])
    assert sorted(values(dedup.duplicate_members(rows), "ord")) == [(0,), (1,)]
    assert dedup.has_repeats(rows) and not dedup.has_repeats(rows.where("ord > 0"))


def test_term_trend(spark):
    day = 86400
    rows = corpus(spark, [
        (0, "uk", "перемога дякую"), (day, "uk", "перемоги перемож"), (31 * day, "uk", None),
        (40 * day, "uk", "Дякую дякую"), (70 * day, "uk", "дякую"), (None, "uk", "дякую"), (0, "en", "дякую"),
    ])
    got = trend.term_trend(rows, lang="uk")
    assert got.columns == ["month", *K.TREND_TERMS]
    assert values(got, "month", "перемога", "дякую") == [("70-01", 3, 1), ("70-02", 0, 1)]
    line = trend.columnar(got, "month", ["дякую"]).first()
    assert line.month == ["70-01", "70-02"] and line["дякую"] == [1, 1]


def test_term_trend_of_nothing(spark):
    assert trend.term_trend(corpus(spark, [(0, "en", "x")]), lang="uk").collect() == []
    assert trend.term_trend(corpus(spark, [(0, "uk", "x")]), lang="uk").collect() == []


def test_top_words_first_seen_equals_counter(spark):
    texts = ["Bravo alpha, delta alpha", "delta Charlie bravo zebra12", None, "zebra12 п'ять слово_1"]
    rows = corpus(spark, [(n, "uk", t) for n, t in enumerate(texts)])
    expected = Counter(re.findall(r"\b\w{5,}\b", " ".join(t for t in texts if t).lower())).most_common(4)
    assert values(words.top_words(rows, "uk", 4, tie="first"), "word", "n") == expected
    by_word = sorted(Counter(dict(expected)).items(), key=lambda p: (-p[1], p[0]))
    assert values(words.top_words(rows, "uk", 4), "word", "n") == by_word
    with pytest.raises(ValueError):
        words.top_words(rows, tie="other")


def test_quality_reports(spark):
    rows = corpus(spark, [(1, "en", "a–b"), (2, "en", ""), (3, "en", None), (4, "uk", "я")])
    assert values(quality.max_invalid_percentage(rows, "en"), "max_invalid_pct") == [(33.33,)]
    assert values(quality.missing_counts(rows), "missing", "present") == [(2, 2)]
    assert sorted(values(filters.english_looking(rows), "ord")) == [(1,), (2,)]
    assert sorted(values(quality.rows_per_language(rows), "lang", "n")) == [("en", 3), ("uk", 1)]
    verdicts = spark.createDataFrame([(0, 1, 1), (2, 2, 1), (2, 2, 2)], "t int, d int, h int")
    got = verdicts.select(quality.element_audit(F.col("t"), F.col("d"), F.col("h"))).collect()
    assert [r[0] for r in got] == ["no_topics_found", "element_count_mismatch", "elements_found"]


def test_take_while(spark):
    items = spark.createDataFrame(
        [("en", p, d) for p, d in enumerate((9, 7, 3, 8))] + [("uk", 0, 4), ("de", 0, 9)], "lang string, pos bigint, date bigint"
    )
    marks = spark.createDataFrame([("en", 5), ("uk", 3)], "lang string, high_water bigint")
    got = takewhile.take_while_newer(items, marks)
    assert sorted(values(got, "lang", "date")) == [("en", 7), ("en", 9), ("uk", 4)]
    newer = filters.newer_than_mark(items, marks)
    assert sorted(values(newer, "lang", "date")) == [("en", 7), ("en", 8), ("en", 9), ("uk", 4)]
    assert filters.newer_than_mark(items, marks, force=True).count() == 6
    assert sorted(values(takewhile.latest_marks(items), "lang", "latest")) == [("de", 9), ("en", 9), ("uk", 4)]


def test_deny_and_patch(spark):
    rows = corpus(spark, [(1, "en", "a"), (2, "en", "b"), (3, "en", "c")])
    deny = spark.createDataFrame([("http://l/1",)], "link string")
    assert sorted(values(filters.without_links(rows, deny), "ord")) == [(0,), (2,)]
    patches = spark.createDataFrame([("http://l/0", "new"), ("http://l/2", None), ("http://l/9", "x")], "link string, full_text string")
    patched = repair.patch_text(rows, patches)
    assert sorted(values(patched, "ord", "full_text")) == [(0, "new"), (1, "b"), (2, None)]
    assert patched.columns == rows.columns


def test_repair_counts_add_up(spark):
    rows = corpus(spark, [(1, "en", None), (2, "en", ""), (3, "en", "kept"), (4, "en", None), (5, "en", " ")])
    page = lambda t: f'<div class="article_content">{t}</div>'
    pages = spark.createDataFrame(
        [("http://l/0", page("old"), 200, 1), ("http://l/0", page(" new  text "), 200, 2),
         ("http://l/1", "<p>none</p>", 200, 1), ("http://l/2", page("no"), 200, 1)], PAGES
    )
    repaired = repair.repair_missing(rows, pages)
    assert sorted(values(repaired, "ord", "full_text")) == [(0, "new text"), (1, ""), (2, "kept"), (3, None), (4, " ")]
    assert values(repair.repair_counts(repaired), "missing", "fixed", "remaining") == [(3, 1, 2)]
