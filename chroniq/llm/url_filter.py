"""Verdicts on addresses: host and path rules first, then naive Bayes, learned from the pages that the rules decide, over the words of host and path.

Names in hosts are often several words written as one. A name is split by the Viterbi path through all its pieces, under unigram
frequencies counted over all pages. Pieces of all names are joined with the counts, so the vocabulary is never
broadcast; each different name is split once, however many pages bear it.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chroniq.llm.common import LOWER, UPPER, scratch, ship
from chroniq.operators.lookup import lookup_join
from chroniq.session import stage

#: Fixed values: (host, path, verdict).
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

SHORT = 20  # letters; longer words are looked up by as many of their first letters, and then compared whole


def parts(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path; both empty for null and for an address without ``://``."""
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, "://([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """``(rule, verdict)`` of the longest rule that fits, or null. Of rules of one length the first fits."""
    found = F.lit(None).cast("struct<rule:string, verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1]), reverse=True)[::-1]:
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def names_of(host: Column) -> Column:
    """Runs of letters in a host, its last label, the top domain, aside."""
    return F.regexp_extract_all(F.regexp_replace(host, "[.][^.]*$", ""), F.lit("[^\\x00-\\x60\\x7B-\\x7F]+"), F.lit(0))


def path_words(path: Column) -> Column:
    """Words of a path; any number is the one word 0."""
    words = F.regexp_extract_all(F.translate(path, UPPER, LOWER), F.lit("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), F.lit(0))
    return F.transform(words, lambda w: F.when(w.rlike("^[0-9]+$"), F.lit("0")).otherwise(w))


def best_split(name: str, pieces: dict[tuple[int, int], int], total: int) -> list[str]:
    """The likeliest words of a name, from the counts of its known pieces by ``(start, size)``. A piece that is no word costs ten times
    more with each letter; of equal splits the one with the longer last word wins. Pieces may be of any length."""
    known: dict[int, list[tuple[int, int]]] = {}
    for (start, size), n in pieces.items():
        known.setdefault(start + size, []).append((start, n))
    best: list[tuple[float, int]] = [(0.0, 0)]
    run = 0  # where the cheapest unknown piece that ends here begins: the next one prolongs it, or begins here
    for end in range(1, len(name) + 1):
        tries = [(best[start][0] + log(total) + (end - start - 1) * log(10), start) for start in {run, end - 1}]
        run = min(tries)[1]
        tries += [(best[start][0] - log(n / total), start) for start, n in known.get(end, [])]
        best.append(min(tries))
    words, end = [], len(name)
    while end:
        start = best[end][1]
        words.append(name[start:end])
        end = start
    return words[::-1]


def splitter(total: int):
    """(name, pieces with counts) to (name, words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            counts = [{(p["start"], p["size"]): p["n"] for p in found} for found in batch.column(1).to_pylist()]
            words = [best_split(name, c, total) for name, c in zip(names, counts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.list_(pa.string()))], ["name", "words"])

    return run


def segment(names: DataFrame, counts: DataFrame) -> DataFrame:
    """``(name, words)`` for each different name of a column ``name``, by the ``(word, n)`` of ``counts``."""
    spark = names.sparkSession
    ship(spark)
    total = max(counts.agg(F.sum("n")).first()[0] or 0, 1)
    names = names.where("name <> ''").distinct()
    start = F.explode(F.sequence(F.lit(0), F.length("name") - 1)).alias("start")
    starts = names.select("name", start)
    size = F.explode(F.sequence(F.lit(1), F.least(F.lit(SHORT), F.length("name") - F.col("start")))).alias("size")
    pieces = starts.select("name", "start", size)
    pieces = pieces.withColumn("word", F.substring(F.col("name"), F.col("start") + 1, F.col("size")))
    # A letter is a piece of nearly every name: hot words are spread where the counts are too many to broadcast.
    short = lookup_join(pieces, counts.where(F.length("word") <= SHORT), ["word"], "inner").select("name", "start", "size", "n")
    heads = starts.withColumn("head", F.substring(F.col("name"), F.col("start") + 1, F.lit(SHORT))).where(F.length("name") - F.col("start") > SHORT)
    words = counts.where(F.length("word") > SHORT).select(F.substring("word", 1, SHORT).alias("head"), "word", F.length("word").alias("size"), "n")
    long = lookup_join(heads, words, ["head"], "inner")
    long = long.where(F.substring(F.col("name"), F.col("start") + 1, F.col("size")) == F.col("word")).select("name", "start", "size", "n")
    found = short.unionByName(long).groupBy("name").agg(F.collect_list(F.struct("start", "size", "n")).alias("pieces"))
    # Of a name there are at most SHORT short pieces for each letter.
    empty = F.array().cast("array<struct<start:int, size:int, n:bigint>>")
    every = names.join(found, "name", "left").select("name", F.coalesce("pieces", empty).alias("pieces"))
    return every.mapInArrow(splitter(total), "name string, words array<string>")


def word_counts(pages: DataFrame) -> DataFrame:
    """``(word, n)`` over the addresses' parts and the pages' text, of all pages. ``pages`` has ``host``, ``path`` and ``html``."""
    text = F.translate(F.regexp_replace(F.coalesce("html", F.lit("")), "<[^>]*>", " "), UPPER, LOWER)
    letters = F.regexp_extract_all(text, F.lit("[^\\x00-\\x60\\x7B-\\x7F]+"), F.lit(0))
    # Parts of a host between hyphens are words as they stand; other parts may be several.
    apart = F.when(F.col("host").contains("-"), F.regexp_extract_all("host", F.lit("[a-z]+(?=-)|(?<=-)[a-z]+"), F.lit(0))).otherwise(F.array())
    words = pages.select(F.explode(F.concat(letters, apart, path_words(F.col("path")))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] | None = None,
    block_words: list[str] | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """``(page_id, host, path, rule, verdict, words, log_odds)`` for each row of ``pages``.

    The longest rule that fits decides. Else multinomial naive Bayes does: it learns from the words of host and path of all pages that a rule
    decides, by the rule's verdict, and blocks if the log odds of an address's words are above zero. Words that no such page has do not count.
    With ``block_words`` the other pages are learned from as well: "block" where the host has one of these words, else "allow".

    A null address, or one without ``://``, has empty host and path, and the verdict of the prior; a null identifier stays null;
    repeated rows count and come back as often as they are there; an empty table gives an empty result; other
    columns are not looked at. Without any page to learn "block" from, every verdict of the method is "allow".
    """
    spark = pages.sparkSession
    ship(spark)
    folder = scratch(spark, "urls")
    host, path = parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    counts = stage(word_counts(rows), folder, "words")
    known = stage(rows.drop("html").withColumn("uid", F.monotonically_increasing_id()), folder, "rows")

    hosts = known.groupBy("host").agg(F.count("*").alias("n")).withColumn("names", names_of(F.col("host")))
    hosts = stage(hosts, folder, "hosts")
    split = stage(segment(hosts.select(F.explode("names").alias("name")), counts), folder, "split")
    placed = hosts.select("host", F.posexplode("names").alias("at", "name"))
    placed = lookup_join(placed, split, ["name"], "inner").groupBy("host").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])).alias("words")
    )  # a host is one row per name in it
    seeds = F.array(*[F.lit(w) for w in block_words or []]).cast("array<string>")
    tld = F.regexp_extract("host", "[.]([^.]*)$", 1)
    worded = hosts.select("host").join(placed, "host", "left").select(
        "host",
        F.concat(F.coalesce("words", F.array().cast("array<string>")), F.when(tld != "", F.array(F.concat(F.lit("."), tld))).otherwise(F.array())).alias("words"),
    )
    worded = stage(worded.withColumn("seeded", F.arrays_overlap("words", seeds)), folder, "worded")

    told = lookup_join(known, worded, ["host"], "inner")
    told = told.withColumn("found", rule_of(F.col("host"), F.col("path"), RULES if rules is None else rules))
    bad = F.coalesce(F.col("found.verdict") == "block", F.col("seeded") if block_words else F.lit(None).cast("boolean"))  # null: not learned from
    told = stage(told.withColumn("words", F.concat("words", path_words(F.col("path")))).withColumn("bad", bad), folder, "told")
    pages_of = told.agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good")).first()
    tokens = told.select("uid", "bad", F.explode("words").alias("word"))
    table = tokens.where("bad IS NOT NULL").groupBy("word").agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good"))
    table = stage(table, folder, "table")
    sums = table.agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.count("*").alias("types")).first()
    bad, good, types = sums.bad or 0, sums.good or 0, sums.types
    odds = F.log((F.col("bad") + 1) / float(bad + types + 1)) - F.log((F.col("good") + 1) / float(good + types + 1))
    weights = table.select("word", odds.alias("weight"))
    scored = lookup_join(tokens.select("uid", "word"), weights, ["word"], "inner").groupBy("uid").agg(F.sum("weight").alias("sum"))
    prior = log((pages_of.bad + 1) / (pages_of.good + 1)) if pages_of.bad or pages_of.good else 0.0
    log_odds = F.coalesce("sum", F.lit(0.0)) + prior
    method = F.when((log_odds > 0) & F.lit(pages_of.bad > 0), "block").otherwise("allow")
    return (
        told.join(scored, "uid", "left")
        .select(
            F.col("id").alias(id_col), "host", "path", F.col("found.rule").alias("rule"),
            F.coalesce("found.verdict", method).alias("verdict"), "words", log_odds.alias("log_odds"),
        )
    )
