"""Token counts with a cache keyed by content and tokenizer version.

The cache is a Parquet table ``(tokenizer, content, n_tokens)``: digests of the tokenizer's file and
of the normalised content. A run joins digests with the cache, encodes one text for each digest
that is not there, appends these counts, and reads every count from the cache.

Only digests, identifiers and sizes are shuffled for the lookup. A group of copies shrinks to one
digest before the shuffle and only its first row's text is encoded, so a group may hold any share of all rows.
"""

from __future__ import annotations

import hashlib
import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chroniq.llm.common import scratch, ship
from chroniq.operators.lookup import lookup_join, skew_join
from chroniq.session import stage
from chroniq.sources.corpus import path_exists

CACHE_SCHEMA = "tokenizer string, content binary, n_tokens bigint"
MEMO_WORDS = 150_000  # per worker; a bound of memory only, as further words are encoded without being remembered

_TEXT, _BYTES, _DIGEST = "__text", "__bytes", "__content"


def file_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def drops_white_space(path: str) -> bool:
    """Whether the tokenizer turns every run of white space into one boundary between pieces.

    True if its normalizer collapses white space and its pattern keeps only pieces without it. Then
    pieces between white space are encoded independently of one another.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    steps = (spec.get("normalizer") or {}).get("normalizers", [])
    collapses = any(s.get("type") == "Replace" and s.get("pattern") == {"Regex": r"\s+"} for s in steps)
    split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
    keeps_pieces = split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert") is True
    return collapses and keeps_pieces and r"[^\s" in split.get("pattern", {}).get("Regex", "")


class Counts:
    """Tokens of whole texts, by the tokenizer's own library, without added special tokens."""

    def __init__(self, path: str, by_piece: bool) -> None:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self.encode = lambda texts: [len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        self.by_piece = by_piece
        self.memo: dict[bytes, int] = {}

    def __call__(self, texts: list[bytes]) -> list[int]:
        if not self.by_piece:
            return self.encode([t.decode() for t in texts])
        pieces = [t.split() for t in texts]
        memo = self.memo
        if len(memo) < MEMO_WORDS:  # remember what comes again within a batch
            seen = Counter(w for ws in pieces for w in ws if w not in memo)
            again = [w for w, n in seen.most_common(MEMO_WORDS - len(memo)) if n > 1]
            for i in range(0, len(again), 5000):
                memo.update(zip(again[i : i + 5000], self.encode([w.decode() for w in again[i : i + 5000]]), strict=True))
        rest = [[w for w in ws if w not in memo] for ws in pieces]
        known = [sum(memo[w] for w in ws if w in memo) for ws in pieces]
        more = self.encode([b" ".join(ws).decode() for ws in rest])
        return [a + b for a, b in zip(known, more, strict=True)]


def encoder(path: str, by_piece: bool, rows: int = 500):
    """A function for ``mapInArrow``: (content, text) to (content, n_tokens)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        counts = Counts(path, by_piece)
        for batch in batches:
            for i in range(0, batch.num_rows, rows):
                part = batch.slice(i, rows)
                n = counts(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64())], ["content", "n_tokens"])

    return count


def count_tokens(
    docs: DataFrame, tokenizer_path: str, cache_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048
) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` for each row of ``docs``.

    A null text is empty and has no tokens; a null identifier stays null; repeated rows come back as often as
    they are there; an empty table gives an empty result; other columns are not looked at, whatever
    their names. ``tokenizer_path`` is a file that driver and executors have. Runs that share a cache
    may run at the same time: both then append the same counts, and readers take one of them.
    """
    spark = docs.sparkSession
    ship(spark)
    version = file_digest(tokenizer_path)
    by_piece = not tokenizer_path.endswith(".model") and drops_white_space(tokenizer_path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    content = text
    if by_piece:  # the tokenizer collapses white space itself, so this changes no tokens
        spaced = F.translate(text, "\t\n\r\f\x0b", "     ")
        content = F.trim(F.when(spaced.contains("  "), F.regexp_replace(spaced, " {2,}", " ")).otherwise(spaced))
    keyed = docs.select(
        F.col(id_col).alias("__id"),
        F.octet_length(text).cast("bigint").alias(_BYTES),
        F.unhex(F.sha2(content.cast("binary"), 256)).alias(_DIGEST),
        text.cast("binary").alias(_TEXT),
    )
    narrow = stage(keyed.drop(_TEXT), scratch(spark, "token-digests"), "rows")

    def cached() -> DataFrame:
        if not path_exists(spark, cache_path):
            return spark.createDataFrame([], CACHE_SCHEMA)
        rows = spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
        return rows.where(F.col("tokenizer") == version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))

    # One row stands for a digest: that of the lowest identifier, as text; a null one is the lowest.
    key = F.coalesce(F.concat(F.lit("i"), F.col("__id").cast("string")), F.lit("")).alias("__key")
    rows_of = narrow.select(_DIGEST, key).groupBy(_DIGEST, "__key").agg(F.count("*").alias("__n"))
    first = rows_of.groupBy(_DIGEST).agg(F.min(F.struct("__key", "__n")).alias("f")).select(_DIGEST, "f.*")
    known = cached()
    misses = first.join(known.withColumnRenamed("content", _DIGEST), _DIGEST, "left_anti")
    misses = stage(misses, scratch(spark, "token-misses"), "rows")
    # Rows that are not encoded: later copies and digests that are known. They are fewer than the misses
    # on a corpus with few copies, and where they are few they are broadcast and no text is shuffled.
    alone = misses.where("__n = 1").select(_DIGEST, F.col("__key").alias("__rep"))
    skip = skew_join(narrow.select(key, _DIGEST), alone, [_DIGEST], "left").where("__rep IS NULL OR __key <> __rep").select("__key", _DIGEST)
    todo = lookup_join(keyed.select(key, _DIGEST, _TEXT), skip, ["__key", _DIGEST], "left_anti").select(_DIGEST, _TEXT)
    # Where the row that would stand for a digest is there several times, one text of the digest is taken.
    repeated = misses.where("__n > 1").select(_DIGEST)
    if not repeated.isEmpty():
        same = lookup_join(keyed.select(_DIGEST, _TEXT), repeated, [_DIGEST], "left_semi")
        todo = todo.unionByName(same.groupBy(_DIGEST).agg(F.first(_TEXT).alias(_TEXT)))
    encoded = todo.mapInArrow(encoder(tokenizer_path, by_piece), "content binary, n_tokens bigint")
    encoded.select(F.lit(version).alias("tokenizer"), "content", "n_tokens").write.mode("append").parquet(cache_path)

    counts = cached().withColumnRenamed("content", _DIGEST)
    return skew_join(narrow, counts, [_DIGEST], "left").select(
        F.col("__id").alias(id_col),
        F.col(_BYTES).alias("n_bytes"),
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )


def fresh_cache(spark) -> str:
    """A cache of one run only, for queries whose figures must not depend on earlier runs."""
    return f"{scratch(spark, 'token-cache')}/counts"
