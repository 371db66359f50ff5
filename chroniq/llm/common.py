"""Helpers of the training-data operators: tables, scratch folders, code for the workers, words."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chroniq.session import remove_path, work_folder

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: ASCII A-Z become a-z, all other ASCII but letters and digits becomes a blank, and bytes of other characters stay.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Give the executors this package's code, once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    folder = tempfile.mkdtemp(prefix="chroniq-code-")
    archive = shutil.make_archive(f"{folder}/chroniq_code", "zip", root, "chroniq")
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder on the shared storage, removed when the driver ends.

    A lazily returned frame may read it any time until then.
    """
    return work_folder(spark, name)


def discard(spark: SparkSession, folder: str) -> None:
    """Remove a staged folder that nothing reads any more."""
    remove_path(spark, folder)


def text_bytes(column: Column | str = "text") -> Column:
    """A text's UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast("binary")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with more underscores in front if the frame has such a column."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def fold(column: Column | str, modulus: int) -> Column:
    """crc32 of the identifier's text, modulo ``modulus``. A null identifier is in fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus, F.lit(0))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters, digits and characters beyond ASCII."""
    return text.translate(WORD_BYTES).split()


MULT = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix (the finalizer of SplitMix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordHashes(dict):
    """Word to 64-bit hash. Forgets all words when it holds ``limit``, so memory is bounded."""

    def __init__(self, limit: int = 200_000) -> None:
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingle_hashes(words: list[bytes], hashes: WordHashes, size: int = 5) -> np.ndarray:
    """One 64-bit hash per run of ``size`` words, in text order.

    Fewer words than that give one hash of all of them, no words give none. The hash of a shorter
    run never equals one of a full run but by chance of 64 bits.
    """
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    k = min(size, n)
    out = np.full(n - k + 1, np.uint64(k), np.uint64)
    for i in range(k):
        out = mixed(out * MULT + h[i : n - k + 1 + i])
    return out
