"""SimHash fingerprints of documents, and a search for all of them within a Hamming radius.

Terms are words and pairs of neighbouring words (the characters, where a text has no words). A term votes with its hash, bit by
bit for or against, and with the weight ``1 + log2(count)`` in sixteenths; a fingerprint's bit is set where the votes are above
zero. Weights are whole numbers, so equal texts have equal fingerprints on every machine.

The search cuts a fingerprint into ``blocks`` blocks. Two fingerprints that differ in at most ``radius`` bits agree in
``blocks - radius`` blocks at least, so there is a table for every choice of that many blocks: a fingerprint permuted so that
they come first, dealt by them. Fingerprints that meet in a table are compared by their bits, and a pair counts in the first
table in which it meets, so nothing is lost and nothing is counted twice. Copies of a fingerprint are one row with a count. Of a
bucket with many fingerprints the slices are compared two by two, so no task holds more than two slices.

For the registered query every document also meets its successor in the order of identifiers. Texts are dealt by ranges of
identifiers; the bounds are first rows of parts, and a row that is a bound is also sent to the part before its own, so a task
walks through its sorted rows with two texts in memory.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chroniq.llm.common import WORD_BYTES, WordHashes, mixed, scratch, ship
from chroniq.operators.lookup import lookup_join
from chroniq.session import stage

BITS = 256
RADIUS = 10
PART_BYTES = 32 << 20  # text of a part
SLICE = 1024  # fingerprints of a bucket that are compared at a time
TERMS = 4096  # terms whose votes are cast at a time
BATCH_ROWS = 256  # rows that are handed on at a time

_WORD_SEED, _PAIR_SEED = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


class SimHash:
    """Fingerprints as bytes."""

    def __init__(self, bits: int = BITS) -> None:
        if bits % 64:
            raise ValueError("bits must be a multiple of 64")
        self.bits, self.hashes = bits, WordHashes(100_000)
        # One seed for each 64 bits of a fingerprint.
        self.seeds = mixed(np.arange(1, bits // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def terms(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct 64-bit term hashes and their weights in sixteenths."""
        words = text.encode().translate(WORD_BYTES).split()
        if words:
            h = np.fromiter(map(self.hashes.__getitem__, words), np.uint64, len(words))
            pairs = mixed(mixed(h[:-1] + _PAIR_SEED) + h[1:])
            h = np.concatenate([mixed(h + _WORD_SEED), pairs])
        else:
            h = mixed(np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1))
        terms, counts = np.unique(h, return_counts=True)
        return terms, np.rint(16 * (1 + np.log2(counts))).astype(np.int64)

    def __call__(self, text: str) -> bytes:
        """A text without characters has no votes and therefore no bit."""
        terms, weights = self.terms(text)
        votes = np.zeros(self.bits, np.int64)
        for i in range(0, len(terms), TERMS):
            w = weights[i : i + TERMS]
            hashes = mixed(terms[i : i + TERMS, None] ^ self.seeds)
            signs = np.unpackbits(hashes.astype("<u8").view(np.uint8), axis=1).astype(np.float32)
            # Sums of whole numbers below 2**24 are exact in any order.
            votes += 2 * np.einsum("i,ij->j", w.astype(np.float32), signs).astype(np.int64) - int(w.sum())
        return np.packbits(votes > 0).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """The cosine of two texts' weighted terms as their fingerprints tell it: cos(pi * share of differing bits), 0 at least."""
    differ = (int.from_bytes(a, "big") ^ int.from_bytes(b, "big")).bit_count()
    return max(0.0, float(np.cos(np.pi * differ / (8 * len(a)))))


def half_edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the beginning of ``following``."""
    cut = len(text) // 2
    return text[: len(text) - cut] + following[:cut]


# --- documents and their successors ---------------------------------------------------------------------------------------


def _sender(bounds):
    """(id, hash, text) to (part, ahead, id, hash, text), texts packed; a bound goes to the part before as well."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        firsts = bounds.value
        nulls = sum(i is None for i, _ in firsts)  # rows without an identifier come first
        without_id, with_id = [h for _, h in firsts[:nulls]], firsts[nulls:]
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                out = []
                for i, h, text in zip(*(c.to_pylist() for c in whole.slice(at, BATCH_ROWS).columns), strict=True):
                    part = (bisect_right(without_id, h) if i is None else nulls + bisect_right(with_id, (i, h))) - 1
                    packed = zlib.compress(text, 1)
                    out.append((part, False, i, h, packed))
                    if firsts[part] == (i, h):
                        out.append(((part - 1) % len(firsts), True, i, h, packed))
                types = [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], ["part", "ahead", "id", "hash", "text"]
                )

    return run


def _walker(bits: int):
    """Sorted rows of parts to the query's columns: each row together with the one after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        simhash = SimHash(bits)
        own = own_part = own_print = None
        out = []

        def rows():
            """(part, id, text) in order; of the rows sent ahead, which are the last of a part and equal, the first."""
            last = None
            for batch in batches:
                for part, ahead, i, _, packed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if ahead and last == part:
                        continue
                    last = part if ahead else last
                    yield part, ahead, i, zlib.decompress(packed).decode()

        def flush():
            types = [pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()] + [pa.float64()] * 2
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], WALKED)

        for part, ahead, i, text in rows():
            # An equal text has an equal fingerprint.
            fingerprint = own_print if own is not None and own[1] == text else simhash(text)
            if own is not None and own_part == part:
                edited = half_edited(own[1], text)
                edited_print = simhash(edited)
                digest = hashlib.sha256(edited.encode()).hexdigest()
                out.append((own[0], len(own[1]), digest, own_print, edited_print, likeness(own_print, edited_print), likeness(own_print, fingerprint)))
                if len(out) >= BATCH_ROWS:
                    yield flush()
                    out = []
            own, own_part, own_print = (None if ahead else (i, text)), part, fingerprint
        if out:
            yield flush()

    return run


WALKED = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def fingerprint_pairs(docs: DataFrame, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES) -> DataFrame:
    """``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``, one row for each of ``docs``.

    The edited text of a document is that of :func:`half_edited` with the next document: the one with the next larger identifier,
    after the last one the first. Rows without an identifier come before all others; those of equal identifier are in the order
    of a hash of their texts, so a repeated row is followed by its repeat. A null text is empty; an empty text has no bit set. The only
    document is its own successor. An empty table gives an empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = scratch(spark, "simhash")
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    keys = stage(rows.select("id", "hash", F.length("text").alias("size")), folder, "keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    parts = max(1, -(-total // part_bytes))
    # Every part's first row: one for each 32 MB of text.
    dealt = keys.select("id", "hash").repartitionByRange(parts, F.col("id").asc_nulls_first(), "hash")
    known = F.col("id").isNotNull()
    first = F.min(F.struct(known.alias("known"), "id", "hash"))
    firsts = dealt.groupBy(F.spark_partition_id()).agg(first.alias("first")).select("first.*").orderBy("known", "id", "hash").collect()
    bounds = spark.sparkContext.broadcast([(r.id, r["hash"]) for r in firsts])
    sent = rows.mapInArrow(_sender(bounds), "part int, ahead boolean, id bigint, hash bigint, text binary")
    together = sent.repartition(max(1, len(firsts)), "part")
    # The rows sent ahead are behind all others of a part.
    together = together.sortWithinPartitions("part", "ahead", F.col("id").asc_nulls_first(), "hash")
    schema = (
        "id bigint, n_chars bigint, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
    )
    return stage(together.mapInArrow(_walker(bits), schema), folder, "prints")


# --- all fingerprints within a radius --------------------------------------------------------------------------------------


def block_cuts(bits: int, radius: int, blocks: int) -> np.ndarray:
    """Where the blocks begin, and the end of the last."""
    if not 0 <= radius < blocks <= bits:
        raise ValueError("more blocks than the radius are needed, and at most one for each bit")
    return np.linspace(0, bits, blocks + 1).astype(int)


def block_tables(radius: int, blocks: int) -> list[tuple[int, ...]]:
    """The blocks that must agree in each table."""
    return list(combinations(range(blocks), blocks - radius))


def table_masks(bits: int, radius: int, blocks: int) -> np.ndarray:
    """One row of 64-bit masks for each table: the bits that must agree in it."""
    cuts, masks = block_cuts(bits, radius, blocks), []
    for kept in block_tables(radius, blocks):
        mask = np.zeros(bits, np.uint8)
        for k in kept:
            mask[cuts[k] : cuts[k + 1]] = 1
        masks.append(np.packbits(mask).view("<u8"))
    return np.array(masks)


def _words(prints: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(prints), "<u8").reshape(len(prints), -1)


def _tables(masks: np.ndarray, whole: bool):
    """(print, n) to a row for each table: the bucket's key, and with ``whole`` the table, the fingerprint and its count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, 2048):
                batch = whole_batch.slice(at, 2048)
                prints = batch.column(0).to_pylist()
                words = _words(prints)
                for t, mask in enumerate(masks):
                    key = np.full(len(words), np.uint64(t + 1))
                    for column in (words & mask).T:
                        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
                    bucket = pa.array(key.view(np.int64))
                    if whole:
                        table = pa.array(np.full(len(words), t, np.int32))
                        yield pa.RecordBatch.from_arrays([bucket, table, batch.column(0), batch.column(1)], ["bucket", "table", "print", "n"])
                    else:
                        yield pa.RecordBatch.from_arrays([bucket], ["bucket"])

    return run


def _signs(prints: list[bytes]) -> np.ndarray:
    bits = np.unpackbits(np.frombuffer(b"".join(prints), np.uint8).reshape(len(prints), -1), axis=1)
    return bits.astype(np.float32) * 2 - 1


def _comparer(bits: int, radius: int, blocks: int, pairs: bool):
    """Rows sorted by (bucket, low, high) to pairs of fingerprints, or to each fingerprint's weighted number of partners."""
    cuts, tables = block_cuts(bits, radius, blocks), block_tables(radius, blocks)

    def compare(table: int, left: tuple, right: tuple | None):
        kept = tables[table]
        a, na = _signs(left[0]), np.array(left[1], np.float64)
        b, nb = (a, na) if right is None else (_signs(right[0]), np.array(right[1], np.float64))
        partners = left[0] if right is None else right[0]
        # Products of signs: the bits that agree less those that differ.
        distance = (bits - a @ b.T) / 2
        near = distance <= radius
        if right is None:  # each pair of a slice once
            near = np.triu(near, 1)
        if not near.any():
            return
        # The first table in which two fingerprints meet is that of the first blocks in which they agree.
        agreeing = np.zeros(near.shape, np.int16)
        for k in range(kept[-1] + 1):
            at = slice(cuts[k], cuts[k + 1])
            agree = a[:, at] @ b[:, at].T == cuts[k + 1] - cuts[k]
            agreeing += agree
            if k in kept:
                near &= agree
        near &= agreeing == len(kept)
        if pairs:
            for p, q in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
                yield *sorted((left[0][p], partners[q])), int(distance[p, q])
        else:
            for prints, sums in ((left[0], near @ nb), (partners, na @ near)):
                for k in np.flatnonzero(sums).tolist():
                    yield prints[k], None, int(sums[k])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, out = None, {}, []

        def finish():
            # A unit is one slice, or two different ones.
            sides = [held[k] for k in sorted(held)]
            if sides and key[1] == key[2]:
                yield from compare(sides[0][2], sides[0], None)
            elif len(sides) == 2:
                yield from compare(sides[0][2], *sides)

        def flush():
            columns = zip(*out, strict=True) if out else [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.binary(), pa.binary(), pa.int64()], strict=True)], ["a", "b", "value"])

        for batch in batches:
            for bucket, low, high, own, table, one, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (bucket, low, high) != key:
                    for row in finish():
                        out.append(row)
                        if len(out) >= 20_000:
                            yield flush()
                            out = []
                    key, held = (bucket, low, high), {}
                prints, counts, _ = held.setdefault(own, ([], [], table))
                prints.append(one)
                counts.append(n)
        for row in finish():
            out.append(row)
            if len(out) >= 20_000:
                yield flush()
                out = []
        yield flush()

    return run


def _compared(prints: DataFrame, bits: int, radius: int, blocks: int, pairs: bool, folder: str) -> DataFrame:
    """``prints(print, n)`` are distinct fingerprints with their numbers of documents."""
    masks = table_masks(bits, radius, blocks)
    keys = prints.mapInArrow(_tables(masks, False), "bucket bigint")
    # Buckets with several fingerprints, and the slices that each is cut into.
    sizes = keys.groupBy("bucket").count().where("count > 1").select("bucket", F.ceil(F.col("count") / SLICE).cast("int").alias("slices"))
    sizes = stage(sizes, folder, "buckets")
    rows = prints.mapInArrow(_tables(masks, True), "bucket bigint, table int, print binary, n bigint")
    met = lookup_join(rows, sizes, ["bucket"], "inner")
    own = F.pmod(F.xxhash64("print"), F.col("slices")).cast("int")
    others = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    met = met.select("bucket", "table", "print", "n", own.alias("own"), others.alias("other"))
    units = met.select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "table", "print", "n")
    together = units.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    return together.mapInArrow(_comparer(bits, radius, blocks, pairs), "a binary, b binary, value bigint")


def near_pairs(prints: DataFrame, radius: int = RADIUS, blocks: int | None = None, bits: int = BITS) -> DataFrame:
    """``(a, b, distance)``: all pairs of different fingerprints of ``prints(fingerprint binary)`` within ``radius`` bits, ``a < b``.

    Nulls take no part; repeats count once. ``blocks`` (``radius + 1`` unless given) sets the tables: ``blocks`` over
    ``blocks - radius`` of them, each dealt by ``(blocks - radius) / blocks`` of the bits; the pairs found are the same for any.
    """
    ship(prints.sparkSession)
    distinct = prints.where("fingerprint IS NOT NULL").groupBy(F.col("fingerprint").alias("print")).agg(F.count("*").alias("n"))
    folder = scratch(prints.sparkSession, "simhash-pairs")
    found = _compared(stage(distinct, folder, "prints"), bits, radius, blocks or radius + 1, True, folder)
    return found.select("a", "b", F.col("value").alias("distance"))


def near_counts(prints: DataFrame, radius: int = RADIUS, blocks: int | None = None, bits: int = BITS) -> DataFrame:
    """``(fingerprint, n_copies, n_near)``: how many rows of ``prints(fingerprint)`` have it, and how many others one within ``radius`` bits of it.

    As :func:`near_pairs`, with the partners added up where they are found, so a group of many near copies is never written out in pairs.
    """
    spark = prints.sparkSession
    ship(spark)
    folder = scratch(spark, "simhash-counts")
    distinct = prints.where("fingerprint IS NOT NULL").groupBy(F.col("fingerprint").alias("print")).agg(F.count("*").alias("n"))
    distinct = stage(distinct, folder, "prints")
    found = _compared(distinct, bits, radius, blocks or radius + 1, False, folder)
    partners = found.groupBy(F.col("a").alias("print")).agg(F.sum("value").alias("near"))
    both = distinct.join(partners, "print", "left")
    return stage(
        both.select(F.col("print").alias("fingerprint"), F.col("n").alias("n_copies"), (F.col("n") + F.coalesce("near", F.lit(0)) - 1).alias("n_near")), folder, "counts"
    )


def document_fingerprints(docs: DataFrame, radius: int = RADIUS, blocks: int | None = None, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of :func:`fingerprint_pairs`, fingerprints in hexadecimal, with ``n_copies`` and ``n_near`` of :func:`near_counts`."""
    prints = fingerprint_pairs(docs, bits, id_col, text_col)
    counts = near_counts(prints.select("fingerprint"), radius, blocks, bits)
    # Only fingerprints that are not alone are looked up, so the lookup holds the near copies and no more.
    known = lookup_join(prints, counts.where("n_near > 0"), ["fingerprint"], "left")
    return known.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
    )
