"""Benchmark items inside documents: size-partitioned MinHash containment search, verified exactly.

An item's containment in a long document says little about their Jaccard similarity, so items are partitioned by size,
and a document is cut into overlapping windows of twice the largest size in the partition. An item
that stands in a document then lies whole inside a window, and its similarity with that window is at least 0.19 at a
containment of 0.8, whatever the document's length. A window is a candidate for an item if one of their 64 minimum
hashes agrees, which misses such an item with probability below 2e-6; items in up to four scattered parts are still
found with probability 0.998. An item whose distinct shingles are too few for that in its window, as it is very short or repeats
itself, is looked up by its shingles themselves, so none is missed. Every candidate is verified by the exact share of
the item's shingles that the whole document holds.

Documents are read once for each part of the items and never shuffled. A part holds a bounded number of
bytes, and only one part is broadcast in a pass.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chroniq.llm.common import WordHashes, free_name, scratch, ship, shingle_hashes, text_bytes, words_of
from chroniq.operators.lookup import lookup_join
from chroniq.session import stage

BLOCK = 8  # shingles whose minimum is shared by all windows
HASHES = 64
PART_BYTES = 16 * 1024 * 1024
GROUP_SHINGLES = 300_000
MISS = 2e-6  # probability from which on an item is not left to the minimum hashes


def multipliers(n: int, seed: int = 20) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Items:
    """One part of the items: shingle sets, and the minimum hashes or the shingles by which documents find them."""

    def __init__(self, ids: list, texts: list[bytes], size: int, hashes: int, threshold: float) -> None:
        memo = WordHashes()
        runs = [shingle_hashes(words_of(t), memo, size) for t in texts]
        at = [i for i, r in enumerate(runs) if len(r)]
        self.ids = [ids[i] for i in at]
        self.sets = [np.unique(runs[i]) for i in at]
        #: A level stands for a partition of sizes: windows of 2**level blocks hold items of up to half that length.
        levels = [max(1, (len(runs[i]) - 1).bit_length() - 2) for i in at]
        need = [min(len(s), max(1, ceil(threshold * len(s)))) for s in self.sets]
        few = [
            (1 - n / ((BLOCK << level) + len(s) - n)) ** hashes >= MISS
            for s, n, level in zip(self.sets, need, levels, strict=True)
        ]
        # A document that holds enough of an item's shingles holds one of any len - need + 1 of them.
        keys = [(s[: len(s) - n + 1], i) for i, (s, n, f) in enumerate(zip(self.sets, need, few, strict=True)) if f]
        looked_up = np.concatenate([k for k, _ in keys]) if keys else np.zeros(0, np.uint64)
        items = np.repeat(np.array([i for _, i in keys], np.int32), np.array([len(k) for k, _ in keys], np.int64))
        by_key = np.argsort(looked_up, kind="stable")
        self.keys, self.key_items = looked_up[by_key], items[by_key]
        self.key_present = np.zeros(1 << min(23, max(16, 4 + len(keys).bit_length())), bool)
        self.key_present[self.keys & np.uint64(len(self.key_present) - 1)] = True
        hashed = [i for i, f in enumerate(few) if not f]
        self.levels = sorted({levels[i] for i in hashed})
        self.factors = multipliers(hashes)
        minima = np.array([[(self.sets[i] * a).min() for a in self.factors] for i in hashed], np.uint64).reshape(-1, hashes)
        order = np.argsort(minima, axis=0, kind="stable")
        self.values = np.take_along_axis(minima, order, axis=0)
        self.order = np.array(hashed, np.int64)[order]
        self.bits = min(20, max(16, 8 + len(at).bit_length()))
        self.present = np.zeros((hashes, 1 << self.bits), bool)
        mask = np.uint64((1 << self.bits) - 1)
        for k in range(hashes):
            self.present[k, minima[:, k] & mask] = True

    def candidates(self, docs: list[np.ndarray]) -> set[tuple[int, int]]:
        """(document's index, item's index) of documents with a window that shares a minimum hash with an item, or with
        a shingle by which an item is looked up."""
        return self.by_shingles(docs) | (self.by_windows(docs) if self.levels else set())

    def by_shingles(self, docs: list[np.ndarray]) -> set[tuple[int, int]]:
        found = set()
        if not len(self.keys):
            return found
        x = np.concatenate(docs)
        doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
        hits = np.flatnonzero(self.key_present[x & np.uint64(len(self.key_present) - 1)])
        lo = np.searchsorted(self.keys, x[hits], "left")
        hi = np.searchsorted(self.keys, x[hits], "right")
        seen = np.unique(np.stack([doc[hits], lo, hi], 1)[hi > lo], axis=0)
        for d, i, j in seen.tolist():
            found.update((d, int(item)) for item in self.key_items[i:j])
        return found

    def by_windows(self, docs: list[np.ndarray]) -> set[tuple[int, int]]:
        lengths = np.array([-(-len(d) // BLOCK) for d in docs])
        last = np.cumsum(lengths) - 1
        first = last - lengths + 1
        x = np.empty(int(lengths.sum()) * BLOCK, np.uint64)
        for d, a, n in zip(docs, first.tolist(), lengths.tolist(), strict=True):
            x[a * BLOCK : a * BLOCK + len(d)] = d
            x[a * BLOCK + len(d) : (a + n) * BLOCK] = d[-1]
        x = np.ascontiguousarray(x.reshape(-1, BLOCK).T)
        doc = np.repeat(np.arange(len(docs)), lengths)
        place = np.arange(len(doc)) - first[doc]
        end = last[doc]
        nexts = [np.minimum(np.arange(len(doc)) + (1 << i), end) for i in range(self.levels[-1])]
        starts = {v: np.flatnonzero(place % (1 << (v - 1)) == 0) for v in self.levels}
        mask, found = np.uint64((1 << self.bits) - 1), set()
        for k, a in enumerate(self.factors):
            low = x[0] * a
            for row in x[1:]:
                np.minimum(low, row * a, out=low)
            for level, following in enumerate(nexts, 1):
                low = np.minimum(low, low[following])
                if level not in starts:
                    continue
                window = low[starts[level]]
                hits = np.flatnonzero(self.present[k][window & mask])
                if len(hits):
                    value = window[hits]
                    lo = np.searchsorted(self.values[:, k], value, "left")
                    hi = np.searchsorted(self.values[:, k], value, "right")
                    for h, i, j in zip(hits.tolist(), lo.tolist(), hi.tolist(), strict=True):
                        d = int(doc[starts[level][h]])
                        found.update((d, int(item)) for item in self.order[i:j, k])
        return found


def finder(part, size: int, threshold: float):
    """(id, text) to (id, item's number in the part, shingles of the item, found ones)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, memo = part.value, WordHashes()

        def flush(rows: list[int], docs: list[np.ndarray], ids: pa.Array) -> pa.RecordBatch:
            found = sorted(items.candidates(docs)) if docs else []
            out, at, held = [], -1, None
            for d, item in found:
                if d != at:
                    at, held = d, np.unique(docs[d])
                wanted = items.sets[item]
                n = int((held[np.minimum(np.searchsorted(held, wanted), len(held) - 1)] == wanted).sum())
                if n >= threshold * len(wanted):
                    out.append((rows[d], item, len(wanted), n))
            row, item, size_, n = (list(c) for c in zip(*out, strict=True)) if out else ([], [], [], [])
            return pa.RecordBatch.from_arrays(
                [ids.take(pa.array(row, pa.int64())), pa.array(item, pa.int32()), pa.array(size_, pa.int64()), pa.array(n, pa.int64())],
                ["doc_id", "item", "n_item_shingles", "n_found"],
            )

        for batch in batches:
            rows, docs, total = [], [], 0
            for i, text in enumerate(batch.column(1)):
                shingles = shingle_hashes(words_of(text.as_py()), memo, size)
                if len(shingles):
                    rows.append(i)
                    docs.append(shingles)
                    total += len(shingles)
                if total >= GROUP_SHINGLES:
                    yield flush(rows, docs, batch.column(0))
                    rows, docs, total = [], [], 0
            yield flush(rows, docs, batch.column(0))

    return run


def find_items(
    docs: DataFrame,
    items: DataFrame,
    threshold: float = 0.8,
    size: int = 5,
    hashes: int = HASHES,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``(doc_id, item_id, n_item_shingles, n_found, containment)`` for each document and item with a containment of at
    least ``threshold``: the share of the item's distinct shingles that occur in the document.

    A shingle is ``size`` consecutive words, lower-cased; a text of fewer words is one shingle of all of them. Null and
    empty texts, and texts without words, have no shingles and match nothing. Repeated documents give repeated rows,
    repeated items one row each; a null identifier stays null; an empty table on either side gives no rows; other columns
    are not looked at. Equal containments need no tie rule, as all are returned.
    """
    spark = docs.sparkSession
    ship(spark)
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    wanted = items.select(F.col(item_id_col).alias("item_id"), text_bytes(item_text_col).alias("text"))
    # An upper bound of what an item takes in memory: its shingles, their minimum hashes and its text.
    cost = F.octet_length("text") * 10 + hashes * 20 + 200
    parts = -(-(wanted.agg(F.sum(cost)).first()[0] or 0) // PART_BYTES)
    found = None
    for p in range(max(1, parts)):
        rows = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, parts))) == p).collect()
        part = Items([r.item_id for r in rows], [bytes(r.text) for r in rows], size, hashes, threshold)
        item_ids = spark.createDataFrame([(i, v) for i, v in enumerate(part.ids)], f"item int, item_id {items.schema[item_id_col].dataType.simpleString()}")
        schema = f"doc_id {id_type}, item int, n_item_shingles bigint, n_found bigint"
        if part.ids:
            texts = docs.select(F.col(id_col), text_bytes(text_col))
            hits = texts.mapInArrow(finder(spark.sparkContext.broadcast(part), size, threshold), schema)
        else:
            hits = spark.createDataFrame([], schema)
        hits = hits.join(F.broadcast(item_ids), "item").drop("item")  # one row per item of the part
        found = hits if found is None else found.unionByName(hits)
    return found.select(
        "doc_id", "item_id", "n_item_shingles", "n_found", (F.col("n_found") / F.col("n_item_shingles")).alias("containment")
    )


def decontaminate(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The rows of ``docs`` that hold no item, with their columns. A row is told by its identifier and its text, so
    rows with a null identifier are judged like others."""
    name = free_name(docs, "__row")
    row = F.xxhash64(F.col(id_col), F.col(text_col)).alias(name)
    found = find_items(docs.select(row, text_col), items, id_col=name, text_col=text_col, **options)
    leaks = stage(found.select(F.col("doc_id").alias(name)).distinct(), scratch(docs.sparkSession, "leaks"), "rows")
    return lookup_join(docs.withColumn(name, row), leaks, [name], "left_anti").select(*docs.columns)
