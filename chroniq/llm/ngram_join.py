"""Similarity join of texts on the Jaccard similarity of their word shingles, by a MinHash LSH forest.

1. Every text gets a signature: for each of ``trees`` tries a string of ``depth`` minimum hashes. Equal signatures are one leaf.
2. The tries are searched from their deepest nodes upward, all trees at one depth at a time. Texts that meet under a prefix are compared by all
   their minimum hashes, and those that may be similar are tied together. After each depth the recall of every text is estimated
   from the partners it has met; a text that reaches the target is settled, for the others the prefix is shortened by one hash. A shorter prefix is
   looked at only if an unsettled text is under it and it joins several longer ones, and only pairs that were not under the same longer one are
   compared. The shortest prefix is the longest that finds a pair at the threshold with the target recall.
3. Each group of tied texts is verified exactly: shingle sets are intersected for all pairs of the group. Pairs are counted where they are found
   and never become rows; what leaves a task is one row per text, with its number of links and one edge to its class.
4. Connected components of these edges are the classes.

Large nodes and large groups are cut into blocks, and each pair of blocks is a task's work of its own. Equal texts are one text with a number
of copies from the start, so a group of copies may hold any share of all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chroniq.llm.common import MULT, WordHashes, discard, free_name, scratch, ship, shingle_hashes, text_bytes, words_of
from chroniq.llm.components import components
from chroniq.llm.decontaminate import multipliers
from chroniq.operators.lookup import lookup_join
from chroniq.session import stage

TREES, DEPTH, RECALL = 20, 6, 0.9999
MISS = 1e-7  # chance that a pair at the threshold agrees in too few minimum hashes to be tied
HASH_BYTES = 2
NODE_BLOCK = 2048  # texts of a trie node compared at once
SET_BLOCK, SET_SHINGLES = 1024, 1_000_000  # texts and their shingles in a block that is verified at once
GROUP_SHINGLES = 300_000

SIGNED = "row bigint, id {id}, text_key binary, n_shingles int, signature binary"
MET = "a binary, b binary, agree int"


def prefix_length(threshold: float, trees: int, depth: int, recall: float) -> int:
    """The longest prefix at which a pair at the threshold is found with the target recall; 1 if none is."""
    for k in range(depth, 1, -1):
        if 1 - (1 - threshold**k) ** trees >= recall:
            return k
    return 1


def trees_for(threshold: float, trees: int, recall: float) -> int:
    """``trees``, or as many as a prefix of one hash needs for the target recall."""
    return max(trees, math.ceil(math.log(1 - recall) / math.log(1 - threshold))) if threshold < 1 else trees


def least_agreement(threshold: float, hashes: int) -> int:
    """The minimum hashes in which a pair at the threshold agrees, but for a chance of ``MISS``."""
    below = 0.0
    for k in range(hashes + 1):
        below += math.comb(hashes, k) * threshold**k * (1 - threshold) ** (hashes - k)
        if below > MISS:
            return k
    return hashes


def signer(size: int, hashes: int):
    """(row, id, text) to signed rows. A signature has ``HASH_BYTES`` of each minimum hash; without words it is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        memo, factors = WordHashes(), multipliers(hashes)

        def flush(part: pa.RecordBatch, keys: list, sets: list[np.ndarray]) -> pa.RecordBatch:
            lengths = np.array([len(s) for s in sets])
            full = np.flatnonzero(lengths)
            signatures = [b""] * len(sets)
            if len(full):
                x = np.concatenate([sets[i] for i in full])
                starts = np.cumsum(lengths[full]) - lengths[full]
                low = np.empty((len(full), hashes), ">u2")
                for k, a in enumerate(factors):
                    low[:, k] = (np.minimum.reduceat(x * a, starts) * MULT) >> np.uint64(48)
                for j, i in enumerate(full.tolist()):
                    signatures[i] = low[j].tobytes()
            return pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(keys, pa.binary()), pa.array(lengths, pa.int32()), pa.array(signatures, pa.binary())],
                ["row", "id", "text_key", "n_shingles", "signature"],
            )

        for batch in batches:
            begin, keys, sets, total = 0, [], [], 0
            for i, text in enumerate(batch.column(2)):
                words = words_of(text.as_py())
                keys.append(xxhash.xxh3_128_digest(b" ".join(words)))
                sets.append(shingle_hashes(words, memo, size))
                total += len(sets[-1])
                if total >= GROUP_SHINGLES:
                    yield flush(batch.slice(begin, i + 1 - begin), keys, sets)
                    begin, keys, sets, total = i + 1, [], [], 0
            if keys:
                yield flush(batch.slice(begin), keys, sets)

    return run


def runs(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[list[tuple]]:
    """Rows sorted by their first ``n_keys`` columns, one list for each run of equal keys."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:n_keys] != key:
                if rows:
                    yield rows
                key, rows = row[:n_keys], []
            rows.append(row)
    if rows:
        yield rows


def reached(n: int, matches) -> np.ndarray:
    """The first member of each one's connected group; ``matches(i, others)`` tells which of ``others`` go with ``i``."""
    root = np.arange(n)
    free = np.arange(n)
    while len(free):
        head, free = free[0], free[1:]
        queue = [head]
        while queue and len(free):
            hit = matches(queue.pop(), free)
            joined, free = free[hit], free[~hit]
            root[joined] = head
            queue.extend(joined.tolist())
    return root


def tie(least: int):
    """Texts under one prefix (tree, prefix, low, high, child, open, key, signature) to edges of those that agree in enough minimum hashes.

    Pairs under the same longer prefix (``child``) met there, and pairs of settled texts are not looked for.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for rows in runs(batches, 4):
            if len(rows) > 1:
                child = np.array([r[4] for r in rows], np.int64)
                unsettled = np.array([r[5] for r in rows], bool)
                marks = np.array([np.frombuffer(r[7], np.uint16) for r in rows])

                def agreeing(i, others, rows=rows, child=child, unsettled=unsettled, marks=marks):
                    agree = (marks[others] == marks[i]).sum(1)
                    hit = (agree >= least) & (child[others] != child[i])
                    if not unsettled[i]:
                        hit &= unsettled[others]
                    out.extend((rows[i][6], rows[j][6], n) for j, n in zip(others[hit].tolist(), agree[hit].tolist(), strict=True))
                    return hit

                reached(len(rows), agreeing)
            if len(out) >= 10_000:
                yield to_batch(out)
                out.clear()
        yield to_batch(out)

    def to_batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.binary()), pa.array([r[2] for r in out], pa.int32())],
            ["a", "b", "agree"],
        )

    return run


def intersections(sets: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all pairwise intersections of sorted sets of numbers."""
    n = len(sets)
    doc = np.repeat(np.arange(n), [len(s) for s in sets])
    _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    place = np.cumsum(shared) - 1
    keep = shared[at]
    doc, at = doc[keep], place[at[keep]]
    order = np.argsort(at, kind="stable")
    doc, at = doc[order], at[order]
    out = np.zeros((n, n), np.float32)
    for low in range(0, int(shared.sum()), columns):
        i, j = np.searchsorted(at, (low, low + columns))
        held = np.zeros((n, columns), np.float32)
        held[doc[i:j], at[i:j] - low] = 1
        out += held @ held.T
    return out


def similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sets have a Jaccard similarity of at least the threshold, no set with itself."""
    sizes = np.array([len(s) for s in sets], np.int64)
    both = np.rint(intersections(sets)).astype(np.int64)
    # In whole numbers up to the one product, as |a and b| >= t * |a or b|.
    linked = both >= threshold * (sizes[:, None] + sizes[None, :] - both)
    np.fill_diagonal(linked, False)
    return linked


def verify(size: int, threshold: float):
    """Texts of a group and pair of blocks (group, low, high, block, key, copies, text) to (key, links, class key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        out: list[tuple] = []
        for rows in runs(batches, 3):
            seen: dict[bytes, tuple] = {}
            for r in rows:  # rows of different texts may share a row hash; then a key's text comes more than once
                seen.setdefault(r[4], r)
            rows = list(seen.values())
            sets = [np.unique(shingle_hashes(words_of(r[6]), memo, size)) for r in rows]
            linked = similar(sets, threshold)
            root = reached(len(rows), lambda i, others, m=linked: m[i, others])
            block = np.array([r[3] for r in rows])
            if rows[0][1] != rows[0][2]:  # pairs inside a block are counted by that block's own task
                linked &= block[:, None] != block[None, :]
            links = linked @ np.array([r[5] for r in rows], np.int64)
            out.extend((r[4], int(n), rows[i][4]) for r, n, i in zip(rows, links.tolist(), root.tolist(), strict=True))
            if len(out) >= 10_000:
                yield to_batch(out)
                out = []
        yield to_batch(out)

    def to_batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.binary())],
            ["text_key", "links", "head"],
        )

    return run


def block_pairs(df: DataFrame, blocks: Column, key: str) -> DataFrame:
    """Each row once for each pair of blocks that its own block is in: columns ``low <= high`` and ``block``."""
    own = F.pmod(F.xxhash64(key), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))).alias("other")
    return df.withColumn("block", own).select("*", other).select(
        "*", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )


def dealt(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of equal keys together in a partition, one after another."""
    return df.repartition(*keys).sortWithinPartitions(*keys)


def prefix_at(tree: str, depth: int, length: int) -> Column:
    """The first ``length`` hashes of a tree's part of ``signature``."""
    return F.expr(f"substring(signature, {tree} * {depth * HASH_BYTES} + 1, {length * HASH_BYTES})")


def meet(leaves: DataFrame, folder: str, trees: int, depth: int, length: int, least: int) -> DataFrame:
    """Edges ``(a, b, agree)`` of leaves ``(leaf, signature, open)`` that first meet under prefixes of ``length`` hashes."""
    # At the full depth each leaf is a child of its own, above it the longer prefix is the child.
    child = F.xxhash64("leaf") if length == depth else F.xxhash64(prefix_at("tree", depth, length + 1))
    under = leaves.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).select(
        "tree", prefix_at("tree", depth, length).alias("prefix"), child.alias("child"), "leaf", "open"
    )
    nodes = under.groupBy("tree", "prefix").agg(
        F.count("*").alias("n"), F.max("open").alias("any_open"), F.min("child").alias("first"), F.max("child").alias("last")
    )
    nodes = stage(nodes.where("any_open AND first < last").select("tree", "prefix", "n"), folder, f"nodes-{length}")
    held = lookup_join(under, nodes, ["tree", "prefix"], "inner").join(leaves.select("leaf", "signature"), "leaf")
    held = block_pairs(held, F.ceil(F.col("n") / NODE_BLOCK), "leaf").where(f"n <= {NODE_BLOCK} OR low < high")
    node = ["tree", "prefix", "low", "high"]
    met = dealt(held.select(*node, "child", "open", "leaf", "signature"), node).mapInArrow(tie(least), MET)
    return stage(met.distinct(), folder, f"met-{length}")


def settle(leaves: DataFrame, met: DataFrame, trees: int, hashes: int, length: int, recall: float) -> DataFrame:
    """``leaves``, open only where the estimated recall is still short.

    A partner that agrees in a share ``s`` of the hashes is met with probability ``1 - (1 - s**length)**trees``, so it stands for the inverse
    of that many partners. A leaf's recall is estimated as those met over those they stand for, and is 0 if none was met.
    """
    chance = 1 - F.pow(1 - F.pow(F.col("agree") / hashes, F.lit(length)), F.lit(trees))
    ends = met.select(F.explode(F.array("a", "b")).alias("leaf"), (1 / chance).alias("stands_for"))
    settled = ends.groupBy("leaf").agg((F.count("*") / F.sum("stands_for")).alias("recall")).where(F.col("recall") >= recall)
    settled = settled.select("leaf", F.lit(True).alias("settled"))
    return leaves.join(settled, "leaf", "left").select("leaf", "signature", (F.col("open") & F.col("settled").isNull()).alias("open"))


def forest_ties(distinct: DataFrame, folder: str, threshold: float, trees: int, depth: int, recall: float) -> DataFrame:
    """Edges ``(a, b)`` between keys of ``distinct`` texts that may be similar."""
    spark = distinct.sparkSession
    hashes, least = trees * depth, least_agreement(threshold, trees * depth)
    leaves = distinct.groupBy("signature").agg(F.min("text_key").alias("leaf"), F.count("*").alias("n"))
    leaves = stage(leaves.select("leaf", "signature", F.lit(True).alias("open"), "n"), folder, "leaves")
    crowded = leaves.where("n > 1").select("signature", F.col("leaf").alias("a"))
    ties = lookup_join(distinct.select("signature", F.col("text_key").alias("b")), crowded, ["signature"], "inner").where("a < b").select("a", "b")
    now = leaves.drop("n")
    for length in range(depth, prefix_length(threshold, trees, depth, recall) - 1, -1):
        met = meet(now, folder, trees, depth, length, least)
        discard(spark, f"{folder}/nodes-{length}")
        ties = ties.union(met.select("a", "b"))
        now = stage(settle(now, met, trees, hashes, length, recall), folder, f"open-{length}")
        if length < depth:
            discard(spark, f"{folder}/open-{length + 1}")
        if now.where("open").isEmpty():
            break
    return ties


def one_text_each(texts: DataFrame, members: DataFrame, rows: DataFrame, folder: str) -> DataFrame:
    """``members`` with the text of their ``row``, each once, however many of ``rows`` are equal in identifier and text."""
    repeated = rows.groupBy("row").agg(F.count("*").alias("n")).where("n > 1").select("row")
    repeated = stage(repeated, folder, "repeated")
    once = stage(lookup_join(members, repeated, ["row"], "left_anti"), folder, "once")
    several = stage(lookup_join(members, repeated, ["row"], "left_semi"), folder, "several")
    held = lookup_join(texts, once, ["row"], "inner")
    if several.isEmpty():
        return held
    one = lookup_join(texts, several.select("row").distinct(), ["row"], "left_semi").groupBy("row").agg(F.first("text").alias("text"))
    return held.unionByName(one.join(several, "row").select(*held.columns))


def similarity_classes(
    docs: DataFrame,
    threshold: float = 0.8,
    size: int = 5,
    trees: int = TREES,
    depth: int = DEPTH,
    recall: float = RECALL,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``(row, doc_id, class_key, class_id, n_copies, n_links)`` for each row of ``docs``.

    Words are runs of ASCII letters and digits, lower-cased, and of characters beyond ASCII; a shingle is ``size`` words, and a text of
    fewer words is one shingle of all of them. ``n_copies`` counts the rows with the same words, the row
    itself included; ``n_links`` the other rows whose similarity is at least the threshold, copies included. A class is a set of rows that are linked
    directly or by way of others; ``class_id`` is its lowest identifier. ``row`` is a hash of identifier and text,
    ``class_key`` tells classes apart even where rows of different texts share an identifier; it is null without words.

    Null and empty texts and texts without words are linked with nothing: each row is its own class with one copy. A
    null identifier is a row like others, and ``class_id`` is null if all of the class are null. Repeated rows are
    copies. An empty table gives an empty result; other columns are not looked at.

    Of pairs at the threshold a text that is not settled misses at most ``1 - recall``; a pair of texts that both settled at a prefix of
    ``k`` hashes was met with probability ``1 - (1 - threshold**k)**trees``. Where the threshold is so low that ``trees`` don't reach the
    recall with any prefix, there are more trees.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = scratch(spark, "similarity")
    trees = trees_for(threshold, trees, recall)
    row = F.xxhash64(F.col(id_col), F.col(text_col)).alias("row")
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    texts = docs.select(row, F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    signed = stage(texts.mapInArrow(signer(size, trees * depth), SIGNED.format(id=id_type)), folder, "signed")

    distinct = signed.where("n_shingles > 0").groupBy("text_key").agg(
        F.count("*").alias("copies"),
        F.min("id").alias("least_id"),
        F.min("row").alias("row"),
        F.min("n_shingles").alias("n_shingles"),
        F.min("signature").alias("signature"),
    )
    distinct = stage(distinct, folder, "distinct")

    tied = components(forest_ties(distinct, folder, threshold, trees, depth, recall))
    members = tied.select(F.col("vertex").alias("text_key"), F.col("component").alias("group")).join(
        distinct.select("text_key", "row", "copies", "n_shingles"), "text_key"
    )
    members = stage(members, folder, "tied")

    groups = members.groupBy("group").agg(
        F.ceil(F.greatest(F.count("*") / SET_BLOCK, F.sum("n_shingles") / SET_SHINGLES)).alias("blocks")
    )
    members = stage(members.join(groups, "group").select("row", "text_key", "copies", "group", "blocks"), folder, "members")
    held = one_text_each(docs.select(row, text_bytes(text_col).alias("text")), members, signed.where("n_shingles > 0"), folder)
    held = block_pairs(held, F.col("blocks"), "text_key").select("group", "low", "high", "block", "text_key", "copies", "text")
    checked = dealt(held, ["group", "low", "high"]).mapInArrow(
        verify(size, threshold), "text_key binary, links bigint, head binary"
    )
    checked = stage(checked, folder, "checked")

    links = checked.groupBy("text_key").agg(F.sum("links").alias("links"))
    classes = components(checked.select(F.col("head").alias("a"), F.col("text_key").alias("b")))
    classed = (
        distinct.select("text_key", "copies", "least_id")
        .join(links, "text_key", "left")
        .join(classes.select(F.col("vertex").alias("text_key"), "component"), "text_key", "left")
        .withColumn("component", F.coalesce("component", "text_key"))
    )
    classed = stage(classed, folder, "classed")
    names = classed.groupBy("component").agg(F.min("least_id").alias("class_id"))
    result = stage(
        classed.join(names, "component").select(
            "text_key", F.col("component").alias("class_key"), "class_id", F.col("copies").alias("n_copies"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
        ),
        folder,
        "classes",
    )
    rows = signed.select("row", "id", "n_shingles", "text_key")
    return rows.join(result, "text_key", "left").select(
        "row",
        F.col("id").alias(id_col),
        "class_key",
        F.when(F.col("n_shingles") > 0, F.col("class_id")).otherwise(F.col("id")).alias("class_id"),
        F.coalesce("n_copies", F.lit(1)).alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class: that with the lowest identifier, of those the lowest row hash, of equal rows
    one. Columns are kept. A null identifier comes after all others. Rows without words all stay.
    """
    spark = docs.sparkSession
    folder = scratch(spark, "one-of-each")
    name = free_name(docs, "__row")
    row = F.xxhash64(F.col(id_col), F.col(text_col))
    found = similarity_classes(docs, id_col=id_col, text_col=text_col, **options)
    rows = found.groupBy("row").agg(F.min(id_col).alias("id"), F.first("class_key").alias("class_key"), F.count("*").alias("n"))
    rows = stage(rows.where("class_key IS NOT NULL"), folder, "rows")
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "row"))
    heads = rows.groupBy("class_key").agg(first.alias("first")).select(F.col("first.row").alias("row"))
    losers = rows.join(heads, "row", "left_anti").select(F.col("row").alias(name))
    again = rows.join(heads, "row", "left_semi").where("n > 1").select(F.col("row").alias(name))
    marked = docs.withColumn(name, row)
    stay = lookup_join(marked, stage(losers, folder, "losers"), [name], "left_anti")
    # Of a row that is there several times, one stays.
    again = stage(again, folder, "again")
    once = lookup_join(stay, again, [name], "left_anti").select(*docs.columns)
    several = lookup_join(stay, again, [name], "left_semi").groupBy(name).agg(*[F.first(c).alias(c) for c in docs.columns])
    return once.unionByName(several.select(*docs.columns))
