"""Packing of documents into fixed windows of tokens, with every source at its target share of every window.

Each source is a queue of tokens. Deficit round-robin serves the queues window by window: a queue's
share of a window is its target times the window's length, plus what rounding owed it before. That schedule has
a closed form. The queues are the leaves of a binary tree. Of ``g`` tokens that a node gives, its left child gives ``floor(g * A / W)``,
with ``A`` and ``W`` the weights of the child and the node, and its right child the others; the remainder of that division is the
deficit that is carried on. Both grow with ``g`` token by token, however small a weight is. So no task has to
wait for another: the tokens that a queue gives to a window follow from the window's number alone, and the
deficits go across windows and partitions without being handed over. A queue that runs dry ends
a phase, and the others go on with their weights.

The driver holds the queues of large sources and of those with a target of their own. All other sources are below one queue of it, in a
tree whose nodes are the beginnings of the hashes of their names; the weights on the way to a source are joined to its documents.

Documents are encoded once. Every task keeps a running sum for each queue, and only the sums of the tasks
are shuffled, so a source may hold any share of all tokens and no text or token is shuffled.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chroniq.llm.common import scratch, ship
from chroniq.operators.lookup import lookup_join
from chroniq.session import stage

#: Fixed value: the public pattern of byte-level BPE vocabularies of this kind.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
NO_SOURCE = "\x00null"  # the queue of rows whose source is null
REST = "\x00rest"
MIN_SHARE = 1 / 1024  # sources below this share of all tokens are have their queues in a tree below one of the driver's

PIECES = (
    "doc_id {id}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "`offset` bigint, source string{ids}"
)


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable ones as they are, the rest from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Encoder:
    """Token ids of a tokenizer file, without added special tokens.

    A plain byte-level BPE file is run by the faster of the two libraries that read such vocabularies;
    its ids are those of the other (tests compare them). Any other file is run by its own library.
    """

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        plain = (
            spec["model"].get("type") == "BPE"
            and not spec.get("normalizer")
            and pre.get("type") == "ByteLevel"
            and pre.get("use_regex") is True
            and pre.get("add_prefix_space") is False
            and all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec["added_tokens"])
        )
        if plain:
            import tiktoken

            letters = byte_letters()
            special = {t["content"]: t["id"] for t in spec["added_tokens"]}
            ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
            encoding = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=special)
            allowed = set(special)
            self.encode = lambda text: encoding.encode_to_numpy(
                text, allowed_special=allowed if any(s in text for s in allowed) else set(), disallowed_special=()
            )
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            self.encode = lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)


def tokenizer_task(path: str, end_id: int):
    """(part, id, source, text) to the rows of the staged table, with running sums for each source of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        before: dict[str, int] = defaultdict(int)
        for whole in batches:
            for i in range(0, whole.num_rows, 2000):
                part = whole.slice(i, 2000)
                sources = part.column(2).to_pylist()
                blobs, sizes, starts = [], [], []
                for source, text in zip(sources, part.column(3).to_pylist(), strict=True):
                    ids = np.append(encoder.encode(text), end_id).astype("<u4")
                    narrow = ids.astype("<u2") if int(ids.max()) < 65536 else ids
                    blobs.append(narrow.tobytes())
                    sizes.append(len(ids))
                    starts.append(before[source])
                    before[source] += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), pa.array(sizes, pa.int64()), pa.array(starts, pa.int64()), pa.array(blobs, pa.binary())],
                    ["part", "doc_id", "source", "doc_tokens", "before", "ids"],
                )

    return run


def mul_div(a: np.ndarray, b: int, c: int) -> np.ndarray:
    """floor(a * b / c) exactly, for products beyond 64 bits: an estimate, put right by the wrapped remainder."""
    a = a.astype(np.int64)
    if b == 0:
        return np.zeros_like(a)
    guess = np.floor(a.astype(np.longdouble) * (np.longdouble(b) / np.longdouble(c))).astype(np.int64)
    with np.errstate(over="ignore"):
        rest = (a.astype(np.uint64) * np.uint64(b) - guess.astype(np.uint64) * np.uint64(c)).view(np.int64)
    return guess + rest // np.int64(c)


def divided(weights: list[int], g: int) -> list[int]:
    """What each queue gives of ``g`` tokens."""
    sums = [0, *accumulate(weights)]
    out = [0] * len(weights)
    todo = [(0, len(weights), g)]
    while todo:
        lo, hi, n = todo.pop()
        if hi - lo == 1:
            out[lo] = n
        elif n:
            mid = (lo + hi) // 2
            left = n * (sums[mid] - sums[lo]) // (sums[hi] - sums[lo])
            todo += [(lo, mid, left), (mid, hi, n - left)]
    return out


@dataclass(frozen=True)
class Schedule:
    """How many tokens each queue has given after ``e`` tokens of output."""

    names: tuple[str, ...]
    sizes: tuple[int, ...]
    length: int
    phases: tuple[tuple[int, tuple[int, ...], tuple[int, ...]], ...]  # (start, tokens given before, weights)

    @property
    def total(self) -> int:
        return sum(self.sizes)

    @classmethod
    def plan(cls, sizes: dict[str, int], length: int, weights: dict[str, float] | None = None) -> Schedule:
        names = tuple(sorted(sizes))
        left = [sizes[n] for n in names]
        # Without targets, each queue's share is its share of all tokens, and all end together.
        wanted = list(left) if weights is None else [max(1, round(weights.get(n, 0) * (1 << 30))) for n in names]
        given, phases, at = [0] * len(names), [], 0
        while any(left):
            w = [v if rest else 0 for v, rest in zip(wanted, left, strict=True)]
            # The last token at which no queue has given more than it has left; there one has given all.
            low, high = 1, sum(left)
            while low < high:
                mid = (low + high + 1) // 2
                fits = all(n <= rest for n, rest in zip(divided(w, mid), left, strict=True))
                low, high = (mid, high) if fits else (low, mid - 1)
            phases.append((at, tuple(given), tuple(w)))
            for i, n in enumerate(divided(w, low)):
                given[i] += n
                left[i] -= n
            at += low
        return cls(names, tuple(sizes[n] for n in names), length, tuple(phases))

    def placed(self, queue: int, e: np.ndarray, path: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
        """Tokens that the queues before a queue, and the queue itself, have given after ``e`` tokens of output.

        ``path`` leads to a source below the queue: the weight of the node, then for each step the weight of the next node,
        negative if it is the right one.
        """
        before, own = np.zeros(len(e), np.int64), np.zeros(len(e), np.int64)
        starts = np.array([p[0] for p in self.phases], np.int64)
        which = np.searchsorted(starts, e, side="right") - 1
        for i in np.unique(which):
            start, given, w = self.phases[i]
            at = which == i
            g, passed, lo, hi = e[at] - start, sum(given[:queue]), 0, len(w)
            while hi - lo > 1:
                mid = (lo + hi) // 2
                left = mul_div(g, sum(w[lo:mid]), max(1, sum(w[lo:hi])))
                if queue < mid:
                    g, hi = left, mid
                else:
                    passed, g, lo = passed + left, g - left, mid
            before[at], own[at] = passed, given[queue] + g
        for whole, part in zip(map(abs, path), path[1:], strict=False):
            if part < 0:
                left = mul_div(own, whole + part, whole)
                before, own = before + left, own - left
            else:
                own = mul_div(own, part, whole)
        return before, own

    def given(self, queue: int, window: np.ndarray, path: tuple[int, ...] = ()) -> np.ndarray:
        """Tokens that a queue has given when the windows ``0..window`` are full."""
        return self.placed(queue, np.minimum((window + 1) * self.length, self.total), path)[1]

    def pieces(self, queue: int, first: np.ndarray, last: np.ndarray, path: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
        """Cut token ranges ``[first, last)`` of a queue: (range's index, start in queue, length, window, offset)."""
        low, high = np.zeros(len(first), np.int64), np.full(len(first), -(-self.total // self.length) - 1, np.int64)
        ends = []
        for target in (first, last - 1):  # the first window after which the token is given
            lo, hi = low.copy(), high.copy()
            while (lo < hi).any():
                mid = (lo + hi) // 2
                done = self.given(queue, mid, path) > target
                lo, hi = np.where(done, lo, np.minimum(mid + 1, hi)), np.where(done, mid, hi)
            ends.append(lo)
        n = ends[1] - ends[0] + 1
        row = np.repeat(np.arange(len(first)), n)
        window = ends[0][row] + np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        (passed0, opens), (passed1, closes) = (self.placed(queue, np.minimum(w * self.length, self.total), path) for w in (window, window + 1))
        start = np.maximum(first[row], opens)
        size = np.minimum(last[row], closes) - start
        offset = passed1 - passed0 + start - opens
        keep = size > 0
        return row[keep], start[keep], size[keep], window[keep], offset[keep]


def cutter(schedule: Schedule, with_ids: bool):
    """(id, queue, first token in queue, tokens, ids, source, path below the queue) to pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 1000):
                part = whole.slice(i, 1000)
                queue = part.column(1).to_numpy(zero_copy_only=False)
                first = part.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
                tokens = part.column(3).to_numpy(zero_copy_only=False).astype(np.int64)
                cuts = []
                queues = defaultdict(list)
                for r, key in enumerate(zip(queue.tolist(), map(tuple, part.column(6).to_pylist()), strict=True)):
                    queues[key].append(r)
                for (q, path), rows in queues.items():
                    rows = np.array(rows)
                    row, *rest = schedule.pieces(q, first[rows], first[rows] + tokens[rows], path)
                    cuts.append((rows[row], *rest))
                row, start, size, window, offset = (np.concatenate(c) for c in zip(*cuts, strict=True))
                start -= first[row]
                blobs = part.column(4).to_pylist()
                wide = [np.frombuffer(b, "<u2" if len(b) == 2 * n else "<u4").astype("<u4") for b, n in zip(blobs, tokens, strict=True)]
                sums, ids = np.empty(len(row), np.int64), []
                for k, (r, a, n) in enumerate(zip(row.tolist(), start.tolist(), size.tolist(), strict=True)):
                    piece = wide[r][a : a + n]
                    sums[k] = zlib.crc32(piece)
                    if with_ids:
                        ids.append(piece)
                take = pa.array(row)
                columns = [part.column(0).take(take), pa.array(start), pa.array(size), pa.array(sums), pa.array(tokens[row]), pa.array(window), pa.array(offset), part.column(5).take(take)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def paths_below(sources: DataFrame, folder: str) -> DataFrame:
    """``(source, leaf, path)`` of the sources, by their tokens ``n``, in the tree of the hashes of their names.

    Only two sources of the same hash would share a leaf. Steps at which a node has one child are left out.
    """
    sources = sources.withColumn("leaf", F.xxhash64("source"))
    steps = sources.select("source", "leaf", "n", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("depth"))
    # The first bits of the hash; of none, and of all, there is no shift.
    node = F.when(F.col("depth") == 0, F.lit(0).cast("bigint")).otherwise(F.expr("shiftrightunsigned(leaf, 64 - depth)"))
    steps = steps.withColumn("node", node)
    nodes = stage(steps.groupBy("depth", "node").agg(F.sum("n").alias("weight")), folder, "nodes")
    steps = lookup_join(steps, nodes, ["depth", "node"], "inner")
    right = (F.col("depth") > 0) & (F.col("node").bitwiseAND(1) == 1)
    step = F.struct("depth", F.when(right, -F.col("weight")).otherwise(F.col("weight")).alias("weight"))
    found = steps.groupBy("source", "leaf").agg(F.array_sort(F.collect_list(step)).alias("steps"))  # 65 for each source
    weights = F.transform("steps", lambda x: x["weight"])
    path = F.filter(weights, lambda x, i: (i == 0) | (F.abs(x) != F.abs(F.get(weights, i - 1))))
    return stage(found.select("source", "leaf", path.alias("path")), folder, "paths")


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    length: int = 2048,
    end_id: int = 1,
    weights: dict[str, float] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of documents in windows of ``length`` tokens: ``(doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, source[, ids])``.

    ``weights`` are target shares by source, by default the shares the sources have of all tokens. Every
    token, the end token of each document included, lies in one piece. All windows are full but the last.

    A null text is empty (its document is the end token alone); a null source is a source of its own; a null identifier
    stays null; repeated rows are packed as often as they are there; an empty table gives no pieces;
    other columns are not looked at. Every source has its own target, however small it is and however many there are. Sources that
    ``weights`` does not name come after the others; small ones among them by their shares of all tokens.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = scratch(spark, "packing")
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    source = F.coalesce(F.col(source_col).cast("string"), F.lit(NO_SOURCE))
    rows = docs.select(F.spark_partition_id().alias("part"), F.col(id_col), source, F.coalesce(F.col(text_col), F.lit("")))
    schema = f"part int, doc_id {id_type}, source string, doc_tokens bigint, before bigint, ids binary"
    rows.mapInArrow(tokenizer_task(tokenizer_path, end_id), schema).write.option("compression", "zstd").parquet(f"{folder}/ids")
    encoded = spark.read.schema(schema).parquet(f"{folder}/ids")

    by_task = stage(encoded.groupBy("source", "part").agg(F.sum("doc_tokens").alias("n")), folder, "sums")
    total = by_task.agg(F.sum("n")).first()[0] or 0
    by_source = by_task.groupBy("source").agg(F.sum("n").alias("n"))
    least = total * max(MIN_SHARE, 1 / length)
    named = F.col("source").isin(list(weights or {}))
    large = {r.source: r.n for r in by_source.where((F.col("n") >= least) | named).collect()}  # at most 1,024 and those named
    rest = total - sum(large.values())
    if weights is None and 0 < rest < least and large:  # too small for a queue of its own: one more source goes below it
        rest += large.pop(min(large, key=lambda s: (large[s], s)))
    sizes = large | ({REST: rest} if rest else {})
    schedule = Schedule.plan(sizes, length, weights)

    number = {name: i for i, name in enumerate(schedule.names)}
    queue = F.lit(number.get(REST, 0))
    if large:
        ids = F.create_map(*[F.lit(x) for s in large for x in (s, number[s])])
        queue = F.coalesce(F.try_element_at(ids, F.col("source")), queue)
    no_path = F.array().cast("array<bigint>")
    by_task = by_task.withColumn("queue", queue)
    if rest:
        small = by_source.where(~F.col("source").isin(list(large)))
        by_task = by_task.join(paths_below(small, folder), "source", "left")
        by_task = by_task.withColumns({"leaf": F.coalesce("leaf", F.lit(0)), "path": F.coalesce("path", no_path)})
    else:
        by_task = by_task.withColumns({"leaf": F.lit(0).cast("bigint"), "path": no_path})
    # Where a task's tokens of a source begin in the queue: sums of the tasks before it, in the order (part, source).
    order = Window.partitionBy("queue", "leaf").orderBy("part", "source").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.withColumn("base", F.coalesce(F.sum("n").over(order), F.lit(0))).drop("n", "leaf")
    bases = stage(bases, folder, "bases")
    placed = lookup_join(encoded, bases, ["source", "part"], "inner")
    null_source = F.when(F.col("source") != NO_SOURCE, F.col("source"))
    return placed.select(
        "doc_id", "queue", (F.col("base") + F.col("before")).alias("first"), "doc_tokens", "ids", null_source.alias("source"), "path"
    ).mapInArrow(cutter(schedule, with_ids), PIECES.format(id=id_type, ids=", ids array<bigint>" if with_ids else ""))
