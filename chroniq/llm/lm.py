"""Bigram language model by deleted interpolation, learned from and applied to whole corpora.

    P(w | h) = l2 * c(h, w) / C(h) + l1 * c(w) / N + l0 / (V + 1),   weights by the bucket floor(log2(C(h) + 1))

The weights of each bucket are learned by expectation-maximisation. For that, a tenth of the training texts is deleted from the
counts, and the likelihood of its tokens under the rest is maximised; the final counts are those of all training texts.

Counts never pass through the driver and are never broadcast. A task turns texts into chunks, each with its own small
vocabulary. A chunk sends its distinct words and word pairs, each once with its local counts, to the buckets of
their hashes; a bucket adds up and answers each chunk with the totals. So a word that makes up any share of all tokens is one entry
per chunk, and the work grows with the tokens.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chroniq.llm.common import MULT, WordHashes, mixed, scratch, ship, text_bytes
from chroniq.llm.ngram_join import dealt, runs
from chroniq.session import stage

TEST, KEPT, DELETED = 0, 1, 2
BEGIN, END = 0, 1  # local numbers; words follow
CHUNK_TOKENS = 1_000_000
BUCKET_KEYS = 1_000_000
LEVELS = 40  # buckets of context frequency: up to 2 ** 40
STEPS = 4  # steps to an octave in which relative frequencies are tabulated for the estimation of weights
OCTAVES = 50
CELLS = OCTAVES * STEPS + 2  # the last one stands for a frequency of zero

CHUNK = (
    "chunk bigint, kind int, bucket bigint, uids array<bigint>, ids array<{id}>, classes array<int>, lengths array<int>, "
    "heads array<int>, tokens binary, vocabulary binary, kept binary, deleted binary, owned bigint"
)
ANSWER = (
    "chunk bigint, uids array<bigint>, ids array<{id}>, classes array<int>, lengths array<int>, heads array<int>, tokens binary, "
    "words binary, pairs binary, cells array<int>, counts array<bigint>"
)


def packed(x: np.ndarray) -> bytes:
    """Numbers as planes of bytes, compressed: leading zero bytes of small numbers cost nothing."""
    import zstandard

    x = np.ascontiguousarray(x)
    planes = np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(blob: bytes, dtype) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).ravel()


def tokens_of(text: bytes) -> list[bytes]:
    """Words between ASCII white space, with A-Z in lower case."""
    return text.lower().split()


def chunker(limit: int):
    """(part, uid, id, class, text) to chunks. A text of more than ``limit`` tokens goes to several chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, number = WordHashes(), 0

        def fresh() -> tuple:
            return {}, [], [], [], [], [], []

        vocabulary, uids, ids, classes, lengths, heads, tokens = fresh()
        part, filled = 0, 0

        def flush() -> pa.RecordBatch:
            marks = [b"\t", b"\n"]  # no word has these
            words = np.fromiter((hashes[w] for w in [*marks, *vocabulary]), np.uint64, len(vocabulary) + 2)
            local = np.concatenate(tokens).astype(np.uint32)
            values = [(part << 32) + number, 0, -1, uids, ids, classes, lengths, heads, packed(local), packed(words), None, None, None]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names)

        types = names = None
        for batch in batches:
            if types is None:
                ints = pa.list_(pa.int32())
                types = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(batch.schema.field(2).type), ints, ints, ints, *[pa.binary()] * 4, pa.int64()]
                names = [c.split()[0] for c in CHUNK.split(", ")]
            part = batch.column(0)[0].as_py() if batch.num_rows else part
            for i in range(batch.num_rows):
                uid, name, kind = (batch.column(c)[i].as_py() for c in (1, 2, 3))
                words = tokens_of(batch.column(4)[i].as_py())
                at, head = 0, b""
                while True:
                    piece = words[at : at + limit]
                    first = BEGIN if at == 0 else vocabulary.setdefault(head, len(vocabulary) + 2)
                    local = [vocabulary.setdefault(w, len(vocabulary) + 2) for w in piece]
                    at += len(piece)
                    if at == len(words):
                        local.append(END)
                    if local:
                        uids.append(uid), ids.append(name), classes.append(kind), lengths.append(len(local)), heads.append(first)
                        tokens.append(np.array(local, np.uint32))
                        filled += len(local)
                    if filled >= limit:
                        yield flush()
                        vocabulary, uids, ids, classes, lengths, heads, tokens = fresh()
                        number, filled = number + 1, 0
                    if at == len(words):
                        break
                    head = piece[-1]
        if filled:
            yield flush()

    return run


class Chunk:
    """A chunk's tokens with their contexts, its distinct word pairs, and the hashes of both."""

    def __init__(self, row: dict) -> None:
        self.words = unpacked(row["vocabulary"], np.uint64) if row.get("vocabulary") else None
        self.tokens = unpacked(row["tokens"], np.uint32).astype(np.int64)
        self.lengths = np.array(row["lengths"], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.classes = np.repeat(np.array(row["classes"]), self.lengths)
        self.heads = np.array(row["heads"], np.int64)
        self.before = np.empty_like(self.tokens)
        self.before[1:] = self.tokens[:-1]
        self.before[self.starts] = self.heads
        self.base = int(max(self.tokens.max(), self.before.max())) + 1
        self.pairs, self.which = np.unique(self.before * self.base + self.tokens, return_inverse=True)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of words and then of pairs, and the order that sorts them."""
        w = self.words
        pairs = mixed(mixed(w[self.pairs // self.base]) * MULT + w[self.pairs % self.base])
        keys = np.concatenate([mixed(w ^ MULT), pairs])
        return keys, np.argsort(keys, kind="stable")

    def counts(self, kind: int, row_classes: np.ndarray) -> np.ndarray:
        """Local counts of words and pairs in texts of a class. A beginning counts as the context that it is."""
        chosen = self.classes == kind
        words = np.bincount(self.tokens[chosen], minlength=len(self.words))
        words[BEGIN] = ((self.heads == BEGIN) & (row_classes == kind)).sum()
        return np.concatenate([words, np.bincount(self.which[chosen], minlength=len(self.pairs))])


def buckets_of(keys: np.ndarray, n: int) -> np.ndarray:
    """Ranges of hashes: sorted keys have sorted buckets."""
    return ((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)


def asker(n_buckets: int):
    """Chunks to requests: (bucket, chunk, keys as steps, local counts, which keys are words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row)
                keys, order = chunk.keys()
                keys = keys[order]
                kept, deleted = (chunk.counts(k, np.array(row["classes"]))[order].astype(np.uint32) for k in (KEPT, DELETED))
                is_word = (order < len(chunk.words)) & (order != BEGIN)
                bucket = buckets_of(keys, n_buckets)
                cuts = np.flatnonzero(np.diff(bucket)) + 1
                out = []
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
                    steps = np.diff(keys[a:b], prepend=np.uint64(0))
                    out.append((int(bucket[a]), row["chunk"], packed(steps), packed(kept[a:b]), packed(deleted[a:b]), packed(is_word[a:b].view(np.uint8))))
                kinds = [pa.int64(), pa.int64(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                    ["bucket", "chunk", "keys", "kept", "deleted", "is_word"],
                )

    return run


def adder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Requests of a bucket to answers with the totals of their keys. A word is owned by one of the chunks that have it."""
    for rows in runs(batches, 1):
        keys = [np.cumsum(unpacked(r[2], np.uint64)) for r in rows]
        ends = np.cumsum([len(k) for k in keys])
        distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
        kept = np.bincount(which, np.concatenate([unpacked(r[3], np.uint32) for r in rows]), len(distinct)).astype(np.int64)
        deleted = np.bincount(which, np.concatenate([unpacked(r[4], np.uint32) for r in rows]), len(distinct)).astype(np.int64)
        is_word = np.concatenate([unpacked(r[5], np.uint8) for r in rows]).astype(bool)
        first = np.full(len(distinct), len(which))
        np.minimum.at(first, which, np.arange(len(which)))
        owner = first[which] == np.arange(len(which))
        owned = owner & is_word & ((kept + deleted)[which] > 0)
        out = []
        for r, a, b in zip(rows, [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            w = which[a:b]
            out.append((r[1], r[0], packed(kept[w]), packed(deleted[w]), int(owned[a:b].sum())))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["chunk", "bucket", "kept", "deleted", "owned"]
        )


def level(context: np.ndarray) -> np.ndarray:
    """The bucket of a context's frequency."""
    return np.minimum(np.log2(context + 1.0), LEVELS).astype(np.int64)


def cell(part: np.ndarray, whole: np.ndarray | float) -> np.ndarray:
    """The step in which a relative frequency falls, and the last cell for zero."""
    with np.errstate(divide="ignore", invalid="ignore"):
        step = np.rint(-STEPS * np.log2(part / whole))
    return np.where(part > 0, np.clip(np.nan_to_num(step, posinf=0, neginf=0), 0, CELLS - 2), CELLS - 1).astype(np.int64)


def answered(kept_tokens: int):
    """A chunk and its answers to the chunk with totals, and the table of frequencies of its deleted tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in CHUNK.split(", ")]
        ints = pa.list_(pa.int32())
        for rows in runs(batches, 1):
            row = dict(zip(names, rows[0], strict=True))
            chunk = Chunk(row)
            keys, order = chunk.keys()
            kept, deleted = np.empty(len(keys), np.int64), np.empty(len(keys), np.int64)
            kept[order] = np.concatenate([unpacked(r[names.index("kept")], np.int64) for r in rows[1:]])
            deleted[order] = np.concatenate([unpacked(r[names.index("deleted")], np.int64) for r in rows[1:]])
            n = len(chunk.words)
            held = chunk.classes == DELETED
            context = kept[:n][chunk.before[held]]
            table = (level(context) * CELLS + cell(kept[n:][chunk.which[held]], context)) * CELLS + cell(kept[:n][chunk.tokens[held]], float(max(kept_tokens, 1)))
            cells, counts = np.unique(table, return_counts=True)
            total = kept + deleted
            id_type = batches_type(row["ids"])
            values = [row["chunk"], row["uids"], row["ids"], row["classes"], row["lengths"], row["heads"], row["tokens"], packed(total[:n]), packed(total[n:]), cells.tolist(), counts.tolist()]
            types = [pa.int64(), pa.list_(pa.int64()), id_type, ints, ints, ints, *[pa.binary()] * 3, ints, pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) if t is not None else pa.array([v]) for v, t in zip(values, types, strict=True)],
                [c.split()[0] for c in ANSWER.split(", ")],
            )

    return run


def batches_type(ids: list):
    """Identifiers of a chunk may all be null; a number type is then as good as any other."""
    return pa.list_(pa.int64()) if all(i is None or isinstance(i, int) for i in ids) else None


def mixture_weights(table: np.ndarray, counts: np.ndarray, types: int, rounds: int = 100) -> np.ndarray:
    """Weights (l2, l1, l0) of each bucket by expectation-maximisation.

    Every component starts with one token's worth of belief, which also is what a bucket without tokens gets;
    in the bucket of unseen contexts the pair has no weight.
    """
    where = table // (CELLS * CELLS)

    def share(steps: np.ndarray) -> np.ndarray:
        return np.where(steps == CELLS - 1, 0.0, 2.0 ** (-steps / STEPS))

    f = np.stack([share(table // CELLS % CELLS), share(table % CELLS), np.full(len(table), 1.0 / (types + 1))])
    prior = np.ones((LEVELS + 1, 3))
    prior[0, 0] = 0
    weights = prior / prior.sum(1, keepdims=True)
    for _ in range(rounds):
        part = weights[where].T * f
        part *= counts / part.sum(0)
        seen = np.stack([np.bincount(where, p, LEVELS + 1) for p in part], 1) + prior
        weights = seen / seen.sum(1, keepdims=True)
    return weights


def scorer(weights: np.ndarray, tokens: int, types: int):
    """Chunks with totals to sums over each text: (uid, id, class, tokens, known ones, base score, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                chunk = Chunk(row)
                words, pairs = unpacked(row["words"], np.int64), unpacked(row["pairs"], np.int64)
                count, context = words[chunk.tokens], words[chunk.before]
                base = np.log10((words + 0.5) / (tokens + 0.5 * (types + 1)))[chunk.tokens]
                by = weights[level(context)]
                p = by[:, 0] * pairs[chunk.which] / np.maximum(context, 1) + by[:, 1] * count / max(tokens, 1) + by[:, 2] / (types + 1)
                sums = [np.add.reduceat(x, chunk.starts) for x in ((count > 0).astype(np.int64), base, np.log10(p))]
                id_type = batches_type(row["ids"])
                ids = pa.array(row["ids"], id_type.value_type) if id_type is not None else pa.array(row["ids"])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["uids"]), ids, pa.array(row["classes"], pa.int32()), pa.array(chunk.lengths), *map(pa.array, sums)],
                    ["uid", "id", "class", "n_tokens", "n_known", "base_score", "score"],
                )

    return run


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for each row of ``docs``.

    The model learns from the rows for which ``held_out`` is false. Tokens are words between ASCII white space with A-Z lower-cased, and an
    end. ``score`` is the model's log10 probability of the text; ``base_score`` that of smoothed unigrams; ``n_known``
    counts the tokens that occur in training.

    A null or empty text is the end alone; a null identifier stays null; repeated rows are counted and scored as
    often as they are there. Without training rows all frequencies are zero and the last component alone has a share.
    An empty table gives an empty result; other columns are not looked at. Identifiers are numbers or strings.
    """
    spark = docs.sparkSession
    ship(spark)
    folder = scratch(spark, "lm")
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    deleted = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col)), F.lit(10)) == 0
    kind = F.when(F.coalesce(held_out, F.lit(False)), TEST).when(deleted, DELETED).otherwise(KEPT)
    rows = docs.select(
        F.spark_partition_id().cast("bigint"), F.monotonically_increasing_id(), F.col(id_col), kind.alias("kind"), text_bytes(text_col)
    )
    schema = CHUNK.format(id=id_type)
    rows.mapInArrow(chunker(CHUNK_TOKENS), schema).write.parquet(f"{folder}/chunks")
    chunks = spark.read.schema(schema).parquet(f"{folder}/chunks")

    sizes = chunks.select(F.explode(F.arrays_zip("classes", "lengths")).alias("x")).groupBy("x.classes").agg(F.sum("x.lengths").alias("n"))
    tokens = {r.classes: r.n for r in sizes.collect()}
    train, everything = tokens.get(KEPT, 0) + tokens.get(DELETED, 0), sum(tokens.values())
    n_buckets = max(1, -(-everything // BUCKET_KEYS))  # there are fewer distinct pairs in a chunk than tokens

    asked = chunks.mapInArrow(asker(n_buckets), "bucket bigint, chunk bigint, keys binary, kept binary, deleted binary, is_word binary")
    answers = dealt(asked, ["bucket"]).mapInArrow(adder, "chunk bigint, bucket bigint, kept binary, deleted binary, owned bigint")
    answers = stage(answers, folder, "answers")
    types = answers.agg(F.sum("owned")).first()[0] or 0
    replies = answers.select(
        "chunk", F.lit(1).alias("kind"), "bucket", *[F.lit(None).cast(f.dataType).alias(f.name) for f in chunks.schema.fields[3:10]], "kept", "deleted", "owned"
    )
    both = chunks.unionByName(replies).repartition("chunk").sortWithinPartitions("chunk", "kind", "bucket")
    known = stage(both.mapInArrow(answered(tokens.get(KEPT, 0)), ANSWER.format(id=id_type)), folder, "known")

    table = known.select(F.explode(F.arrays_zip("cells", "counts")).alias("x")).groupBy("x.cells").agg(F.sum("x.counts").alias("n"))
    held = table.toPandas()  # a bounded number of cells: buckets by steps by steps
    weights = mixture_weights(held["cells"].to_numpy(np.int64), held["n"].to_numpy(np.float64), types)

    scored = known.select("uids", "ids", "classes", "lengths", "heads", "tokens", "words", "pairs").mapInArrow(
        scorer(weights, train, types),
        f"uid bigint, id {id_type}, class int, n_tokens bigint, n_known bigint, base_score double, score double",
    )
    # A very long text comes in several pieces.
    whole = scored.groupBy("uid").agg(
        F.first("id").alias(id_col),
        F.first("class").alias("class"),
        *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")],
    )
    return whole.select(
        id_col, (F.col("class") == TEST).alias("held_out"), "n_tokens", "n_known", F.lit(train).cast("bigint").alias("train_tokens"), "base_score", "score"
    )
