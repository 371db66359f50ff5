"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad. Its evidence is what the line looks like and what its neighbours look like; transition
weights tie it to the state before. Forward-backward gives each line's probability of being good, and a document's score is the
mean of these, weighted by the lines' lengths. The field is fitted to lines that carry their document's label, by gradient
ascent on the exact likelihood over a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chroniq.llm.common import ship, text_bytes

SAMPLE_DOCS = 8_000  # labelled documents the field is fitted to, at most
SAMPLE_LINES = 400_000  # and their lines, at most
GROUP_BYTES = 4 * 1024 * 1024

BINS = 16
NONE = BINS  # the bin of a neighbour that is not there
FEATURES = 12
SLOTS = FEATURES * (BINS + 1)

#: Kinds of bytes: 0 white space, 1 lower case, 2 upper case, 3 first and 4 further bytes of other characters, 5 digits, 6 full stop and
#: comma, 7 exclamation and question marks, 8 other marks.
KINDS = np.array(
    [
        0 if c in b" \t\r\n\x0b\x0c" else 1 if 97 <= c <= 122 else 2 if 65 <= c <= 90 else 4 if 128 <= c < 192 else 3 if c >= 192
        else 5 if 48 <= c <= 57 else 6 if c in b".," else 7 if c in b"!?" else 8
        for c in range(256)
    ],
    np.uint8,
)
N_KINDS = 9


def kind_counts(lines: list[bytes]) -> np.ndarray:
    """Bytes of each kind in each line. Taken in pieces, so that a very long text needs no more memory."""
    out = np.zeros((len(lines), N_KINDS), np.int64)
    a, size = 0, 0
    for b, line in enumerate(lines):
        size += len(line)
        if size >= GROUP_BYTES or b == len(lines) - 1:
            part = lines[a : b + 1]
            data = np.frombuffer(b"".join(part), np.uint8)
            row = np.repeat(np.arange(len(part), dtype=np.int32), [len(x) for x in part])
            out[a : b + 1] = np.bincount(row * N_KINDS + KINDS[data], minlength=len(part) * N_KINDS).reshape(-1, N_KINDS)
            a, size = b + 1, 0
    return out


def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """A share in bins that are finer near none and near all."""
    x = part / np.maximum(whole, 1)
    edges = np.array([1e-9, 0.01, 0.02, 0.04, 0.07, 0.12, 0.2, 0.3, 0.45, 0.6, 0.75, 0.88, 0.95, 0.99, 1.0])
    return np.searchsorted(edges, x, side="right")


def line_features(lines: list[bytes], new_text: np.ndarray) -> np.ndarray:
    """A bin for each feature of each line. ``new_text`` marks the first line of each document."""
    kinds = kind_counts(lines)
    size = kinds.sum(1)
    words = [x.split() for x in lines]
    n_words = np.array([len(w) for w in words], np.int64)
    distinct = np.array([len(set(w)) for w in words], np.int64)
    again = np.array([i > 0 and lines[i] == lines[i - 1] for i in range(len(lines))]) & ~new_text
    ends = np.array([KINDS[x[-1]] if x else 9 for x in (y.rstrip() for y in lines)], np.int64)
    begins = np.array([KINDS[x[0]] if x else 9 for x in (y.lstrip() for y in lines)], np.int64)
    letters = kinds[:, 1] + kinds[:, 2] + kinds[:, 3]
    marks = kinds[:, 6] + kinds[:, 7] + kinds[:, 8]
    return np.stack(
        [
            np.minimum(np.log2(size + 1), BINS - 1).astype(np.int64),
            np.minimum(np.log2(n_words + 1), BINS - 1).astype(np.int64),
            share(kinds[:, 2], letters),
            share(kinds[:, 8], size),
            share(kinds[:, 7], size),
            share(kinds[:, 5], size),
            share(marks, n_words),
            share(distinct, n_words),
            np.minimum(letters / np.maximum(n_words, 1), BINS - 1).astype(np.int64),
            ends,
            begins,
            again.astype(np.int64),
        ],
        axis=1,
    )


def with_neighbours(own: np.ndarray, new_text: np.ndarray) -> np.ndarray:
    """Weight numbers of a line's own features, of those of the line before and of those of the line after."""
    before, after = np.full_like(own, NONE), np.full_like(own, NONE)
    before[1:] = np.where(new_text[1:, None], NONE, own[:-1])
    after[:-1] = np.where(new_text[1:, None], NONE, own[1:])
    column = np.arange(FEATURES) * (BINS + 1)
    return np.concatenate([own + column, before + column + SLOTS, after + column + 2 * SLOTS], axis=1).astype(np.int32)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(weight numbers of lines, lengths of lines, lines of each text). An empty text is one empty line."""
    split = [t.split(b"\n") for t in texts]
    counts = np.array([len(s) for s in split], np.int64)
    lines = [x for s in split for x in s]
    new_text = np.zeros(len(lines), bool)
    new_text[np.cumsum(counts) - counts] = True
    return with_neighbours(line_features(lines, new_text), new_text), np.array([len(x) for x in lines], np.int64), counts


@dataclass
class Field:
    """Weights for the state good; those for bad are zero."""

    line: np.ndarray
    start: np.ndarray  # log weights of the first state
    move: np.ndarray  # log weights of (state, next state)

    def marginals(self, numbers: np.ndarray, counts: np.ndarray, pairs: bool = False):
        """P(good) of each line, and, if asked for, expected transitions, first states and the log of the normaliser.

        All documents advance together, one line at a time; those with more lines come first.
        """
        evidence = np.exp(np.clip(self.line[numbers].sum(1), -30, 30))
        psi = np.stack([np.ones_like(evidence), evidence], 1)
        move, start = np.exp(self.move), np.exp(self.start)
        first = np.cumsum(counts) - counts
        order = np.argsort(-counts, kind="stable")
        active = len(counts) - np.searchsorted(np.sort(counts), np.arange(counts.max()), side="right")
        forward, scale = np.empty_like(psi), np.empty(len(psi))
        for t, n in enumerate(active):
            at = first[order[:n]] + t
            a = psi[at] * (start if t == 0 else forward[at - 1] @ move)
            scale[at] = a.sum(1)
            forward[at] = a / scale[at, None]
        backward = np.ones_like(psi)
        expected = np.zeros((2, 2))
        for t in range(len(active) - 1, 0, -1):
            at = first[order[: active[t]]] + t
            b = psi[at] * backward[at] / scale[at, None]
            if pairs:
                expected += move * (forward[at - 1].T @ b)
            backward[at - 1] = b @ move.T
        good = forward * backward
        good = good[:, 1] / good.sum(1)
        return (good, expected, good[first], np.log(scale).sum()) if pairs else good


def fit(numbers: np.ndarray, counts: np.ndarray, labels: np.ndarray, rounds: int = 200, rate: float = 0.05, ridge: float = 1.0) -> Field:
    """The field under which the labels, given to every line of a document, are likeliest; by Adam, over all documents at once."""
    model = Field(np.zeros(3 * SLOTS), np.zeros(2), np.zeros((2, 2)))
    if not len(counts):
        return model
    parts = [model.line, model.start, model.move]
    means, squares = [np.zeros_like(p) for p in parts], [np.zeros_like(p) for p in parts]
    gold = np.repeat(labels, counts).astype(float)
    steps = (counts - 1).astype(float)
    stay = np.array([[(steps * (1 - labels)).sum(), 0], [0, (steps * labels).sum()]])
    begin = np.array([(1 - labels).sum(), labels.sum()], float)
    for k in range(1, rounds + 1):
        good, expected, heads, _ = model.marginals(numbers, counts, pairs=True)
        slope = np.bincount(numbers.ravel(), np.repeat(gold - good, numbers.shape[1]), len(model.line))
        slopes = [slope, begin - np.array([(1 - heads).sum(), heads.sum()]), stay - expected]
        for p, g, m, v in zip(parts, slopes, means, squares, strict=True):
            g = g - ridge * p
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-9)
    return model


def featurizer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, text) to (label, lines, weight numbers)."""
    for batch in batches:
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            numbers, _, counts = features([text])
            yield pa.RecordBatch.from_arrays(
                [pa.array([label], pa.int32()), pa.array(counts), pa.array([numbers.astype(np.int16).tobytes()], pa.binary())],
                ["label", "lines", "numbers"],
            )


def scorer(model: Field):
    """(id, held out, text) to (id, held out, score, lines, good lines)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, a, size = batch.column(2).to_pylist(), 0, 0
            for b, text in enumerate(texts):
                size += len(text)
                if size < GROUP_BYTES and b < len(texts) - 1:
                    continue
                numbers, length, counts = features(texts[a : b + 1])
                good = model.marginals(numbers, counts)
                first = np.cumsum(counts) - counts
                weight = np.maximum(length, 1).astype(float)
                score = np.add.reduceat(good * weight, first) / np.add.reduceat(weight, first)
                part = batch.slice(a, b + 1 - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(np.clip(score, 0, 1)), pa.array(counts), pa.array(np.add.reduceat((good >= 0.5).astype(np.int64), first))],
                    ["doc_id", "held_out", "score", "n_lines", "n_good_lines"],
                )
                a, size = b + 1, 0

    return run


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, n: int, id_col: str, text_col: str) -> DataFrame:
    """``(label, text)`` of at most ``n`` labels, chosen by a hash of their identifiers.

    A repeated identifier has one text, that with the lowest hash, so there are never more rows than labels chosen.
    """
    chosen = (
        labels.where(usable & F.col(id_col).isNotNull() & F.col(label).isNotNull())
        .select(F.col(id_col).alias("__id"), F.col(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("__id"), "__id", "label")
        .limit(n)
    )
    texts = docs.select(F.col(id_col).alias("__id"), text_bytes(text_col).alias("text"))
    wanted = texts.join(F.broadcast(chosen.select("__id")), "__id", "left_semi")  # at most n rows of two numbers
    one = wanted.groupBy("__id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first"))
    return one.join(F.broadcast(chosen), "__id").select("label", F.col("first.text").alias("text"))


def learn(
    docs: DataFrame, labels: DataFrame, usable: Column, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
    max_docs: int = SAMPLE_DOCS, max_lines: int = SAMPLE_LINES,
) -> Field:
    """Fit the field to labelled documents for which ``usable``, a condition on the labels' rows, holds.

    Only features of lines reach the driver, of at most ``max_docs`` documents and ``max_lines`` lines. Null labels and labels
    without a document are left out; without any label every state is as likely as the other.
    """
    ship(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, usable, max_docs, id_col, text_col)
    numbers, counts, gold, total = [], [], [], 0
    for row in sample.mapInArrow(featurizer, "label int, lines bigint, numbers binary").where(F.col("lines") <= max_lines).toLocalIterator():
        if total + row.lines > max_lines:
            break
        total += row.lines
        numbers.append(np.frombuffer(row.numbers, np.int16).reshape(row.lines, -1))
        counts.append(row.lines)
        gold.append(row.label)
    matrix = np.concatenate(numbers).astype(np.int32) if numbers else np.zeros((0, 3 * FEATURES), np.int32)
    return fit(matrix, np.array(counts, np.int64), np.array(gold, np.int64))


def score_quality(
    docs: DataFrame, model: Field, held_out: Column, id_col: str = "doc_id", text_col: str = "text", least: float = 0.7
) -> DataFrame:
    """``(doc_id, held_out, score, predicted, n_lines, n_good_lines)`` for each row of ``docs``.

    A null text is empty, and an empty text is one empty line; a null identifier stays null; repeated rows give repeated
    rows; an empty table gives an empty result; other columns are not looked at.
    """
    ship(docs.sparkSession)
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.coalesce(held_out, F.lit(False)).alias("held_out"), text_bytes(text_col))
    schema = f"doc_id {id_type}, held_out boolean, score double, n_lines bigint, n_good_lines bigint"
    scored = rows.mapInArrow(scorer(model), schema)
    return scored.select(
        F.col("doc_id").alias(id_col), "held_out", "score", (F.col("score") >= least).cast("int").alias("predicted"), "n_lines", "n_good_lines"
    )
