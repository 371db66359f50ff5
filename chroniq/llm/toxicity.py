"""Toxicity by a factorization machine over hashed terms.

    score = sigmoid(w0 + sum of w_i + sum over pairs of <v_i, v_j>)   over the terms i of a document

The factors give every pair of terms a weight of its own, so an insult beside a group's name can weigh more than both
do apart. Terms are lower-cased words and their first bytes (so that inflected forms share a term), hashed. Terms that tell the labels
apart are chosen by counts over a bounded sample of labelled documents, and the machine is fitted to
the same sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chroniq.llm.common import ship, text_bytes, words_of
from chroniq.llm.quality import labelled_sample

SAMPLE_DOCS = 40_000  # labelled documents that are learned from, at most
TERMS = 4096  # terms that have weights, at most
SPACE = 1 << 22  # numbers that terms are hashed to
PREFIXES = (5, 6, 7, 8)  # bytes
FACTORS = 8
LEAST_Z = 4.0  # a term must stand out by so many standard deviations


class TermNumbers(dict):
    """A word to the numbers of its terms. Forgets all words when it holds ``limit``."""

    def __init__(self, chosen: dict[int, int] | None = None, limit: int = 150_000) -> None:
        super().__init__()
        self.chosen, self.limit = chosen, limit

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        terms = [b"w " + word, *(b"p " + word[:n] for n in PREFIXES if len(word) >= n)]
        numbers = [xxhash.xxh64_intdigest(t) % SPACE for t in terms]
        if self.chosen is not None:
            numbers = [self.chosen[n] for n in numbers if n in self.chosen]
        self[word] = value = tuple(numbers)
        return value


def terms_of(text: bytes, numbers: TermNumbers) -> set[int]:
    return {n for word in set(words_of(text)) for n in numbers[word]}


def counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, text) to documents per term and label, added up within a batch."""
    numbers = TermNumbers()
    for batch in batches:
        counts = np.zeros((2, SPACE), np.int32)
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            found = terms_of(text, numbers)
            counts[1 if label else 0, np.fromiter(found, np.int64, len(found))] += 1
        term = np.flatnonzero(counts.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(term), pa.array(counts[0, term].astype(np.int64)), pa.array(counts[1, term].astype(np.int64))], ["term", "clean", "toxic"]
        )


@dataclass
class Machine:
    chosen: dict[int, int]  # a term's number to its row of weights
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def scores(self, rows: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
        """Scores of ``n`` documents that have ``terms[i]`` in document ``rows[i]``."""
        out = self.bias + np.bincount(rows, self.linear[terms], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[terms, f]
            out += 0.5 * (np.bincount(rows, v, n) ** 2 - np.bincount(rows, v * v, n))
        return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def fit(
    chosen: dict[int, int], rows: np.ndarray, terms: np.ndarray, labels: np.ndarray, rounds: int = 400, rate: float = 0.05, ridge: float = 1e-4,
    ridge_factors: float = 1e-3, n_factors: int = FACTORS,
) -> Machine:
    """Weights that minimise the log loss and the ridge penalty, by Adam over all documents at once."""
    n, m = len(labels), len(chosen)
    share = min(max(labels.mean() if n else 0.5, 1e-3), 1 - 1e-3)
    machine = Machine(chosen, float(np.log(share / (1 - share))), np.zeros(m), np.random.default_rng(3).normal(0, 0.01, (m, n_factors)))
    if not len(terms):
        return machine
    means = [0.0, np.zeros(m), np.zeros((m, n_factors))]
    squares = [0.0, np.zeros(m), np.zeros((m, n_factors))]
    for k in range(1, rounds + 1):
        miss = machine.scores(rows, terms, n) - labels
        each = miss[rows]
        slopes = [miss.mean(), np.bincount(terms, each, m) / n + ridge * machine.linear, np.empty((m, n_factors))]
        for f in range(n_factors):
            v = machine.factors[terms, f]
            rest = np.bincount(rows, v, n)[rows] - v
            slopes[2][:, f] = np.bincount(terms, each * rest, m) / n + ridge_factors * machine.factors[:, f]
        values = [machine.bias, machine.linear, machine.factors]
        for i, g in enumerate(slopes):
            means[i] = 0.9 * means[i] + 0.1 * g
            squares[i] = 0.99 * squares[i] + 0.01 * g * g
            values[i] = values[i] - rate * (means[i] / (1 - 0.9**k)) / (np.sqrt(squares[i] / (1 - 0.99**k)) + 1e-8)
        machine = Machine(chosen, float(values[0]), values[1], values[2])
    return machine


def learn(
    docs: DataFrame, labels: DataFrame, usable: Column, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
    max_docs: int = SAMPLE_DOCS, max_terms: int = TERMS,
) -> Machine:
    """Fit the machine to labelled documents for which ``usable``, a condition on the labels' rows, holds.

    At most ``max_terms`` counts, and numbers of chosen terms of ``max_docs`` documents, reach the driver. Null labels and
    labels without a document are left out; without any label each score is one half.
    """
    ship(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, usable, max_docs, id_col, text_col)
    sums = sample.groupBy("label").agg(F.count("*").alias("n")).collect()
    n = {1: sum(r.n for r in sums if r.label), 0: sum(r.n for r in sums if not r.label)}
    counted = sample.mapInArrow(counter, "term bigint, clean bigint, toxic bigint").groupBy("term").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    total, share = max(n[0] + n[1], 1), n[1] / max(n[0] + n[1], 1)
    both = F.col("clean") + F.col("toxic")
    # Toxic documents of a term against those expected, in standard deviations of a draw without replacement.
    spread = F.sqrt(F.greatest(both * share * (1 - share) * (1 - both / total), F.lit(1e-9)))
    z = F.abs(F.col("toxic") - both * share) / spread
    top = counted.where(both >= 3).select("term", z.alias("z")).where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "term").limit(max_terms).collect()
    chosen = {r.term: i for i, r in enumerate(sorted(top))}

    def featurizer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = TermNumbers(chosen)
        for batch in batches:
            found = [sorted(terms_of(t, numbers)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], ["label", "terms"])

    held = sample.mapInArrow(featurizer, "label int, terms array<int>").toArrow()  # at most max_docs rows
    found = held.column("terms").to_pylist()
    rows = np.repeat(np.arange(len(found)), [len(t) for t in found])
    terms = np.array([i for t in found for i in t], np.int64)
    return fit(chosen, rows, terms, (np.array(held.column("label").to_pylist()) > 0).astype(float))


def scorer(machine: Machine):
    """(id, held out, text) to (id, held out, score, terms)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = TermNumbers(machine.chosen)
        for batch in batches:
            found = [sorted(terms_of(t.as_py(), numbers)) for t in batch.column(2)]
            counts = np.array([len(t) for t in found], np.int64)
            rows = np.repeat(np.arange(len(found)), counts)
            score = machine.scores(rows, np.array([i for t in found for i in t], np.int64), len(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(score), pa.array(counts)], ["doc_id", "held_out", "score", "n_terms"]
            )

    return run


def score_toxicity(
    docs: DataFrame, machine: Machine, held_out: Column, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5
) -> DataFrame:
    """``(doc_id, held_out, score, predicted, n_terms)`` for each row of ``docs``; ``n_terms`` counts terms with weights.

    A null or empty text has no terms and the score of the bias; a null identifier stays null; repeated rows give repeated
    rows; an empty table gives an empty result; other columns are not looked at.
    """
    ship(docs.sparkSession)
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_col), F.coalesce(held_out, F.lit(False)).alias("held_out"), text_bytes(text_col))
    scored = rows.mapInArrow(scorer(machine), f"doc_id {id_type}, held_out boolean, score double, n_terms bigint")
    return scored.select(
        F.col("doc_id").alias(id_col), "held_out", "score", (F.col("score") >= least).cast("int").alias("predicted"), "n_terms"
    )
