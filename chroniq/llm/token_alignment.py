"""Alignment of the tokens of two tokenizers, and how often their ids are linked in the corpus.

The ends of a text's tokens, in bytes, are a dictionary from end to index for each tokenizer. The ends that both have are the
intersection of the two key sets; in order they cut both id lists into slices, one slice of each list to a group. The
links of a group are those of its tokens that end together: the last of its one slice with the last of the other.

Two tokens that end together are such that the bytes of one are an ending of the other's. So the pairs of ids that can be linked
at all follow from the two vocabularies: they are listed once, their counts are an array, and the table of counts is bounded
by the tokens' lengths in bytes whatever the corpus (about half a million pairs here). Documents are encoded once; each keeps the
numbers of its pairs, tasks add up their own counts before anything is shuffled, and no document, text or token is shuffled.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chroniq.llm.common import scratch, ship
from chroniq.llm.packing import BYTE_LEVEL_PATTERN, byte_letters
from chroniq.session import stage

ROWS = 256  # texts that are encoded at a time
SPACE = "▁"
ENCODED = "kind int, id {id}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, links binary"


class ByteLevel:
    """A byte-level BPE file, special strings as plain text. ``pieces`` are the bytes of each id.

    The faster of the two libraries that read such vocabularies runs it; tests compare the ids with the other's.
    """

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        if spec["model"].get("type") != "BPE" or pre.get("type") != "ByteLevel" or spec.get("normalizer") or pre.get("add_prefix_space"):
            raise ValueError("a plain byte-level BPE file is needed")
        letters, special = byte_letters(), {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        self.pieces = [b""] * (max(spec["model"]["vocab"].values()) + 1)
        for piece, i in ranks.items():
            self.pieces[i] = piece
        self.encoding = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(t) for t in texts]


class Pieces:
    """A sentencepiece model. ``pieces`` are the bytes of each id: U+2581 is a space and ``<0xHH>`` a byte."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            byte = re.fullmatch(r"<0x([0-9A-Fa-f]{2})>", piece)
            self.pieces.append(bytes([int(byte[1], 16)]) if byte else piece.replace(SPACE, " ").encode())

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def possible_pairs(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """All pairs of ids of which one's bytes are an ending of the other's, as sorted numbers ``id_a << 32 | id_b``."""

    def by_bytes(pieces: list[bytes]) -> dict[bytes, list[int]]:
        found: dict[bytes, list[int]] = {}
        for i, piece in enumerate(pieces):
            if piece:
                found.setdefault(piece, []).append(i)
        return found

    of_a, of_b = by_bytes(a), by_bytes(b)
    pairs = set()
    for i, piece in enumerate(a):
        for k in range(len(piece)):
            pairs.update((i << 32) | j for j in of_b.get(piece[k:], ()))
    for j, piece in enumerate(b):
        for k in range(1, len(piece)):
            pairs.update((i << 32) | j for i in of_a.get(piece[k:], ()))
    return np.array(sorted(pairs), np.int64)


def common_ends(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """For each end that both lists have, in order, how many tokens of either list lie up to it."""
    index_a = dict(zip(ends_a, range(1, len(ends_a) + 1)))
    index_b = dict(zip(ends_b, range(1, len(ends_b) + 1)))
    common = sorted(index_a.keys() & index_b.keys())
    return list(map(index_a.__getitem__, common)), list(map(index_b.__getitem__, common))


class PairTexts(dict):
    """A pair to its text. There are no more pairs than can be linked."""

    def __missing__(self, pair: int) -> str:
        self[pair] = text = f"{pair >> 32}|{pair & 0xFFFFFFFF}"
        return text


class Aligner:
    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.sizes_a, self.sizes_b = (np.array([len(p) for p in t.pieces], np.int64) for t in (self.a, self.b))
        self.pair_texts = PairTexts()
        self.digits = [str(i) for i in range(max(len(self.sizes_a), len(self.sizes_b)))]

    def groups(self, text: str, ids_a: np.ndarray, ids_b: np.ndarray, list_b: list[int]) -> tuple[list[int], list[int]] | None:
        """The cuts of :func:`common_ends`; None where the tokens' joined bytes are not the text's."""
        raw = text.encode()
        ends_a, ends_b = self.sizes_a[ids_a].cumsum(), self.sizes_b[ids_b].cumsum()
        # A byte-level vocabulary has every byte and cuts the text as it is, so its bytes are the text's if they are as many.
        if ends_a[-1] != len(raw) or b"".join(map(self.b.pieces.__getitem__, list_b)) != raw:
            return None
        return common_ends(ends_a.tolist(), ends_b.tolist())

    def digest(self, ids_a: list[int], ids_b: list[int], cuts: tuple[list[int], list[int]], linked: np.ndarray) -> str:
        """Of the groups as text. ``linked`` are the pairs that end the groups; most groups are such a pair and no more."""
        out = list(map(self.pair_texts.__getitem__, linked.tolist()))
        ends_a, ends_b = ([0, *c] for c in cuts)
        digits = self.digits
        for n in np.flatnonzero((np.diff(ends_a) > 1) | (np.diff(ends_b) > 1)).tolist():
            a, b = ids_a[ends_a[n] : ends_a[n + 1]], ids_b[ends_b[n] : ends_b[n + 1]]
            out[n] = ",".join([digits[i] for i in a]) + "|" + ",".join([digits[i] for i in b])
        return hashlib.sha256(";".join(out).encode()).hexdigest()


def _encode(path_a: str, path_b: str, id_type: pa.DataType, possible):
    """(id, text) to a row for each document, and at the end of a task one with its counts of pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        pairs = possible.value
        counts = np.zeros(len(pairs), np.int64)
        types = [pa.int32(), id_type, pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            names = ["kind", "id", "n_a", "n_b", "n_groups", "groups_sha256", "links"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                part = whole.slice(at, ROWS)
                texts = part.column(1).to_pylist()
                out = []
                spaced = [" " + t for t in texts]
                for i, text, spaced_text, ids_a, ids_b in zip(part.column(0).to_pylist(), texts, spaced, aligner.a(spaced), aligner.b(texts), strict=True):
                    array_a, array_b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
                    cuts = aligner.groups(spaced_text, array_a, array_b, ids_b) if text else None
                    if cuts is None:
                        out.append((0, i, 0, 0, 0, "", b""))
                        continue
                    last_a, last_b = (np.array(c, np.int64) - 1 for c in cuts)
                    linked = (array_a[last_a] << 32) | array_b[last_b]
                    numbers = np.searchsorted(pairs, linked).astype("<u4")
                    np.add.at(counts, numbers, 1)
                    out.append((0, i, len(ids_a), len(ids_b), len(numbers), aligner.digest(ids_a, ids_b, cuts, linked), numbers.tobytes()))
                yield batch_of(out)
        if counts.any():
            seen = np.flatnonzero(counts)
            yield batch_of([(1, None, len(seen), 0, 0, "", np.stack([seen, counts[seen]]).astype("<i8").tobytes())])

    return run


def _unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's counts to (pair, n)."""
    for batch in batches:
        for n, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            numbers, counts = np.frombuffer(blob, "<i8").reshape(2, n)
            yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(counts)], ["pair", "n"])


class Alignments:
    """Documents aligned and staged: ``docs`` with one row each, and ``pair_counts()`` of the corpus."""

    def __init__(self, docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> None:
        self.spark = docs.sparkSession
        ship(self.spark)
        field = docs.select(id_col).schema.fields[0]
        text = F.coalesce(F.col(text_col), F.lit(""))
        from pyspark.sql.pandas.types import to_arrow_type

        schema = ENCODED.format(id=field.dataType.simpleString())
        self.pairs = possible_pairs(ByteLevel(path_a).pieces, Pieces(path_b).pieces)
        possible = self.spark.sparkContext.broadcast(self.pairs)
        rows = docs.select(F.col(id_col).alias("id"), text.alias("text")).mapInArrow(_encode(path_a, path_b, to_arrow_type(field.dataType), possible), schema)
        self.rows = stage(rows, scratch(self.spark, "alignment"), "rows")
        self.id_col = id_col
        self.docs = self.rows.where("kind = 0").drop("kind")
        tasks = self.rows.where("kind = 1").select("n_a", "links")
        self.counts = tasks.mapInArrow(_unfold, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))

    def _counted(self) -> np.ndarray:
        """The counts of all possible pairs. Their number is bounded by the vocabularies."""
        found = self.counts.toArrow()
        counts = np.zeros(len(self.pairs), np.int64)
        counts[found["pair"].to_numpy()] = found["n"].to_numpy()
        return counts

    def pair_counts(self) -> DataFrame:
        """``(id_a, id_b, n, best)``: the pairs that are linked, how often, and whether no pair of the same ``id_b`` is linked more often."""
        pairs, counts = self.pairs, self._counted()
        best = is_best(pairs, counts)
        seen = np.flatnonzero(counts)
        columns = {"id_a": pairs[seen] >> 32, "id_b": pairs[seen] & 0xFFFFFFFF, "n": counts[seen], "best": best[seen]}
        return self.spark.createDataFrame(pa.table(columns), "id_a bigint, id_b bigint, n bigint, best boolean")

    def documents(self) -> DataFrame:
        """``(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, one row for each document."""
        counts = self._counted()
        table = self.spark.sparkContext.broadcast((counts, is_best(self.pairs, counts)))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            counts, best = table.value
            for batch in batches:
                n_links, n_best, total = [], [], []
                for blob in batch.column("links"):
                    numbers = np.frombuffer(blob.as_buffer(), "<u4")
                    n_links.append(len(numbers))
                    n_best.append(int(best[numbers].sum()))
                    total.append(int(counts[numbers].sum()))
                kept = [batch.column(c) for c in ("id", "n_a", "n_b", "n_groups", "groups_sha256")]
                more = [pa.array(c, pa.int64()) for c in (n_links, n_best, total)]
                yield pa.RecordBatch.from_arrays(kept + more, ["id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum"])

        id_type = self.docs.schema["id"].dataType.simpleString()
        schema = f"id {id_type}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, n_links bigint, n_best bigint, count_sum bigint"
        scored = self.docs.mapInArrow(score, schema)
        return scored.select(F.col("id").alias(self.id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def is_best(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a pair's count is the highest of its second id."""
    of_b = pairs & 0xFFFFFFFF
    highest = np.zeros(int(of_b.max()) + 1 if len(of_b) else 0, np.int64)
    np.maximum.at(highest, of_b, counts)
    return counts == highest[of_b]


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> Alignments:
    """Align every whole text of ``docs``: a space and the text by the byte-level BPE file ``path_a``, the text by the sentencepiece
    model ``path_b``, which adds that space; no special tokens.

    A null or empty text, and one whose tokens' bytes by either tokenizer differ from the space and the text (the model
    changes some characters), has no tokens: zeros, and an empty digest. Repeated rows come back, and count, as often as they are there; a
    null identifier stays null; an empty table gives an empty result; other columns are not looked at. Driver and executors have both files.
    """
    return Alignments(docs, path_a, path_b, id_col, text_col)


def aligned_groups(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, position, start, end, ids_a, ids_b)``: the groups themselves, with their byte range in the space and the text."""
    ship(docs.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_type

    field = docs.select(id_col).schema.fields[0]
    id_type = to_arrow_type(field.dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        types = [id_type, pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        names = ["id", "position", "start", "end", "ids_a", "ids_b"]
        for batch in batches:
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids_a, ids_b = aligner.a([" " + text])[0], aligner.b([text])[0]
                arrays = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
                cuts = (aligner.groups(" " + text, *arrays, ids_b) if text else None) or ([], [])
                out, i, j, start = [], 0, 0, 0
                for n, (x, y) in enumerate(zip(*cuts, strict=True)):
                    end = start + int(aligner.sizes_a[ids_a[i:x]].sum())
                    out.append((doc, n, start, end, ids_a[i:x], ids_b[j:y]))
                    i, j, start = x, y, end
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = f"id {field.dataType.simpleString()}, position bigint, start bigint, end bigint, ids_a array<int>, ids_b array<int>"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
