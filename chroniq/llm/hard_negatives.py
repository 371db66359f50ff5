"""Hard negatives for anchors among labelled vectors, by rotated one-bit codes with certain bounds.

A vector ``o`` is seen under several seeded rotations, the rows of ``G``; its code is ``b = sign(G o)``, one bit each. The code stands
for the vector ``c = G' b``. Stored with it are the alignment of the two, as the factor ``a`` of the part of ``o`` along ``c``,
and the length of what is left of ``o`` beside that part. For a query ``q`` then

    <q, o> = a <q, c> + <q, rest>,    |<q, rest>| <= |rest| * |part of q beside c|    (Cauchy-Schwarz)

and ``<q, c>`` is a sum of the numbers ``G q`` with the code's signs. Those are rounded to a few bits, so the sum is a few popcounts of
the code against the query's bit planes, wrong by at most the sum of the roundings. Together this is an interval that contains the
score for certain. Only rows whose interval reaches the scores sought are scored, in whole numbers.

Rows are scanned where they lie. Anchors are broadcast, a bounded number at a time, and a task keeps its best few for each of them,
so what is shuffled is a few rows for each task and anchor. The first scan finds the positives, the second the negatives within
the windows that their scores set. A block of rows lies by label, its codes word by word, so that an anchor's popcounts are a few runs
over long arrays; a row is scored once for an anchor, whichever of its windows ask for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chroniq.llm.common import scratch, ship
from chroniq.session import stage

ROTATIONS = 8
PLANES = 6  # bits that a query's numbers are rounded to
ANCHOR_BYTES = 16 << 20  # vectors, windows and planes of the anchors that are broadcast at a time
ROWS = 10_000  # rows that are looked at at a time
CODED_ROWS = 2048  # rows that are coded at a time
SEEDS = 4  # times the rows sought: that many of the best estimates are scored first
EXACT, EXACT_SHORT = 2.0**53, 2.0**24
LONG = 2**63 - 1

CODED = "vec_id bigint, label bigint, size int, vector binary, code binary, along double, rest double, reach double"


def frame(size: int, rotations: int = ROTATIONS, seed: int = 7) -> np.ndarray:
    """``rotations`` random rotations of ``size`` dimensions, one below the other. The same on every machine up to rounding,
    which moves codes but never a bound, as bounds are computed from the code that is stored and the frame at hand."""
    rng = np.random.default_rng([seed, size])
    return np.vstack([np.linalg.qr(rng.standard_normal((size, size)))[0] for _ in range(rotations)])


def packed_bits(bits: np.ndarray) -> np.ndarray:
    """Rows of 0 and 1 as 64-bit words."""
    pad = -bits.shape[1] % 64
    bits = bits.astype(np.uint8)
    return np.packbits(np.pad(bits, ((0, 0), (0, pad))) if pad else bits, axis=1).view(np.uint64)


def encode(x: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code, along, rest, reach) of each row: the factor ``a``, the length of what is left, and the length of ``c``."""
    signs = np.where(x @ g.T >= 0, 1.0, -1.0)
    c = signs @ g
    reach = (c * c).sum(1)
    with np.errstate(all="ignore"):
        along = np.where(reach > 0, (x * c).sum(1) / reach, 0.0)
        left = x - along[:, None] * c
        rest = np.sqrt((left * left).sum(1))
    return packed_bits(signs > 0), along, rest, np.sqrt(reach)


class Query:
    """A query's bit planes, and its intervals for coded rows."""

    def __init__(self, q: np.ndarray, g: np.ndarray, planes: int = PLANES) -> None:
        numbers = g @ q
        self.length = float(np.sqrt((q * q).sum()))
        self.low = float(numbers.min()) if len(numbers) else 0.0
        self.step = (float(numbers.max()) - self.low) / (2**planes - 1) or 1.0
        levels = np.clip(np.rint((numbers - self.low) / self.step), 0, 2**planes - 1)
        self.off = float(np.abs(numbers - (self.low + self.step * levels)).sum())
        self.sum, self.bits = float(levels.sum()), len(numbers)
        self.planes = packed_bits((levels.astype(np.int64)[None] >> np.arange(planes)[:, None]) & 1)

    def estimate(self, code: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """``<q, c>`` of the codes, wrong by at most ``off``. ``ones`` are the codes' numbers of set bits.

        Quickest where all first words of the codes lie together, then all second words (an array of words by codes, transposed)."""
        words = code.T
        both, counts = np.empty(words.shape, np.uint64), np.empty(words.shape, np.uint8)
        picked = np.zeros(len(code), np.uint32 if self.sum < 2**32 else np.uint64)
        for plane in self.planes[::-1, :, None]:
            np.bitwise_and(words, plane, out=both)
            np.bitwise_count(both, out=counts)
            picked <<= 1
            picked += counts.sum(0, dtype=np.uint16 if self.bits < 2**16 else np.uint32)
        # The sum with signs is twice the sum over set bits less the sum over all.
        return self.step * (2.0 * picked - self.sum) + self.low * (2.0 * ones - self.bits)

    def bounds(self, estimate: np.ndarray, along: np.ndarray, rest: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the inner products, from below and from above."""
        with np.errstate(all="ignore"):
            least = np.maximum(np.abs(estimate) - self.off, 0) / np.where(reach > 0, reach, 1.0)
            beside = np.sqrt(np.maximum(self.length**2 - least**2, 0))
            half = np.abs(along) * self.off + rest * beside
            half = half * (1 + 1e-9) + 1e-9 * (np.abs(along) * reach + rest) * self.length
        return along * estimate - half, along * estimate + half

    def interval(self, code: np.ndarray, ones: np.ndarray, along: np.ndarray, rest: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``bounds`` of the codes' estimates."""
        return self.bounds(self.estimate(code, ones), along, rest, reach)


class Block:
    """Coded rows of one size, by label, their codes' first words together, then all second words and so on."""

    def __init__(self, part: pa.RecordBatch, size: int) -> None:
        part = part.take(pa.array(np.argsort(part.column("label").to_numpy(), kind="stable")))
        self.ids, self.labels = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
        self.x = np.frombuffer(b"".join(part.column("vector").to_pylist()), "<f8").reshape(len(self.ids), size)
        code = np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint64).reshape(len(self.ids), -1)
        self.ones = np.bitwise_count(code).sum(1, dtype=np.int64)
        self.words = np.ascontiguousarray(code.T)
        self.along, self.rest, self.reach = (part.column(c).to_numpy() for c in ("along", "rest", "reach"))
        self.largest = np.abs(self.x).max(1)
        self.short = self.x.astype(np.float32) if self.largest.max() < EXACT_SHORT else None
        # The widest half of an interval is a part of this times ``off`` and one of that times a query's length.
        with np.errstate(all="ignore"):
            self.wide_off = np.abs(self.along) * (1 + 2e-9)
            self.wide_rest = self.rest * (1 + 4e-9) + 2e-9 * np.abs(self.along) * self.reach

    def spans(self, label: int, negatives: bool) -> list[tuple[int, int]]:
        """The rows of the label, or those of others."""
        first, end = (int(np.searchsorted(self.labels, label, side)) for side in ("left", "right"))
        return [(a, b) for a, b in ([(0, first), (end, len(self.ids))] if negatives else [(first, end)]) if a < b]

    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact products of some rows, by short floats where those hold every sum."""
        largest = float(self.largest[rows].max())
        if self.short is not None and max(largest, 1.0) * float(np.abs(q).max()) * len(q) < EXACT_SHORT:
            return (self.short.take(rows, axis=0) @ q.astype(np.float32)).astype(np.int64)
        return products(self.x.take(rows, axis=0), q, largest)

    def reaching(self, query: Query, first: int, end: int, floor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, low, high) of those rows of a span that may score ``floor`` or more."""
        along = self.along[first:end]
        estimate = query.estimate(self.words[:, first:end].T, self.ones[first:end])
        with np.errstate(all="ignore"):
            most = along * estimate + self.wide_off[first:end] * query.off + self.wide_rest[first:end] * query.length
        near = np.flatnonzero(~(most < floor))
        rows = near + first
        low, high = query.bounds(estimate[near], along[near], self.rest[rows], self.reach[rows])
        return rows, low, high


def products(x: np.ndarray, q: np.ndarray, largest: float) -> np.ndarray:
    """Exact inner products of whole numbers, none of the rows' beyond ``largest``, held at the ends of 64 bits beyond them."""
    if not len(x):
        return np.zeros(0, np.int64)
    if largest * float(np.abs(q).max()) * len(q) < EXACT:
        return (x @ q).astype(np.int64)
    other = [int(v) for v in q.tolist()]
    return np.array([max(-LONG, min(LONG, sum(int(a) * b for a, b in zip(row, other, strict=True)))) for row in x.tolist()], np.int64)


def _coder(rotations: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames: dict[int, np.ndarray] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, CODED_ROWS):
                batch = whole.slice(at, CODED_ROWS)
                sizes, vectors = batch.column(2).to_numpy(), batch.column(3)
                starts, numbers = np.cumsum(sizes, dtype=np.int64) - sizes, vectors.flatten().to_numpy()
                for size in np.unique(sizes).tolist():
                    g = frames[size] if size in frames else frames.setdefault(size, frame(size, rotations))
                    rows = np.flatnonzero(sizes == size)
                    x = numbers[starts[rows, None] + np.arange(size)]
                    code, along, rest, reach = encode(x, g)
                    columns = [batch.column(k).take(pa.array(rows)) for k in range(3)]
                    blobs = [pa.array([v.tobytes() for v in m], pa.binary()) for m in (x.astype("<f8"), code)]
                    names = ["vec_id", "label", "size", "vector", "code", "along", "rest", "reach"]
                    yield pa.RecordBatch.from_arrays(columns + blobs + [pa.array(along), pa.array(rest), pa.array(reach)], names)

    return run


def _wanted(best: list[tuple[int, int]], k: int) -> float:
    """What a row must score to be among the ``k`` best so far."""
    return best[k - 1][0] if len(best) >= k else -np.inf


def _floor(slots: list[tuple], k: int) -> float:
    """What a row must score to be among the best of any of the slots ``(least, most, best so far)``."""
    return min(max(least, _wanted(own, k)) for least, _, own in slots)


def _scanner(anchors, rotations: int, k: int, negatives: bool):
    """Coded rows to the task's best for each anchor: ``(anchor, slot, vec_id, score, scored)``.

    ``anchors`` are ``(id, label, vector, windows)``. Positives are of the anchor's label, and there is one slot, without a window;
    negatives are of other labels, with a slot for each window ``(low, high)``. ``scored`` counts the exact products of an anchor, which all its slots share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: dict[int, list] = {}  # by size
        for i, label, q, windows in anchors.value:
            asked.setdefault(len(q), []).append((i, label, q, windows))
        queries: dict[int, list] = {}
        best: dict[tuple[int, int, int], list[tuple[int, int]]] = {}
        scored: dict[tuple[int, int], int] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                sizes = batch.column("size").to_numpy()
                for size in np.unique(sizes).tolist():
                    if size not in asked:
                        continue
                    if size not in queries:
                        g = frame(size, rotations)
                        queries[size] = [Query(q, g) for _, _, q, _ in asked[size]]
                    block = Block(batch.take(pa.array(np.flatnonzero(sizes == size))), size)
                    spans = {v: block.spans(v, negatives) for v in {a[1] for a in asked[size]}}
                    for query, (anchor, label, q, windows) in zip(queries[size], asked[size], strict=True):
                        slots = [(least, most, best.setdefault((anchor, slot, size), [])) for slot, (least, most) in enumerate(windows)]
                        top = max(most for _, most in windows)
                        for first, end in spans[label]:
                            rows, low, high = block.reaching(query, first, end, _floor(slots, k))
                            if anchor in block.ids[rows]:
                                others = block.ids[rows] != anchor
                                rows, low, high = rows[others], low[others], high[others]
                            open_ = np.ones(len(rows), bool)  # not scored so far

                            def score(kept: np.ndarray) -> None:
                                """One product of a row serves all slots."""
                                chosen = rows[kept & open_]
                                open_[kept] = False
                                if not len(chosen):
                                    return
                                scores = block.scores(chosen, q)
                                scored[anchor, size] = scored.get((anchor, size), 0) + len(chosen)
                                fit = scores >= _floor(slots, k)
                                scores, ids = scores[fit], block.ids[chosen[fit]]
                                for least, most, own in slots:
                                    fit = np.flatnonzero((scores >= max(least, _wanted(own, k))) & (scores <= most))
                                    if len(fit) > k:
                                        fit = fit[np.lexsort((ids[fit], -scores[fit]))[:k]]
                                    if len(fit):
                                        own.extend(zip(scores[fit].tolist(), (-ids[fit]).tolist(), strict=True))
                                        own.sort(reverse=True)
                                        del own[k:]

                            # A slot's most promising rows first, while it lacks rows: the scores they reach rule out most others.
                            if len(rows) > SEEDS * k:
                                seeds = np.zeros(len(rows), bool)
                                for least, most, own in slots:
                                    if len(own) < k:
                                        middle = np.where((high < least) | (low > most), -np.inf, np.minimum((low + high) / 2, 2 * most - (low + high) / 2))
                                        seeds[np.argpartition(middle, -SEEDS * k)[-SEEDS * k :]] = True
                                score(seeds)
                            # What cannot be ruled out, and so bounds that are no numbers too.
                            score(~((high < _floor(slots, k)) | (low > top)))
        # A slot's number goes with its first row, so that it adds up over tasks.
        out = [(*key[:2], -i, s, 0 if n else scored[key[0], key[2]]) for key, rows in best.items() for n, (s, i) in enumerate(rows)]
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["anchor_id", "slot", "vec_id", "score", "scored"])

    return run


FOUND = "anchor_id bigint, slot int, vec_id bigint, score bigint, scored bigint"


def sound_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """``(vec_id, label, size, vector)`` of the rows that take part."""
    number = F.col(vector_col).cast("array<double>")
    sound = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (F.size(number) > 0) & sound)
    return rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"), F.size(number).alias("size"), number.alias("vector"))


def _floored(rows: DataFrame, scale: int) -> DataFrame:
    """Components as whole numbers ``floor(scale * x)``, kept as doubles, which hold them exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vector = batch.column("vector")
            flat = np.floor(np.clip(vector.flatten().to_numpy() * float(scale), -1e300, 1e300))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(batch.column("size").to_numpy())]), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), batch.column("size"), lists], ["vec_id", "label", "size", "vector"])

    return rows.mapInArrow(run, "vec_id bigint, label bigint, size int, vector array<double>")


def hard_negatives(
    vectors: DataFrame,
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    rotations: int = ROTATIONS,
    anchor_bytes: int = ANCHOR_BYTES,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, scored)``.

    Anchors are the rows whose identifier is divisible by ``every``. An anchor's positives are the ``positives`` other rows of its label
    with the highest inner product; for each of them, the ``negatives`` best rows of other labels whose product is between ``low`` and ``high``
    hundredths of the positive's. Ties go to the smaller identifier. ``scored`` is the number of rows whose product was computed to find the
    anchor's negatives, all others having been ruled out by their intervals.

    Components are ``floor(scale * x)``. Vectors that are null, empty or hold a null or non-finite component, and rows without an identifier
    or a label, take no part; vectors of different lengths are not compared. A repeated identifier is as many candidates and one anchor (its
    smallest label and vector), and never a candidate of its own anchor. A positive without negatives gives no row; so a positive whose score is below zero gives none.
    An empty table gives an empty result; other columns are not looked at. Scores beyond 64 bits are held at their ends.
    """
    spark = vectors.sparkSession
    ship(spark)
    folder = scratch(spark, "negatives")
    whole = _floored(sound_vectors(vectors, id_col, vector_col, label_col), scale)
    rows = stage(whole.mapInArrow(_coder(rotations), CODED), folder, "codes")
    # The smallest row of a repeated identifier.
    chosen = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("label", "size", "vector")).alias("row"))
    chosen = stage(chosen.select("vec_id", "row.*"), folder, "anchors")
    sizes = chosen.agg(F.count("*").alias("n"), F.max("size").alias("size")).first()
    # An anchor's share of a broadcast: its numbers, planes and windows.
    bytes_each = 8 * (sizes.size or 0) + (PLANES * rotations * (sizes.size or 0)) // 8 + 64 * (positives + 4)
    passes = max(1, -(-sizes.n * bytes_each // anchor_bytes))

    def scan(name: str, k: int, windows: DataFrame | None) -> DataFrame:
        """The best ``k`` of each anchor and slot, over passes that each broadcast a bounded part of the anchors."""
        out = None
        for p in range(passes):
            some = chosen.where(F.pmod(F.xxhash64("vec_id"), F.lit(passes)) == p)
            if windows is None:
                part = [(r.vec_id, r.label, np.frombuffer(r.vector, "<f8"), [(-np.inf, np.inf)]) for r in some.collect()]
            else:
                part = [(r.vec_id, r.label, np.frombuffer(r.vector, "<f8"), [(w.low, w.high) for w in r.windows]) for r in some.join(windows, "vec_id").collect()]
            found = rows.mapInArrow(_scanner(spark.sparkContext.broadcast(part), rotations, k, windows is not None), FOUND)
            out = stage(found, folder, f"{name}-{p}") if out is None else out.unionByName(stage(found, folder, f"{name}-{p}"))
        best = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
        scored = F.sum("scored").over(Window.partitionBy("anchor_id", "slot"))
        return out.withColumn("rank", F.row_number().over(best)).withColumn("scored", scored).where(F.col("rank") <= k)

    nearest = scan("near", positives, None).select(F.col("anchor_id").alias("vec_id"), F.col("vec_id").alias("positive_id"), F.col("rank"), "score")
    nearest = stage(nearest, folder, "positives")
    # Windows in whole numbers; a score below zero has none.
    exact = F.col("score").cast("decimal(38,0)")
    bounds = nearest.where("score >= 0").select(
        "vec_id", "rank", "positive_id", "score",
        F.ceil(exact * low / 100).cast("bigint").alias("low"), F.floor(exact * high / 100).cast("bigint").alias("high"),
    )
    bounds = stage(bounds, folder, "windows")
    windows = bounds.groupBy("vec_id").agg(F.sort_array(F.collect_list(F.struct("rank", "low", "high"))).alias("windows"))
    hard = scan("far", negatives, windows)
    slots = bounds.select(
        F.col("vec_id").alias("anchor_id"),
        (F.row_number().over(Window.partitionBy("vec_id").orderBy("rank")) - 1).alias("slot"),
        "positive_id",
        F.col("score").alias("positive_score"),
    )
    return hard.join(slots, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"), "scored"
    )
