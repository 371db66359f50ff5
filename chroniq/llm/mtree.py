"""Exact top-k inner products by best-first search in a forest of M-trees.

An inner product becomes a metric by one more coordinate: with ``m`` the largest squared length, ``x`` goes to ``(x, sqrt(m - |x|^2))`` and a
query to ``(q, 0)``, and then ``|q - x|^2 = |q|^2 + m - 2 <q, x>``. The rows are dealt to cells around a bounded sample of
pivots, a large cell is cut into slices, and each slice is built into an M-tree in a task of its own. A tree is stored as pages: a
node's routing objects or rows, with the covering radius of each child and the distance of each to the node's own object.

A query first goes to the tree with the nearest root, which gives it a bound, and then to those trees whose covering ball reaches
within that bound. Inside a tree, a block of queries goes from node to node together, in the order of the least possible distance of any of them;
each query has its own bound and takes part in the nodes within it. Stored distances to the parent's object rule out entries
by the triangle inequality, and for those that some query needs, the distances of a node are one matrix product. Distances only
bound: every returned score is an integer inner product, computed exactly.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chroniq.llm.common import scratch, ship
from chroniq.llm.ngram_join import runs
from chroniq.session import stage

PIVOTS = 256  # cells, at most; their pivots are a sample of as many rows
CELL_ROWS = 2048  # rows for which there is a cell, until there are as many cells as may be
TREE_ROWS = 4096  # rows of a tree
PAGE = 64  # entries of a node
ROOTS = 4096  # roots looked at in one pass
BLOCK = 256  # queries that search a tree together
PART_QUERIES = 16_384  # queries that a task gets for a tree
EXACT = 2.0**53
LONG = 2**63 - 1

NODES = (
    "tree string, node int, leaf boolean, ids array<bigint>, children array<int>, radii array<double>, to_parent array<double>, "
    "vectors binary, size int"
)


def lifted(x: np.ndarray, m: float) -> np.ndarray:
    """Integer vectors with the coordinate that makes inner products a metric."""
    squares = (x.astype(np.float64) ** 2).sum(1)
    return np.column_stack([x, np.sqrt(np.maximum(m - squares, 0))])


def distances(points: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - one) ** 2).sum(1))


def build(tree: str, ids: np.ndarray, x: np.ndarray, m: float) -> list[tuple]:
    """Pages of a tree, node 0 the root's. A node is split around objects that are far from one another."""
    points = lifted(x, m)
    pages: list[tuple] = []

    def page(rows: np.ndarray, centre: int) -> int:
        number = len(pages)
        pages.append(())
        away = distances(points[rows], points[centre])
        if len(rows) <= PAGE or not away.any():  # equal points make one page of any size
            pages[number] = (tree, number, True, ids[rows].tolist(), [], [], away.tolist(), x[rows].astype("<i8").tobytes(), len(rows))
            return number
        fan = min(PAGE, max(2, -(-len(rows) // PAGE)))
        picks, nearest, owner = [int(np.argmax(away))], None, None
        nearest = distances(points[rows], points[rows[picks[0]]])
        owner = np.zeros(len(rows), np.int64)
        while len(picks) < fan and nearest.max() > 0:
            picks.append(int(np.argmax(nearest)))
            d = distances(points[rows], points[rows[picks[-1]]])
            closer = d < nearest
            owner[closer] = len(picks) - 1
            nearest = np.minimum(nearest, d)
        children, radii, to_parent, objects = [], [], [], []
        for i, p in enumerate(picks):
            own = owner == i
            children.append(page(rows[own], int(rows[p])))
            radii.append(float(nearest[own].max()))
            to_parent.append(float(away[p]))
            objects.append(int(rows[p]))
        pages[number] = (tree, number, False, [], children, radii, to_parent, x[objects].astype("<i8").tobytes(), len(objects))
        return number

    page(np.arange(len(ids)), 0)
    return pages


def builder(m: float):
    """(tree, id, vector) sorted by tree to pages, and a root row (node -1) with the tree's centre and radius."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in NODES.split(", ")]
        floats = pa.list_(pa.float64())
        types = [pa.string(), pa.int32(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int32()), floats, floats, pa.binary(), pa.int32()]
        for rows in runs(batches, 1):
            ids = np.array([r[1] for r in rows], np.int64)
            x = np.array([r[2] for r in rows], np.int64)
            pages = build(rows[0][0], ids, x, m)
            reach = float(distances(lifted(x, m), lifted(x[:1], m)[0]).max())
            pages.append((rows[0][0], -1, False, [], [0], [reach], [0.0], x[:1].astype("<i8").tobytes(), 1))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*pages, strict=True), types, strict=True)], names)

    return run


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices of whole numbers, held at the ends of 64 bits beyond them."""
    if not x.size or not q.size or float(np.abs(x.astype(float)).max()) * float(np.abs(q.astype(float)).max()) * x.shape[1] < EXACT:
        return (x.astype(float) @ q.T.astype(float)).astype(np.int64)
    rows = [[sum(a * b for a, b in zip(r, c, strict=True)) for c in q.tolist()] for r in x.tolist()]
    return np.array([[max(-LONG, min(LONG, v)) for v in r] for r in rows], np.int64).reshape(len(x), len(q))


class Tree:
    """Pages of one tree, and the search in them."""

    def __init__(self, rows: list[dict], m: float) -> None:
        self.m = m
        self.pages = {}
        for r in rows:
            x = np.frombuffer(r["vectors"], "<i8").reshape(r["size"], -1)
            points = lifted(x, m)
            squares = (points * points).sum(1)
            self.pages[r["node"]] = (r["leaf"], np.array(r["ids"], np.int64), r["children"], np.array(r["radii"]), np.array(r["to_parent"]), x, points, squares)

    def search(self, own: np.ndarray, q: np.ndarray, k: int, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(scores, identifiers, distances computed) of the best ``k`` rows for each query that may be among its ``k`` best of all.

        ``least`` are scores that ``k`` rows reach already, or less than any. Places that stay empty have the identifier of the largest number.
        """
        n = len(q)
        point = np.column_stack([q.astype(float), np.zeros(n)])
        lengths = (point * point).sum(1)
        whole = lengths + self.m
        slack = 1e-7 * (1 + np.sqrt(whole))
        scores, ids = np.full((n, k), -LONG - 1, np.int64), np.full((n, k), LONG, np.int64)
        full, computed = np.zeros(n, bool), np.zeros(n, np.int64)

        def limits(of: np.ndarray) -> np.ndarray:
            floor = np.maximum(least[of], np.where(full[of], scores[of, -1], -np.inf))
            reach = np.sqrt(np.maximum(whole[of] - 2.0 * np.maximum(floor, -1e300), 0)) + slack[of]
            return np.where(np.isneginf(floor), np.inf, reach)

        def distance(of: np.ndarray, points: np.ndarray, squares: np.ndarray) -> np.ndarray:
            # Rounding of the sum of squares is far below what the slack allows.
            return np.sqrt(np.maximum(lengths[of, None] + squares - 2 * point[of] @ points.T, 0))

        everyone = np.arange(n)
        start = distance(everyone, self.pages[-1][6], self.pages[-1][7])[:, 0]
        # (least possible distance of any query, node, each query's least possible distance and distance to the node's object)
        low = np.maximum(0, start - self.pages[-1][3][0])
        queue = [(float(low.min()), 0, low, start)]
        while queue:
            _, node, low, to_object = heapq.heappop(queue)
            of = np.flatnonzero(low <= limits(everyone))
            if not len(of):
                continue
            leaf, leaf_ids, children, radii, to_parent, x, points, squares = self.pages[node]
            limit = limits(of)
            needed = np.abs(to_object[of, None] - to_parent) - (0 if leaf else radii) <= limit[:, None]
            computed[of] += needed.sum(1)
            near = np.flatnonzero(needed.any(0))
            if not len(near):
                continue
            needed = needed[:, near]
            if leaf:
                found = products(q[of], x[near])
                fit = needed & (leaf_ids[near] != own[of, None]) & (found >= least[of, None]) & (~full[of, None] | (found >= scores[of, -1:]))
                some = np.flatnonzero(fit.any(1))
                if not len(some):
                    continue
                at = of[some]
                more = np.concatenate([scores[at], np.where(fit[some], found[some], -LONG - 1)], 1)
                names = np.concatenate([ids[at], np.where(fit[some], leaf_ids[near], LONG)], 1)
                order = np.lexsort((names, ~more), axis=1)[:, :k]  # the complement turns the order round
                scores[at], ids[at] = np.take_along_axis(more, order, 1), np.take_along_axis(names, order, 1)
                full[at] = ids[at, -1] != LONG
            else:
                d = distance(of, points[near], squares[near])
                reach = np.maximum(0, d - radii[near])
                for e, child in enumerate(near.tolist()):
                    low, to_child = np.full(n, np.inf), np.full(n, np.inf)
                    wanted = needed[:, e] & (reach[:, e] <= limit)
                    if wanted.any():
                        low[of[wanted]], to_child[of[wanted]] = reach[wanted, e], d[wanted, e]
                        heapq.heappush(queue, (float(reach[wanted, e].min()), children[child], low, to_child))
        return scores, ids, computed


def searcher(m: float, k: int, page_names: list[str]):
    """A tree's pages and then the queries sent to it, to (query, id, score, distances computed). Queries are taken in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, pages, tree, block = None, [], None, []

        def answers():
            own, least = np.array([r[0] for r in block], np.int64), np.array([-np.inf if r[1] is None else r[1] for r in block])
            scores, ids, computed = tree.search(own, np.array([r[2] for r in block], np.int64), k, least)
            row, place = np.nonzero(ids != LONG)
            columns = [own[row], ids[row, place], scores[row, place], computed[row]]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "vec_id", "score", "computed"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:2] != key:
                    if block:
                        yield answers()
                    key, pages, tree, block = row[:2], [], None, []
                if row[2] == 0:
                    pages.append(dict(zip(page_names, row[3:], strict=False)))
                elif pages or tree:
                    if tree is None:
                        tree, pages = Tree(pages, m), []
                    block.append(row[-3:])
                    if len(block) == BLOCK:
                        yield answers()
                        block = []
        if block:
            yield answers()

    return run


def router(roots, m: float, home: bool):
    """(query, least score, vector, home tree) to (tree, query, least score, vector): the nearest root, or the others within reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, centres, radii, sizes = roots.value
        for batch in batches:
            out = []
            for query, least, vector, sent in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fit = np.flatnonzero(sizes == len(vector))
                if not len(fit):
                    continue
                q = np.array(vector, np.int64)
                whole = float((q.astype(np.float64) ** 2).sum()) + m
                centre = np.array([centres[i] for i in fit.tolist()], np.int64)
                d = distances(lifted(centre, m), np.append(q.astype(np.float64), 0.0))
                if home:
                    i = int(np.argmin(d))
                    out.append((names[fit[i]], query, None, vector, float(d[i])))
                else:
                    limit = np.inf if least is None else np.sqrt(max(whole - 2.0 * least, 0.0)) + 1e-7 * (1 + np.sqrt(whole))
                    out += [(names[i], query, least, vector, 0.0) for i in fit[d - radii[fit] <= limit].tolist() if names[i] != sent]
            types = [pa.string(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.float64()]
            columns = zip(*out, strict=True) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["tree", "query_id", "least", "vector", "distance"])

    return run


ROUTED = "tree string, query_id bigint, least bigint, vector array<bigint>, distance double"


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``(vec_id, vector)`` in whole numbers, of the rows that take part."""
    number = F.col(vector_col).cast("array<double>")
    sound = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.where(F.col(id_col).isNotNull() & (F.size(number) > 0) & sound)
    return rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.transform(number, lambda x: F.floor(x * scale)).alias("vector"))


def top_k(
    vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``(query_id, rank, vec_id, score, computed)``: for each row whose identifier is divisible by ``every`` the ``k`` rows of
    the highest inner product, its own identifier aside, ties to the smaller identifier; ``computed`` counts the distances and products
    that the search took for the query.

    Components are ``floor(scale * x)``. Vectors that are null, empty or hold a null or non-finite component, and rows without an
    identifier, take no part; vectors of different lengths are not compared. A repeated identifier is as many candidates, and one
    query (its smallest vector). An empty table gives an empty result; other columns are not looked at. Scores beyond 64 bits are held at
    their ends, and components likewise.
    """
    spark = vectors.sparkSession
    ship(spark)
    folder = scratch(spark, "mtree")
    rows = stage(whole_vectors(vectors, id_col, vector_col, scale), folder, "vectors")
    length = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    sizes = rows.agg(F.max(length).alias("m"), F.count("*").alias("n")).first()
    m, cells = sizes.m or 0.0, min(PIVOTS, -(-sizes.n // CELL_ROWS))

    pivots = [list(r.vector) for r in rows.orderBy(F.xxhash64("vec_id", "vector")).limit(cells).collect()]

    def celler(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size = {n: np.array([p for p in pivots if len(p) == n], np.int64) for n in {len(p) for p in pivots}}
        lifts = {n: lifted(p, m) for n, p in by_size.items()}
        for batch in batches:
            cells = []
            for v in batch.column(1).to_pylist():
                x = lifted(np.array([v], np.int64), m)[0]
                at = int(np.argmin(distances(lifts[len(v)], x))) if len(v) in lifts else 0
                cells.append(f"{len(v)}-{at}")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cells)], ["vec_id", "vector", "cell"])

    celled = stage(rows.mapInArrow(celler, "vec_id bigint, vector array<bigint>, cell string"), folder, "cells")
    slices = celled.groupBy("cell").agg(F.ceil(F.count("*") / TREE_ROWS).alias("slices"))  # at most a row per pivot
    trees = celled.join(F.broadcast(slices), "cell").select(
        # Equal rows are dealt to different slices by their place in the staged table.
        F.concat_ws("/", "cell", F.pmod(F.xxhash64("vec_id", "vector") % 65536 + F.monotonically_increasing_id() % 65536, F.col("slices"))).alias("tree"), "vec_id", "vector"
    )
    # A tree's rows must meet in one task, so they are dealt by the tree alone.
    together = trees.repartition("tree").sortWithinPartitions("tree", "vec_id")
    index = stage(together.mapInArrow(builder(m), NODES), folder, "index")

    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
    queries = queries.select(F.col("vec_id").alias("query_id"), F.lit(None).cast("bigint").alias("least"), "vector", F.lit(None).cast("string").alias("home"))
    queries = stage(queries, folder, "queries")
    root_rows = index.where("node = -1").select("tree", "vectors", "radii")
    passes = max(1, -(-root_rows.count() // ROOTS))

    def routed(asked: DataFrame, home: bool) -> DataFrame:
        """Queries with the trees to search. Roots are looked at ``ROOTS`` at a time."""
        out = None
        for p in range(passes):
            part = root_rows.where(F.pmod(F.xxhash64("tree"), F.lit(passes)) == p).collect()
            centres = [np.frombuffer(r.vectors, "<i8") for r in part]
            roots = ([r.tree for r in part], centres, np.array([r.radii[0] for r in part]), np.array([len(c) for c in centres]))
            one = asked.mapInArrow(router(spark.sparkContext.broadcast(roots), m, home), ROUTED)
            out = one if out is None else out.union(one)
        return out

    page_names = [f.name for f in index.schema.fields]
    # Every tree's queries are dealt to so many tasks, each with the tree's pages.
    parts = max(1, -(-queries.count() // PART_QUERIES))
    asked = [F.lit(None).cast(t).alias(c) for c, t in (("query_id", "bigint"), ("least", "bigint"), ("vector", "array<bigint>"))]
    pages = index.select(F.col("tree").alias("key"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("kind"), *page_names, *asked)

    def search(sent: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int").alias("part")
        asks = sent.select(
            F.col("tree").alias("key"), part, F.lit(1).alias("kind"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in index.schema.fields], "query_id", "least", "vector"
        )
        both = pages.union(asks).repartition("key", "part").sortWithinPartitions("key", "part", "kind")
        return both.mapInArrow(searcher(m, k, page_names), "query_id bigint, vec_id bigint, score bigint, computed bigint")

    homes = routed(queries, True)
    nearest = Window.partitionBy("query_id").orderBy("distance", "tree")
    homes = stage(homes.withColumn("n", F.row_number().over(nearest)).where("n = 1").drop("n"), folder, "homes")
    near = stage(search(homes), folder, "near")
    bounds = near.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
    again = homes.select("query_id", "vector", F.col("tree").alias("home")).join(bounds, "query_id", "left")
    far = stage(search(routed(again.select("query_id", "least", "vector", "home"), False)), folder, "far")
    found = near.union(far)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score", "computed")
