"""Connected components of a graph given as an edge table, by alternating large-star and small-star steps.

Each step is an aggregate and a lookup join; no neighbourhood is gathered, so a vertex may have any number of edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chroniq.llm.common import discard, scratch
from chroniq.operators.lookup import lookup_join
from chroniq.session import stage


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours that are larger than a vertex are tied to the smallest of its neighbourhood."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    # The centre of a star has any number of edges: its small table is broadcast, or the centre is salted.
    moved = lookup_join(both.where(F.col("b") > F.col("a")), lowest, ["a"], "inner").select(F.col("m").alias("a"), "b")
    return moved.where(F.col("a") < F.col("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours are tied to the smallest of these. Edges come as (smaller, larger)."""
    lowest = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = lookup_join(edges, lowest, ["b"], "inner").select(F.col("m").alias("x"), F.col("a").alias("y"))
    kept = lowest.select(F.col("m").alias("x"), F.col("b").alias("y"))
    return moved.union(kept).where("x < y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()


def _print_of(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return row.n, row.x


def components(edges: DataFrame) -> DataFrame:
    """``(vertex, component)`` for every vertex of an edge ``(a, b)``; the component is its smallest vertex.

    Loops and repeated edges do no harm; no edges give an empty result. Every round is written to the shared folder, so
    a lost executor costs one step, and the rounds before the last are removed.
    """
    spark = edges.sparkSession
    folder = scratch(spark, "components")
    clean = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    now = stage(clean, folder, "round-0")
    before, rounds = _print_of(now), 0
    while True:
        rounds += 1
        middle = stage(_large_star(now), folder, f"large-{rounds}")
        now = stage(_small_star(middle), folder, f"round-{rounds}")
        after = _print_of(now)
        discard(spark, f"{folder}/large-{rounds}")
        discard(spark, f"{folder}/round-{rounds - 1}")
        if after == before:
            break
        before = after
    return now.select(F.col("b").alias("vertex"), F.col("a").alias("component")).union(
        now.select("a").distinct().select("a", F.col("a").alias("component"))
    )
