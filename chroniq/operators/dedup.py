"""Duplicate rows: keep the first, or find all members of a group.

Groups are reduced to one row each before the shuffle and never gathered in a task, so one
group may hold any share of the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chroniq.operators.lookup import key_lookup_join
from chroniq.session import stage, work_folder

SLICE_LOSERS = 1_000_000  # row numbers broadcast at once: some tens of megabytes
MAX_SLICES = 64


def dedup_first(
    df: DataFrame, keys: list[str] = ("date", "lang"), order: str = "ord", max_losers: int = SLICE_LOSERS
) -> DataFrame:
    """Keep the row with the lowest ``order`` of each key group. ``order`` is unique; null keys are equal.

    Only ``keys`` and ``order`` are shuffled to find the rows to drop, and the wide rows are not shuffled. If there are more than
    ``max_losers`` of these, the table is read in slices of ``order``, each of which gets its own part of them; where rows are laid
    out by ``order``, as in a published corpus, each slice reads its own row groups only. Beyond 64 full
    slices, some 64 million rows to drop, the rows are joined on ``order``, which has no hot value.
    """
    spark = df.sparkSession
    firsts = df.groupBy(*keys).agg(F.min(order).alias(order)).select(order)
    losers = stage(df.select(order).join(firsts, order, "left_anti"), work_folder(spark, "losers"), "rows")
    n = losers.count()
    slices = min(MAX_SLICES, -(-n // max(1, max_losers)))
    if n > MAX_SLICES * SLICE_LOSERS:
        return df.join(losers, order, "left_anti")
    if slices <= 1:
        return df.join(F.broadcast(losers), order, "left_anti")
    shares = [i / slices for i in range(1, slices)]
    cuts = sorted(set(losers.agg(F.percentile_approx(order, shares, 10_000).alias("c")).first().c))
    column = F.col(order)
    ranges = [(column <= b) & (column > a) for a, b in zip(cuts, cuts[1:])]
    ranges = [(column <= cuts[0]) | column.isNull(), *ranges, column > cuts[-1]]
    return reduce(DataFrame.unionByName, [df.where(r).join(F.broadcast(losers.where(r)), order, "left_anti") for r in ranges])


def repeated_keys(df: DataFrame, keys: list[str] = ("date",)) -> DataFrame:
    """The key values that occur more than once, with their number ``n``."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def has_repeats(df: DataFrame, keys: list[str] = ("date",)) -> bool:
    return not repeated_keys(df, keys).isEmpty()


def duplicate_members(df: DataFrame, keys: list[str] = ("date",)) -> DataFrame:
    """Every row whose key occurs more than once."""
    keys = list(keys)
    return key_lookup_join(df, repeated_keys(df, keys).select(*keys), keys, "left_semi")
