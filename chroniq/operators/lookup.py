"""Joins against lookup tables, safe for hot keys and for lookups of any size.

A side is broadcast only after its size has been measured. Beyond the bound the join is
shuffled, and keys that are counted to hold more rows than a task's share are spread over several tasks.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_BYTES = 32 * 1024 * 1024
MAX_LOOKUP_ROWS = 10_000
HOT_SHARE = 0.005  # share of all rows from which a key counts as hot
SALTS = 4096  # tasks that one key is given at most

_HASH = "__key_hash"
_SALT = "__salt"


def _row_bytes(df: DataFrame) -> Column:
    """An estimate from above of a row's size in memory."""
    sizes = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(field.name), F.lit(0)) + 16)
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0)) * 2 + 16)
        else:
            sizes.append(F.lit(16))
    return reduce(add, sizes, F.lit(16))


def measured_bytes(df: DataFrame) -> int:
    """Size of a frame, by one aggregate over it."""
    return df.select(F.sum(_row_bytes(df).cast("bigint")).alias("n")).first()["n"] or 0


def small_table(df: DataFrame, max_rows: int = MAX_LOOKUP_ROWS) -> DataFrame | None:
    """``df`` as an in-memory table, or ``None`` if it has more than ``max_rows`` rows.

    For narrow rows, such as one mark per language. At most ``max_rows + 1`` rows are fetched.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows or rows.nbytes > MAX_BROADCAST_BYTES:
        return None
    return df.sparkSession.createDataFrame(rows, schema=df.schema)


def hot_keys(left: DataFrame, on: list[str], salts: int) -> dict[int, int]:
    """Hashes of the keys with more rows than their share of the tasks, and the number of tasks each is given.

    A one-pass summary names every key above ``HOT_SHARE`` and may name others; one narrow aggregate then counts these exactly,
    so a unique key is never taken for a hot one.
    """
    key_hash = F.xxhash64(*on)
    named = left.select(key_hash.alias(_HASH)).stat.freqItems([_HASH], HOT_SHARE).first()[0] or []
    if not named:
        return {}
    # At most 1 / HOT_SHARE groups, and one for all other rows.
    group = F.when(key_hash.isin([int(h) for h in named]), key_hash).alias(_HASH)
    counts = {r[0]: r[1] for r in left.groupBy(group).count().collect()}
    total = sum(counts.values())
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = {h: -(-n * tasks // total) for h, n in counts.items() if h is not None and n > HOT_SHARE * total}
    return {h: min(salts, n) for h, n in shares.items() if n > 1}


def skew_join(left: DataFrame, right: DataFrame, on: list[str], how: str, salts: int = SALTS) -> DataFrame:
    """Shuffled equi-join in which each hot key of ``left`` is spread over as many tasks as its rows ask for.

    Rows of ``right`` are repeated for hot keys only. Works for ``inner``, ``left``, ``left_semi`` and ``left_anti``: every copy
    sees all right rows of its key.
    """
    hot = hot_keys(left, on, salts)
    if not hot:
        return left.join(right, on, how)
    key_hash = F.xxhash64(*on)
    tasks = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in hot.items() for x in pair]), key_hash), F.lit(1))
    # The salt depends on the row and its input partition alone, so a task that runs again salts alike.
    plain = [f.name for f in left.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    salt = F.pmod(F.xxhash64(*plain) + F.spark_partition_id(), tasks)
    spread = left.withColumn(_SALT, salt)
    copies = F.sequence(F.lit(0).cast("bigint"), (tasks - 1).cast("bigint"))
    return spread.join(right.withColumn(_SALT, F.explode(copies)), [*on, _SALT], how).drop(_SALT)


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Join that broadcasts ``right`` if it is measured to be small, and else copes with skew."""
    if measured_bytes(right) <= max_bytes:
        return left.join(F.broadcast(right), on, how)
    return skew_join(left, right, on, how)


def key_lookup_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str, max_rows: int = MAX_LOOKUP_ROWS
) -> DataFrame:
    """:func:`lookup_join` for a narrow, computed ``right``: it is computed once if it is small."""
    small = small_table(right, max_rows)
    if small is not None:
        return left.join(F.broadcast(small), on, how)
    return skew_join(left, right, on, how)
