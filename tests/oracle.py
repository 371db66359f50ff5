"""Comparison of a Spark result with a DuckDB result, without regard to row order."""

import math
from pathlib import Path

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_df, con, sql):
    """None if equal, else a short account of the difference."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _rows(names, cursor.fetchall())
    if sorted(spark_df.columns) != sorted(names):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if got == expected:
        return None
    only_got = [r for r in got if r not in set(expected)][:2]
    only_expected = [r for r in expected if r not in set(got)][:2]
    return f"rows {len(got)} vs {len(expected)}; spark only {str(only_got)[:700]}; sql only {str(only_expected)[:700]}"
