"""Run a registered query in Spark and its SQL in DuckDB and compare the rows, whatever their order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark, con, query, sql, sf_dir):
    """(rows in Spark, difference) with equal column names; the difference is empty if all is well."""
    got = query(spark, sf_dir)
    expected = con.execute(sql)
    names = [c[0] for c in expected.description]
    assert sorted(got.columns) == sorted(names), (got.columns, names)
    mine, theirs = rows_of(got.columns, got.collect()), rows_of(names, expected.fetchall())
    difference = {"only Spark": list((mine - theirs).items())[:3], "only SQL": list((theirs - mine).items())[:3]}
    return sum(mine.values()), {k: v for k, v in difference.items() if v}
