"""Names for columns that an operator needs beside those it was given."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, with as many underscores before them as it takes for `df` to have no such column."""
    taken = {c.lower() for c in df.columns}
    prefix = "_"
    while any((prefix + name).lower() in taken for name in names):
        prefix += "_"
    return [prefix + name for name in names]
