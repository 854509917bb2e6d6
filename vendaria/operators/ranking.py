"""Largest rows, over all or within each group. Ties are broken, so results repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_n(df: DataFrame, n: int, by: str, tiebreak: Sequence[str]) -> DataFrame:
    """The `n` largest rows in order; every task keeps `n` rows and nothing is sorted as a whole."""
    return df.orderBy(F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in tiebreak]).limit(n)


def top_n_per_group(
    df: DataFrame, n: int, groups: Sequence[str], by: str, tiebreak: Sequence[str], rank: str
) -> DataFrame:
    """The `n` largest rows of every group with their rank; tasks drop the rest before the shuffle."""
    largest_first = Window.partitionBy(*groups).orderBy(
        F.col(by).desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in tiebreak]
    )
    return df.withColumn(rank, F.row_number().over(largest_first)).filter(F.col(rank) <= n)
