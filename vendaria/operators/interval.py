"""Join days with the spans of days that hold them, without comparing each with each."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NODE = "_node"


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    point: str,
    start: str,
    end: str,
    on: Sequence[str] = (),
    period: tuple[date, date] | None = None,
) -> DataFrame:
    """Every point with every interval (both ends included) that holds it and has the same `on` columns.

    Days are the leaves of a binary tree. An interval is the union of a few nodes, at most two of each level, and a
    day is under one node of each level; so a pair meets in one node exactly, and Spark joins on it with the `on`
    columns, which also match where both are NULL. No condition is left for after the join.

    `period` bounds the points; without it, it is looked up. An interval that reaches beyond it on both sides, such as
    a version that is still valid, is one node. A NULL point, start or end matches nothing. Apart from `on`, the two
    tables have no column name in common.
    """
    shared = (set(points.columns) & set(intervals.columns)) - set(on)
    if shared:
        raise ValueError(f"both sides have columns {sorted(shared)}")
    if period is None:
        period = points.agg(F.min(point), F.max(point)).first()
        if period[0] is None:
            period = (date(1970, 1, 1), date(1970, 1, 1))
    first, last = period
    levels = (last - first).days.bit_length()
    origin = F.unix_date(F.lit(first))

    leaf = F.unix_date(point) - origin
    above = F.array(*[_node(level, F.shiftright(leaf, level)) for level in range(levels + 1)])
    inside = F.col(point).between(F.lit(first), F.lit(last))
    left = points.filter(inside).withColumn(_NODE, F.explode(above)).alias("l")
    right = intervals.withColumn(_NODE, F.explode(_cover(F.col(start), F.col(end), first, last, levels))).alias("r")

    meets = F.col(f"l.{_NODE}") == F.col(f"r.{_NODE}")
    for name in on:
        meets = meets & F.col(f"l.`{name}`").eqNullSafe(F.col(f"r.`{name}`"))
    columns = [F.col(f"l.`{c}`") for c in points.columns]
    columns += [F.col(f"r.`{c}`") for c in intervals.columns if c not in on]
    return left.join(right, meets).select(*columns)


def _cover(start: Column, end: Column, first: date, last: date, levels: int) -> Column:
    """The nodes whose days are those of the interval; it is cut to the tree, and one past the last day fills it."""
    origin, size = F.unix_date(F.lit(first)), 1 << levels
    # From the first leaf to the one behind the last.
    low = F.when(start > F.lit(first), F.unix_date(start) - origin).otherwise(0)
    high = F.when(end < F.lit(last), F.unix_date(end) - origin + 1).otherwise(size)
    nodes = []
    for level in range(levels + 1):
        a, b = F.shiftright(low + ((1 << level) - 1), level), F.shiftright(high, level)
        nodes.append(F.when((a < b) & (a % 2 == 1), _node(level, a)))
        nodes.append(F.when((a < b) & (b % 2 == 1), _node(level, b - 1)))
    holds = start.isNotNull() & end.isNotNull() & (start <= end) & (start <= F.lit(last)) & (end >= F.lit(first))
    return F.when(holds, F.array_compact(F.array(*nodes)))


def _node(level: int, number: Column) -> Column:
    return F.struct(F.lit(level).alias("level"), number.alias("number"))
