"""Column expressions shared by the operators. All are Spark built-ins and stay in code generation."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the end date of a version that is still valid.
OPEN_END = date(9999, 12, 31)


def day(value: date | str) -> Column:
    """A DATE literal; a malformed text fails here instead of turning into NULL."""
    return F.lit(date.fromisoformat(value) if isinstance(value, str) else value)


def in_days(column: Column, first: date | str, last: date | str) -> Column:
    """Inclusive at both ends."""
    return column.between(day(first), day(last))


def day_before(value: date | str) -> Column:
    return F.date_sub(day(value), 1)


def line_value(value: Column, quantity: Column) -> Column:
    return value * quantity


def exact(column: Column) -> Column:
    """As a decimal, so that a sum does not depend on the order of addition: up to 16 digits before the point."""
    return column.cast("decimal(24,8)")


def times(amount: Column, count: Column) -> Column:
    """An exact amount taken `count` times, still exact."""
    return amount * count.cast("decimal(12,0)")


def money(total: Column, scale: int | None = 2) -> Column:
    """An exact total as a double, rounded HALF_UP; `None` leaves all its digits."""
    return (total if scale is None else F.round(total, scale)).cast("double")


def null_count(column: Column) -> Column:
    """NULL, not 0, on an empty input (use `F.count_if` for 0)."""
    return F.sum(F.when(column.isNull(), 1).otherwise(0))


def parse_timestamp(column: Column, strict: bool = True) -> Column:
    """`strict` raises on malformed text under ANSI, otherwise it becomes NULL."""
    return F.to_timestamp(column) if strict else F.try_to_timestamp(column)


def parse_date(column: Column, strict: bool = True) -> Column:
    return F.to_date(column) if strict else F.try_to_date(column)
