from vendaria.functions.columns import (
    OPEN_END,
    day,
    day_before,
    exact,
    in_days,
    line_value,
    money,
    null_count,
    parse_date,
    parse_timestamp,
    times,
)

__all__ = [
    "OPEN_END",
    "day",
    "day_before",
    "exact",
    "in_days",
    "line_value",
    "money",
    "null_count",
    "parse_date",
    "parse_timestamp",
    "times",
]
