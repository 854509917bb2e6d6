"""Checks on the data that feed the marts."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaria.functions import null_count


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with `total_null_<column>` for every column; all NULL if `df` is empty."""
    return df.agg(*[null_count(F.col(c)).alias(f"total_null_{c}") for c in columns or df.columns])


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(rule, violations): rows without a value, one rule per column, all in one pass."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rules = F.array(*[F.struct(F.lit(f"not_null({c})").alias("rule"), F.col(c).alias("violations")) for c in columns])
    return counted.select(F.inline(rules))


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(rule, violations): rows beyond the first of a complete key."""
    per_key = df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.lit(f"unique({', '.join(columns)})").alias("rule"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"),
    )


def audit(df: DataFrame, columns: Sequence[str], key: Sequence[str]) -> DataFrame:
    """(rule, violations) of `not_null` for `columns` and `unique` for `key`, from one pass over `df`.

    Null counts are added up per key, so that both kinds of rules come out of the same aggregation.
    """
    names = [f"_null_{i}" for i in range(len(columns))]
    nulls = [F.count_if(F.col(c).isNull()).alias(n) for c, n in zip(columns, names, strict=True)]
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"), *nulls)
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    counted = per_key.agg(
        F.coalesce(F.sum(F.when(complete, F.col("_rows") - 1)), F.lit(0)).alias("_again"),
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names],
    )
    rules = [(f"not_null({c})", n) for c, n in zip(columns, names, strict=True)]
    rules.append((f"unique({', '.join(key)})", "_again"))
    return counted.select(F.inline(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(c).alias("violations")) for r, c in rules])))


def refers_to(df: DataFrame, columns: Sequence[str], parent: DataFrame, parent_name: str) -> DataFrame:
    """(rule, violations): rows with a complete key that `parent` lacks.

    Rows are counted per key first, so a key shared by much of the table meets the parent as one row.
    """
    columns = list(columns)
    per_key = df.dropna(subset=columns).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    orphans = per_key.join(parent.select(*columns), columns, "left_anti")
    return orphans.agg(
        F.lit(f"refers_to({', '.join(columns)} -> {parent_name})").alias("rule"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("violations"),
    )


def arrives_within(
    df: DataFrame,
    other: DataFrame,
    other_name: str,
    days: int,
    until: datetime,
    key: str = "purchase_id",
    time: str = "transaction_datetime",
) -> DataFrame:
    """(rule, violations): keys of `df` for which `other` has nothing up to `days` after their first record.

    Only keys whose time was up at `until` count, and only records before `until` are looked at; what comes too late
    is a violation like what never comes. Each side is reduced to the first time of every key before they meet, so a
    key with many records is one row. Records without a key or a time are left out.
    """
    firsts = []
    for side in (df, other):
        end = F.lit(str(until)).cast(side.schema[time].dataType)
        seen = side.filter(F.col(key).isNotNull() & (F.col(time) < end))
        firsts.append(seen.groupBy(key).agg(F.min(time).alias("_first")))
    mine, theirs = firsts
    deadline = F.col("_first") + F.make_dt_interval(F.lit(days))
    end = F.lit(str(until)).cast(df.schema[time].dataType)
    due = mine.select(key, deadline.alias("_deadline")).filter(F.col("_deadline") < end)
    late = due.join(theirs, key, "left").filter(F.col("_first").isNull() | (F.col("_first") > F.col("_deadline")))
    return late.agg(
        F.lit(f"arrives_within({key} -> {other_name}, {days} days)").alias("rule"), F.count(F.lit(1)).alias("violations")
    )


def quality_gate(*rules: DataFrame) -> DataFrame:
    """(rule, violations, passed), one row per rule."""
    return reduce(DataFrame.unionByName, rules).withColumn("passed", F.col("violations") == 0)


def enforce(gate: DataFrame) -> None:
    """Raise if a rule failed. Brings at most one row per rule to the driver."""
    failed = gate.filter(~F.col("passed")).collect()
    if failed:
        raise ValueError("data quality: " + "; ".join(f"{r.rule}: {r.violations} rows" for r in failed))
