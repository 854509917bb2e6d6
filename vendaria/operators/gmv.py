"""Daily gross merchandise value by subsidiary, and reads of its history."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vendaria.functions import day, exact, in_days, money
from vendaria.operators.cdc import APPROVED, Feeds, consolidated_purchase, latest_feeds, valid_purchase
from vendaria.operators.interval import interval_join


def gmv_of(consolidated: DataFrame, scale: int | None = 2) -> DataFrame:
    """Value by day and subsidiary of the rows that have a day, i.e. a valid purchase.

    NULL if no purchase of the group has a value. Values are added as decimals: a sum of doubles depends on the
    order of addition, and at size also in the cents, which would look like a change of value to the history.
    """
    return (
        consolidated.filter(F.col("transaction_date").isNotNull())
        .groupBy("transaction_date", "subsidiary")
        .agg(money(F.sum(exact(F.col("purchase_value"))), scale).alias("gmv_daily"))
    )


def gmv_daily(
    feeds: Feeds,
    how: str = "left",
    multiply_quantity: bool = False,
    scale: int | None = 2,
    status_col: str | None = None,
    approved: str = APPROVED,
) -> DataFrame:
    """From raw feeds: latest versions, valid purchases, their value by day and subsidiary.

    Each feed is shuffled once, by purchase id, with the few columns that matter; the joins find all three
    partitioned and sorted. `how="full_outer"` gives the same rows.
    """
    needed = Feeds(
        ["release_date"] + ([status_col] if status_col else []),
        ["purchase_value"] + (["item_quantity"] if multiply_quantity else []),
        ["subsidiary"],
    )
    latest = latest_feeds(feeds, only=needed, status_col=status_col)
    valid = valid_purchase(latest.purchase, status_col, approved)
    consolidated = consolidated_purchase(valid, latest.product_item, latest.extra_info, how, multiply_quantity)
    return gmv_of(consolidated, scale)


def gmv_current_full(history: DataFrame) -> DataFrame:
    return history.filter(F.col("is_current") & F.col("transaction_date").isNotNull()).orderBy(
        "transaction_date", "subsidiary"
    )


def gmv_current(history: DataFrame) -> DataFrame:
    return gmv_current_full(history).select("transaction_date", "subsidiary", "gmv_daily")


def gmv_period(
    history: DataFrame, first: date | str, last: date | str, current_only: bool = False, scale: int | None = 2
) -> DataFrame:
    """Value by day and subsidiary of a period (whole partitions of the stored table).

    Sums every version of a day, closed ones too, unless `current_only`.
    """
    rows = history.filter(in_days(F.col("transaction_date"), first, last))
    if current_only:
        rows = rows.filter(F.col("is_current"))
    return rows.groupBy("transaction_date", "subsidiary").agg(money(F.sum(exact(F.col("gmv_daily"))), scale).alias("gmv"))


def gmv_as_of(history: DataFrame, when: date | str) -> DataFrame:
    """The versions that were valid on a past day."""
    return history.filter((F.col("valid_from") <= day(when)) & (F.col("valid_to") >= day(when)))


def gmv_known(history: DataFrame, first: date | str, last: date | str) -> DataFrame:
    """The versions valid on each day `as_of` of a period: `gmv_as_of` of all its days at once."""
    first, last = (date.fromisoformat(d) if isinstance(d, str) else d for d in (first, last))
    days = history.sparkSession.range((last - first).days + 1)
    days = days.select(F.date_add(day(first), F.col("id").cast("int")).alias("as_of"))
    return interval_join(days, history, "as_of", "valid_from", "valid_to", period=(first, last))


def gmv_known_totals(history: DataFrame, first: date | str, last: date | str, scale: int | None = 2) -> DataFrame:
    """(as_of, subsidiary, gmv): all that was known of a subsidiary on each day of a period."""
    known = gmv_known(history.select("subsidiary", "gmv_daily", "valid_from", "valid_to"), first, last)
    return known.groupBy("as_of", "subsidiary").agg(money(F.sum(exact(F.col("gmv_daily"))), scale).alias("gmv"))


def gmv_known_at_correction(history: DataFrame, purchase: DataFrame) -> DataFrame:
    """(purchase_id, arrived, transaction_date, subsidiary, gmv_daily): where a version of a purchase follows one that
    was released, what was known on its arrival of the day of that release, for every subsidiary."""
    versions = Window.partitionBy("purchase_id").orderBy("transaction_datetime", "release_date")
    corrected = purchase.select(
        "purchase_id",
        F.col("transaction_datetime").cast("date").alias("arrived"),
        F.lag("release_date").over(versions).alias("transaction_date"),
    ).filter(F.col("transaction_date").isNotNull())
    known = history.select("transaction_date", "subsidiary", "gmv_daily", "valid_from", "valid_to")
    found = interval_join(corrected, known, "arrived", "valid_from", "valid_to", ["transaction_date"])
    return found.select("purchase_id", "arrived", "transaction_date", "subsidiary", "gmv_daily")
