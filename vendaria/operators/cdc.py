"""From change feeds to the latest state of every purchase."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType
from pyspark.sql.window import Window

from vendaria.functions import line_value

# Fixed value: the status of a purchase whose payment is approved.
APPROVED = "Aprovado"


class Feeds(NamedTuple):
    """Asynchronous feeds keyed by purchase_id; an entity may arrive, or be corrected, long after another."""

    purchase: DataFrame
    product_item: DataFrame
    extra_info: DataFrame


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order_col: str = "transaction_datetime",
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """Newest row of every key; NULL times are the oldest.

    Rows of equal time are decided by `tiebreak` and then by all other columns, so a recomputed task returns the
    same row. That makes the newest row the maximum of the row read as a tuple that starts with the time: an
    aggregate, which Spark applies on both sides of the shuffle, so a key that holds much of the feed is shuffled
    as one row per task. Rows with a column that has no order, such as a map, are ranked in a window instead, where
    the rank filter works before the shuffle too.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    columns = [order_col, *(tiebreak or [])]
    columns += [c for c in df.columns if c not in keys and c not in columns]
    unordered = {f.name for f in df.schema if _has_no_order(f.dataType)}
    if unordered:
        newest_first = Window.partitionBy(*keys).orderBy(
            *[F.col(c).desc_nulls_last() for c in columns if c not in unordered]
        )
        ranked = df.withColumn("_version", F.row_number().over(newest_first))
        return ranked.filter(F.col("_version") == 1).drop("_version")
    newest = df.groupBy(*keys).agg(F.max(F.struct(*columns)).alias("_newest"))
    return newest.select(*keys, "_newest.*").select(*df.columns)


def _has_no_order(kind: DataType) -> bool:
    return any(name in kind.simpleString() for name in ("map<", "variant"))


# The columns the daily value depends on. Between versions of the same time they decide before all others, so
# leaving the others out does not change which value is the latest.
VALUE_COLUMNS = Feeds(("release_date",), ("purchase_value", "item_quantity"), ("subsidiary",))


def latest_feeds(feeds: Feeds, only: Feeds | None = None, status_col: str | None = None) -> Feeds:
    """Latest version of every purchase id in each feed.

    `only` names the columns to keep besides id and time. All columns take part in the choice, so Spark cannot
    prune them by itself. A status that decides whether a purchase counts takes part before the columns that only
    some of the callers keep, so that all choose the same version.
    """
    decisive = VALUE_COLUMNS
    if status_col is not None:
        decisive = decisive._replace(purchase=(*decisive.purchase, status_col))
    latest = []
    for name, feed in feeds._asdict().items():
        if only is not None:
            feed = feed.select("purchase_id", "transaction_datetime", *getattr(only, name))
        first = [c for c in getattr(decisive, name) if c in feed.columns]
        latest.append(latest_per_key(feed, "purchase_id", tiebreak=first))
    return Feeds(*latest)


def is_confirmed(status_col: str | None = None, approved: str = APPROVED) -> Column:
    """A purchase counts once its payment is released and, where the table has a status, approved."""
    released = F.col("release_date").isNotNull()
    return released if status_col is None else released & (F.col(status_col) == approved)


def valid_purchase(latest_purchase: DataFrame, status_col: str | None = None, approved: str = APPROVED) -> DataFrame:
    """Confirmed purchases and the day their value counts on.

    To be applied to the *latest* versions: a purchase whose newest version is not released is not valid, even
    if an older one was. After the filter the day is the release date; the other dates stand in where the input
    has them, and then never matter.
    """
    dates = [c for c in ("release_date", "transaction_date", "order_date") if c in latest_purchase.columns]
    return latest_purchase.filter(is_confirmed(status_col, approved)).withColumn("gmv_date", F.coalesce(*dates))


def consolidated_purchase(
    valid: DataFrame, item: DataFrame, extra: DataFrame, how: str = "full_outer", multiply_quantity: bool = False
) -> DataFrame:
    """Day, subsidiary and value of each purchase id, from inputs that hold an id at most once.

    The value of a purchase is taken as it is, not times the quantity, unless asked for.

    `full_outer` also returns items and subsidiaries without a valid purchase (NULL day). `left` returns the
    valid purchases only; it needs no further shuffle, as all three inputs are already partitioned by id.
    """
    value = F.col("purchase_value").cast("double")
    if multiply_quantity:
        value = line_value(value, F.col("item_quantity"))
    return (
        valid.select("purchase_id", "gmv_date")
        .join(item.select("purchase_id", value.alias("purchase_value")), "purchase_id", how)
        .join(extra.select("purchase_id", "subsidiary"), "purchase_id", how)
        .select(F.col("gmv_date").alias("transaction_date"), "subsidiary", "purchase_value")
    )
