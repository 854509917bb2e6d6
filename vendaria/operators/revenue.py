"""Revenue of released purchases."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaria.functions import exact, in_days, line_value, money, times
from vendaria.operators.cdc import APPROVED, is_confirmed

ITEM_KEY = ["prod_item_id", "prod_item_partition"]


def purchase_counts(
    purchase: DataFrame,
    period: tuple[date, date] | None = None,
    status_col: str | None = None,
    approved: str = APPROVED,
    precombine: bool = False,
) -> DataFrame:
    """How often each producer sold each item, with the flag `counts` for the purchases that earn revenue.

    A later filter on `counts` moves into the scan. Purchases come one by one. `precombine` counts those of one item
    by one producer, which are alike as far as revenue goes: a best-seller is then shuffled as one row per task, at
    the price of one more shuffle. The filter moves through that aggregation too.
    """
    counts = is_confirmed(status_col, approved)
    if period:
        counts = counts & in_days(F.col("order_date"), *period)
    flagged = purchase.select(*ITEM_KEY, "producer_id", counts.alias("counts"))
    if not precombine:
        return flagged.withColumn("n_purchases", F.lit(1).cast("bigint"))
    return flagged.groupBy(*ITEM_KEY, "producer_id", "counts").agg(F.count(F.lit(1)).alias("n_purchases"))


def revenue_by(
    purchase: DataFrame,
    product_item: DataFrame,
    keys: Sequence[str],
    total: str,
    period: tuple[date, date] | None = None,
    status_col: str | None = None,
    approved: str = APPROVED,
    filter_in: str = "where",
    scale: int | None = 2,
    precombine: bool = False,
) -> DataFrame:
    """Sum of value x quantity of the purchases that count, by `keys`.

    The tables join on item id *and* item partition. `filter_in` places the purchase filter after the join
    ("where") or in its condition ("on"); an inner join gives the same plan for both.

    One plan for every size: Spark broadcasts the items if they are small, and its skew join splits a popular item if
    they are not. `precombine` counts purchases before the join, see `purchase_counts`. Amounts are added as decimals,
    so totals do not depend on the order of rows.
    """
    if filter_in not in ("where", "on"):
        raise ValueError(f"filter_in must be 'where' or 'on', not {filter_in!r}")
    price = product_item.select(
        *ITEM_KEY, "product_id", exact(line_value(F.col("purchase_value"), F.col("item_quantity"))).alias("line")
    ).alias("i")
    sold = purchase_counts(purchase, period, status_col, approved, precombine).alias("p")
    on = F.lit(True)
    for key in ITEM_KEY:
        on = on & (F.col(f"p.{key}") == F.col(f"i.{key}"))
    if filter_in == "on":
        lines = sold.join(price, on & F.col("p.counts"), "inner")
    else:
        lines = sold.join(price, on, "inner").filter(F.col("p.counts"))
    return lines.groupBy(*keys).agg(money(F.sum(times(F.col("line"), F.col("n_purchases"))), scale).alias(total))
