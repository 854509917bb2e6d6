"""Sales reports over the batch tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from vendaria.operators.ranking import top_n, top_n_per_group
from vendaria.operators.revenue import revenue_by


def top_producers(
    purchase: DataFrame, product_item: DataFrame, year: int | None = 2021, n: int = 50, **options
) -> DataFrame:
    """(producer_id, total_sale) of the `n` producers with most revenue from purchases ordered in `year`."""
    period = (date(year, 1, 1), date(year, 12, 31)) if year else None
    totals = revenue_by(purchase, product_item, ["producer_id"], "total_sale", period=period, **options)
    return top_n(totals, n, "total_sale", ["producer_id"])


def top_products_per_producer(purchase: DataFrame, product_item: DataFrame, n: int = 2, **options) -> DataFrame:
    """(producer_id, product_id, total_sales, rank_sales) of the best `n` products of every producer."""
    totals = revenue_by(purchase, product_item, ["producer_id", "product_id"], "total_sales", **options)
    best = top_n_per_group(totals, n, ["producer_id"], "total_sales", ["product_id"], "rank_sales")
    return best.orderBy("producer_id", "rank_sales")
