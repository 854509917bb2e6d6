import random
from collections import defaultdict
from datetime import date

import pytest
from pyspark.sql import functions as F

from fixtures import ITEMS, PURCHASES, bag, optimized
from vendaria import schemas
from vendaria.operators.gmv import gmv_of
from vendaria.operators.quality import null_audit
from vendaria.operators.revenue import revenue_by
from vendaria.plans.sales import top_producers, top_products_per_producer
from vendaria.sources.files import from_rows


@pytest.fixture(scope="module")
def purchase(spark):
    return from_rows(spark, PURCHASES, schemas.PURCHASE)


@pytest.fixture(scope="module")
def item(spark):
    return from_rows(spark, ITEMS, schemas.PRODUCT_ITEM)


@pytest.mark.parametrize("filter_in", ["where", "on"])
@pytest.mark.parametrize("precombine", [True, False])
def test_top_producers(purchase, item, filter_in, precombine):
    top = top_producers(purchase, item, 2021, filter_in=filter_in, precombine=precombine)
    assert [tuple(r) for r in top.collect()] == [(10, 36024.16), (20, 3029.32)]


@pytest.mark.parametrize("filter_in", ["where", "on"])
@pytest.mark.parametrize("precombine", [True, False])
def test_top_products(purchase, item, filter_in, precombine):
    top = top_products_per_producer(purchase, item, filter_in=filter_in, precombine=precombine)
    assert [tuple(r) for r in top.collect()] == [
        (10, 104, 18466.56, 1),
        (10, 111, 10382.52, 2),
        (20, 104, 18466.56, 1),
        (20, 316, 3029.32, 2),
    ]


@pytest.mark.parametrize("report", [top_producers, top_products_per_producer])
@pytest.mark.parametrize("precombine", [True, False])
def test_on_and_where_are_one_plan(purchase, item, report, precombine):
    where, on = (optimized(report(purchase, item, filter_in=f, precombine=precombine)) for f in ("where", "on"))
    assert where == on


def test_unknown_filter_place(purchase, item):
    with pytest.raises(ValueError):
        top_producers(purchase, item, filter_in="having")


def test_ties_and_limits(spark):
    item = from_rows(spark, [(i, 0, i, 1, 5.0) for i in range(6)], schemas.PRODUCT_ITEM)
    rows = [(i, 1, i % 6, "2021-05-05", "2021-05-05", i % 4, 0, 0) for i in range(24)]
    purchase = from_rows(spark, rows, schemas.PURCHASE)
    assert [r.producer_id for r in top_producers(purchase, item, 2021, n=3).collect()] == [0, 1, 2]
    best = top_products_per_producer(purchase, item, n=2).collect()
    assert [(r.producer_id, r.product_id, r.rank_sales) for r in best] == [
        (p, product, rank) for p in range(4) for rank, product in enumerate(sorted({p % 2, p % 2 + 2}), 1)
    ]


def test_status(spark, purchase, item):
    from pyspark.sql import functions as F

    with_status = purchase.withColumn("status", F.when(F.col("purchase_id") == 2, "Cancelado").otherwise("Aprovado"))
    top = top_producers(with_status, item, 2021, status_col="status").collect()
    assert [tuple(r) for r in top] == [(10, 25641.64), (20, 3029.32)]


def test_null_value_is_ignored(spark, purchase):
    item = from_rows(spark, [(1, 6, 481, 92, None), *ITEMS[1:3], (4, 4, 316, 62, None)], schemas.PRODUCT_ITEM)
    assert [tuple(r) for r in top_producers(purchase, item, 2021).collect()] == [(10, 28849.08), (20, None)]


def test_null_audit(spark, purchase):
    row = null_audit(purchase).first().asDict()
    assert row.pop("total_null_release_date") == 1
    assert list(row) == [f"total_null_{c}" for c in schemas.PURCHASE.names if c != "release_date"]
    assert set(row.values()) == {0}
    assert set(null_audit(purchase.limit(0)).first()) == {None}


@pytest.mark.parametrize("precombine", [True, False])
def test_hot_item_and_producer_by_brute_force(spark, precombine):
    """A third of the purchases are of one item, a third by one producer; items repeat a key and lack others."""
    rng = random.Random(7)
    items = [(i, i % 3, i % 17, rng.randint(1, 5), float(rng.randint(1, 400)) / 4) for i in range(40)]
    items += [(3, 0, 99, 2, 1.25), (5, None, 98, 1, 9.0)]
    purchases = []
    for n in range(6000):
        chosen = 3 if n % 3 == 0 else rng.randrange(45)
        producer = 1 if n % 3 == 1 else rng.randrange(30)
        day = f"202{rng.randint(0, 2)}-0{rng.randint(1, 9)}-15"
        partition = None if chosen == 5 and n % 2 else chosen % 3
        purchases.append((n, n, chosen, day, day if rng.random() < 0.7 else None, producer, 0, partition))
    lines = defaultdict(list)
    for i, part, product, quantity, value in items:
        lines[i, part].append((product, quantity * value))
    expected = defaultdict(float)
    for _, _, i, ordered, released, producer, _, part in purchases:
        if released and ordered.startswith("2021") and part is not None:
            for product, value in lines[i, part]:
                expected[producer, product] += value
    got = revenue_by(
        from_rows(spark, purchases, schemas.PURCHASE),
        from_rows(spark, items, schemas.PRODUCT_ITEM),
        ["producer_id", "product_id"],
        "total",
        period=(date(2021, 1, 1), date(2021, 12, 31)),
        precombine=precombine,
    )
    assert bag(got.collect()) == bag((*key, total) for key, total in expected.items())


def test_totals_do_not_depend_on_the_order_of_rows(spark):
    """Two-decimal values up to a million, enough of them that a sum of doubles differs in the cents."""
    cents = (F.xxhash64("id") % 100_000_000 / 100).alias("purchase_value")
    rows = spark.range(0, 4_000_000, 1, 16).select(F.lit(date(2024, 1, 1)).alias("transaction_date"), F.lit("a").alias("subsidiary"), cents)
    totals, raw = set(), set()
    for n in (1, 3, 7, 16):
        part = rows.coalesce(n) if n < 16 else rows
        totals.add(gmv_of(part).first()["gmv_daily"])
        raw.add(part.agg(F.sum("purchase_value")).first()[0])
    exact = rows.agg(F.sum((F.col("purchase_value") * 100).cast("decimal(20,0)"))).first()[0]
    assert totals == {float(exact) / 100} and len(raw) > 1
    purchase = spark.range(0, 200_000, 1, 8).selectExpr(
        "id % 5000 AS prod_item_id", "0L AS prod_item_partition", "id % 3 AS producer_id", "current_date() AS release_date"
    )
    items = spark.range(5000).selectExpr(
        "id AS prod_item_id", "0L AS prod_item_partition", "id AS product_id", "7L AS item_quantity",
        "CAST(xxhash64(id) % 100000000 / 100 AS DOUBLE) AS purchase_value",
    )
    found = {
        tuple(sorted(map(tuple, revenue_by(purchase.coalesce(n), items, ["producer_id"], "t", precombine=p).collect())))
        for n in (1, 3, 8)
        for p in (True, False)
    }
    assert len(found) == 1
