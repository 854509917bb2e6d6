import random

import pytest
from pyspark.sql import functions as F

from fixtures import CUTOFFS, bag, feeds
from vendaria import schemas
from vendaria.operators.cdc import Feeds, consolidated_purchase, latest_feeds, latest_per_key, valid_purchase
from vendaria.operators.gmv import gmv_daily
from vendaria.plans.layers import write_gold, write_silver
from vendaria.plans.reprocess import reprocess
from vendaria.sources.files import from_rows


@pytest.mark.parametrize("until, consolidated, daily", CUTOFFS)
def test_cutoffs(spark, until, consolidated, daily):
    seen = feeds(spark, until)
    latest = latest_feeds(seen)
    valid = valid_purchase(latest.purchase)
    facts = consolidated_purchase(valid, latest.product_item, latest.extra_info)
    assert bag(facts.collect()) == bag(consolidated)
    assert bag(gmv_daily(seen).collect()) == bag(daily)
    assert bag(gmv_daily(seen, how="full_outer").collect()) == bag(daily)


def test_quantity_counts_only_on_request(spark):
    got = {r.subsidiary: r.gmv_daily for r in gmv_daily(feeds(spark), multiply_quantity=True).collect()}
    assert got == {"nacional": 550.0, "internacional": 4000.0}


def test_newest_version_decides_even_if_not_released(spark):
    rows = [
        ("2023-01-01 10:00:00", "2023-01-01", 1, 1, 1, "2023-01-01", "2023-01-01", 1),
        ("2023-01-02 10:00:00", "2023-01-02", 1, 1, 1, "2023-01-01", None, 1),
    ]
    purchase = from_rows(spark, rows, schemas.PURCHASE_FEED)
    assert valid_purchase(latest_per_key(purchase, "purchase_id")).count() == 0
    assert valid_purchase(purchase).select(F.col("gmv_date").cast("string")).first()[0] == "2023-01-01"


def test_status(spark):
    purchase = feeds(spark).purchase.withColumn(
        "status", F.when(F.col("purchase_id") == 69, "Reembolsado").otherwise("Aprovado")
    )
    seen = feeds(spark)._replace(purchase=purchase)
    assert [r.gmv_daily for r in gmv_daily(seen, status_col="status").collect()] == [55.0]
    valid = valid_purchase(latest_per_key(purchase, "purchase_id"), "status")
    assert [r.purchase_id for r in valid.collect()] == [55]


def test_only_null_values_give_null(spark):
    seen = feeds(spark)
    nothing = seen._replace(product_item=seen.product_item.withColumn("purchase_value", F.lit(None).cast("double")))
    assert {r.gmv_daily for r in gmv_daily(nothing).collect()} == {None}


def test_latest_orders_null_times_last_and_takes_the_tiebreak(spark):
    rows = [(1, None, "z"), (1, "2023-01-01", "a"), (1, "2023-01-01", "b"), (None, None, "n"), (2, None, "x")]
    df = spark.createDataFrame(rows, "k int, t string, v string")
    assert bag(latest_per_key(df, "k", "t").collect()) == bag([(1, "2023-01-01", "b"), (None, None, "n"), (2, None, "x")])
    first = latest_per_key(df.withColumn("r", F.expr("if(v = 'a', 9, 0)")), ["k"], "t", ["r"]).filter("k = 1").first()
    assert first.v == "a"


def test_latest_of_rows_with_a_column_that_has_no_order(spark):
    rows = [(1, 1, "a", {"x": 1}), (1, 2, "a", {"x": 2}), (1, 2, "b", {"x": 3}), (None, None, "c", None)]
    df = spark.createDataFrame(rows, "k int, t int, v string, m map<string,int>")
    got = latest_per_key(df, "k", "t")
    assert got.columns == df.columns
    assert bag(got.collect()) == bag([rows[2], rows[3]])


def test_latest_by_two_keys_keeps_the_columns_in_place(spark):
    df = spark.createDataFrame([(1, "x", 1, 9), (2, "x", 1, 8), (3, "y", 1, 7)], "t int, a string, b int, c int")
    got = latest_per_key(df, ["b", "a"], "t")
    assert got.schema.simpleString() == df.schema.simpleString()
    assert bag(got.collect()) == [(2, "x", 1, 8), (3, "y", 1, 7)]


def test_latest_with_a_hot_key_does_not_depend_on_row_order(spark):
    rng = random.Random(3)
    rows = [(0 if i % 3 == 0 else rng.randrange(200), rng.randrange(500), rng.random()) for i in range(6000)]
    expected = {}
    for k, t, v in rows:
        expected[k] = max(expected.get(k, (-1, 0)), (t, v))
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k int, t int, v double").repartition(7)
        assert {r.k: (r.t, r.v) for r in latest_per_key(df, "k", "t").collect()} == expected


def test_a_status_decides_between_versions_of_one_time_in_every_path(spark, tmp_path):
    rows = [("2023-01-01 00:00:00", "2023-01-01", 1, b, 1, "2023-01-01", "2023-02-01", 1) for b in (5, 9)]
    purchase = from_rows(spark, rows, schemas.PURCHASE_FEED)
    status = F.when(F.col("buyer_id") == 5, "Pendente").otherwise("Aprovado")
    for swapped in (False, True):
        given = F.when(status == "Aprovado", "Pendente").otherwise("Aprovado") if swapped else status
        item = from_rows(spark, [("2023-01-01 00:00:00", "2023-01-01", 1, 2, 3, 4.0)], schemas.PRODUCT_ITEM_FEED)
        extra = from_rows(spark, [("2023-01-01 00:00:00", "2023-01-01", 1, "a")], schemas.EXTRA_INFO_FEED)
        seen = Feeds(purchase.withColumn("status", given), item, extra)
        pruned = bag(gmv_daily(seen, status_col="status").collect())
        silver = write_silver(seen, str(tmp_path / f"layers-{swapped}"), status_col="status")
        stored = bag(write_gold(silver, str(tmp_path / f"layers-{swapped}")).collect())
        changed = spark.createDataFrame([(1,)], "purchase_id bigint")
        late, _ = reprocess(seen, changed, str(tmp_path / f"late-{swapped}"), status_col="status")
        # The greater status is the later one: Pendente, so nothing counts.
        assert pruned == stored == bag(late.collect()) == []
        assert bag(gmv_daily(seen, status_col="status", approved="Pendente").collect()) != []


def test_pruned_feeds_choose_the_same_values_on_equal_times(spark):
    rng = random.Random(5)

    def moment():
        return f"2023-01-0{rng.randint(1, 2)} 00:00:00"

    purchase = [
        (moment(), "2023-01-01", i % 40, rng.randrange(9), 1, "2023-01-01", f"2023-02-0{rng.randint(1, 9)}", 1)
        for i in range(400)
    ]
    item = [(moment(), "2023-01-01", i % 45, rng.randrange(9), 1, float(rng.randrange(90))) for i in range(400)]
    extra = [(moment(), "2023-01-01", i % 35, rng.choice("abc")) for i in range(300)]
    seen = Feeds(
        from_rows(spark, purchase, schemas.PURCHASE_FEED),
        from_rows(spark, item, schemas.PRODUCT_ITEM_FEED),
        from_rows(spark, extra, schemas.EXTRA_INFO_FEED),
    )
    latest = latest_feeds(seen)
    facts = consolidated_purchase(valid_purchase(latest.purchase), latest.product_item, latest.extra_info, "left")
    whole = facts.groupBy("transaction_date", "subsidiary").agg(F.round(F.sum("purchase_value"), 2))
    assert bag(gmv_daily(seen).collect()) == bag(whole.collect())
