"""The physical plans that make the queries hold at scale."""

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from fixtures import plan
from vendaria import schemas
from vendaria.operators.cdc import latest_per_key
from vendaria.operators.gmv import gmv_daily
from vendaria.operators.revenue import revenue_by
from vendaria.operators.scd2 import current_of, scd2_changes, stamp
from vendaria.plans.sales import top_producers
from vendaria.sources import star

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    """What the plans are when no table is small."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def query_plan(spark, name):
    return plan(contract.queries()[name](spark, SF_DIR))


@pytest.mark.parametrize(
    "name", [n for n in contract._sales_queries() if not re.search("ingest|load|stream|layers|late", n)]
)
def test_no_cross_join_and_no_python(spark, no_broadcast, name):
    text = query_plan(spark, name)
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python|ArrowEval|MapInPandas", text)


def test_nothing_is_hinted_to_broadcast(spark, no_broadcast):
    for name in ("top_producers", "top_products_per_producer", "consolidated_purchase", "gmv_scd2_merge"):
        assert "BroadcastExchange" not in query_plan(spark, name)


def test_top_producers(spark, no_broadcast):
    text = query_plan(spark, "top_producers")
    assert "TakeOrderedAndProject" in text and text.count("SortMergeJoin") == 1
    assert "partial_count" not in text  # purchases are counted before the join only if asked for
    assert "GreaterThanOrEqual(l_shipdate,1997-01-01T00:00)" in text
    assert "LessThan(l_shipdate,1998-01-01T00:00)" in text
    assert re.search(r"FileScan parquet \[l_partkey#\d+L,l_suppkey#\d+L,l_linestatus#\d+,l_shipdate#\d+\]", text)


def test_purchase_filter_reaches_the_scan(spark, tmp_path, no_broadcast):
    """Through the join, in both of its forms, and through the count."""
    star.purchase(spark, SF_DIR).select(*schemas.PURCHASE.names).write.parquet(str(tmp_path / "p"))
    purchase = spark.read.schema(schemas.PURCHASE).parquet(str(tmp_path / "p"))
    for filter_in in ("where", "on"):
        for precombine in (True, False):
            text = plan(
                top_producers(
                    purchase, star.product_item(spark, SF_DIR), 1997, filter_in=filter_in, precombine=precombine
                )
            )
            pushed = next(p for p in re.findall(r"PushedFilters: \[(.*?)\], Read", text) if "release_date" in p)
            assert "IsNotNull(release_date)" in pushed
            assert "GreaterThanOrEqual(order_date,1997-01-01)" in pushed
            assert "LessThanOrEqual(order_date,1997-12-31)" in pushed
            assert "buyer_id" not in text


def test_top_products_drops_rows_before_the_shuffle(spark, no_broadcast):
    text = query_plan(spark, "top_products_per_producer")
    assert re.search(r"WindowGroupLimit .*, 2, Final", text) and re.search(r"WindowGroupLimit .*, 2, Partial", text)


def test_latest_version_drops_rows_before_the_shuffle(spark):
    text = query_plan(spark, "cdc_latest_purchase")
    assert text.count("partial_max(struct(transaction_datetime") == 1
    assert text.count("Exchange") == 1
    unordered = contract.star.feeds(spark, SF_DIR).purchase.withColumn("m", F.create_map("buyer_id", "producer_id"))
    text = plan(latest_per_key(unordered, "purchase_id"))
    assert "row_number(), 1, Partial" in text and "row_number(), 1, Final" in text
    assert text.count("Exchange") == 1


def test_daily_value_shuffles_each_feed_once_with_few_columns(spark, no_broadcast):
    text = plan(gmv_daily(star.feeds(spark, SF_DIR)))
    assert text.count("hashpartitioning(purchase_id") == 3
    assert text.count("Exchange") == 4
    assert text.count("partial_max(struct(transaction_datetime") == 3
    assert "user_id" not in text


def test_outer_joins_of_the_daily_value_become_left_joins(spark, no_broadcast):
    text = plan(gmv_daily(star.feeds(spark, SF_DIR), how="full_outer"))
    assert "FullOuter" not in text and text.count("LeftOuter") == 2


def test_merge_shuffles_the_current_side_once(spark, no_broadcast):
    """By the keys, with the new values; what comes before are the shuffles of both daily values."""
    rows = [(date(2024, 1, 1), "a", 1.0)]
    target = stamp(spark.createDataFrame(rows, "transaction_date date, subsidiary string, gmv_daily double"), "2024-01-02", datetime(2024, 1, 2))
    text = plan(scd2_changes(current_of(target), target.select("transaction_date", "subsidiary", "gmv_daily"), "2024-01-03", datetime(2024, 1, 3)))
    assert text.count("Exchange hashpartitioning") == 1
    assert "Join" not in text
    whole = query_plan(spark, "gmv_scd2_merge")
    assert "FullOuter" not in whole and whole.count("FileScan") == 6


@pytest.mark.parametrize("precombine", [True, False])
def test_what_is_left_of_a_popular_item_is_split(spark, no_broadcast, precombine):
    """A third of all purchases are of one item, each by a producer of its own, so counting merges none of them."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
    }
    before = {key: spark.conf.get(key) for key in settings}
    item = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).cast("bigint")
    purchase = spark.range(0, 300_000, 1, 16).select(
        item.alias("prod_item_id"),
        F.lit(0).cast("bigint").alias("prod_item_partition"),
        F.col("id").alias("producer_id"),
        F.current_date().alias("release_date"),
    )
    items = spark.range(5000).select(
        F.col("id").alias("prod_item_id"),
        F.lit(0).cast("bigint").alias("prod_item_partition"),
        F.col("id").alias("product_id"),
        F.lit(2).cast("bigint").alias("item_quantity"),
        F.lit(1.5).alias("purchase_value"),
    )
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        total = revenue_by(purchase, items, ["producer_id"], "t", precombine=precombine).agg(F.sum("t"), F.count("*"))
        assert tuple(total.first()) == (900_000.0, 300_000)
        total.collect()
        assert "SortMergeJoin(skew=true)" in plan(total)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
