"""Column layouts of the marketplace tables: fixed values, as the files and feeds have them."""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _nullable(*columns):
    return StructType([StructField(name, kind, True) for name, kind in columns])


# Batch tables.
PURCHASE = _nullable(
    ("purchase_id", LongType()),
    ("buyer_id", LongType()),
    ("prod_item_id", LongType()),
    ("order_date", DateType()),
    ("release_date", DateType()),
    ("producer_id", LongType()),
    ("purchase_partition", LongType()),
    ("prod_item_partition", LongType()),
)

PRODUCT_ITEM = _nullable(
    ("prod_item_id", LongType()),
    ("prod_item_partition", LongType()),
    ("product_id", LongType()),
    ("item_quantity", LongType()),
    ("purchase_value", DoubleType()),
)

# Change feeds: every row is one version of a purchase_id.
PURCHASE_FEED = _nullable(
    ("transaction_datetime", TimestampType()),
    ("transaction_date", DateType()),
    ("purchase_id", LongType()),
    ("buyer_id", LongType()),
    ("prod_item_id", LongType()),
    ("order_date", DateType()),
    ("release_date", DateType()),
    ("producer_id", LongType()),
)

PRODUCT_ITEM_FEED = _nullable(
    ("transaction_datetime", TimestampType()),
    ("transaction_date", DateType()),
    ("purchase_id", LongType()),
    ("product_id", LongType()),
    ("item_quantity", LongType()),
    ("purchase_value", DoubleType()),
)

EXTRA_INFO_FEED = _nullable(
    ("transaction_datetime", TimestampType()),
    ("transaction_date", DateType()),
    ("purchase_id", LongType()),
    ("subsidiary", StringType()),
)

# Type-2 history of the daily value; `sources.catalog` holds its DDL.
GMV_HISTORY = _nullable(
    ("transaction_date", DateType()),
    ("subsidiary", StringType()),
    ("gmv_daily", DoubleType()),
    ("valid_from", DateType()),
    ("valid_to", DateType()),
    ("is_current", BooleanType()),
    ("load_timestamp", TimestampType()),
)
