"""The star-schema Parquet tables seen as marketplace tables and change feeds.

`lineitem` plays the purchases, `part` the product items, and the types of `events` the three feeds.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from vendaria.operators.cdc import Feeds

LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz"
)
PART = "p_partkey bigint, p_size int, p_retailprice double"
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

# How many events in a row are spread over how many purchases, the status that a purchase event plays,
# and how the return flag reads as a status.
EVENTS_IN_BLOCK, PURCHASES_IN_BLOCK = 10_000, 1_500
EVENT_STATUS = "CASE WHEN event_id % 7 < 5 THEN 'Aprovado' ELSE 'Pendente' END"
STATUS_OF_FLAG = {"A": "Aprovado", "R": "Reembolsado", "N": "Pendente"}


def _table(spark: SparkSession, sf_dir: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{sf_dir}/{name}.parquet")


def purchase(spark: SparkSession, sf_dir: str, ordered: tuple[date, date] | None = None) -> DataFrame:
    """`ordered` (inclusive days) bounds the raw timestamp too, as a cast to DATE is not pushed into the scan."""
    lines = _table(spark, sf_dir, "lineitem", LINEITEM)
    if ordered:
        first, after = ordered[0], ordered[1] + timedelta(days=1)
        lines = lines.filter(f"l_shipdate >= TIMESTAMP_NTZ'{first}' AND l_shipdate < TIMESTAMP_NTZ'{after}'")
    statuses = " ".join(f"WHEN '{flag}' THEN '{status}'" for flag, status in STATUS_OF_FLAG.items())
    return lines.selectExpr(
        "l_orderkey AS purchase_id",
        "l_orderkey AS buyer_id",
        "l_partkey AS prod_item_id",
        "CAST(l_shipdate AS DATE) AS order_date",
        "CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS release_date",
        "l_suppkey AS producer_id",
        "l_orderkey % 10 AS purchase_partition",
        "l_partkey % 10 AS prod_item_partition",
        f"CASE l_returnflag {statuses} END AS status",
    )


def product_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part", PART).selectExpr(
        "p_partkey AS prod_item_id",
        "p_partkey % 10 AS prod_item_partition",
        "p_partkey AS product_id",
        "CAST(p_size AS BIGINT) AS item_quantity",
        "p_retailprice AS purchase_value",
    )


def feeds(
    spark: SparkSession, sf_dir: str, until: str | None = None, since: str | None = None, status: bool = False
) -> Feeds:
    """The three change feeds; `since` and `until` (excluded) bound the arrival of the versions.

    `status` gives the purchases a status by their event.
    """
    events = _table(spark, sf_dir, "events", EVENTS)
    if since:
        events = events.filter(f"ts >= TIMESTAMP_NTZ'{since}'")
    if until:
        events = events.filter(f"ts < TIMESTAMP_NTZ'{until}'")
    version = (
        "ts AS transaction_datetime",
        "CAST(ts AS DATE) AS transaction_date",
        f"event_id div {EVENTS_IN_BLOCK} * {PURCHASES_IN_BLOCK} + event_id % {PURCHASES_IN_BLOCK} AS purchase_id",
    )
    return Feeds(
        purchase=events.filter("event_type IN ('purchase', 'signup')").selectExpr(
            *version,
            "user_id AS buyer_id",
            "user_id % 50 AS prod_item_id",
            "CAST(ts AS DATE) AS order_date",
            "CASE WHEN event_id % 5 <> 0 THEN CAST(ts AS DATE) END AS release_date",
            "user_id % 20 AS producer_id",
            *([f"{EVENT_STATUS} AS status"] if status else []),
        ),
        product_item=events.filter("event_type IN ('click', 'error')").selectExpr(
            *version, "user_id AS product_id", "1L AS item_quantity", "value AS purchase_value"
        ),
        extra_info=events.filter("event_type = 'view'").selectExpr(
            *version,
            "CASE WHEN CAST(get_json_object(props, '$.k') AS BIGINT) % 2 = 0 THEN 'nacional' "
            "ELSE 'internacional' END AS subsidiary",
        ),
    )
