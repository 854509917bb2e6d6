"""The feeds, their latest state and the daily value as stored layers, each partitioned by day.

`write_*` build a layer whole. `refresh_layers` brings a batch of records from the first layer to the last one and
replaces only the days that it changes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from vendaria import schemas
from vendaria.operators.cdc import (
    APPROVED,
    VALUE_COLUMNS,
    Feeds,
    consolidated_purchase,
    latest_feeds,
    latest_per_key,
    valid_purchase,
)
from vendaria.operators.gmv import gmv_of
from vendaria.operators.quality import audit, enforce, quality_gate
from vendaria.plans.state import BLOCK, Kept, apply_batch, clear_staging
from vendaria.sources.files import read_parquet, write_partitioned
from vendaria.sources.parts import BATCH, read_all_parts, read_parts, whole_spans, write_parts
from vendaria.sources.scratch import discard, materialize

DAY = "transaction_date"
# The day that decides where a row of the second layer is.
SILVER_DAYS = Feeds("gmv_date", DAY, DAY)
DAILY = StructType([f for f in schemas.GMV_HISTORY if f.name in (DAY, "subsidiary", "gmv_daily")])


def write_bronze(feeds: Feeds, base: str) -> None:
    """The feeds as they came, by day of transaction."""
    for name, feed in feeds._asdict().items():
        write_partitioned(feed, f"{base}/bronze/{name}", DAY)


def read_bronze(spark: SparkSession, base: str, schemas: dict[str, StructType]) -> Feeds:
    return Feeds(**{name: read_parquet(spark, f"{base}/bronze/{name}", schemas[name]) for name in Feeds._fields})


def write_silver(
    bronze: Feeds, base: str, status_col: str | None = None, approved: str = APPROVED
) -> Feeds:
    """The valid purchases, by the day they count on, and for every id the latest item and extra information."""
    latest = latest_feeds(bronze, status_col=status_col)
    silver = latest._replace(purchase=valid_purchase(latest.purchase, status_col, approved))
    return Feeds(
        *[_stored(df, f"{base}/silver/{name}", getattr(SILVER_DAYS, name)) for name, df in silver._asdict().items()]
    )


def gmv_gate(daily: DataFrame) -> DataFrame:
    """What a daily value has to fulfil before it is stored: a day, a value, and one row for a day and subsidiary."""
    return quality_gate(audit(daily, [DAY, "gmv_daily"], [DAY, "subsidiary"]))


def write_gold(
    silver: Feeds,
    base: str,
    multiply_quantity: bool = False,
    scale: int | None = 2,
    checks: Callable[[DataFrame], DataFrame] = gmv_gate,
) -> DataFrame:
    """The daily value, stored by day and read back. A rule that fails stops it before anything is stored."""
    daily = gmv_of(consolidated_purchase(*silver, how="left", multiply_quantity=multiply_quantity), scale)
    daily = materialize(daily, f"{base}/gold-staged")
    enforce(checks(daily))
    return _stored(daily, f"{base}/gold/gmv_daily", DAY)


def _stored(df: DataFrame, path: str, day: str) -> DataFrame:
    write_partitioned(df, path, day)
    return read_parquet(df.sparkSession, path, df.schema)


def refresh_layers(
    spark: SparkSession,
    records: Feeds,
    base: str,
    kept: Kept,
    batch_id: int,
    checks: Callable[[DataFrame], DataFrame] = gmv_gate,
) -> DataFrame:
    """Take a batch of records into all layers; the days whose value it changes.

    The first layer gains the batch's files, in the days of its records. The second is rewritten for the days that
    rows come to or leave, the third for the days whose value changes. What the batch has to know of earlier ones is
    `kept`, and the latest rows of each feed in blocks of ids. Batches come one after another, from an empty `base` on;
    one that is repeated replaces what it wrote. A rule that fails stops a batch before any layer changes.
    """
    daily, days = apply_batch(spark, records, kept, batch_id)
    enforce(checks(daily))
    for name, feed in records._asdict().items():
        append_bronze(feed, f"{base}/bronze/{name}", batch_id)
        _refresh_silver(spark, name, feed, base, kept, batch_id)
    changed = [row[0] for row in days.collect()]
    write_parts(daily, f"{base}/gold/gmv_daily", DAY, batch_id, changed)
    clear_staging(spark, kept, batch_id)
    return spark.createDataFrame([(d,) for d in changed], StructType([DAILY[DAY]]))


def append_bronze(feed: DataFrame, path: str, batch_id: int) -> None:
    """Records in folders of their day and batch; a repeated batch replaces its own."""
    (
        feed.withColumn(BATCH, F.lit(batch_id).cast("long"))
        .hint("rebalance", F.col(DAY))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY, BATCH)
        .parquet(path)
    )


def read_silver(spark: SparkSession, base: str, types: dict[str, StructType]) -> Feeds:
    """The refreshed second layer, by the types of the feeds."""
    parts = []
    for name, day in SILVER_DAYS._asdict().items():
        parts.append(read_all_parts(spark, f"{base}/silver/{name}", _silver_type(name, types[name]), day))
    return Feeds(*parts)


def read_gold(spark: SparkSession, base: str) -> DataFrame:
    return read_all_parts(spark, f"{base}/gold/gmv_daily", DAILY, DAY)


def _silver_type(name: str, feed: StructType) -> StructType:
    return StructType([*feed, StructField("gmv_date", feed["release_date"].dataType)]) if name == "purchase" else feed


def _refresh_silver(spark: SparkSession, name: str, feed: DataFrame, base: str, kept: Kept, batch_id: int) -> None:
    staging, status = f"{base}/staging/{batch_id}/{name}", kept.rules.status_col
    day, columns = getattr(SILVER_DAYS, name), feed.columns
    blocked = StructType([*feed.schema, StructField(BLOCK, LongType())])
    blocks = whole_spans([row[0] for row in feed.select(kept.block().cast("long")).distinct().collect()])
    old = read_parts(spark, f"{base}/latest/{name}", blocked, BLOCK, blocks, batch_id).select(*columns)
    first = [c for c in (*getattr(VALUE_COLUMNS, name), *([status] if status else [])) if c in columns]
    latest = latest_per_key(old.unionByName(feed), "purchase_id", tiebreak=first)
    latest = materialize(latest.withColumn(BLOCK, kept.block().cast("long")), f"{staging}/latest")
    write_parts(latest, f"{base}/latest/{name}", BLOCK, batch_id)

    def shown(rows: DataFrame) -> DataFrame:
        return valid_purchase(rows, status, kept.rules.approved) if name == "purchase" else rows

    before, after = F.struct(*[f"old.{c}" for c in columns]), F.struct(*[f"new.{c}" for c in columns])
    same_id = F.col("old.purchase_id").eqNullSafe(F.col("new.purchase_id"))
    moved = latest.alias("new").join(old.alias("old"), same_id, "left").select(
        before.alias("before"), after.alias("after")
    )
    moved = materialize(moved.filter(~F.col("before").eqNullSafe(F.col("after"))), f"{staging}/moved")
    # Of a purchase that is new, the row before is NULL; it counts for the day NULL, which is then read in vain.
    gone, come = shown(moved.select("before.*")).select(day), shown(moved.select("after.*"))
    days = [row[0] for row in gone.union(come.select(day)).distinct().collect()]
    others = read_parts(spark, f"{base}/silver/{name}", _silver_type(name, feed.schema), day, days, batch_id)
    ids = moved.select(F.col("after.purchase_id").alias("purchase_id"))
    same_id = F.col("l.purchase_id").eqNullSafe(F.col("r.purchase_id"))
    others = others.alias("l").join(ids.alias("r"), same_id, "left_anti")
    rows = materialize(others.unionByName(come), f"{staging}/silver")
    write_parts(rows, f"{base}/silver/{name}", day, batch_id, days)
    discard(spark, staging)
