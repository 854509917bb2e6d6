"""Keep the history up to date from streams of change records.

A correction may come months late, so no watermark may drop it. `stream_gmv` keeps all versions in a stored table; with
`kept`, a micro-batch costs the blocks of ids and the days it touches, and without it the days are computed again from
all versions. `streaming.state` keeps the latest versions in the state of the stream instead.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from vendaria.operators.cdc import Feeds
from vendaria.plans.history import load_gmv
from vendaria.plans.reprocess import reprocess
from vendaria.plans.state import Kept, apply_batch, clear_staging
from vendaria.sources.scratch import directories, discard, is_folder


def tagged(feeds: Feeds) -> DataFrame:
    """The three feeds in one, told apart by `feed`."""
    parts = [df.withColumn("feed", F.lit(name)) for name, df in feeds._asdict().items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def untagged(records: DataFrame, schemas: dict[str, StructType]) -> Feeds:
    return Feeds(**{n: records.filter(F.col("feed") == n).select(*schemas[n].names) for n in Feeds._fields})


def append_batch(records: DataFrame, batch_id: int, store: str) -> None:
    """Add a micro-batch to the stored records; a repeated batch replaces its own partition."""
    (
        records.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("feed", "batch_id")
        .parquet(store)
    )


def read_store(spark: SparkSession, store: str, schema: StructType) -> DataFrame:
    partitions = [StructField("feed", StringType()), StructField("batch_id", LongType())]
    columns = [f for f in schema if f.name not in ("feed", "batch_id")]
    return spark.read.schema(StructType([*columns, *partitions])).parquet(store)


def read_batch(spark: SparkSession, store: str, schema: StructType, batch_id: int) -> DataFrame:
    """The stored records of one micro-batch; the folders of the others are not listed."""
    folders = [path for _, path in directories(spark, store)]
    found = [f"{f}/batch_id={batch_id}" for f in folders if is_folder(spark, f"{f}/batch_id={batch_id}")]
    partitions = [StructField("feed", StringType()), StructField("batch_id", LongType())]
    stored = StructType([*[f for f in schema if f.name not in ("feed", "batch_id")], *partitions])
    if not found:
        return spark.createDataFrame([], stored)
    return spark.read.schema(stored).option("basePath", store).parquet(*found)


def stream_gmv(
    feeds: Feeds,
    table: str,
    store: str,
    checkpoint: str,
    as_of: Callable[[int], date],
    load_ts: Callable[[int], datetime],
    location: str | None = None,
    trigger: dict | None = None,
    checks: Callable[[DataFrame], DataFrame] | None = None,
    kept: Kept | None = None,
    **options,
) -> StreamingQuery:
    """Start a query that stores the records of the streaming `feeds` and merges what they change into `table`.

    `as_of` and `load_ts` give the day and time of a load by micro-batch; days must not go back. A batch that is
    repeated after a failure stores the same files and, with the same day, leaves the same history. `checks` is the
    gate of each load; `options` are those of `gmv_daily`, such as `status_col`.

    `kept` says where the latest state and the totals are kept and what counts (then there are no `options`). It must
    have seen all batches of the query, and no others.
    """
    if kept is not None and options:
        raise ValueError("with `kept` the options are in its rules")
    schemas = {name: df.schema for name, df in feeds._asdict().items()}
    records = tagged(feeds)

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        append_batch(batch, batch_id, store)
        staging = f"{store}-staging/{batch_id}"
        if kept is not None:
            arrived = untagged(read_batch(spark, store, records.schema, batch_id), schemas)
            daily, days = apply_batch(spark, arrived, kept, batch_id)
        else:
            stored = read_store(spark, store, records.schema)
            changed = stored.filter(F.col("batch_id") == batch_id).select("purchase_id")
            daily, days = reprocess(untagged(stored, schemas), changed, f"{staging}/keys", **options)
        load_gmv(
            spark,
            daily,
            table,
            as_of(batch_id),
            load_ts(batch_id),
            days=days,
            location=location,
            load_id=f"batch {batch_id}",
            checks=checks,
        )
        discard(spark, staging)
        if kept is not None:
            clear_staging(spark, kept, batch_id)

    return (
        records.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
