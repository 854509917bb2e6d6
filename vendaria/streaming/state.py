"""Keep the history up to date from streams, with the latest versions of every purchase in the stream's state.

A group of the stream is a block of purchase ids in a row, as a call for each id would cost far more than its records.
Its state is the newest version of each feed for every id of the block, however late it comes: there is no watermark
that could drop one, and no state ever ends. A micro-batch touches the blocks of the ids it brings, and emits the ids
that count otherwise than before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import date, datetime
from functools import reduce
from typing import Any, NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegralType, TimestampNTZType

from vendaria.functions import exact
from vendaria.operators.cdc import Feeds
from vendaria.plans.history import load_gmv
from vendaria.plans.state import Kept, Rules, apply_changes, clear_staging


class Version(NamedTuple):
    """A version of a feed: its time, then what decides between versions of the same time. None is the least."""

    time: int | None = None
    first: Any = None
    second: Any = None

    def order(self) -> tuple:
        return tuple((part is not None, part) for part in self)


class Counted(NamedTuple):
    """What a purchase adds to the daily value, if it counts."""

    counts: bool = False
    day: int | None = None
    subsidiary: str | None = None
    value: float | None = None


#: Ids in a row that share a group; an id of another type than a whole number is a group of its own.
IDS_PER_GROUP = 256
#: By id, as lists of the same length.
STATE = (
    "p_time array<long>, p_day array<int>, p_status array<string>, i_time array<long>, i_value array<double>, "
    "i_quantity array<long>, x_time array<long>, x_subsidiary array<string>"
)
CHANGES = [f"{side}_{name}" for side in ("before", "after") for name in Counted._fields]
CHANGES_SCHEMA = ", ".join(
    f"{side}_counts boolean, {side}_day int, {side}_subsidiary string, {side}_value double" for side in ("before", "after")
)
FEEDS = Feeds("p", "i", "x")


def counted(known: bool, purchase: Version, item: Version, extra: Version, rules: Rules) -> Counted:
    """As `plans.state.counted_value` has it."""
    day, status = purchase.first, purchase.second
    if day is None or (rules.status_col and status != rules.approved):
        return Counted()
    value = item.first
    if rules.multiply_quantity and value is not None:
        value = None if item.second is None else value * item.second
    return Counted(True, day, extra.first if known else None, value if known else None)


def records(feeds: Feeds, rules: Rules) -> DataFrame:
    """The feeds in one, (purchase_id, feed, time, number, text, value). Whole numbers travel as text, as they may be
    missing, which makes a column of pandas floating."""
    none = F.lit(None)
    day = F.unix_date("release_date")
    quantity = F.col("item_quantity").cast("long") if rules.multiply_quantity else none
    status = F.col(rules.status_col) if rules.status_col else none
    columns = Feeds((day, status, none), (quantity, none, F.col("purchase_value")), (none, F.col("subsidiary"), none))
    parts = []
    for kind, feed, (number, text, amount) in zip(FEEDS, feeds, columns, strict=True):
        parts.append(
            feed.select(
                "purchase_id",
                F.lit(kind).alias("feed"),
                _micros(feed, "transaction_datetime").cast("string").alias("time"),
                number.cast("string").alias("number"),
                text.cast("string").alias("text"),
                amount.cast("double").alias("value"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _micros(feed: DataFrame, column: str) -> Column:
    """A time as a number, also one without a zone, whatever the zone of the session."""
    time = F.col(column)
    if not isinstance(feed.schema[column].dataType, TimestampNTZType):
        return F.unix_micros(time)
    minutes = (F.hour(time) * 60 + F.minute(time)).cast("long")
    of_day = minutes * 60_000_000 + (F.extract(F.lit("SECOND"), time) * 1_000_000).cast("long")
    return F.unix_date(time.cast("date")).cast("long") * 86_400_000_000 + of_day


def _version(row) -> Version:
    time, number = (None if text is None else int(text) for text in (row.time, row.number))
    value = None if row.value is None or row.value != row.value else row.value
    return Version(time, *{"p": (number, row.text), "i": (value, number), "x": (row.text, None)}[row.feed])


def _versions(kept: tuple) -> dict[str, Version]:
    return {"p": Version(*kept[:3]), "i": Version(*kept[3:6]), "x": Version(*kept[6:])}


def value_changes(feeds: Feeds, rules: Rules) -> DataFrame:
    """A stream of (before, after) what a purchase counts, for those that a micro-batch changes."""
    id_type = feeds.purchase.schema["purchase_id"].dataType
    group = F.col("purchase_id")
    if isinstance(id_type, IntegralType):
        group = F.expr(f"purchase_id div {IDS_PER_GROUP}")

    def run(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        known = key[0] is not None and key[0] == key[0]
        kept = {id_: values for id_, *values in zip(*state.get, strict=True)} if state.exists else {}
        none = (None,) * 8
        new: dict[Any, dict[str, Version]] = {}
        for batch in batches:
            for row in batch.itertuples(index=False):
                id_ = row.purchase_id if known else None
                if id_ not in new:
                    new[id_] = _versions(kept.get(id_, none))
                versions = new[id_]
                versions[row.feed] = max(versions[row.feed], _version(row), key=Version.order)
        changes = []
        for id_, versions in new.items():
            both = (_versions(kept.get(id_, none)), versions)
            before, after = (counted(known, v["p"], v["i"], v["x"], rules) for v in both)
            if before != after:
                changes.append([*before, *after])
            kept[id_] = (*versions["p"], *versions["i"], *versions["x"][:2])
        state.update(tuple(list(column) for column in zip(*[(id_, *values) for id_, values in kept.items()])))
        if changes:
            yield pd.DataFrame(changes, columns=CHANGES, dtype=object)

    grouped = records(feeds, rules).withColumn("of_ids", group).groupBy("of_ids")
    stored = f"ids array<{id_type.simpleString()}>, {STATE}"
    changes = grouped.applyInPandasWithState(run, CHANGES_SCHEMA, stored, "update", "NoTimeout")
    return changes.select(*[_struct(side) for side in ("before", "after")])


def _struct(side: str) -> Column:
    day, subsidiary, value = (F.col(f"{side}_{name}") for name in Counted._fields[1:])
    of = F.struct(F.date_from_unix_date(day).alias("day"), subsidiary.alias("subsidiary"), exact(value).alias("value"))
    return F.when(F.col(f"{side}_counts"), of).alias(side)


def stream_gmv_by_state(
    feeds: Feeds,
    table: str,
    kept: Kept,
    checkpoint: str,
    as_of: Callable[[int], date],
    load_ts: Callable[[int], datetime],
    location: str | None = None,
    trigger: dict | None = None,
    checks: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Start a query that merges into `table` what the records of the streaming `feeds` change.

    The parameters are those of `stream_gmv`. Of `kept`, only the totals by day are used. A batch that is repeated
    after a failure finds the state and the totals from before it. For more ids than an executor's memory holds, name
    a state store that keeps them on disk in `spark.sql.streaming.stateStore.providerClass`.
    """

    def load(changes: DataFrame, batch_id: int) -> None:
        spark = changes.sparkSession
        daily, days = apply_changes(spark, changes, kept, batch_id)
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
        clear_staging(spark, kept, batch_id)

    return (
        value_changes(feeds, kept.rules)
        .writeStream.foreachBatch(load)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
