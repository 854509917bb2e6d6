"""The latest state of every purchase and the daily totals, kept between batches, so that a batch costs what it touches.

Two tables of files. `by_id` has the latest version of each feed for every purchase id, in blocks of ids in a row.
`totals` has the exact sums by day and subsidiary. A batch reads the blocks of its ids and the days whose sums they
change, and writes these anew beside the old ones, under its number: `block=7/batch=12`, or where it has most blocks of
64 in a row, all of them in one folder; of many other blocks, those of 64 in a row share one too. The state before a batch is in the highest number below its own, so a batch that is repeated starts from the same rows and replaces what it left.
Batches must come one after another, each when the one before has ended.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, LongType, StringType, StructField, StructType

from vendaria.functions import exact, line_value, money
from vendaria.operators.cdc import APPROVED, Feeds
from vendaria.sources.parts import read_all_parts, read_parts, whole_spans, write_parts
from vendaria.sources.scratch import discard, materialize

DAY = "transaction_date"
BLOCK = "block"


class Rules(NamedTuple):
    """What makes a purchase's value: the options of `gmv_daily`."""

    status_col: str | None = None
    approved: str = APPROVED
    multiply_quantity: bool = False
    scale: int | None = 2

    def columns(self) -> Feeds:
        """The columns of each feed that a value depends on, in the order in which they decide between versions."""
        return Feeds(
            ("release_date", *([self.status_col] if self.status_col else [])),
            ("purchase_value", *(["item_quantity"] if self.multiply_quantity else [])),
            ("subsidiary",),
        )


class Kept(NamedTuple):
    """Where the state is, and how many ids in a row share a block."""

    path: str
    rules: Rules = Rules()
    ids_per_block: int = 1_000_000

    def block(self) -> Column:
        return F.expr(f"purchase_id div {self.ids_per_block}")


def newest(feeds: Feeds, rules: Rules) -> DataFrame:
    """(purchase_id, purchase, product_item, extra_info): the newest version of each feed as a struct, or NULL.

    All three feeds go through one aggregation, which Spark applies before the shuffle too.
    """
    wanted = rules.columns()
    parts = []
    for name, feed in feeds._asdict().items():
        version = F.struct("transaction_datetime", *getattr(wanted, name))
        parts.append(feed.select("purchase_id", version.alias(name)))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    return rows.groupBy("purchase_id").agg(*[F.max(name).alias(name) for name in Feeds._fields])


def counted_value(state: str, rules: Rules) -> Column:
    """What the purchase in the struct column `state` adds to the daily value: (day, subsidiary, value), or NULL.

    A purchase without an id counts, but nothing can be found to it.
    """
    purchase, item, extra = (f"{state}.{name}" for name in Feeds._fields)
    value = F.col(f"{item}.purchase_value").cast("double")
    if rules.multiply_quantity:
        value = line_value(value, F.col(f"{item}.item_quantity"))
    known = F.col(f"{state}.purchase_id").isNotNull()
    counts = F.col(f"{purchase}.release_date").isNotNull()
    if rules.status_col:
        counts = counts & (F.col(f"{purchase}.{rules.status_col}") == rules.approved)
    return F.when(
        counts,
        F.struct(
            F.col(f"{purchase}.release_date").alias("day"),
            F.when(known, F.col(f"{extra}.subsidiary")).alias("subsidiary"),
            F.when(known, exact(value)).alias("value"),
        ),
    )


def apply_batch(spark: SparkSession, records: Feeds, kept: Kept, batch_id: int) -> tuple[DataFrame, DataFrame]:
    """(daily value, days) after a batch of records: the value is complete for the returned days, which it changed.

    The state then includes the batch. The records may hold any number of versions, in any order, also such as came
    before; older versions than the kept ones change nothing. What is read of the state are the blocks of the batch's
    ids, known by a list of their numbers, and the days that change.
    """
    changes = state_changes(spark, records, kept, batch_id)
    return apply_changes(spark, changes, kept, batch_id)


def state_changes(spark: SparkSession, records: Feeds, kept: Kept, batch_id: int) -> DataFrame:
    """(before, after) of every purchase that counts otherwise than before; the kept versions are brought up to date."""
    staging = f"{kept.path}/staging/{batch_id}"
    discard(spark, staging)
    new = newest(records, kept.rules).withColumn(BLOCK, kept.block())
    new = materialize(new, f"{staging}/new")
    blocks = whole_spans([row[0] for row in new.select(BLOCK).distinct().collect()])
    old = read_parts(spark, f"{kept.path}/by_id", new.schema, BLOCK, blocks, batch_id)
    columns = ["purchase_id", *Feeds._fields]
    both = old.alias("old").join(
        new.alias("new"), F.col("old.purchase_id").eqNullSafe(F.col("new.purchase_id")), "full_outer"
    )
    # A missing side is a struct of NULLs, and the greatest of two versions is the newer one.
    merged = [F.greatest(F.col(f"old.{c}"), F.col(f"new.{c}")) if c != "purchase_id" else _either(c) for c in columns]
    rows = both.select(
        F.struct(*[F.col(f"old.{c}").alias(c) for c in columns]).alias("old"),
        F.struct(*[m.alias(c) for m, c in zip(merged, columns)]).alias("new"),
        _either(BLOCK).alias(BLOCK),
    )
    rows = materialize(rows, f"{staging}/rows")
    write_parts(rows.select("new.*", BLOCK), f"{kept.path}/by_id", BLOCK, batch_id)
    changes = rows.select(
        counted_value("old", kept.rules).alias("before"), counted_value("new", kept.rules).alias("after")
    )
    return changes.filter(~F.col("before").eqNullSafe(F.col("after")))


def apply_changes(spark: SparkSession, changes: DataFrame, kept: Kept, batch_id: int) -> tuple[DataFrame, DataFrame]:
    """(daily value, days) after changes (before, after) of what purchases count; the kept totals take them in."""
    signed = F.array(*[F.struct(F.lit(s).alias("sign"), F.col(c).alias("of")) for s, c in ((-1, "before"), (1, "after"))])
    one = changes.select(F.explode(signed).alias("c")).filter(F.col("c.of").isNotNull()).select("c.sign", "c.of.*")
    sign, value = F.col("sign"), F.col("value")
    delta = one.groupBy(F.col("day").alias(DAY), "subsidiary").agg(
        F.sum(F.when(sign > 0, value).otherwise(-value)).cast(TOTALS["total"].dataType).alias("total"),
        F.sum(sign).cast("long").alias("n_rows"),
        F.sum(F.when(value.isNotNull(), sign).otherwise(0)).cast("long").alias("n_values"),
    )
    delta = materialize(delta, f"{kept.path}/staging/{batch_id}/delta")
    days = [row[0] for row in delta.select(DAY).distinct().collect()]
    old = read_parts(spark, f"{kept.path}/totals", delta.schema, DAY, days, batch_id)
    total = F.sum(F.coalesce("total", F.lit(0))).cast(TOTALS["total"].dataType)
    sums = [total.alias("total"), F.sum("n_rows").alias("n_rows"), F.sum("n_values").alias("n_values")]
    totals = old.unionByName(delta).groupBy(DAY, "subsidiary").agg(*sums)
    totals = materialize(totals, f"{kept.path}/staging/{batch_id}/totals")
    write_parts(totals, f"{kept.path}/totals", DAY, batch_id)
    return _daily(totals, kept.rules), totals.select(DAY).distinct()


def clear_staging(spark: SparkSession, kept: Kept, batch_id: int) -> None:
    """Once what `apply_batch` returned has been used."""
    discard(spark, f"{kept.path}/staging/{batch_id}")


def daily_totals(spark: SparkSession, kept: Kept) -> DataFrame:
    """The daily value of all days, as the last batch left it."""
    return _daily(read_all_parts(spark, f"{kept.path}/totals", TOTALS, DAY), kept.rules)


#: A group that no purchase counts in any more stays with 0 rows, so that its day has a newer part than before.
TOTALS = StructType(
    [
        StructField(DAY, DateType()),
        StructField("subsidiary", StringType()),
        StructField("total", DecimalType(38, 8)),
        StructField("n_rows", LongType()),
        StructField("n_values", LongType()),
    ]
)


def _daily(totals: DataFrame, rules: Rules) -> DataFrame:
    value = F.when(F.col("n_values") > 0, F.col("total"))
    return totals.filter(F.col("n_rows") > 0).select(DAY, "subsidiary", money(value, rules.scale).alias("gmv_daily"))


def _either(column: str) -> Column:
    return F.coalesce(F.col(f"old.{column}"), F.col(f"new.{column}"))
