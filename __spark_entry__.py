"""

The star-schema tables stand in for the marketplace tables, see `vendaria.sources.star`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendaria import schemas
from vendaria.functions import parse_date, parse_timestamp
from vendaria.operators.cdc import Feeds, consolidated_purchase, latest_feeds, latest_per_key, valid_purchase
from vendaria.operators.gmv import (
    gmv_as_of,
    gmv_current,
    gmv_current_full,
    gmv_daily,
    gmv_known,
    gmv_known_at_correction,
    gmv_known_totals,
    gmv_period,
)
from vendaria.operators.history_audit import audit_history
from vendaria.operators.quality import arrives_within, audit, null_audit, quality_gate, refers_to
from vendaria.operators.scd2 import scd2_merge, stamp
from vendaria.plans.history import gmv_as_known, history_at, load_gmv, stage_gmv
from vendaria.plans.layers import (
    read_bronze,
    read_gold,
    read_silver,
    refresh_layers,
    write_bronze,
    write_gold,
    write_silver,
)
from vendaria.plans.reprocess import reprocess
from vendaria.plans.sales import top_producers, top_products_per_producer
from vendaria.plans.state import Kept, apply_batch, daily_totals
from vendaria.sources import star
from vendaria.sources.catalog import (
    create_table_from,
    ensure_database,
    ensure_gmv_table,
    publish_view,
    read_table,
)
from vendaria.sources.files import Checked, read_csv, read_csv_checked, read_parquet, write_partitioned
from vendaria.sources.scratch import materialize, scratch_dir
from vendaria.streaming.feeds import stream_gmv, tagged
from vendaria.streaming.state import stream_gmv_by_state

try:
    import vendaria.llm.registry as corpus
except ModuleNotFoundError as missing:
    # The corpus operators are optional; an import that fails inside them is an error.
    if missing.name not in ("vendaria.llm", "vendaria.llm.registry"):
        raise
    corpus = None

YEAR = 1997
IN_YEAR = (date(YEAR, 1, 1), date(YEAR, 12, 31))

# Two loads of the history: the first sees the feeds up to a moment, the second all of them.
FIRST_UNTIL = "2024-01-28 00:00:00"
FIRST_DAY, SECOND_DAY = date(2024, 1, 28), date(2024, 2, 1)
LOAD_TS = datetime(2024, 2, 1, 6, 0, 0)
PERIOD = (date(2024, 1, 10), date(2024, 1, 20))
PAST_DAY = date(2024, 1, 30)
# Three loads, where two are too few; and days on which values are asked for.
THREE_LOADS = (("2024-01-16 00:00:00", date(2024, 1, 16)), (FIRST_UNTIL, FIRST_DAY), (None, SECOND_DAY))
KNOWN = (date(2024, 1, 26), date(2024, 2, 3))
KNOWN_DAY = date(2024, 1, 27)
# Purchases of the star schema that share a block of the kept state.
IDS_PER_BLOCK = 500


def entry(spark: SparkSession) -> DataFrame:
    """Top producers of all years on the smallest tables."""
    sf_dir = "/root/testdata/sf0.001"
    return top_producers(_purchase(spark, sf_dir), star.product_item(spark, sf_dir), year=None)


def _purchase(spark: SparkSession, sf_dir: str, ordered: tuple[date, date] | None = None) -> DataFrame:
    return star.purchase(spark, sf_dir, ordered).select(*schemas.PURCHASE.names)


def _revenue(report: Callable, ordered=None, **options) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark, sf_dir):
        purchase = star.purchase(spark, sf_dir, ordered)
        return report(purchase, star.product_item(spark, sf_dir), **options)

    return query


def _from_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    publish_view(_purchase(spark, sf_dir, IN_YEAR), "purchase_gold")
    publish_view(star.product_item(spark, sf_dir), "product_item_gold")
    return top_producers(read_table(spark, "purchase_gold"), read_table(spark, "product_item_gold"), year=YEAR)


def _roundtrip(table: str) -> Callable[[SparkSession, str], DataFrame]:
    """CSV -> Parquet partitioned by item partition -> read back."""

    def query(spark, sf_dir):
        base = scratch_dir(spark)
        if table == "purchase":
            raw, schema = _purchase(spark, sf_dir), schemas.PURCHASE
        else:
            raw, schema = star.product_item(spark, sf_dir), schemas.PRODUCT_ITEM
        raw.write.option("header", "true").csv(f"{base}/csv")
        write_partitioned(read_csv(spark, f"{base}/csv", schema), f"{base}/{table}", "prod_item_partition")
        return read_parquet(spark, f"{base}/{table}", schema)

    return query


def _damaged(result: Callable[[Checked], DataFrame]):
    """The purchases as lines of text, some with cells that do not fit and some with a cell too many."""

    def query(spark, sf_dir):
        base = scratch_dir(spark)
        cells = {name: F.coalesce(F.col(name).cast("string"), F.lit("")) for name in schemas.PURCHASE.names}
        cells["order_date"] = F.when(F.col("purchase_id") % 97 == 0, "soon").otherwise(cells["order_date"])
        cells["producer_id"] = F.when(F.col("purchase_id") % 89 == 0, F.concat(F.lit("p"), "producer_id")).otherwise(
            cells["producer_id"]
        )
        more = F.when(F.col("purchase_id") % 83 == 0, ",more").otherwise("")
        lines = _purchase(spark, sf_dir).select(F.concat(F.concat_ws(",", *cells.values()), more).alias("value"))
        lines.write.text(f"{base}/csv")
        return result(read_csv_checked(spark, f"{base}/csv", schemas.PURCHASE, f"{base}/parsed", header=False))

    return query


def _rejected(checked: Checked) -> DataFrame:
    """Lines by what is wrong with them, and those with nothing wrong."""
    lines = F.count(F.lit(1)).alias("lines")
    bad = checked.rejected.groupBy(F.coalesce("column", F.lit("number of cells")).alias("wrong")).agg(lines)
    return bad.unionByName(checked.rows.agg(lines).select(F.lit("nothing").alias("wrong"), "lines"))


def _table_from_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product items as a table that takes its columns from the data."""
    base = scratch_dir(spark)
    database = f"vendaria_{uuid.uuid4().hex}"
    try:
        ensure_database(spark, database, f"{base}/warehouse")
        create_table_from(star.product_item(spark, sf_dir), f"{database}.product_item", "prod_item_partition")
        return materialize(read_table(spark, f"{database}.product_item"), f"{base}/result")
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def _times_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feeds' days and times as text, parsed; what is no day or time is NULL."""
    feed = star.feeds(spark, sf_dir).purchase
    every_other = F.col("buyer_id") % 2 == 0
    text = F.when(every_other, F.col("transaction_datetime").cast("string")).otherwise("yesterday")
    day = F.when(every_other, F.col("transaction_date").cast("string")).otherwise("2024-13-01")
    return feed.select(
        "purchase_id",
        F.unix_micros(parse_timestamp(text, strict=False)).alias("micros"),
        parse_date(day, strict=False).alias("day"),
    )


def _feeds_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    feeds = star.feeds(spark, sf_dir)
    return quality_gate(
        *[
            arrives_within(feeds.purchase, getattr(feeds, name), name, days, datetime.fromisoformat(FIRST_UNTIL))
            for name in ("product_item", "extra_info")
            for days in (1, 7)
        ]
    )


def _quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    purchase, item = _purchase(spark, sf_dir), star.product_item(spark, sf_dir)
    item_key = ["prod_item_id", "prod_item_partition"]
    return quality_gate(
        audit(purchase, schemas.PURCHASE.names, ["purchase_id"]),
        audit(item, [], item_key),
        refers_to(purchase, item_key, item, "product_item"),
    )


def _latest(feed: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: latest_per_key(getattr(star.feeds(spark, sf_dir), feed), "purchase_id")


def _valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_purchase(latest_per_key(star.feeds(spark, sf_dir).purchase, "purchase_id"))


def _consolidated(how: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark, sf_dir):
        latest = latest_feeds(star.feeds(spark, sf_dir))
        return consolidated_purchase(valid_purchase(latest.purchase), latest.product_item, latest.extra_info, how)

    return query


def _daily(**options) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: gmv_daily(star.feeds(spark, sf_dir), **options)


def _first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp(gmv_daily(star.feeds(spark, sf_dir, FIRST_UNTIL)), FIRST_DAY, LOAD_TS)


def _history(spark: SparkSession, sf_dir: str, mode: str = "single_pass") -> DataFrame:
    """After the second load; the load time is left out of what is compared."""
    source = gmv_daily(star.feeds(spark, sf_dir))
    return scd2_merge(_first_load(spark, sf_dir), source, SECOND_DAY, LOAD_TS, mode).drop("load_timestamp")


def _on_history(read: Callable[[DataFrame], DataFrame], mode: str = "single_pass"):
    return lambda spark, sf_dir: read(_history(spark, sf_dir, mode))


def _stored_history(load: Callable[[SparkSession, str, str, str, str], None]):
    """Let `load(spark, sf_dir, table, location, base)` fill a table of its own and return what it then holds."""

    def query(spark, sf_dir):
        base = scratch_dir(spark)
        database = f"vendaria_{uuid.uuid4().hex}"
        table = f"{database}.fact_gmv_daily_scd2"
        try:
            load(spark, sf_dir, table, f"{base}/warehouse", base)
            return materialize(read_table(spark, table).select(*schemas.GMV_HISTORY.names[:-1]), f"{base}/result")
        finally:
            spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")

    return query


def _two_loads(mode: str):
    def load(spark, sf_dir, table, location, base):
        for until, as_of in ((FIRST_UNTIL, FIRST_DAY), (None, SECOND_DAY)):
            daily = gmv_daily(star.feeds(spark, sf_dir, until))
            load_gmv(spark, daily, table, as_of, LOAD_TS, mode, location=location)

    return load


def _recovered(mode: str):
    """The second load dies when its rows are staged, and is repeated."""

    def load(spark, sf_dir, table, location, base):
        first, second = (gmv_daily(star.feeds(spark, sf_dir, until)) for until in (FIRST_UNTIL, None))
        load_gmv(spark, first, table, FIRST_DAY, LOAD_TS, mode, location=location)
        stage_gmv(spark, second, table, SECOND_DAY, LOAD_TS, mode)
        load_gmv(spark, second, table, SECOND_DAY, LOAD_TS, mode)

    return load


def _first_load_recovered(mode: str):
    """The first load dies when its rows are staged, and is repeated."""

    def load(spark, sf_dir, table, location, base):
        first = gmv_daily(star.feeds(spark, sf_dir, FIRST_UNTIL))
        ensure_gmv_table(spark, table, location)
        stage_gmv(spark, first, table, FIRST_DAY, LOAD_TS, mode)
        load_gmv(spark, first, table, FIRST_DAY, LOAD_TS, mode, location=location)

    return load


def _three_loads(mode: str, result: Callable[[SparkSession, str], DataFrame]):
    """What `result(spark, table)` reads after three loads, without the times of loading."""

    def query(spark, sf_dir):
        base = scratch_dir(spark)
        database = f"vendaria_{uuid.uuid4().hex}"
        table = f"{database}.fact_gmv_daily_scd2"
        try:
            for until, as_of in THREE_LOADS:
                daily = gmv_daily(star.feeds(spark, sf_dir, until))
                load_gmv(spark, daily, table, as_of, _load_time(as_of), mode, location=f"{base}/warehouse")
            return materialize(result(spark, table), f"{base}/result")
        finally:
            spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")

    return query


def _load_time(as_of: date) -> datetime:
    return datetime(as_of.year, as_of.month, as_of.day, 6)


def _after_each_load(read: Callable[[SparkSession, str, int], DataFrame]):
    def result(spark, table):
        loads = [
            read(spark, table, n).drop("load_timestamp").withColumn("load", F.lit(n).cast("long"))
            for n in range(1, len(THREE_LOADS) + 1)
        ]
        return reduce(DataFrame.unionByName, loads)

    return result


def _as_known(spark: SparkSession, table: str, number: int) -> DataFrame:
    """By the time of the load."""
    return gmv_as_known(spark, table, KNOWN_DAY, _load_time(THREE_LOADS[number - 1][1]))


def _audited(mode: str):
    return _three_loads(mode, lambda spark, table: audit_history(read_table(spark, table)))


def _known_at_correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gmv_known_at_correction(_history(spark, sf_dir), star.feeds(spark, sf_dir).purchase)


def _streamed(start: Callable):
    """The feeds arrive as files in two deliveries, each picked up by a run of the stream that `start` begins."""

    def load(spark, sf_dir, table, location, base):
        days = (FIRST_DAY, SECOND_DAY)
        options = {"as_of": lambda batch: days[min(batch, 1)], "load_ts": lambda batch: LOAD_TS, "location": location}
        for delivery in (star.feeds(spark, sf_dir, until=FIRST_UNTIL), star.feeds(spark, sf_dir, since=FIRST_UNTIL)):
            arriving = []
            for name, feed in delivery._asdict().items():
                feed.write.mode("append").parquet(f"{base}/landing/{name}")
                arriving.append(spark.readStream.schema(feed.schema).parquet(f"{base}/landing/{name}"))
            start(Feeds(*arriving), table, base, f"{base}/checkpoint", **options).awaitTermination()

    return load


def _from_store(feeds, table, base, checkpoint, **options):
    return stream_gmv(feeds, table, f"{base}/records", checkpoint, **options)


def _from_kept_state(feeds, table, base, checkpoint, **options):
    kept = Kept(f"{base}/kept", ids_per_block=IDS_PER_BLOCK)
    return stream_gmv(feeds, table, f"{base}/records", checkpoint, kept=kept, **options)


def _from_stream_state(feeds, table, base, checkpoint, **options):
    return stream_gmv_by_state(feeds, table, Kept(f"{base}/kept"), checkpoint, **options)


def _two_batches(result: Callable[[SparkSession, Kept, tuple[DataFrame, DataFrame]], DataFrame]):
    """The records up to the first load are one batch, the later ones another."""

    def query(spark, sf_dir):
        kept = Kept(scratch_dir(spark), ids_per_block=IDS_PER_BLOCK)
        apply_batch(spark, star.feeds(spark, sf_dir, until=FIRST_UNTIL), kept, 0)
        return result(spark, kept, apply_batch(spark, star.feeds(spark, sf_dir, since=FIRST_UNTIL), kept, 1))

    return query


def _late_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily value of every day that the records after the first load can have changed."""
    late = tagged(star.feeds(spark, sf_dir, since=FIRST_UNTIL)).select("purchase_id")
    daily, _ = reprocess(star.feeds(spark, sf_dir), late, scratch_dir(spark))
    return daily


def _layers(status_col: str | None = None):
    def query(spark, sf_dir):
        base = scratch_dir(spark)
        feeds = star.feeds(spark, sf_dir, status=status_col is not None)
        write_bronze(feeds, base)
        bronze = read_bronze(spark, base, {name: df.schema for name, df in feeds._asdict().items()})
        # A day of which no purchase has a value is stored, so the gate of the query asks for the keys only.
        gate = lambda daily: quality_gate(audit(daily, ["transaction_date"], ["transaction_date", "subsidiary"]))
        return write_gold(write_silver(bronze, base, status_col), base, checks=gate)

    return query


def _refreshed(result: Callable[[SparkSession, str, dict], DataFrame]):
    """The layers after the records up to the first load, and then the later ones, have been taken in."""

    def query(spark, sf_dir):
        base = scratch_dir(spark)
        kept = Kept(f"{base}/state", ids_per_block=IDS_PER_BLOCK)
        deliveries = (star.feeds(spark, sf_dir, until=FIRST_UNTIL), star.feeds(spark, sf_dir, since=FIRST_UNTIL))
        gate = lambda daily: quality_gate(audit(daily, ["transaction_date"], ["transaction_date", "subsidiary"]))
        for number, delivery in enumerate(deliveries):
            refresh_layers(spark, delivery, base, kept, number, checks=gate)
        return result(spark, base, {name: df.schema for name, df in deliveries[0]._asdict().items()})

    return query


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _sales_queries() | (corpus.queries() if corpus else {})


def _sales_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "ingest_roundtrip": _roundtrip("product_item"),
        "ingest_roundtrip_purchase": _roundtrip("purchase"),
        "ingest_checked": _damaged(lambda checked: checked.rows),
        "ingest_checked_rejected": _damaged(_rejected),
        "ingest_table": _table_from_data,
        "times_from_text": _times_from_text,
        "quality_gate_feeds": _feeds_gate,
        "null_audit": lambda spark, sf_dir: null_audit(_purchase(spark, sf_dir)),
        "quality_gate": _quality_gate,
        "top_producers": _revenue(top_producers, IN_YEAR, year=YEAR),
        "top_producers_on_filter": _revenue(top_producers, IN_YEAR, year=YEAR, filter_in="on"),
        "top_producers_from_views": _from_views,
        "top_producers_all_years": _revenue(top_producers, year=None),
        "top_producers_approved": _revenue(top_producers, IN_YEAR, year=YEAR, status_col="status"),
        "top_products_per_producer": _revenue(top_products_per_producer),
        "top_products_per_producer_on_filter": _revenue(top_products_per_producer, filter_in="on"),
        "top_products_per_producer_approved": _revenue(top_products_per_producer, status_col="status"),
        "cdc_latest_purchase": _latest("purchase"),
        "cdc_latest_item": _latest("product_item"),
        "cdc_latest_extra": _latest("extra_info"),
        "valid_purchase": _valid,
        "consolidated_purchase": _consolidated("full_outer"),
        "consolidated_purchase_left": _consolidated("left"),
        "gmv_daily_by_subsidiary": _daily(),
        "gmv_daily_by_subsidiary_outer": _daily(how="full_outer"),
        "gmv_daily_approved": lambda spark, sf_dir: gmv_daily(
            star.feeds(spark, sf_dir, status=True), status_col="status"
        ),
        "gmv_layers": _layers(),
        "gmv_layers_approved": _layers("status"),
        "gmv_layers_refreshed": _refreshed(lambda spark, base, types: read_gold(spark, base)),
        "gmv_layers_refreshed_purchase": _refreshed(lambda spark, base, types: read_silver(spark, base, types).purchase),
        "gmv_layers_refreshed_item": _refreshed(lambda spark, base, types: read_silver(spark, base, types).product_item),
        "gmv_layers_refreshed_bronze": _refreshed(
            lambda spark, base, types: read_bronze(spark, base, types).extra_info
        ),
        "gmv_late_days": _late_days,
        "gmv_late_days_kept": _two_batches(lambda spark, kept, changed: changed[0]),
        "gmv_daily_kept": _two_batches(lambda spark, kept, changed: daily_totals(spark, kept)),
        "gmv_scd2_initial": lambda spark, sf_dir: _first_load(spark, sf_dir).drop("load_timestamp"),
        "gmv_scd2_merge": _history,
        "gmv_scd2_merge_reference": lambda spark, sf_dir: _history(spark, sf_dir, "reference"),
        "gmv_scd2_load": _stored_history(_two_loads("single_pass")),
        "gmv_scd2_load_reference": _stored_history(_two_loads("reference")),
        "gmv_scd2_load_recovered": _stored_history(_recovered("single_pass")),
        "gmv_scd2_load_recovered_reference": _stored_history(_recovered("reference")),
        "gmv_scd2_stream": _stored_history(_streamed(_from_store)),
        "gmv_scd2_stream_kept": _stored_history(_streamed(_from_kept_state)),
        "gmv_scd2_stream_state": _stored_history(_streamed(_from_stream_state)),
        "gmv_current": _on_history(gmv_current),
        "gmv_current_full": _on_history(gmv_current_full),
        "gmv_current_reference": _on_history(gmv_current, "reference"),
        "gmv_period": _on_history(lambda history: gmv_period(history, *PERIOD)),
        "gmv_period_current": _on_history(lambda history: gmv_period(history, *PERIOD, current_only=True)),
        "gmv_period_reference": _on_history(lambda history: gmv_period(history, *PERIOD), "reference"),
        "gmv_as_of": _on_history(lambda history: gmv_as_of(history, PAST_DAY)),
        "gmv_known": _on_history(lambda history: gmv_known(history, *KNOWN)),
        "gmv_known_totals": _on_history(lambda history: gmv_known_totals(history, *KNOWN)),
        "gmv_known_at_correction": _known_at_correction,
        "gmv_scd2_first_load_recovered": _stored_history(_first_load_recovered("single_pass")),
        "gmv_scd2_first_load_recovered_reference": _stored_history(_first_load_recovered("reference")),
        "gmv_history_loads": _three_loads("single_pass", _after_each_load(history_at)),
        "gmv_history_loads_reference": _three_loads("reference", _after_each_load(history_at)),
        "gmv_as_known_loads": _three_loads("single_pass", _after_each_load(_as_known)),
        "gmv_history_audit_loads": _audited("single_pass"),
        "gmv_history_audit_loads_reference": _audited("reference"),
    }


# The SQL below is written from the meaning of each query, not from the operators.

_SALES = """
purchase AS (
    SELECT l_orderkey AS purchase_id, l_orderkey AS buyer_id, l_partkey AS prod_item_id,
           CAST(l_shipdate AS DATE) AS order_date,
           CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS release_date,
           l_suppkey AS producer_id, l_orderkey % 10 AS purchase_partition, l_partkey % 10 AS prod_item_partition,
           CASE l_returnflag WHEN 'A' THEN 'Aprovado' WHEN 'R' THEN 'Reembolsado' WHEN 'N' THEN 'Pendente' END AS status
    FROM lineitem
),
product_item AS (
    SELECT p_partkey AS prod_item_id, p_partkey % 10 AS prod_item_partition, p_partkey AS product_id,
           CAST(p_size AS BIGINT) AS item_quantity, p_retailprice AS purchase_value
    FROM part
)
"""

_PURCHASE_COLUMNS = ", ".join(schemas.PURCHASE.names)


def _null_audit_sql() -> str:
    sums = ", ".join(
        f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS total_null_{c}" for c in schemas.PURCHASE.names
    )
    return f"WITH {_SALES} SELECT {sums} FROM purchase"


def _quality_sql() -> str:
    rules = [
        f"SELECT 'not_null({c})' AS rule, count(*) - count({c}) AS violations FROM purchase"
        for c in schemas.PURCHASE.names
    ]
    rules += [
        "SELECT 'unique(prod_item_id, prod_item_partition)', count(*) - count(DISTINCT (prod_item_id, "
        "prod_item_partition)) FROM product_item",
        "SELECT 'unique(purchase_id)', count(purchase_id) - count(DISTINCT purchase_id) FROM purchase",
        "SELECT 'refers_to(prod_item_id, prod_item_partition -> product_item)', count(*) FROM purchase p "
        "WHERE NOT EXISTS (SELECT 1 FROM product_item i WHERE i.prod_item_id = p.prod_item_id "
        "AND i.prod_item_partition = p.prod_item_partition)",
    ]
    return (
        f"WITH {_SALES}, gate AS ({' UNION ALL '.join(rules)}) "
        "SELECT rule, CAST(violations AS BIGINT) AS violations, violations = 0 AS passed FROM gate"
    )


def _top_producers_sql(*conditions: str) -> str:
    return f"""
        WITH {_SALES}
        SELECT p.producer_id, round(sum(i.purchase_value * i.item_quantity), 2) AS total_sale
        FROM purchase p JOIN product_item i USING (prod_item_id, prod_item_partition)
        WHERE {' AND '.join(['p.release_date IS NOT NULL', *conditions])}
        GROUP BY p.producer_id ORDER BY total_sale DESC NULLS LAST, p.producer_id NULLS FIRST LIMIT 50
    """


def _top_products_sql(*conditions: str) -> str:
    return f"""
        WITH {_SALES},
        billing AS (
            SELECT p.producer_id, i.product_id, round(sum(i.purchase_value * i.item_quantity), 2) AS total_sales
            FROM purchase p JOIN product_item i USING (prod_item_id, prod_item_partition)
            WHERE {' AND '.join(['p.release_date IS NOT NULL', *conditions])}
            GROUP BY p.producer_id, i.product_id
        ),
        ranked AS (
            SELECT *, row_number() OVER (
                PARTITION BY producer_id ORDER BY total_sales DESC NULLS LAST, product_id NULLS FIRST) AS rank_sales
            FROM billing
        )
        SELECT producer_id, product_id, total_sales, CAST(rank_sales AS INT) AS rank_sales
        FROM ranked WHERE rank_sales <= 2
    """


# 1,500 purchases for every 10,000 events in a row.
_PURCHASE_ID = "(event_id // 10000 * 1500 + event_id % 1500)"


def _feeds_sql(prefix: str = "", until: str | None = None, approved: bool = False) -> str:
    """CTEs up to the daily value; `prefix` tells two loads apart, `approved` asks for the status too."""
    status = ", CASE WHEN event_id % 7 < 5 THEN 'Aprovado' ELSE 'Pendente' END AS status" if approved else ""
    is_approved = "AND status = 'Aprovado'" if approved else ""
    seen = f"AND ts < TIMESTAMP '{until}'" if until else ""
    feeds = {
        "purchase": (
            "event_type IN ('purchase', 'signup')",
            "user_id AS buyer_id, user_id % 50 AS prod_item_id, CAST(ts AS DATE) AS order_date, "
            "CASE WHEN event_id % 5 <> 0 THEN CAST(ts AS DATE) END AS release_date, user_id % 20 AS producer_id" + status,
        ),
        "item": (
            "event_type IN ('click', 'error')",
            "user_id AS product_id, CAST(1 AS BIGINT) AS item_quantity, value AS purchase_value",
        ),
        "extra": (
            "event_type = 'view'",
            "CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0 THEN 'nacional' "
            "ELSE 'internacional' END AS subsidiary",
        ),
    }
    ctes = [
        f"""
        {prefix}{name} AS (
            SELECT * EXCLUDE (version) FROM (
                SELECT ts AS transaction_datetime, CAST(ts AS DATE) AS transaction_date,
                       {_PURCHASE_ID} AS purchase_id, {columns},
                       row_number() OVER (PARTITION BY {_PURCHASE_ID} ORDER BY ts DESC, event_id DESC) AS version
                FROM events WHERE {kind} {seen}
            ) WHERE version = 1
        )"""
        for name, (kind, columns) in feeds.items()
    ]
    ctes.append(
        f"""
        {prefix}valid AS (
            SELECT *, coalesce(release_date, transaction_date, order_date) AS gmv_date
            FROM {prefix}purchase WHERE release_date IS NOT NULL {is_approved}
        ),
        {prefix}daily AS (
            SELECT v.gmv_date AS transaction_date, x.subsidiary, round(sum(i.purchase_value), 2) AS gmv_daily
            FROM {prefix}valid v
            LEFT JOIN {prefix}item i ON i.purchase_id = v.purchase_id
            LEFT JOIN {prefix}extra x ON x.purchase_id = v.purchase_id
            GROUP BY v.gmv_date, x.subsidiary
        )"""
    )
    return ",".join(ctes)


def _feeds_gate_sql() -> str:
    kinds = {"product_item": "'click', 'error'", "extra_info": "'view'"}
    rules = [
        f"""
        SELECT 'arrives_within(purchase_id -> {name}, {days} days)' AS rule, count(*) AS violations
        FROM (SELECT {_PURCHASE_ID} AS id, min(ts) + INTERVAL {days} DAY AS deadline FROM events
              WHERE event_type IN ('purchase', 'signup') AND ts < TIMESTAMP '{FIRST_UNTIL}' GROUP BY id) p
        WHERE deadline < TIMESTAMP '{FIRST_UNTIL}' AND NOT EXISTS (
            SELECT 1 FROM events WHERE event_type IN ({kind}) AND {_PURCHASE_ID} = p.id AND ts <= deadline)
        """
        for name, kind in kinds.items()
        for days in (1, 7)
    ]
    return f"SELECT rule, violations, violations = 0 AS passed FROM ({' UNION ALL '.join(rules)})"


def _counted_sql(prefix: str = "") -> str:
    """What each purchase adds to a day and subsidiary."""
    return f"""
        SELECT v.purchase_id, v.gmv_date, x.subsidiary, i.purchase_value
        FROM {prefix}valid v
        LEFT JOIN {prefix}item i ON i.purchase_id = v.purchase_id
        LEFT JOIN {prefix}extra x ON x.purchase_id = v.purchase_id
    """


def _consolidated_sql(how: str) -> str:
    return f"""
        WITH {_feeds_sql()}
        SELECT v.gmv_date AS transaction_date, x.subsidiary, CAST(i.purchase_value AS DOUBLE) AS purchase_value
        FROM valid v
        {how} JOIN item i ON i.purchase_id = v.purchase_id
        {how} JOIN extra x ON x.purchase_id = coalesce(v.purchase_id, i.purchase_id)
    """


_NEW = f"DATE '{SECOND_DAY}' AS valid_from, DATE '9999-12-31' AS valid_to, TRUE AS is_current"

_INITIAL = f"""
first_load AS (
    SELECT transaction_date, subsidiary, gmv_daily,
           DATE '{FIRST_DAY}' AS valid_from, DATE '9999-12-31' AS valid_to, TRUE AS is_current
    FROM first_daily
)
"""


def _history_sql(mode: str = "single_pass") -> str:
    """CTEs up to `history`: the state after the second load."""
    same_day = "s.transaction_date = t.transaction_date"
    if mode == "single_pass":
        match = f"{same_day} AND s.subsidiary IS NOT DISTINCT FROM t.subsidiary"
        closes = "s.transaction_date IS NULL OR s.gmv_daily IS DISTINCT FROM t.gmv_daily"
        inserts = "t.transaction_date IS NULL OR s.gmv_daily IS DISTINCT FROM t.gmv_daily"
    else:
        match = f"{same_day} AND s.subsidiary = t.subsidiary"
        closes = "s.transaction_date IS NOT NULL AND s.gmv_daily <> t.gmv_daily"
        inserts = "t.transaction_date IS NULL"
    return f"""
        {_feeds_sql("first_", FIRST_UNTIL)}, {_feeds_sql()}, {_INITIAL},
        history AS (
            SELECT t.transaction_date, t.subsidiary, t.gmv_daily, t.valid_from,
                   CASE WHEN {closes} THEN DATE '{SECOND_DAY}' - 1 ELSE t.valid_to END AS valid_to,
                   NOT coalesce({closes}, FALSE) AS is_current
            FROM first_load t LEFT JOIN daily s ON {match}
            UNION ALL
            SELECT s.transaction_date, s.subsidiary, s.gmv_daily, {_NEW}
            FROM daily s LEFT JOIN first_load t ON {match}
            WHERE {inserts}
        )
    """


_DAYS = f"(SELECT CAST(unnest(range(DATE '{KNOWN[0]}', DATE '{KNOWN[1]}' + 1, INTERVAL 1 DAY)) AS DATE) AS as_of)"


def _merge_sql(name: str, before: str, daily: str, as_of: date, mode: str) -> str:
    """A CTE: the history `before` after a load of `daily`."""
    sub = "s.subsidiary IS NOT DISTINCT FROM t.subsidiary" if mode == "single_pass" else "s.subsidiary = t.subsidiary"
    match = f"s.transaction_date = t.transaction_date AND {sub}"
    if mode == "single_pass":
        closes = "s.transaction_date IS NULL OR s.gmv_daily IS DISTINCT FROM t.gmv_daily"
        inserts = "t.transaction_date IS NULL OR s.gmv_daily IS DISTINCT FROM t.gmv_daily"
    else:
        closes = "s.transaction_date IS NOT NULL AND s.gmv_daily <> t.gmv_daily"
        inserts = "t.transaction_date IS NULL"
    return f"""
        {name} AS (
            SELECT * FROM {before} WHERE NOT is_current
            UNION ALL
            SELECT t.transaction_date, t.subsidiary, t.gmv_daily, t.valid_from,
                   CASE WHEN {closes} THEN DATE '{as_of}' - 1 ELSE t.valid_to END AS valid_to,
                   NOT coalesce({closes}, FALSE) AS is_current
            FROM (SELECT * FROM {before} WHERE is_current) t LEFT JOIN {daily} s ON {match}
            UNION ALL
            SELECT s.transaction_date, s.subsidiary, s.gmv_daily, DATE '{as_of}', DATE '9999-12-31', TRUE
            FROM {daily} s LEFT JOIN (SELECT * FROM {before} WHERE is_current) t ON {match}
            WHERE {inserts}
        )
    """


def _three_loads_sql(mode: str) -> str:
    """CTEs up to `after1`, `after2` and `after3`."""
    ctes = ["after0 AS (SELECT NULL::DATE AS transaction_date, NULL AS subsidiary, NULL::DOUBLE AS gmv_daily, "
            "NULL::DATE AS valid_from, NULL::DATE AS valid_to, NULL::BOOLEAN AS is_current LIMIT 0)"]
    for n, (until, as_of) in enumerate(THREE_LOADS, 1):
        ctes += [_feeds_sql(f"l{n}_", until), _merge_sql(f"after{n}", f"after{n - 1}", f"l{n}_daily", as_of, mode)]
    return ", ".join(ctes)


def _after_each_load_sql(mode: str, where: str = "TRUE") -> str:
    loads = " UNION ALL ".join(f"SELECT *, {n}::BIGINT AS load FROM after{n} WHERE {where}" for n in (1, 2, 3))
    return f"WITH {_three_loads_sql(mode)} {loads}"


def _audit_sql(mode: str) -> str:
    """Each rule by comparing the versions of a key with each other."""
    same = (
        "b.transaction_date IS NOT DISTINCT FROM a.transaction_date AND b.subsidiary IS NOT DISTINCT FROM a.subsidiary"
    )
    place = "(b.valid_from, b.valid_to, b.is_current, coalesce(b.gmv_daily, -1e300), b.n)"
    earlier = f"{same} AND {place} < {place.replace('b.', 'a.')}"
    until = f"(SELECT max(b.valid_to) FROM h b WHERE {earlier})"
    rules = {
        "ends before it begins": "a.valid_to < a.valid_from",
        "overlaps an earlier version": f"a.valid_from <= {until}",
        "leaves a gap": f"a.valid_from - 1 > {until}",
        "repeats the version before": f"EXISTS (SELECT 1 FROM h b WHERE {earlier} AND b.valid_to = a.valid_from - 1 "
        f"AND b.gmv_daily IS NOT DISTINCT FROM a.gmv_daily)",
        "more than one is current": f"a.is_current AND EXISTS (SELECT 1 FROM h b WHERE {earlier} AND b.is_current)",
        "current does not mean open": "a.is_current <> (a.valid_to = DATE '9999-12-31')",
        "not the last but current": f"a.is_current AND EXISTS (SELECT 1 FROM h b WHERE {same} "
        f"AND {place} > {place.replace('b.', 'a.')})",
    }
    counts = " UNION ALL ".join(f"SELECT '{r}' AS rule, count(*) AS violations FROM h a WHERE {c}" for r, c in rules.items())
    return (
        f"WITH {_three_loads_sql(mode)}, h AS (SELECT *, row_number() OVER () AS n FROM after3) "
        f"SELECT rule, violations, violations = 0 AS passed FROM ({counts})"
    )


def _on_history_sql(select: str, mode: str = "single_pass") -> str:
    return f"WITH {_history_sql(mode)} {select}"


def oracle_sql() -> dict[str, str]:
    return _sales_sql() | (corpus.oracle_sql() if corpus else {})


def _sales_sql() -> dict[str, str]:
    in_year = f"p.order_date BETWEEN DATE '{IN_YEAR[0]}' AND DATE '{IN_YEAR[1]}'"
    approved = "p.status = 'Aprovado'"
    feed = f"WITH {_feeds_sql()} SELECT * FROM "
    full = "SELECT * FROM history"
    current = "SELECT transaction_date, subsidiary, gmv_daily FROM history WHERE is_current"
    valid = "as_of BETWEEN valid_from AND valid_to"
    initial = f"WITH {_feeds_sql('first_', FIRST_UNTIL)}, {_INITIAL} SELECT * FROM first_load"
    in_period = f"transaction_date BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}'"
    period = (
        "SELECT transaction_date, subsidiary, round(sum(gmv_daily), 2) AS gmv FROM history "
        "WHERE {} GROUP BY transaction_date, subsidiary"
    )
    late_days = f"""
        daily WHERE transaction_date IN (
            SELECT CAST(ts AS DATE) FROM events
            WHERE event_type IN ('purchase', 'signup') AND event_id % 5 <> 0 AND {_PURCHASE_ID} IN (
                SELECT {_PURCHASE_ID} FROM events
                WHERE ts >= TIMESTAMP '{FIRST_UNTIL}'
                  AND event_type IN ('purchase', 'signup', 'click', 'error', 'view')))
    """
    return {
        "ingest_roundtrip": f"WITH {_SALES} SELECT * FROM product_item",
        "ingest_roundtrip_purchase": f"WITH {_SALES} SELECT {_PURCHASE_COLUMNS} FROM purchase",
        "ingest_checked": f"""
            WITH {_SALES} SELECT {_PURCHASE_COLUMNS} FROM purchase
            WHERE purchase_id % 97 <> 0 AND purchase_id % 89 <> 0 AND purchase_id % 83 <> 0
        """,
        "ingest_checked_rejected": f"""
            WITH {_SALES}
            SELECT unnest(['order_date', 'producer_id', 'number of cells', 'nothing']) AS wrong,
                   unnest([count(*) FILTER (purchase_id % 97 = 0 AND purchase_id % 83 <> 0),
                           count(*) FILTER (purchase_id % 89 = 0 AND purchase_id % 83 <> 0),
                           count(*) FILTER (purchase_id % 83 = 0),
                           count(*) FILTER (purchase_id % 97 <> 0 AND purchase_id % 89 <> 0 AND purchase_id % 83 <> 0)
                          ]) AS lines
            FROM purchase
        """,
        "ingest_table": f"WITH {_SALES} SELECT * FROM product_item",
        "times_from_text": f"""
            SELECT {_PURCHASE_ID} AS purchase_id, CASE WHEN user_id % 2 = 0 THEN epoch_us(ts) END AS micros,
                   CASE WHEN user_id % 2 = 0 THEN CAST(ts AS DATE) END AS day
            FROM events WHERE event_type IN ('purchase', 'signup')
        """,
        "quality_gate_feeds": _feeds_gate_sql(),
        "null_audit": _null_audit_sql(),
        "quality_gate": _quality_sql(),
        "top_producers": _top_producers_sql(in_year),
        "top_producers_on_filter": _top_producers_sql(in_year),
        "top_producers_from_views": _top_producers_sql(in_year),
        "top_producers_all_years": _top_producers_sql(),
        "top_producers_approved": _top_producers_sql(in_year, approved),
        "top_products_per_producer": _top_products_sql(),
        "top_products_per_producer_on_filter": _top_products_sql(),
        "top_products_per_producer_approved": _top_products_sql(approved),
        "cdc_latest_purchase": feed + "purchase",
        "cdc_latest_item": feed + "item",
        "cdc_latest_extra": feed + "extra",
        "valid_purchase": feed + "valid",
        "consolidated_purchase": _consolidated_sql("FULL"),
        "consolidated_purchase_left": _consolidated_sql("LEFT"),
        "gmv_daily_by_subsidiary": feed + "daily",
        "gmv_daily_by_subsidiary_outer": feed + "daily",
        "gmv_daily_approved": f"WITH {_feeds_sql(approved=True)} SELECT * FROM daily",
        "gmv_layers": feed + "daily",
        "gmv_layers_approved": f"WITH {_feeds_sql(approved=True)} SELECT * FROM daily",
        "gmv_layers_refreshed": feed + "daily",
        "gmv_layers_refreshed_purchase": feed + "valid",
        "gmv_layers_refreshed_item": feed + "item",
        "gmv_layers_refreshed_bronze": f"""
            SELECT ts AS transaction_datetime, CAST(ts AS DATE) AS transaction_date, {_PURCHASE_ID} AS purchase_id,
                   CASE WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) % 2 = 0 THEN 'nacional'
                   ELSE 'internacional' END AS subsidiary
            FROM events WHERE event_type = 'view'
        """,
        "gmv_late_days": feed + late_days,
        "gmv_late_days_kept": f"""
            WITH {_feeds_sql("first_", FIRST_UNTIL)}, {_feeds_sql()},
            counted AS ({_counted_sql()}), first_counted AS ({_counted_sql("first_")}),
            changed AS ((TABLE counted EXCEPT TABLE first_counted) UNION (TABLE first_counted EXCEPT TABLE counted))
            SELECT * FROM daily WHERE transaction_date IN (SELECT gmv_date FROM changed)
        """,
        "gmv_daily_kept": feed + "daily",
        "gmv_scd2_initial": initial,
        "gmv_scd2_merge": _on_history_sql(full),
        "gmv_scd2_merge_reference": _on_history_sql(full, "reference"),
        "gmv_scd2_load": _on_history_sql(full),
        "gmv_scd2_load_recovered": _on_history_sql(full),
        "gmv_scd2_load_recovered_reference": _on_history_sql(full, "reference"),
        "gmv_scd2_load_reference": _on_history_sql(full, "reference"),
        "gmv_scd2_stream": _on_history_sql(full),
        "gmv_scd2_stream_kept": _on_history_sql(full),
        "gmv_scd2_stream_state": _on_history_sql(full),
        "gmv_current": _on_history_sql(current),
        "gmv_current_full": _on_history_sql(full + " WHERE is_current"),
        "gmv_current_reference": _on_history_sql(current, "reference"),
        "gmv_period": _on_history_sql(period.format(in_period)),
        "gmv_period_current": _on_history_sql(period.format(f"{in_period} AND is_current")),
        "gmv_period_reference": _on_history_sql(period.format(in_period), "reference"),
        "gmv_as_of": _on_history_sql(f"{full} WHERE DATE '{PAST_DAY}' BETWEEN valid_from AND valid_to"),
        "gmv_known": _on_history_sql(f"SELECT as_of, history.* FROM history JOIN {_DAYS} ON {valid}"),
        "gmv_known_totals": _on_history_sql(
            f"SELECT as_of, subsidiary, round(sum(gmv_daily), 2) AS gmv FROM history JOIN {_DAYS} ON {valid} GROUP BY ALL"
        ),
        "gmv_known_at_correction": _on_history_sql(f"""
            SELECT purchase_id, as_of AS arrived, transaction_date, subsidiary, gmv_daily
            FROM (SELECT {_PURCHASE_ID} AS purchase_id, CAST(ts AS DATE) AS as_of,
                         lag(CASE WHEN event_id % 5 <> 0 THEN CAST(ts AS DATE) END) OVER (
                             PARTITION BY {_PURCHASE_ID} ORDER BY ts) AS released
                  FROM events WHERE event_type IN ('purchase', 'signup'))
            JOIN history ON transaction_date = released AND {valid}
        """),
        "gmv_scd2_first_load_recovered": initial,
        "gmv_scd2_first_load_recovered_reference": initial,
        "gmv_history_loads": _after_each_load_sql("single_pass"),
        "gmv_history_loads_reference": _after_each_load_sql("reference"),
        "gmv_as_known_loads": _after_each_load_sql("single_pass", f"DATE '{KNOWN_DAY}' BETWEEN valid_from AND valid_to"),
        "gmv_history_audit_loads": _audit_sql("single_pass"),
        "gmv_history_audit_loads_reference": _audit_sql("reference"),
    }
