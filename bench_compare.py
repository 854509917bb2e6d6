"""The library against the same questions as plain Spark SQL, on the same tables and session.

Both break ties the same way, add amounts as decimals and round. The plain text ranks all columns of a feed in a
window. `BENCH_SF_DIR` and `BENCH_CPUS` as in `bench.py`; prints one line per query and table size limit
for broadcasts (the session's default, and none, which is how large tables are planned).
"""

from __future__ import annotations

import os
import tempfile
import time

from pyspark.sql import SparkSession

from vendaria.operators.cdc import Feeds
from vendaria.operators.gmv import gmv_daily
from vendaria.plans.sales import top_producers, top_products_per_producer
from vendaria.sources import star

# The questions that the library answers, ties, rounding and exact sums included, as one would first write them.
_LATEST = """
    SELECT * EXCEPT (place) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY purchase_id ORDER BY transaction_datetime DESC NULLS LAST, {ties}) AS place FROM {feed}
    ) WHERE place = 1
"""

_SOLD = """
    SELECT p.producer_id, i.product_id, p.order_date,
           CAST(i.purchase_value * i.item_quantity AS DECIMAL(24, 8)) AS amount
    FROM item i JOIN purchase p
      ON p.prod_item_partition = i.prod_item_partition AND p.prod_item_id = i.prod_item_id
     AND p.release_date IS NOT NULL
"""

PLAIN = {
    "top_producers": f"""
        WITH sold AS ({_SOLD})
        SELECT producer_id, CAST(round(sum(amount), 2) AS DOUBLE) AS total_sale
        FROM sold WHERE year(order_date) = 1997
        GROUP BY producer_id ORDER BY total_sale DESC NULLS LAST, producer_id LIMIT 50
    """,
    "top_products_per_producer": f"""
        WITH sold AS ({_SOLD}),
        totals AS (
            SELECT producer_id, product_id, CAST(round(sum(amount), 2) AS DOUBLE) AS total_sales
            FROM sold GROUP BY ALL
        ),
        places AS (
            SELECT *, row_number() OVER (
                PARTITION BY producer_id ORDER BY total_sales DESC NULLS LAST, product_id) AS rank_sales
            FROM totals
        )
        SELECT * FROM places WHERE rank_sales < 3 ORDER BY producer_id, rank_sales
    """,
    "gmv_daily_by_subsidiary": f"""
        WITH sale AS ({_LATEST.format(feed="purchase_feed", ties="release_date DESC NULLS LAST")}),
        price AS ({_LATEST.format(feed="item_feed", ties="purchase_value DESC NULLS LAST")}),
        place AS ({_LATEST.format(feed="extra_feed", ties="subsidiary DESC NULLS LAST")})
        SELECT sale.release_date AS transaction_date, place.subsidiary,
               CAST(round(sum(CAST(price.purchase_value AS DECIMAL(24, 8))), 2) AS DOUBLE) AS gmv_daily
        FROM sale LEFT JOIN price USING (purchase_id) LEFT JOIN place USING (purchase_id)
        WHERE sale.release_date IS NOT NULL
        GROUP BY ALL
    """,
}


def _seconds(make, runs: int = 5) -> float:
    times = []
    for _ in range(runs + 2):
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - start)
    return sorted(times[2:])[runs // 2]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="vendaria-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    feeds = star.feeds(spark, sf_dir)
    views = {
        "purchase": star.purchase(spark, sf_dir),
        "item": star.product_item(spark, sf_dir),
        "purchase_feed": feeds.purchase,
        "item_feed": feeds.product_item,
        "extra_feed": feeds.extra_info,
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    tables = {name: spark.table(name) for name in views}
    feeds = Feeds(tables["purchase_feed"], tables["item_feed"], tables["extra_feed"])
    library = {
        "top_producers": lambda: top_producers(tables["purchase"], tables["item"], 1997),
        "top_products_per_producer": lambda: top_products_per_producer(tables["purchase"], tables["item"]),
        "gmv_daily_by_subsidiary": lambda: gmv_daily(feeds),
    }
    default = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for limit in (default, "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        for name, text in PLAIN.items():
            plain = _seconds(lambda text=text: spark.sql(text))
            ours = _seconds(library[name])
            print(f"{name:28s} broadcast limit {limit:>10s}  plain {plain:.3f} s  library {ours:.3f} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
