"""Late and corrected records: what is recomputed equals a full recomputation."""

import random
import uuid
from datetime import date, datetime

import pytest

from fixtures import CUTOFFS, bag, feeds
from test_scd2 import plain
from vendaria import schemas
from vendaria.operators.cdc import Feeds
from vendaria.operators.gmv import gmv_current, gmv_daily
from vendaria.operators.scd2 import scd2_merge, stamp
from vendaria.plans.reprocess import reprocess
from vendaria.sources.catalog import read_table
from vendaria.sources.files import from_rows
from vendaria.streaming.feeds import append_batch, read_store, stream_gmv, tagged, untagged

SCHEMAS = {
    "purchase": schemas.PURCHASE_FEED,
    "product_item": schemas.PRODUCT_ITEM_FEED,
    "extra_info": schemas.EXTRA_INFO_FEED,
}
LOADED = [date(2023, 2, 1), date(2023, 2, 27), date(2023, 3, 1), date(2023, 4, 1), date(2023, 8, 1)]
TS = datetime(2023, 8, 1)


def deliver(parts, landing):
    for name, df in parts._asdict().items():
        df.write.mode("append").parquet(f"{landing}/{name}")


def run(spark, base, table, days):
    arriving = Feeds(*[spark.readStream.schema(SCHEMAS[n]).parquet(f"{base}/landing/{n}") for n in Feeds._fields])
    query = stream_gmv(
        arriving,
        table,
        f"{base}/records",
        f"{base}/checkpoint",
        as_of=lambda batch: days[batch],
        load_ts=lambda batch: TS,
        location=f"{base}/db",
    )
    query.awaitTermination()
    assert query.exception() is None


def test_golden_feeds_arrive_in_five_deliveries(spark, tmp_path):
    database = f"test_{uuid.uuid4().hex}"
    table = f"{database}.gmv"
    after, expected = "0001-01-01 00:00:00", None
    try:
        for (until, _, daily), day in zip(CUTOFFS, LOADED):
            deliver(feeds(spark, until, after), f"{tmp_path}/landing")
            run(spark, tmp_path, table, LOADED)
            current = bag(gmv_current(read_table(spark, table)).collect())
            assert current == bag(daily)
            full = gmv_daily(feeds(spark, until))
            expected = stamp(full, day, TS) if expected is None else scd2_merge(expected, full, day, TS)
            expected = spark.createDataFrame(expected.collect(), schemas.GMV_HISTORY)
            after = until
        assert plain(read_table(spark, table)) == plain(expected)
        before = plain(read_table(spark, table))
        run(spark, tmp_path, table, LOADED)  # nothing new
        assert plain(read_table(spark, table)) == before

        # The last batch was done but not recorded as such: it runs again and changes nothing.
        for name in ("4", ".4.crc"):
            (tmp_path / "checkpoint" / "commits" / name).unlink(missing_ok=True)
        stored = read_store(spark, f"{tmp_path}/records", tagged(feeds(spark)).schema).count()
        run(spark, tmp_path, table, LOADED)
        assert (tmp_path / "checkpoint" / "commits" / "4").exists()
        assert plain(read_table(spark, table)) == before
        assert read_store(spark, f"{tmp_path}/records", tagged(feeds(spark)).schema).count() == stored == 13
        assert not any((tmp_path / "records-staging").iterdir())
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def random_feeds(spark, seed, n=600):
    rng = random.Random(seed)

    def moment(i):
        return f"2023-01-{1 + i * 27 // n:02d} {i % 24:02d}:{i // 24 % 60:02d}:{rng.randrange(60):02d}"

    def key():
        return 7 if rng.random() < 0.33 else rng.choice([None, *range(60)])

    def released():
        return rng.choice([None, *[f"2023-02-{d:02d}" for d in range(1, 13)]])

    purchase = [(moment(i), "2023-01-01", key(), 1, 1, "2023-01-01", released(), 1) for i in range(n)]
    item = [(moment(i), "2023-01-01", key(), 1, 1, rng.randrange(400) / 4) for i in range(n)]
    extra = [(moment(i), "2023-01-01", key(), rng.choice(["a", "b", None])) for i in range(n)]
    rows = (purchase, item, extra)

    def between(after, until):
        return Feeds(
            *[
                from_rows(spark, [r for r in part if after <= r[0] < until], SCHEMAS[name])
                for part, name in zip(rows, Feeds._fields)
            ]
        )

    return between


@pytest.mark.parametrize("limit", ["10m", "-1"])
def test_reprocessed_days_equal_a_full_recomputation(spark, tmp_path, limit):
    """With a hot and a missing id; with key lists that Spark broadcasts and with shuffled ones."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        _compare_reprocessed(spark, tmp_path)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _compare_reprocessed(spark, tmp_path):
    between = random_feeds(spark, 1)
    cut, end = "2023-01-26 12:00:00", "2023-02-01"
    everything, late = between("", end), between(cut, end)
    changed = tagged(late).select("purchase_id")
    before = {tuple(r) for r in gmv_daily(between("", cut)).collect()}
    now = {tuple(r) for r in gmv_daily(everything).collect()}

    daily, days = reprocess(everything, changed, str(tmp_path))
    days = {r[0] for r in days.collect()}
    assert {r[0] for r in before ^ now} <= days
    assert {tuple(r) for r in daily.collect()} == {r for r in now if r[0] in days}


def test_few_changes_touch_few_days(spark, tmp_path):
    seen = feeds(spark)
    _, days = reprocess(seen, spark.createDataFrame([(69,), (56,), (1000,)], "purchase_id bigint"), str(tmp_path))
    assert [str(r[0]) for r in days.collect()] == ["2023-02-28"]


def test_repeated_batch_replaces_itself(spark, tmp_path):
    records = tagged(feeds(spark))
    for batch in (0, 1, 1):
        append_batch(records, batch, str(tmp_path / "store"))
    stored = read_store(spark, str(tmp_path / "store"), records.schema)
    assert stored.count() == 2 * records.count()
    once = untagged(stored.filter("batch_id = 1"), SCHEMAS)
    for got, expected in zip(once, feeds(spark)):
        assert bag(got.collect()) == bag(expected.collect())
