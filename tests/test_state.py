"""The kept state: a batch gives what a full recomputation would, and reads what it touches."""

import random
import uuid
from datetime import date, datetime
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fixtures import CUTOFFS, bag, feeds
from test_scd2 import plain
from test_stream import LOADED, SCHEMAS, TS, deliver, random_feeds
from vendaria import schemas
from vendaria.operators.cdc import Feeds
from vendaria.operators.gmv import gmv_current, gmv_daily
from vendaria.operators.scd2 import scd2_merge, stamp
from vendaria.plans import state as plans
from vendaria.plans.state import Kept, Rules, apply_batch, daily_totals, newest
from vendaria.sources.catalog import read_table
from vendaria.sources.parts import read_all_parts
from vendaria.streaming.feeds import stream_gmv
from vendaria.streaming.state import Version, _micros, counted, stream_gmv_by_state

CUTS = ["", "2023-01-03", "2023-01-12", "2023-01-26 12:00:00", "2023-02-01"]


def with_status(parts):
    status = F.when(F.col("purchase_id") % 3 == 0, "Pendente").otherwise("Aprovado")
    return parts._replace(purchase=parts.purchase.withColumn("status", status))


def union(parts):
    return Feeds(*[reduce(DataFrame.unionByName, frames) for frames in zip(*parts)])


@pytest.mark.parametrize("rules", [Rules(), Rules("status", "Aprovado", True, None)])
def test_batches_in_any_order_equal_a_full_recomputation(spark, tmp_path, rules):
    """Later records come first, some twice; with a hot and a missing id."""
    between = random_feeds(spark, 3, 300)
    batches = [with_status(between(a, b)) for a, b in zip(CUTS, CUTS[1:])]
    random.Random(1).shuffle(batches)
    batches.append(batches[0])
    kept = Kept(str(tmp_path), rules, ids_per_block=7)
    options = {"status_col": rules.status_col, "multiply_quantity": rules.multiply_quantity, "scale": rules.scale}
    before = set()
    for number, batch in enumerate(batches):
        daily, days = apply_batch(spark, batch, kept, number)
        now = {tuple(r) for r in gmv_daily(union(batches[: number + 1]), **options).collect()}
        days = {r[0] for r in days.collect()}
        assert {r[0] for r in before ^ now} <= days
        assert {tuple(r) for r in daily.collect()} == {r for r in now if r[0] in days}
        assert {tuple(r) for r in daily_totals(spark, kept).collect()} == now
        before = now
    assert not days  # the last batch brought nothing new


@pytest.mark.parametrize("dies_in", ["by_id", "totals", "nowhere"])
def test_a_repeated_batch_starts_from_the_same_state(spark, tmp_path, monkeypatch, dies_in):
    between = random_feeds(spark, 5, 200)
    first, second, third = (between(a, b) for a, b in zip([CUTS[0], *CUTS[2:4]], [*CUTS[2:4], CUTS[4]]))
    kept = Kept(str(tmp_path), ids_per_block=5)
    apply_batch(spark, first, kept, 0)
    write = plans.write_parts

    def dies(rows, path, part_col, batch_id):
        write(rows, path, part_col, batch_id)
        if path.endswith(dies_in):
            raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(plans, "write_parts", dies)
        if dies_in == "nowhere":
            apply_batch(spark, second, kept, 1)
        else:
            with pytest.raises(RuntimeError):
                apply_batch(spark, second, kept, 1)
    daily, days = apply_batch(spark, second, kept, 1)
    now = {tuple(r) for r in gmv_daily(union([first, second])).collect()}
    days = {r[0] for r in days.collect()}
    assert days and {tuple(r) for r in daily.collect()} == {r for r in now if r[0] in days}
    apply_batch(spark, third, kept, 2)
    everything = {tuple(r) for r in gmv_daily(union([first, second, third])).collect()}
    assert {tuple(r) for r in daily_totals(spark, kept).collect()} == everything


def purchases(spark, ids, moment, released):
    n = spark.range(*ids).withColumnRenamed("id", "purchase_id")
    time = F.lit(datetime.fromisoformat(moment))
    released = F.date_add(F.lit(date.fromisoformat(released)), (F.col("purchase_id") % 3).cast("int"))
    return Feeds(
        n.select("purchase_id", time.alias("transaction_datetime"), released.alias("release_date")),
        n.select("purchase_id", time.alias("transaction_datetime"), F.lit(2.5).alias("purchase_value")),
        n.select("purchase_id", time.alias("transaction_datetime"), F.lit("a").alias("subsidiary")),
    )


def test_a_batch_reads_as_much_of_a_store_twice_as_large(spark, tmp_path, monkeypatch):
    read = {}
    original = plans.read_parts

    def recorded(spark, path, *rest):
        rows = original(spark, path, *rest)
        base, _, name = path.rpartition("/")
        read.setdefault(base, {})[name] = (rows.count(), rows.inputFiles())
        return rows

    monkeypatch.setattr(plans, "read_parts", recorded)
    for size in (4000, 8000):
        kept = Kept(str(tmp_path / str(size)), ids_per_block=1000)
        apply_batch(spark, purchases(spark, (0, size), "2023-01-01", "2023-02-01"), kept, 0)
        daily, days = apply_batch(spark, purchases(spark, (1500, 1510), "2023-03-01", "2023-02-02"), kept, 1)
        assert sorted(str(r[0]) for r in days.collect()) == ["2023-02-01", "2023-02-02", "2023-02-03", "2023-02-04"]
        by_id = read[kept.path]["by_id"]
        assert by_id[0] == 1000 and all("/block=1/batch=0/" in f for f in by_id[1])
        assert read[kept.path]["totals"][0] == 3
    small, large = read.values()
    assert {k: v[0] for k, v in small.items()} == {k: v[0] for k, v in large.items()}


def test_older_parts_go_and_untouched_ones_stay(spark, tmp_path):
    kept = Kept(str(tmp_path), ids_per_block=10)
    for number in range(4):
        ids = (0, 20) if number == 0 else (0, 5)
        apply_batch(spark, purchases(spark, ids, f"2023-01-0{number + 1}", f"2023-02-0{number + 1}"), kept, number)
    found = {b.name: sorted(x.name for x in b.iterdir()) for b in (tmp_path / "by_id").glob("block=*")}
    assert found == {"block=0": ["batch=2", "batch=3"], "block=1": ["batch=0"]}


def test_blocks_in_a_row_share_a_folder(spark, tmp_path):
    """Where a batch has most of 64; what it has of others is in their own folders, and the newer of both counts."""
    kept = Kept(str(tmp_path / "kept"), ids_per_block=2)
    folder, batches = tmp_path / "kept" / "by_id", []
    for number, ids in enumerate([(-10, 400), (0, 4), (0, 100), (2, 6), (128, 140), (-2, 2)]):
        records = purchases(spark, ids, f"2023-01-{number + 1:02d}", f"2023-02-{number + 1:02d}")
        if number == 0:
            nobody = records.purchase.filter("purchase_id = 7").withColumn("purchase_id", F.lit(None).cast("long"))
            records = records._replace(purchase=records.purchase.unionByName(nobody))
        batches.append(records)
        apply_batch(spark, records, kept, number)
        now = {tuple(r) for r in gmv_daily(union(batches)).collect()}
        assert {tuple(r) for r in daily_totals(spark, kept).collect()} == now
        if number == 0:
            names = sorted(x.name for x in folder.iterdir() if "=" in x.name)
            alone = [f"block={b}" for b in (*range(-5, 0), *range(192, 200), "__HIVE_DEFAULT_PARTITION__")]
            assert set(names) == {*alone, "span=0", "span=1", "span=2"}
    assert sorted(x.name for x in (folder / "span=0").iterdir()) == ["batch=2"]
    stored = newest(batches[0], kept.rules).withColumn(plans.BLOCK, kept.block())
    rows = read_all_parts(spark, str(folder), stored.schema, plans.BLOCK)
    assert rows.count() == 411 and rows.select("purchase_id").distinct().count() == 411
    some = plans.read_parts(spark, str(folder), stored.schema, plans.BLOCK, [0, 1, 2, 3, 64, None], 9)
    assert {r[0] for r in some.select("purchase_id").collect()} == {None, -1, *range(8), 128, 129} and some.count() == 12


def test_many_blocks_apart_share_the_folders_of_their_spans(spark, tmp_path):
    """Of spans that a batch has little of; each block's newest rows count, wherever they are, and older folders go."""
    kept = Kept(str(tmp_path / "kept"), ids_per_block=2)
    folder, batches = tmp_path / "kept" / "by_id", []
    folders = lambda: sorted(f"{x.name}/{b.name}" for x in folder.iterdir() if "=" in x.name for b in x.iterdir())
    for number, (ids, step) in enumerate([((-300, 600), 6), ((0, 50), 1), ((-256, 700), 6), ((6, 8), 1), ((-300, 600), 6), ((-300, 600), 6)]):
        records = purchases(spark, ids, f"2023-01-{number + 1:02d}", f"2023-02-{number + 1:02d}")
        of_step = lambda p: p.filter(f"purchase_id % {step} = 0")  # noqa: B023, E731
        records = Feeds(*[of_step(p) for p in records])
        if number == 0:
            nobody = records.purchase.limit(1).withColumn("purchase_id", F.lit(None).cast("long"))
            records = records._replace(purchase=records.purchase.unionByName(nobody))
        batches.append(records)
        for _ in range(1 + (number == 2)):  # repeated, it replaces its own
            apply_batch(spark, records, kept, number)
        now = {tuple(r) for r in gmv_daily(union(batches)).collect()}
        assert {tuple(r) for r in daily_totals(spark, kept).collect()} == now
        stored = newest(batches[0], kept.rules).withColumn(plans.BLOCK, kept.block())
        rows = read_all_parts(spark, str(folder), stored.schema, plans.BLOCK).drop(plans.BLOCK)
        assert bag(rows.collect()) == bag(newest(union(batches), kept.rules).collect())
        if number == 0:
            assert folders() == sorted(["block=__HIVE_DEFAULT_PARTITION__/batch=0", *[f"some={s}/batch=0" for s in range(-3, 5)]])
    assert {f"some={s}/batch=4" for s in range(-3, 5)} < set(folders())
    assert not {f"some={s}/batch=0" for s in range(-3, 5)} & set(folders())
    some = plans.read_parts(spark, str(folder), stored.schema, plans.BLOCK, [0, 1, 3, 5, 6, 349, -150, None], 9)
    assert {r[0] for r in some.select("purchase_id").collect()} == {None, 0, 1, 2, 3, 6, 7, 10, 11, 12, 13, 698, -300} - {698}


def test_an_empty_batch_changes_nothing(spark, tmp_path):
    kept = Kept(str(tmp_path))
    nothing = Feeds(*[p.limit(0) for p in purchases(spark, (0, 1), "2023-01-01", "2023-02-01")])
    daily, days = apply_batch(spark, nothing, kept, 0)
    assert daily.count() == 0 and days.count() == 0
    assert daily_totals(spark, kept).count() == 0


def kept_files(spark, arriving, base, table, options):
    kept = Kept(f"{base}/kept", ids_per_block=20)
    return stream_gmv(arriving, table, f"{base}/records", f"{base}/checkpoint", kept=kept, **options)


def kept_in_stream(spark, arriving, base, table, options):
    return stream_gmv_by_state(arriving, table, Kept(f"{base}/kept"), f"{base}/checkpoint", **options)


@pytest.fixture
def table(spark):
    database = f"test_{uuid.uuid4().hex}"
    yield f"{database}.gmv"
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def run(spark, start, base, table, days=LOADED):
    arriving = Feeds(*[spark.readStream.schema(SCHEMAS[n]).parquet(f"{base}/landing/{n}") for n in Feeds._fields])
    options = {"as_of": lambda b: days[b], "load_ts": lambda b: TS, "location": f"{base}/db"}
    query = start(spark, arriving, base, table, options)
    query.awaitTermination()
    assert query.exception() is None


@pytest.mark.parametrize("start", [kept_files, kept_in_stream])
def test_streams_with_kept_state(spark, tmp_path, table, start):
    """The golden feeds in five deliveries, each by a query that starts from the checkpoint; the last is repeated."""
    after, expected = "0001-01-01 00:00:00", None
    for (until, _, daily), day in zip(CUTOFFS, LOADED):
        deliver(feeds(spark, until, after), f"{tmp_path}/landing")
        run(spark, start, tmp_path, table)
        assert bag(gmv_current(read_table(spark, table)).collect()) == bag(daily)
        full = gmv_daily(feeds(spark, until))
        expected = stamp(full, day, TS) if expected is None else scd2_merge(expected, full, day, TS)
        expected = spark.createDataFrame(expected.collect(), schemas.GMV_HISTORY)
        after = until
    assert plain(read_table(spark, table)) == plain(expected)
    for name in ("4", ".4.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    run(spark, start, tmp_path, table)
    assert plain(read_table(spark, table)) == plain(expected)
    assert not any((tmp_path / "kept" / "staging").iterdir())


def test_late_and_repeated_records_in_the_stream_s_state(spark, tmp_path, table):
    """Newest records first, then older and equal ones; with a hot and a missing id and times that are the same."""
    between = random_feeds(spark, 9, 150)
    batches = [between(a, b) for a, b in zip(CUTS, CUTS[1:])]
    for batch in (batches[3], batches[1], union([batches[0], batches[1]])):
        deliver(batch, f"{tmp_path}/landing")
        run(spark, kept_in_stream, tmp_path, table, [date(2024, 1, d) for d in range(1, 9)])
    now = gmv_daily(union([batches[3], batches[1], batches[0]]))
    assert bag(gmv_current(read_table(spark, table)).collect()) == bag(now.collect())


def test_the_stream_s_state_groups_ids(spark, tmp_path, table):
    """A group for each id would cost a call for each."""
    deliver(purchases(spark, (0, 1000), "2023-01-01", "2023-02-01"), f"{tmp_path}/landing")
    deliver(purchases(spark, (500, 510), "2023-01-02", "2023-02-02"), f"{tmp_path}/landing")
    types = {n: df.schema for n, df in purchases(spark, (0, 1), "2023-01-01", "2023-02-01")._asdict().items()}
    arriving = Feeds(*[spark.readStream.schema(types[n]).parquet(f"{tmp_path}/landing/{n}") for n in Feeds._fields])
    options = {"as_of": lambda b: LOADED[b], "load_ts": lambda b: TS, "location": f"{tmp_path}/db"}
    query = kept_in_stream(spark, arriving, tmp_path, table, options)
    query.awaitTermination()
    assert sum(o["numRowsTotal"] for p in query.recentProgress[:1] for o in p["stateOperators"]) == 4
    found = gmv_current(read_table(spark, table))
    assert found.agg(F.sum("gmv_daily")).first()[0] == 2500.0


def test_versions_are_ordered_as_in_spark():
    versions = [Version(), Version(None, 1), Version(1), Version(1, None, 2), Version(1, 0, 2), Version(2)]
    assert sorted(versions[::-1], key=Version.order) == versions
    assert not counted(True, Version(5), Version(1, 2.0), Version(1, "a"), Rules()).counts
    assert counted(False, Version(5, 3), Version(1, 2.0), Version(1, "a"), Rules()) == (True, 3, None, None)


def test_times_without_a_zone(spark):
    times = ["1969-12-31 23:59:59.999999", "2024-03-31 02:30:00.000001", "9999-12-31 23:59:59"]
    rows = spark.createDataFrame([(t,) for t in times], "t string").selectExpr(
        "CAST(t AS TIMESTAMP_NTZ) AS ntz", "CAST(t AS TIMESTAMP) AS ltz"
    )
    for a, b in rows.select(_micros(rows, "ntz"), _micros(rows, "ltz")).collect():
        assert a == b  # the session is in UTC
