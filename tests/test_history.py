"""The stored history: created, merged into, interrupted."""

import re
import uuid
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fixtures import bag
from test_scd2 import NEW, OPEN, SOURCE, TARGET, TS, history, plain, source
from vendaria import schemas
from vendaria.operators.gmv import gmv_current, gmv_period
from vendaria.operators.quality import not_null, quality_gate, unique
from vendaria.operators.scd2 import scd2_merge, stamp
from vendaria.plans import history as plans
from vendaria.plans.history import load_gmv
from vendaria.sources.catalog import create_table_from, ensure_gmv_table, read_table, table_exists

D = date.fromisoformat


@pytest.fixture
def table(spark, tmp_path):
    database = f"test_{uuid.uuid4().hex}"
    yield f"{database}.fact_gmv_daily_scd2"
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def files(spark, table):
    """Data files by partition directory."""
    found = {}
    for row in spark.table(table).select(F.input_file_name().alias("f")).distinct().collect():
        path = Path(row.f)
        found.setdefault(path.parent.name, set()).add(path.name)
    return found


def test_ddl(spark, table):
    ensure_gmv_table(spark, table)
    ensure_gmv_table(spark, table)
    assert table_exists(spark, table)
    columns = {c.name: c for c in spark.catalog.listColumns(table)}
    assert {n: c.dataType for n, c in columns.items()} == {
        f.name: f.dataType.simpleString() for f in schemas.GMV_HISTORY
    }
    assert [n for n, c in columns.items() if c.isPartition] == ["transaction_date"]
    assert all(c.description for c in columns.values())
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    assert described["Comment"] and described["Provider"].lower() == "parquet"


def test_create_from_data(spark, table):
    spark.sql(f"CREATE DATABASE {table.split('.')[0]}")
    create_table_from(history(spark, TARGET), table, "transaction_date")
    assert plain(read_table(spark, table)) == bag(TARGET)


@pytest.mark.parametrize("mode", ["single_pass", "reference"])
def test_first_load_and_merge(spark, table, tmp_path, mode):
    first = [("2023-01-20", "nacional", 50.0), ("2023-02-28", None, 10.0), ("2023-02-27", "gone", 7.0), ("2023-02-26", "same", 8.0)]
    load_gmv(spark, source(spark, first), table, D("2023-03-01"), TS, mode, location=str(tmp_path / "db"))
    assert plain(read_table(spark, table)) == bag((*r, "2023-03-01", OPEN, True) for r in first)
    before = files(spark, table)
    expected = plain(scd2_merge(read_table(spark, table), source(spark, NEW), D("2023-03-02"), TS, mode))

    load_gmv(spark, source(spark, NEW), table, D("2023-03-02"), TS, mode)
    assert plain(read_table(spark, table)) == expected
    after = files(spark, table)
    same = {"transaction_date=2023-02-26"}
    same |= {"transaction_date=2023-02-28"} if mode == "single_pass" else {"transaction_date=2023-02-27"}
    assert {day for day in before if before[day] == after[day]} == same


def test_repeated_load_touches_nothing(spark, table):
    for _ in range(2):
        load_gmv(spark, source(spark, NEW), table, D("2023-03-02"), TS)
        seen = files(spark, table)
    load_gmv(spark, source(spark, NEW), table, D("2023-03-05"), datetime(2023, 3, 5))
    assert files(spark, table) == seen


def test_emptied_day_is_dropped(spark, table):
    load_gmv(spark, source(spark, NEW), table, D("2023-03-02"), TS)
    load_gmv(spark, source(spark, NEW[1:]), table, D("2023-03-02"), TS)
    assert plain(read_table(spark, table)) == bag((*r, "2023-03-02", OPEN, True) for r in NEW[1:])
    assert "transaction_date=2023-01-20" not in {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def test_a_day_missing_its_date_survives(spark, table):
    rows = [(None, "a", 1.0), (D("2023-01-01"), "a", 2.0)]
    load_gmv(spark, spark.createDataFrame(rows, SOURCE), table, D("2023-03-01"), TS)
    load_gmv(spark, spark.createDataFrame([(None, "a", 3.0), rows[1]], SOURCE), table, D("2023-03-02"), TS)
    assert plain(read_table(spark, table)) == bag(
        [
            ("None", "a", 1.0, "2023-03-01", "2023-03-01", False),
            ("None", "a", 3.0, "2023-03-02", OPEN, True),
            ("2023-01-01", "a", 2.0, "2023-03-01", OPEN, True),
        ]
    )


def test_an_emptied_day_without_date_is_dropped(spark, table):
    rows = [(None, "a", 1.0), (D("2023-01-01"), "a", 2.0)]
    load_gmv(spark, spark.createDataFrame(rows, SOURCE), table, D("2023-03-01"), TS)
    load_gmv(spark, spark.createDataFrame(rows[1:], SOURCE), table, D("2023-03-01"), TS)
    assert plain(read_table(spark, table)) == [("2023-01-01", "a", 2.0, "2023-03-01", OPEN, True)]


def test_load_of_some_days_leaves_the_others(spark, table):
    load_gmv(spark, source(spark, NEW), table, D("2023-03-01"), TS)
    days = spark.createDataFrame([(D("2023-01-20"),), (D("2023-02-28"),)], "transaction_date date")
    load_gmv(spark, source(spark, [("2023-02-28", None, 11.0)]), table, D("2023-03-02"), TS, days=days)
    assert plain(read_table(spark, table)) == bag(
        [
            ("2023-01-20", "nacional", 55.0, "2023-03-01", "2023-03-01", False),
            ("2023-02-28", None, 10.0, "2023-03-01", "2023-03-01", False),
            ("2023-02-28", None, 11.0, "2023-03-02", OPEN, True),
            *[(*r, "2023-03-01", OPEN, True) for r in NEW[2:]],
        ]
    )


def interrupted(spark, monkeypatch, rows, table, day, mode="single_pass", half=False):
    """A load that dies after staging, or after it has lost one day of the table."""

    def dies(session, path, name):
        if half:
            spark.sql(f"ALTER TABLE {name} DROP PARTITION (transaction_date = DATE'2023-01-20')")
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(plans, "_replace_days", dies)
        with pytest.raises(RuntimeError):
            load_gmv(spark, source(spark, rows), table, D(day), TS, mode)


def nothing_staged(spark, table):
    return not Path(plans._staging(spark, table).removeprefix("file:")).exists()


@pytest.mark.parametrize("mode", ["single_pass", "reference"])
@pytest.mark.parametrize("half", [True, False])
def test_interrupted_load_is_finished_by_its_repetition(spark, table, monkeypatch, mode, half):
    """The table loses a partition half-way; the staged rows bring it back with its closed versions."""
    load_gmv(spark, source(spark, [("2023-01-20", "nacional", 50.0)]), table, D("2023-03-01"), TS, mode)
    expected = plain(scd2_merge(read_table(spark, table), source(spark, NEW), D("2023-03-02"), TS, mode))
    interrupted(spark, monkeypatch, NEW, table, "2023-03-02", mode, half)
    assert plain(read_table(spark, table)) != expected
    load_gmv(spark, source(spark, NEW), table, D("2023-03-02"), TS, mode)
    assert plain(read_table(spark, table)) == expected
    assert nothing_staged(spark, table)


@pytest.mark.parametrize("mode", ["single_pass", "reference"])
def test_another_load_finishes_the_interrupted_one_and_does_its_own(spark, table, monkeypatch, mode):
    load_gmv(spark, source(spark, NEW[:1]), table, D("2023-03-01"), TS, mode)
    expected = scd2_merge(read_table(spark, table), source(spark, NEW[:3]), D("2023-03-02"), TS, mode)
    expected = plain(scd2_merge(expected, source(spark, NEW[1:]), D("2023-03-03"), TS, mode))
    interrupted(spark, monkeypatch, NEW[:3], table, "2023-03-02", mode)
    load_gmv(spark, source(spark, NEW[1:]), table, D("2023-03-03"), TS, mode)
    assert plain(read_table(spark, table)) == expected
    assert nothing_staged(spark, table)


@pytest.mark.parametrize("second", ["days", "all"])
def test_a_load_of_other_days_is_not_taken_for_the_interrupted_one(spark, table, monkeypatch, second):
    """Same day, time and mode: only the days differ."""
    load_gmv(spark, source(spark, NEW[:1]), table, D("2023-03-01"), TS)
    of = {d: spark.createDataFrame([(D(d),)], "transaction_date date") for d in ("2023-02-01", "2023-02-02")}
    one, two = ("2023-02-01", "a", 1.0), ("2023-02-02", "b", 2.0)
    with monkeypatch.context() as patch:
        patch.setattr(plans, "_replace_days", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            load_gmv(spark, source(spark, [one]), table, D("2023-03-02"), TS, days=of["2023-02-01"])
    days = of["2023-02-02"] if second == "days" else None
    load_gmv(spark, source(spark, [two]), table, D("2023-03-02"), TS, close_missing=False, days=days)
    found = {r[:3] for r in plain(read_table(spark, table)) if r[-1]}
    assert {one, two} <= found
    assert nothing_staged(spark, table)


@pytest.mark.parametrize("mode", ["single_pass", "reference"])
@pytest.mark.parametrize("again", [True, False])
def test_a_finished_load_whose_files_were_left_is_not_applied_again(spark, table, monkeypatch, mode, again):
    load_gmv(spark, source(spark, [("2023-01-20", "nacional", 50.0)]), table, D("2023-03-01"), TS, mode)
    expected = scd2_merge(read_table(spark, table), source(spark, NEW), D("2023-03-02"), TS, mode)
    other = plain(scd2_merge(expected, source(spark, NEW[1:]), D("2023-03-03"), TS, mode))
    expected, discard = plain(expected), plans.discard

    def dies(session, path):
        if path.endswith("_SUCCESS"):
            raise RuntimeError("driver lost")
        discard(session, path)

    with monkeypatch.context() as patch:
        patch.setattr(plans, "discard", dies)
        with pytest.raises(RuntimeError):
            load_gmv(spark, source(spark, NEW), table, D("2023-03-02"), TS, mode)
    if again:
        load_gmv(spark, source(spark, NEW), table, D("2023-03-02"), TS, mode)
    else:
        load_gmv(spark, source(spark, NEW[1:]), table, D("2023-03-03"), TS, mode)
    assert plain(read_table(spark, table)) == (expected if again else other)
    assert nothing_staged(spark, table)


def test_staged_rows_of_an_older_table_are_dropped(spark, table, monkeypatch):
    """Load A is interrupted, its files are put back after B has changed the table: C must not bring A's rows in."""
    load_gmv(spark, source(spark, [("2023-01-20", "a", 1.0)]), table, D("2023-03-01"), TS)
    interrupted(spark, monkeypatch, [("2023-01-20", "a", 2.0)], table, "2023-03-02")
    staging = Path(plans._staging(spark, table).removeprefix("file:"))
    aside = staging.with_name("aside")
    staging.rename(aside)
    load_gmv(spark, source(spark, [("2023-01-20", "a", 3.0)]), table, D("2023-03-03"), TS)
    aside.rename(staging)
    load_gmv(spark, source(spark, [("2023-01-20", "a", 4.0)]), table, D("2023-03-04"), TS)
    assert plain(read_table(spark, table)) == bag(
        [
            ("2023-01-20", "a", 1.0, "2023-03-01", "2023-03-02", False),
            ("2023-01-20", "a", 3.0, "2023-03-03", "2023-03-03", False),
            ("2023-01-20", "a", 4.0, "2023-03-04", OPEN, True),
        ]
    )
    assert nothing_staged(spark, table)


def test_half_staged_rows_are_not_used(spark, table, monkeypatch):
    load_gmv(spark, source(spark, NEW[:1]), table, D("2023-03-01"), TS)
    interrupted(spark, monkeypatch, NEW[1:], table, "2023-03-02")
    (Path(plans._staging(spark, table).removeprefix("file:")) / "manifest" / "_SUCCESS").unlink()
    load_gmv(spark, source(spark, NEW[:2]), table, D("2023-03-03"), TS)
    assert plain(read_table(spark, table)) == bag(
        [(*NEW[0], "2023-03-01", OPEN, True), (*NEW[1], "2023-03-03", OPEN, True)]
    )


def test_failing_check_stops_a_load_before_the_table_changes(spark, table):
    def checks(rows):
        return quality_gate(not_null(rows, ["gmv_daily"]), unique(rows, ["transaction_date", "subsidiary"]))

    bad = [("2023-01-20", "a", None)]
    with pytest.raises(ValueError, match="gmv_daily"):
        load_gmv(spark, source(spark, bad), table, D("2023-03-01"), TS, checks=checks)
    assert not table_exists(spark, table)
    load_gmv(spark, source(spark, NEW), table, D("2023-03-01"), TS, checks=checks)
    before = plain(read_table(spark, table))
    with pytest.raises(ValueError, match="gmv_daily"):
        load_gmv(spark, source(spark, [*NEW, *bad]), table, D("2023-03-02"), TS, checks=checks)
    assert plain(read_table(spark, table)) == before


def test_days_of_a_load_prune_the_history(spark, table, monkeypatch):
    load_gmv(spark, source(spark, NEW), table, D("2023-03-01"), TS)
    read = []
    current = plans.current_of
    monkeypatch.setattr(plans, "current_of", lambda history: read.append(history) or current(history))
    days = spark.createDataFrame([(D("2023-02-28"),)], "transaction_date date")
    load_gmv(spark, source(spark, [("2023-02-28", None, 11.0)]), table, D("2023-03-02"), TS, days=days)
    assert re.search(r"PartitionFilters: \[[^]]*transaction_date", read[0]._jdf.queryExecution().executedPlan().toString())


def test_overwrite_mode_of_the_session_is_restored(spark, table):
    load_gmv(spark, source(spark, NEW), table, D("2023-03-02"), TS)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_period_reads_its_partitions_only(spark, table):
    load_gmv(spark, source(spark, NEW), table, D("2023-03-02"), TS)
    read = gmv_period(read_table(spark, table), "2023-02-01", "2023-02-28")
    assert "PartitionFilters: [isnotnull(transaction_date" in read._jdf.queryExecution().executedPlan().toString()
    assert len(read.inputFiles()) >= 2 and read.count() == 2


def test_sql_reads_the_stored_table(spark, table):
    load_gmv(spark, source(spark, NEW), table, D("2023-03-02"), TS)
    current = spark.sql(
        f"SELECT transaction_date, subsidiary, gmv_daily FROM {table} "
        "WHERE is_current = true AND transaction_date IS NOT NULL ORDER BY transaction_date, subsidiary"
    )
    assert [(str(r[0]), r[1], r[2]) for r in current.collect()] == sorted(NEW)
    assert bag(gmv_current(read_table(spark, table)).collect()) == bag(current.collect())


def test_stamp_types(spark):
    assert stamp(source(spark, NEW), "2023-03-02", TS).schema.simpleString() == schemas.GMV_HISTORY.simpleString()
