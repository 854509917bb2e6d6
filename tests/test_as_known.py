"""The history as earlier loads left it, first loads, and the audit of its versions."""

import uuid
from datetime import date, datetime

import pytest

from fixtures import bag
from test_scd2 import NEW, OPEN, history, plain, source
from vendaria import schemas
from vendaria.operators.gmv import gmv_as_of
from vendaria.operators.history_audit import audit_history
from vendaria.operators.scd2 import scd2_merge, stamp
from vendaria.plans import history as plans
from vendaria.plans.history import gmv_as_known, history_at, load_gmv, stage_gmv
from vendaria.sources.catalog import ensure_gmv_table, read_table

D = date.fromisoformat
LOADS = [
    ("2023-03-01", [("2023-01-20", "a", 50.0), ("2023-01-21", None, 1.0), ("2023-01-22", "gone", 2.0), ("2023-01-23", "b", None)]),
    ("2023-03-05", [("2023-01-20", "a", 55.0), ("2023-01-21", None, 3.0), ("2023-01-23", "b", None), ("2023-01-24", "a", 9.0)]),
    ("2023-03-05", [("2023-01-20", "a", 56.0), ("2023-01-21", None, 3.0), ("2023-01-23", "b", 4.0), ("2023-01-24", "a", 9.0)]),
    ("2023-03-09", [("2023-01-20", "a", 50.0), ("2023-01-22", "gone", 2.0)]),
]


def moment(n):
    return datetime(2023, 4, 1 + n, 6)


@pytest.fixture
def table(spark):
    database = f"test_{uuid.uuid4().hex}"
    yield f"{database}.gmv"
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def rows_of(df):
    return bag(df.select(*schemas.GMV_HISTORY.names).collect())


@pytest.mark.parametrize("mode", ["single_pass", "reference"])
def test_each_load_can_be_read_back(spark, table, mode):
    """With versions that are replaced on the day they were opened, and equal rows in the plain merge."""
    stored = []
    for n, (day, rows) in enumerate(LOADS):
        load_gmv(spark, source(spark, rows), table, D(day), moment(n), mode)
        stored.append(rows_of(read_table(spark, table)))
    for n, expected in enumerate(stored):
        assert rows_of(history_at(spark, table, n + 1)) == expected
        assert rows_of(history_at(spark, table, moment(n))) == expected
        for when in ("2023-02-28", "2023-03-04", "2023-03-08", "2023-03-09"):
            then = spark.createDataFrame(expected, schemas.GMV_HISTORY)
            assert rows_of(gmv_as_known(spark, table, when, n + 1)) == rows_of(gmv_as_of(then, when))
    assert history_at(spark, table, datetime(2023, 1, 1)).count() == 0
    assert rows_of(history_at(spark, table, datetime(2024, 1, 1))) == stored[-1]


def test_a_load_that_dies_is_logged_once(spark, table, monkeypatch):
    load_gmv(spark, source(spark, LOADS[0][1]), table, D(LOADS[0][0]), moment(0))
    log = plans._log

    def dies(*arguments):
        log(*arguments)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(plans, "_log", dies)
        with pytest.raises(RuntimeError):
            load_gmv(spark, source(spark, LOADS[1][1]), table, D(LOADS[1][0]), moment(1))
    load_gmv(spark, source(spark, LOADS[1][1]), table, D(LOADS[1][0]), moment(1))
    assert rows_of(history_at(spark, table, 2)) == rows_of(read_table(spark, table))
    assert history_at(spark, table, 1).count() == 4


def test_a_table_that_was_not_logged_says_so(spark, table):
    ensure_gmv_table(spark, table)
    with pytest.raises(ValueError, match="not logged"):
        history_at(spark, table, 1)


@pytest.mark.parametrize("mode", ["single_pass", "reference"])
def test_a_first_load_with_a_key_twice_is_refused(spark, table, mode):
    twice = [("2023-01-20", "a", 1.0), ("2023-01-20", "a", 2.0), ("2023-01-21", "b", 2.0)]
    with pytest.raises(Exception, match="key twice"):
        load_gmv(spark, source(spark, twice), table, D("2023-03-01"), moment(0), mode)
    assert read_table(spark, table).count() == 0
    load_gmv(spark, source(spark, twice[1:]), table, D("2023-03-01"), moment(0), mode)
    assert plain(read_table(spark, table)) == bag((*r, "2023-03-01", OPEN, True) for r in twice[1:])


@pytest.mark.parametrize("mode", ["single_pass", "reference"])
@pytest.mark.parametrize("dies_in", ["ensure_gmv_table", "stage_gmv", "_replace_days", "_log", "_set_version"])
@pytest.mark.parametrize("after", [False, True])
def test_an_interrupted_first_load_is_repeated(spark, table, monkeypatch, mode, dies_in, after):
    """Before and after each step; a row without a subsidiary comes once, in the plain merge too."""
    step = getattr(plans, dies_in)

    def dies(*arguments):
        if after:
            step(*arguments)
        raise RuntimeError("driver lost")

    first = LOADS[0][1]
    with monkeypatch.context() as patch:
        patch.setattr(plans, dies_in, dies)
        with pytest.raises(RuntimeError):
            load_gmv(spark, source(spark, first), table, D("2023-03-01"), moment(0), mode, load_id="first")
    load_gmv(spark, source(spark, first), table, D("2023-03-01"), moment(0), mode, load_id="first")
    assert plain(read_table(spark, table)) == plain(stamp(source(spark, first), D("2023-03-01"), moment(0)))
    assert rows_of(history_at(spark, table, 1)) == rows_of(read_table(spark, table))


def violations(stored):
    return {r.rule: r.violations for r in audit_history(stored).collect() if not r.passed}


def test_audit_of_loads(spark):
    """Versions of the one-pass merge fit; the plain one leaves gaps and inserts keys without a subsidiary again."""
    stored = {}
    for mode in ("single_pass", "reference"):
        merged = None
        for n, (day, rows) in enumerate([*LOADS[:2], ("2023-03-07", LOADS[1][1]), ("2023-03-08", LOADS[1][1])]):
            new = source(spark, rows)
            merged = stamp(new, D(day), moment(n)) if merged is None else scd2_merge(merged, new, D(day), moment(n), mode)
            merged = spark.createDataFrame(merged.collect(), merged.schema)
        stored[mode] = merged
    assert violations(stored["single_pass"]) == {}
    assert violations(stored["reference"]) == {
        "overlaps an earlier version": 3,
        "more than one is current": 3,
        "not the last but current": 3,
        "leaves a gap": 1,
    }


@pytest.mark.parametrize(
    ("versions", "expected"),
    [
        ([], {}),
        ([("2023-03-01", OPEN, True, 1.0)], {}),
        ([("2023-03-02", "2023-03-01", False, 1.0)], {"ends before it begins": 1}),
        ([("2023-03-01", "2023-03-05", False, 1.0), ("2023-03-05", OPEN, True, 2.0)], {"overlaps an earlier version": 1}),
        (
            [("2023-03-01", "2023-03-09", False, 1.0), ("2023-03-02", "2023-03-03", False, 2.0), ("2023-03-06", "2023-03-07", False, 1.0)],
            {"overlaps an earlier version": 2},
        ),
        ([("2023-03-01", "2023-03-05", False, 1.0), ("2023-03-07", OPEN, True, 2.0)], {"leaves a gap": 1}),
        ([("2023-03-01", "2023-03-05", False, 1.0), ("2023-03-06", OPEN, True, 1.0)], {"repeats the version before": 1}),
        ([("2023-03-01", "2023-03-05", False, None), ("2023-03-06", OPEN, True, None)], {"repeats the version before": 1}),
        ([("2023-03-01", "2023-03-05", True, 1.0)], {"current does not mean open": 1}),
        ([("2023-03-01", OPEN, False, 1.0)], {"current does not mean open": 1}),
    ],
)
def test_each_rule_of_the_audit(spark, versions, expected):
    for subsidiary in ("a", None):
        rows = [("2023-01-01", subsidiary, value, a, b, c) for a, b, c, value in versions]
        rows.append(("2023-01-02", subsidiary, 7.0, "2023-03-01", OPEN, True))
        assert violations(history(spark, rows)) == expected
