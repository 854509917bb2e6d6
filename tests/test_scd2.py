import random
from datetime import date, datetime, timedelta

import pytest

from fixtures import bag
from vendaria import schemas
from vendaria.functions import OPEN_END
from vendaria.operators.gmv import gmv_as_of, gmv_current, gmv_current_full, gmv_period
from vendaria.operators.scd2 import scd2_merge, stamp

D = date.fromisoformat
TS = datetime(2023, 3, 1, 12)
AS_OF = D("2023-03-02")
SOURCE = "transaction_date date, subsidiary string, gmv_daily double"


def history(spark, rows):
    return spark.createDataFrame([(D(d), s, g, D(a), D(b), c, TS) for d, s, g, a, b, c in rows], schemas.GMV_HISTORY)


def source(spark, rows):
    return spark.createDataFrame([(D(d), s, g) for d, s, g in rows], SOURCE)


def merged(spark, target, new, mode, as_of=AS_OF, **options):
    out = scd2_merge(target, new, as_of, TS, mode, **options)
    assert out.columns == schemas.GMV_HISTORY.names
    return out


def plain(df):
    return bag(
        (str(r.transaction_date), r.subsidiary, r.gmv_daily, str(r.valid_from), str(r.valid_to), r.is_current)
        for r in df.collect()
    )


OPEN = str(OPEN_END)
TARGET = [
    ("2023-01-20", "nacional", 50.0, "2023-03-01", OPEN, True),
    ("2023-02-28", None, 10.0, "2023-03-01", OPEN, True),
    ("2023-02-27", "gone", 7.0, "2023-03-01", OPEN, True),
    ("2023-02-26", "same", 8.0, "2023-03-01", OPEN, True),
    ("2023-02-25", "old", 1.0, "2023-02-01", "2023-02-10", False),
]
NEW = [
    ("2023-01-20", "nacional", 55.0),
    ("2023-02-28", None, 10.0),
    ("2023-02-26", "same", 8.0),
    ("2023-03-01", "nacional", 55.0),
]


def test_reference_merge(spark):
    got = merged(spark, history(spark, TARGET), source(spark, NEW), "reference")
    assert plain(got) == bag(
        [
            ("2023-01-20", "nacional", 50.0, "2023-03-01", "2023-03-01", False),
            ("2023-02-28", None, 10.0, "2023-03-01", OPEN, True),
            ("2023-02-28", None, 10.0, "2023-03-02", OPEN, True),
            *TARGET[2:],
            ("2023-03-01", "nacional", 55.0, "2023-03-02", OPEN, True),
        ]
    )
    again = merged(spark, got, source(spark, NEW[:1]), "reference", D("2023-03-03"))
    assert ("2023-01-20", "nacional", 55.0, "2023-03-03", OPEN, True) in plain(again)


def test_single_pass_merge(spark):
    got = merged(spark, history(spark, TARGET), source(spark, NEW), "single_pass")
    expected = [
        ("2023-01-20", "nacional", 50.0, "2023-03-01", "2023-03-01", False),
        ("2023-01-20", "nacional", 55.0, "2023-03-02", OPEN, True),
        TARGET[1],
        ("2023-02-27", "gone", 7.0, "2023-03-01", "2023-03-01", False),
        *TARGET[3:],
        ("2023-03-01", "nacional", 55.0, "2023-03-02", OPEN, True),
    ]
    assert plain(got) == bag(expected)
    assert plain(merged(spark, got, source(spark, NEW), "single_pass")) == bag(expected)
    kept = merged(spark, history(spark, TARGET), source(spark, NEW), "single_pass", close_missing=False)
    assert TARGET[2] in plain(kept)


SAME_DAY = [
    ("2023-03-05", "a", 1.0, "2023-03-02", OPEN, True),
    ("2023-03-06", "b", None, "2023-03-01", OPEN, True),
    ("2023-03-07", "c", 3.0, "2023-03-01", OPEN, True),
    ("2023-03-08", "d", None, "2023-03-01", OPEN, True),
    ("2023-03-09", "e", 4.0, "2023-03-02", OPEN, True),
]
SAME_DAY_NEW = [("2023-03-05", "a", 2.0), ("2023-03-06", "b", 5.0), ("2023-03-07", "c", None), ("2023-03-08", "d", None)]


def test_null_values_and_same_day(spark):
    target, new = history(spark, SAME_DAY), source(spark, SAME_DAY_NEW)
    assert plain(merged(spark, target, new, "reference")) == bag(
        [("2023-03-05", "a", 1.0, "2023-03-02", "2023-03-01", False), *SAME_DAY[1:]]
    )
    expected = [
        ("2023-03-05", "a", 2.0, "2023-03-02", OPEN, True),
        ("2023-03-06", "b", None, "2023-03-01", "2023-03-01", False),
        ("2023-03-06", "b", 5.0, "2023-03-02", OPEN, True),
        ("2023-03-07", "c", 3.0, "2023-03-01", "2023-03-01", False),
        ("2023-03-07", "c", None, "2023-03-02", OPEN, True),
        SAME_DAY[3],
    ]
    got = merged(spark, target, new, "single_pass")
    assert plain(got) == bag(expected)
    assert plain(merged(spark, got, new, "single_pass")) == bag(expected)


def test_surplus_current_rows_are_retired(spark):
    surplus = [
        ("2023-02-28", None, 10.0, "2023-02-27", OPEN, True),
        ("2023-02-28", None, 10.0, "2023-03-01", OPEN, True),
        ("2023-02-28", None, 11.0, "2023-03-02", OPEN, True),
    ]
    got = merged(spark, history(spark, surplus), source(spark, [("2023-02-28", None, 11.0)]), "single_pass")
    assert plain(got) == bag(
        [
            ("2023-02-28", None, 10.0, "2023-02-27", "2023-03-01", False),
            ("2023-02-28", None, 10.0, "2023-03-01", "2023-03-01", False),
            ("2023-02-28", None, 11.0, "2023-03-02", OPEN, True),
        ]
    )


def test_older_load_is_refused(spark):
    target = history(spark, [("2023-03-05", "a", 1.0, "2023-03-03", OPEN, True)])
    with pytest.raises(Exception, match="load is older"):
        merged(spark, target, source(spark, [("2023-03-05", "a", 2.0)]), "single_pass").collect()


@pytest.mark.parametrize("mode", ["single_pass", "reference"])
def test_a_key_twice_in_the_source_is_refused(spark, mode):
    target = history(spark, [("2023-03-05", "a", 1.0, "2023-03-01", OPEN, True)])
    for values in ((2.0, 3.0), (1.0, 1.0)):
        new = source(spark, [("2023-03-05", "a", v) for v in values])
        with pytest.raises(Exception, match="key twice.*2023-03-05"):
            merged(spark, target, new, mode).collect()


def test_reference_inserts_every_key_with_a_null(spark):
    got = merged(spark, history(spark, []), source(spark, [("2023-03-05", None, v) for v in (2.0, 3.0)]), "reference")
    assert got.count() == 2


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        scd2_merge(history(spark, TARGET), source(spark, NEW), AS_OF, TS, "merge")


@pytest.mark.parametrize("seed", range(3))
def test_many_loads_by_brute_force(spark, seed):
    """Random loads, some on the same day: at any past day the history shows the last load up to it."""
    rng = random.Random(seed)
    keys = [(f"2023-01-0{d}", s) for d in range(1, 6) for s in ("a", "b", None)]
    state, shown, day = None, {}, D("2023-02-01")
    for _ in range(5):
        rows = [(*k, rng.choice([None, 1.0, 2.0, 3.0])) for k in keys if rng.random() < 0.7]
        new = source(spark, rows or [("2023-01-01", "a", 1.0)])
        state = stamp(new, day, TS) if state is None else merged(spark, state, new, "single_pass", day)
        # Cut the lineage of the loop through the driver: a few rows of a test.
        state = spark.createDataFrame(state.collect(), schemas.GMV_HISTORY)
        shown[day] = bag(new.collect())
        day += timedelta(days=rng.choice([0, 1, 3]))
    rows = state.collect()
    current = [(r.transaction_date, r.subsidiary) for r in rows if r.is_current]
    assert len(current) == len(set(current))
    assert all(r.valid_from <= r.valid_to and (r.valid_to == OPEN_END) == r.is_current for r in rows)
    last = max(shown)
    for offset in range((last - D("2023-02-01")).days + 2):
        when = D("2023-02-01") + timedelta(days=offset)
        load = max(d for d in shown if d <= when)
        as_of = gmv_as_of(state, when).select("transaction_date", "subsidiary", "gmv_daily")
        assert bag(as_of.collect()) == shown[load]


def test_reads(spark):
    state = merged(spark, history(spark, TARGET), source(spark, NEW), "single_pass")
    assert [(str(r[0]), r[1], r[2]) for r in gmv_current(state).collect()] == [
        ("2023-01-20", "nacional", 55.0),
        ("2023-02-26", "same", 8.0),
        ("2023-02-28", None, 10.0),
        ("2023-03-01", "nacional", 55.0),
    ]
    assert gmv_current_full(state).columns == schemas.GMV_HISTORY.names
    every = {(str(r[0]), r[1]): r[2] for r in gmv_period(state, "2023-01-01", "2023-02-27").collect()}
    assert every == {
        ("2023-01-20", "nacional"): 105.0,
        ("2023-02-25", "old"): 1.0,
        ("2023-02-26", "same"): 8.0,
        ("2023-02-27", "gone"): 7.0,
    }
    now = {(str(r[0]), r[1]): r[2] for r in gmv_period(state, "2023-01-01", D("2023-02-27"), current_only=True).collect()}
    assert now == {("2023-01-20", "nacional"): 55.0, ("2023-02-26", "same"): 8.0}
    with pytest.raises(ValueError):
        gmv_period(state, "2023-01-01", "2023-02-30")
