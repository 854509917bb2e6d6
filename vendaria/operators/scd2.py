"""Type-2 history: keep every version of a value with the days it was valid.

`MERGE` needs a table format that Spark does not bring along, so a load is expressed as a window over the current
versions and the new values of each key: one shuffle, and no join. Nothing is written here.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vendaria.functions import OPEN_END, day, day_before

KEYS = ("transaction_date", "subsidiary")
TRACKED = ("gmv_daily",)

# What a load does to a version.
KEEP, CLOSE, REMOVE, INSERT = "keep", "close", "remove", "insert"

_NEW = "_new"


def stamp(df: DataFrame, as_of: date | str, load_ts: datetime) -> DataFrame:
    """New versions, valid from `as_of` on."""
    return df.withColumns(
        {
            "valid_from": day(as_of),
            "valid_to": day(OPEN_END),
            "is_current": F.lit(True),
            "load_timestamp": F.lit(load_ts),
        }
    )


def current_of(history: DataFrame) -> DataFrame:
    return history.filter(F.col("is_current"))


def closed_of(history: DataFrame) -> DataFrame:
    return history.filter(~F.col("is_current") | F.col("is_current").isNull())


def scd2_changes(
    current: DataFrame,
    source: DataFrame,
    as_of: date | str,
    load_ts: datetime,
    mode: str = "single_pass",
    close_missing: bool = True,
    keys: Sequence[str] = KEYS,
    tracked: Sequence[str] = TRACKED,
) -> DataFrame:
    """Every current and every new version with the `action` of this load; closed versions are not looked at.

    `single_pass`: NULL keys match and NULL values compare; a changed key is closed and reopened in the same
    load; a key missing from the source is closed if `close_missing`, which is right only where the source is
    complete for the days in `current`. A version opened on `as_of` itself was never valid for a whole day and
    is replaced, so repeating a load changes nothing. Surplus current versions of a key, as `reference` loads
    leave behind, are retired. Loads must come in the order of their days.

    A source that holds a key twice is refused, as no single value could replace the old one.

    `reference`: the plain merge. NULL keys never match and are inserted by every load, a NULL value never
    differs, a changed key is closed only (the next load inserts it) and missing keys stay.
    """
    if mode not in ("single_pass", "reference"):
        raise ValueError(f"mode must be 'single_pass' or 'reference', not {mode!r}")
    single_pass = mode == "single_pass"
    columns = [*keys, *tracked, "valid_from", "valid_to", "is_current", "load_timestamp"]

    old = current.select(*columns, F.lit(False).alias(_NEW))
    new = stamp(source.select(*keys, *tracked), as_of, load_ts).select(*columns, F.lit(True).alias(_NEW))
    is_new, value = F.col(_NEW), F.struct(*tracked)

    # All versions of a key meet in one window: the old ones first, the newest of them at the top.
    of_key = Window.partitionBy(*keys)
    newest_first = of_key.orderBy(
        _NEW, F.col("valid_from").desc(), F.col("load_timestamp").desc(), *[F.col(c).desc() for c in tracked]
    )
    matches = F.lit(True) if single_pass else reduce(and_, [F.col(k).isNotNull() for k in keys])
    rows = old.unionByName(new).withColumns(
        {
            "_n_new": F.when(matches, F.count_if(is_new).over(of_key)).otherwise(0),
            "_n_old": F.when(matches, F.count_if(~is_new).over(of_key)).otherwise(0),
            "_new_value": F.max(F.when(is_new, value)).over(of_key),
            "_top": F.first(F.when(~is_new, value)).over(newest_first),
            "_rank": F.row_number().over(newest_first),
        }
    )

    def differs(one: str, other: Sequence[str] | str) -> Column:
        pairs = [(F.col(f"{one}.{c}"), F.col(c if other is tracked else f"{other}.{c}")) for c in tracked]
        return reduce(or_, [_differs(a, b, single_pass) for a, b in pairs])

    has_old, has_new = F.col("_n_old") > 0, F.col("_n_new") > 0
    changed = differs("_new_value", tracked)
    if single_pass:
        # A surplus version may not match, or the source row would be taken as already present.
        retire = (F.col("_rank") > 1) | F.when(has_new, changed).otherwise(F.lit(close_missing))
        opened = F.col("valid_from")
        old_action = (
            F.when(~retire, KEEP)
            .when(opened < day(as_of), CLOSE)
            .when(opened == day(as_of), REMOVE)
            .otherwise(F.raise_error(F.concat(F.lit("load is older than a version opened on "), opened.cast("string"))))
        )
        insert = ~has_old | differs("_new_value", "_top")
    else:
        old_action = F.when(has_new & changed, CLOSE).otherwise(KEEP)
        insert = ~has_old
    twice = F.concat(F.lit("the source has a key twice: "), F.to_json(F.struct(*keys)))
    action = (
        F.when(F.col("_n_new") > 1, F.raise_error(twice).cast("string"))
        .when(is_new, F.when(insert, INSERT))
        .otherwise(old_action)
    )
    rows = rows.withColumn("action", action).filter(F.col("action").isNotNull())
    closing = F.col("action") == CLOSE
    return rows.select(
        "action",
        *keys,
        *tracked,
        "valid_from",
        F.when(closing, day_before(as_of)).otherwise(F.col("valid_to")).alias("valid_to"),
        F.when(closing, F.lit(False)).otherwise(F.col("is_current")).alias("is_current"),
        "load_timestamp",
    )


def scd2_merge(
    history: DataFrame,
    source: DataFrame,
    as_of: date | str,
    load_ts: datetime,
    mode: str = "single_pass",
    close_missing: bool = True,
    keys: Sequence[str] = KEYS,
    tracked: Sequence[str] = TRACKED,
) -> DataFrame:
    """The whole history after a load."""
    changes = scd2_changes(current_of(history), source, as_of, load_ts, mode, close_missing, keys, tracked)
    kept = changes.filter(F.col("action") != REMOVE).drop("action")
    return closed_of(history).select(*kept.columns).unionByName(kept)


def _differs(a: Column, b: Column, null_safe: bool) -> Column:
    return ~a.eqNullSafe(b) if null_safe else F.coalesce(a != b, F.lit(False))
