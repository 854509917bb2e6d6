"""Load the daily value into the stored history, and read it as it was after an earlier load."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from vendaria import schemas
from vendaria.functions import OPEN_END
from vendaria.operators.gmv import gmv_as_of
from vendaria.operators.quality import enforce
from vendaria.operators.scd2 import CLOSE, INSERT, KEEP, REMOVE, closed_of, current_of, scd2_changes
from vendaria.sources.catalog import ensure_gmv_table, read_table, table_exists
from vendaria.sources.files import read_parquet
from vendaria.sources.scratch import discard, is_complete, is_folder, materialize, scratch_dir

PARTITION = "transaction_date"


def load_gmv(
    spark: SparkSession,
    daily: DataFrame,
    table: str,
    as_of: date | str,
    load_ts: datetime,
    mode: str = "single_pass",
    close_missing: bool = True,
    days: DataFrame | None = None,
    location: str | None = None,
    load_id: str | None = None,
    checks: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """A merge that rewrites only the days it changes; into an empty table if `table` is missing.

    `days` (one column, transaction_date) says that `daily` is complete for those days only, so the rest of
    the table stays as it is. `checks` makes a quality gate (see `quality_gate`) of the rows to be loaded; a rule that
    fails stops the load before the table changes.

    The rows of the changed days are staged beside the table, under the load's id and the version of the table they
    were computed from, before the table is touched, as partitions are replaced one by one. The next load looks
    there first. Rows of a load that was interrupted are brought in, unless the table has changed since: then they
    are of no use and go. After that the load does its own work, in both modes; only where it is the very load
    that was interrupted, by its id, it has been done. Without a `load_id` a load is known by its day, time, mode,
    `close_missing` and `days`.

    What a load does to the rows is logged beside the table too, see `history_at`.
    """
    load_id = load_id or _load_id(as_of, load_ts, mode, close_missing, days)
    if not table_exists(spark, table):
        if checks is not None:
            daily, checks = _checked(daily, checks, scratch_dir(spark)), None
        ensure_gmv_table(spark, table, location)
    if finish_interrupted(spark, table) == load_id:
        return
    stage_gmv(spark, daily, table, as_of, load_ts, mode, close_missing, days, load_id, checks)
    finish_interrupted(spark, table)


def stage_gmv(
    spark: SparkSession,
    daily: DataFrame,
    table: str,
    as_of: date | str,
    load_ts: datetime,
    mode: str = "single_pass",
    close_missing: bool = True,
    days: DataFrame | None = None,
    load_id: str | None = None,
    checks: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """The first half of a load: what the table's changed days will hold. The table stays as it is."""
    staging = _staging(spark, table)
    discard(spark, staging)
    history = read_table(spark, table)
    if days is not None:
        # Literals prune the partitions that are read; a semi-join with a table of days would not.
        history = history.filter(_is_one_of(_days(days)))
    current = current_of(history)
    if checks is not None:
        daily = _checked(daily, checks, staging)
    changes = materialize(scd2_changes(current, daily, as_of, load_ts, mode, close_missing), f"{staging}/changes")

    touched = _touched_days(changes)
    kept = changes.filter(F.col("action") != REMOVE).drop("action")
    closed = closed_of(history).select(*kept.columns)
    on_touched = _is_one_of(touched)
    materialize(closed.filter(on_touched).unionByName(kept.filter(on_touched)), f"{staging}/rewritten")
    load_id = load_id or _load_id(as_of, load_ts, mode, close_missing, days)
    manifest = [(load_id, _version(spark, table)[0], touched, load_ts)]
    manifest = spark.createDataFrame(manifest, MANIFEST).coalesce(1)
    materialize(manifest, f"{staging}/manifest")  # last: what is staged is complete


def finish_interrupted(spark: SparkSession, table: str) -> str | None:
    """The second half of a load: bring staged rows into the table. The id of that load, None if there was none.

    Rows computed from another version of the table are dropped; if the table's last load is that very one, it had
    come to its end and only its files were left. Replacing the days once more, after an interruption between two of
    them, does no harm.
    """
    staging = _staging(spark, table)
    if not is_complete(spark, f"{staging}/manifest"):
        return None
    load_id, version, touched, load_ts = read_parquet(spark, f"{staging}/manifest", MANIFEST).first()
    now, last = _version(spark, table)
    done = load_id if (now, last) == (version + 1, _digest(load_id)) else None
    if version == now:
        _replace_days(spark, f"{staging}/rewritten", table)
        rewritten = read_parquet(spark, f"{staging}/rewritten", schemas.GMV_HISTORY)
        # A day without any version left writes no partition, so the old one has to go by itself.
        for emptied in set(touched) - set(_days(rewritten)):
            value = "NULL" if emptied is None else f"DATE'{emptied}'"
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({PARTITION} = {value})")
        _log(spark, table, f"{staging}/changes", version + 1, load_ts)
        _set_version(spark, table, version + 1, load_id)
        done = load_id
    discard(spark, f"{staging}/manifest/_SUCCESS")  # before the files, which may not go all at once
    discard(spark, staging)
    return done


MANIFEST = StructType(
    [
        StructField("load_id", StringType()),
        StructField("version", LongType()),
        StructField("touched", ArrayType(DateType())),
        StructField("load_ts", TimestampType()),
    ]
)

# What loads did: a row of the history, taken away (-1) or put in (1), by the time and the number of the load.
LOGGED = StructType(
    [*schemas.GMV_HISTORY, StructField("sign", IntegerType()), StructField("logged_at", TimestampType()), StructField("load", LongType())]
)


def history_at(spark: SparkSession, table: str, load: int | datetime) -> DataFrame:
    """The history as it was stored after a load: by its number, from 1, or the last one up to a time of loading.

    A row of the table says since when and until when a value was valid, and the log says which loads it was in the
    table: rows that were put in and not taken away again up to that load. Rows that are equal are as many as then.
    """
    path = _log_path(spark, table)
    if not is_folder(spark, f"{path}/load=1"):
        raise ValueError(f"the loads of {table} are not logged from the first one on")
    up_to = F.col("load") <= load if isinstance(load, int) else F.col("logged_at") <= F.lit(load)
    log = read_parquet(spark, path, LOGGED).filter(up_to)
    rows = log.groupBy(*schemas.GMV_HISTORY.names).agg(F.sum("sign").alias("_n")).filter(F.col("_n") > 0)
    times = F.explode(F.array_repeat(F.lit(True), F.col("_n").cast("int")))
    return rows.select(*schemas.GMV_HISTORY.names, times.alias("_once")).drop("_once")


def gmv_as_known(spark: SparkSession, table: str, when: date | str, load: int | datetime) -> DataFrame:
    """The versions that were valid on a past day, as far as an earlier load knew."""
    return gmv_as_of(history_at(spark, table, load), when)


def _log(spark: SparkSession, table: str, changes: str, number: int, load_ts: datetime) -> None:
    """Write what a load did, in a folder of its own, which a repetition replaces."""
    rows = spark.read.schema(StructType([StructField("action", StringType()), *schemas.GMV_HISTORY])).parquet(changes)
    columns = schemas.GMV_HISTORY.names
    put_in = F.col("action").isin(INSERT, CLOSE)
    gone = {"valid_to": F.lit(OPEN_END), "is_current": F.lit(True)}
    before = rows.filter(F.col("action").isin(CLOSE, REMOVE)).withColumns(gone).select(*columns, F.lit(-1).alias("sign"))
    after = rows.filter(put_in).select(*columns, F.lit(1).alias("sign"))
    logged = before.unionByName(after).withColumn("logged_at", F.lit(load_ts))
    logged.hint("rebalance").write.mode("overwrite").parquet(f"{_log_path(spark, table)}/load={number}")


def _log_path(spark: SparkSession, table: str) -> str:
    return _location(spark, table) + "-log"


# Counts the loads of a table, in its properties, and names the last one by a digest, which needs no quotes.
VERSION = "vendaria.loads"
LAST = "vendaria.last"


def _load_id(as_of, load_ts: datetime, mode: str, close_missing: bool, days: DataFrame | None) -> str:
    covered = "all" if days is None else _digest(" ".join(sorted(str(d) for d in _days(days))))
    return f"{as_of} {load_ts.isoformat()} {mode} {close_missing} {covered}"


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _version(spark: SparkSession, table: str) -> tuple[int, str | None]:
    """The number of loads and the digest of the last one's id."""
    found = {row["key"]: row["value"] for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return int(found.get(VERSION, 0)), found.get(LAST)


def _set_version(spark: SparkSession, table: str, version: int, load_id: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{VERSION}' = '{version}', '{LAST}' = '{_digest(load_id)}')")


def _staging(spark: SparkSession, table: str) -> str:
    """Beside the table's own files, so that whoever loads the table next finds it."""
    return _location(spark, table) + "-load"


def _location(spark: SparkSession, table: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter(F.col("col_name") == "Location")
    return described.first()["data_type"].rstrip("/")


def _checked(rows: DataFrame, checks: Callable[[DataFrame], DataFrame], path: str) -> DataFrame:
    """The rows, computed once, if they pass."""
    rows = materialize(rows, f"{path}/checked")
    enforce(checks(rows))
    return rows


def _touched_days(changes: DataFrame) -> list[date | None]:
    return _days(changes.filter(F.col("action") != KEEP))


def _days(df: DataFrame) -> list[date | None]:
    """The calendar days in `df`: at most one row for each partition of the table. As literals they prune it."""
    return [row[PARTITION] for row in df.select(PARTITION).distinct().collect()]


def _is_one_of(days: list[date | None]):
    found = F.col(PARTITION).isin([d for d in days if d is not None])
    return found | F.col(PARTITION).isNull() if None in days else found


def _replace_days(spark: SparkSession, path: str, table: str) -> None:
    """Overwrite the partitions that the rows in `path` have and leave the others alone.

    In a session of its own, so that the setting reaches no other write of the caller's.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    rows = read_parquet(own, path, schemas.GMV_HISTORY).select(*own.table(table).columns)
    rows.hint("rebalance", F.col(PARTITION)).write.insertInto(table, overwrite=True)
