"""Late and re-sent records: recompute only the days they can change."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaria.operators.cdc import Feeds
from vendaria.operators.gmv import gmv_daily
from vendaria.sources.scratch import materialize


def reprocess(feeds: Feeds, changed_ids: DataFrame, staging: str, **options) -> tuple[DataFrame, DataFrame]:
    """(daily value, days) after some purchase ids changed: the value is complete for the returned days.

    `feeds` are the stored feeds, the changed records included. A purchase counts on the release date of one of
    its versions, so the days a changed id can enter or leave are the release dates of all its versions; and
    whoever counts on such a day has a version released on it. Only those purchases are consolidated again.

    The lists of ids and days are written once, so Spark knows their size and broadcasts them where they are small:
    then they filter the scans of the feeds. Releases are made distinct before they meet a list, which takes the
    weight off an id with many versions. `options` are those of `gmv_daily`.
    """
    releases = feeds.purchase.select("purchase_id", "release_date").filter(F.col("release_date").isNotNull())
    releases = releases.distinct()
    changed = materialize(changed_ids.select("purchase_id").distinct(), f"{staging}/changed")
    days = _of(releases, changed).select("release_date").distinct()
    days = materialize(days, f"{staging}/days")
    affected = materialize(_of(releases, days).select("purchase_id").distinct(), f"{staging}/affected")

    chosen = Feeds(*[_of(feed, affected) for feed in feeds])
    on_days = days.withColumnRenamed("release_date", "transaction_date")
    return _of(gmv_daily(chosen, **options), on_days), on_days


def _of(df: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of `df` whose key is in the list; NULL is a key like any other."""
    (name,) = keys.columns
    return df.alias("l").join(keys.alias("r"), F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}")), "left_semi")
