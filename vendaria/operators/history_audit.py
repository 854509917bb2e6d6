"""Whether the versions of a history fit together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vendaria.functions import OPEN_END, day
from vendaria.operators.quality import quality_gate
from vendaria.operators.scd2 import KEYS, TRACKED


def audit_history(history: DataFrame, keys: Sequence[str] = KEYS, tracked: Sequence[str] = TRACKED) -> DataFrame:
    """(rule, violations, passed) of a type-2 history, all rules from one window over the versions of each key.

    Versions of a key come in the order of `valid_from`. Violations are versions that

    * `ends before it begins`: their last day is before the first,
    * `overlaps an earlier version`: begin before all earlier ones have ended,
    * `leaves a gap`: begin more than a day after all earlier ones have ended (right for a key that was gone),
    * `repeats the version before`: follow a version of the same value without a gap,
    * `more than one is current`: are current beyond the first of a key,
    * `current does not mean open`: are current and have an end, or the other way round,
    * `not the last but current`: are current and have a later version.

    A key may be NULL, in part or all of it, as the loads have them. No violations on an empty history.
    """
    in_order = Window.partitionBy(*keys).orderBy("valid_from", "valid_to", "is_current", *tracked)
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    value = F.struct(*tracked)
    rows = history.select(
        "valid_from",
        "valid_to",
        F.coalesce("is_current", F.lit(False)).alias("is_current"),
        value.alias("_value"),
        F.max("valid_to").over(earlier).alias("_until"),
        F.lag(value).over(in_order).alias("_before"),
        F.lag("valid_to").over(in_order).alias("_before_to"),
        F.lead("valid_from").over(in_order).alias("_next"),
        F.sum(F.col("is_current").cast("int")).over(in_order.rowsBetween(Window.unboundedPreceding, 0)).alias("_n_current"),
    )
    is_current = F.col("is_current")
    violated = {
        "ends before it begins": F.col("valid_to") < F.col("valid_from"),
        "overlaps an earlier version": F.col("valid_from") <= F.col("_until"),
        "leaves a gap": F.date_sub("valid_from", 1) > F.col("_until"),
        "repeats the version before": F.col("_before").isNotNull()
        & F.col("_before").eqNullSafe(F.col("_value"))
        & (F.date_sub("valid_from", 1) == F.col("_before_to")),
        "more than one is current": is_current & (F.col("_n_current") > 1),
        "current does not mean open": is_current != F.coalesce(F.col("valid_to") == day(OPEN_END), F.lit(False)),
        "not the last but current": is_current & F.col("_next").isNotNull(),
    }
    counted = rows.agg(*[F.count_if(broken).alias(f"_{i}") for i, broken in enumerate(violated.values())])
    rules = [F.struct(F.lit(rule).alias("rule"), F.col(f"_{i}").alias("violations")) for i, rule in enumerate(violated)]
    return quality_gate(counted.select(F.inline(F.array(*rules))))
