"""Daily inventory decomposition (#12 plan level, #13 group level).

A daily snapshot count is split into *completed*, *became ineligible* and a
net change, using the previous row's count (LAG) as the start of the day:

    start - end = completed + ineligible        (balance check)

Every window is partitioned by the entity keys and ordered by day.  The
available snapshot is unique per (entity, day) (DQ ``unique`` test, error
severity) and the group level aggregates to that grain first, so those window
partitions hold at most one row per calendar day.  The attested snapshot has
no such test: its copies are counted first, weigh the sums by their number and
are laid out again at the end (``operators.copies``).

The two levels differ on purpose (reference quirks, kept):
* plan level: net change is start - end; the cumulative completed count is a
  running sum over the *attested rows* before the left join, then 0-filled, so
  it drops to 0 on days without an attestation and counts attested-only days;
* group level: counts are summed over plans first; net change is end - start;
  the cumulative completed count runs over the *joined* rows; and a
  ``daily_net_new_available_actions`` column is added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions.calendar import month_start, weekend_flag
from kpiloom.functions.metrics import non_negative, running
from kpiloom.operators.copies import count_copies, lay_out

PLAN_KEYS = ["medical_group_id", "plan_id"]
GROUP_KEYS = ["medical_group_id"]


def _with_start_of_day(snapshot: DataFrame, keys: list[str], w) -> DataFrame:
    """actions_end_of_day = the count; start = previous row's count (first row: itself)."""
    cnt = F.col("count_actions_available")
    return snapshot.select(
        "date_day", *keys,
        cnt.alias("actions_end_of_day"),
        F.coalesce(F.lag(cnt, 1).over(w), cnt).alias("actions_start_of_day"),
    )


def _balance_check() -> F.Column:
    start, end = F.col("actions_start_of_day"), F.col("actions_end_of_day")
    done, lost = F.col("count_actions_completed_in_day"), F.col("count_actions_became_ineligible_in_day")
    return F.when(start - end == done + lost, F.lit(True)).otherwise(F.lit(False))


def plan_daily_decomposition(available: DataFrame, attested: DataFrame) -> DataFrame:
    """#12: one row per (day, group, plan) of the available snapshot.

    The reference takes a running sum over the attested rows, left-joins them
    to the snapshot rows, then takes a running sum over the joined rows.  Both
    sums are computed here in one pass over the full outer join of the two, each
    input read once: the completed-count sum skips the snapshot-only rows (their
    count is null) and so equals the sum over attested rows, attested-only days
    included; the ineligible sum skips the attested-only rows (their ineligible
    count is null) and so equals the sum over joined rows; attested-only rows
    are dropped afterwards.

    The attested snapshot has no uniqueness test, so one key may carry many
    copies, and every copy yields a row (the reference's left join fans out).
    SQL leaves the order among them open; here they run by count, then copy by
    copy.  Copies of a count are one row of the join and the windows, weighted by their
    number; copy i has the sum before it plus (i + 1) times its value.  The copies are
    laid out with the days of a month together, as the monthly summary groups them.
    """
    keys = PLAN_KEYS
    on = [*keys, "date_day"]        # as the windows before and after sort: their rows come in sorted runs, which sort faster
    by_day = Window.partitionBy(*keys).orderBy("date_day")
    inventory = (_with_start_of_day(available, keys, by_day)  # available is unique per key (DQ error test)
                 .withColumn("__snapshot", F.lit(True)))
    done = count_copies(attested.select(*[F.col(c).alias(f"__{c}") for c in on],
                                        F.col("count_actions_attested_as_complete").alias("done")), "__n")
    same = [inventory[c] == done[f"__{c}"] for c in on]
    completed = F.coalesce(F.col("done"), F.lit(0))
    drop = F.col("actions_start_of_day") - F.col("actions_end_of_day")
    rows = inventory.join(done, same[0] & same[1] & same[2], "full_outer").select(
        *[F.when(F.col("__snapshot"), inventory[c]).otherwise(F.col(f"__{c}")).alias(c) for c in on],
        "actions_start_of_day", "actions_end_of_day", "done", "__snapshot",
        F.col("__n").isNotNull().alias("__attested"),
        F.coalesce("__n", F.lit(1)).alias("__n"),
        F.when(F.col("__snapshot"), non_negative(drop - completed)).alias("lost"),
    )
    before = (Window.partitionBy(*keys).orderBy("date_day", "done", "lost")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.select(
        "*",
        *[F.sum(F.col(c) * F.col("__n")).over(before).alias(f"__{c}_before") for c in ("done", "lost")],
    ).filter(F.col("__snapshot"))
    rows = lay_out(rows, "__n", "__copy", by=[*map(F.col, keys), month_start(F.col("date_day"))])

    def upto(value: str) -> F.Column:
        """Sum up to this copy; null while only nulls came by."""
        own, past = F.col(value) * (F.col("__copy") + 1), F.col(f"__{value}_before")
        return F.when(own.isNotNull() | past.isNotNull(), F.coalesce(past, F.lit(0)) + F.coalesce(own, F.lit(0)))

    step = rows.select(
        "date_day", *keys, "actions_start_of_day", "actions_end_of_day",
        drop.alias("daily_net_change_of_actions"),
        completed.cast("long").alias("count_actions_completed_in_day"),
        F.when(F.col("__attested"), F.coalesce(upto("done"), F.lit(0))).otherwise(F.lit(0))
        .cast("long").alias("cumulative_actions_completed"),
        F.col("lost").alias("count_actions_became_ineligible_in_day"),
        upto("lost").alias("cumulative_actions_became_ineligible"),
    )
    return step.select(
        "*",
        _balance_check().alias("decomposition_balance_check"),
        weekend_flag(F.col("date_day")).alias("is_weekend"),
    )


def group_daily_decomposition(available: DataFrame, attested: DataFrame) -> DataFrame:
    """#13: sums over plans per (day, group), then the same decomposition."""
    keys = GROUP_KEYS
    w = Window.partitionBy(*keys).orderBy("date_day")
    snapshot = available.groupBy("date_day", *keys).agg(
        F.sum("count_actions_available").alias("count_actions_available"))
    done = attested.groupBy("date_day", *keys).agg(
        F.sum("count_actions_attested_as_complete").alias("done"))
    joined = _with_start_of_day(snapshot, keys, w).join(done, ["date_day", *keys], "left")
    completed = F.coalesce(F.col("done"), F.lit(0))
    step = joined.select(
        "date_day", *keys, "actions_start_of_day", "actions_end_of_day",
        (F.col("actions_end_of_day") - F.col("actions_start_of_day")).alias("daily_net_change_of_actions"),
        completed.alias("count_actions_completed_in_day"),
        non_negative(F.col("actions_start_of_day") - F.col("actions_end_of_day") - completed)
        .alias("count_actions_became_ineligible_in_day"),
    )
    residual = (F.col("daily_net_change_of_actions") - F.col("count_actions_completed_in_day")
                - F.col("count_actions_became_ineligible_in_day"))
    return step.select(
        "date_day", *keys,
        "actions_start_of_day",
        "actions_end_of_day",
        "daily_net_change_of_actions",
        "count_actions_completed_in_day",
        "count_actions_became_ineligible_in_day",
        running("count_actions_completed_in_day", w).alias("cumulative_actions_completed"),
        running("count_actions_became_ineligible_in_day", w).alias("cumulative_actions_became_ineligible"),
        F.when(residual > 0, residual).otherwise(F.lit(0)).alias("daily_net_new_available_actions"),
        _balance_check().alias("decomposition_balance_check"),
        weekend_flag(F.col("date_day")).alias("is_weekend"),
    )
