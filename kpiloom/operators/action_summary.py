"""Monthly action summaries (#14 group level, #15 plan level).

Daily decomposition rows are rolled up per (entity, month) with one hash
aggregate; running totals and month-over-month values are then one window
pass per entity ordered by month (LAG is by row: a missing month makes the
previous *present* month the comparison).

Kept reference quirks: "start of month" is the MAX start-of-day in the month;
end of month is MAX at group level but MIN at plan level; plan-level rates
divide by the *global* maximum start-of-day over the whole table, and plan-level
running rates use the max of the daily cumulative counts instead of a running
total of monthly starts.

The global maximum is the maximum of the monthly maxima, so it is rolled up from
the monthly aggregate and the daily table is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions.calendar import month_start
from kpiloom.functions.metrics import aac_status, loss_status, running, safe_rate
from kpiloom.params import KpiParams

GROUP_KEYS = ["medical_group_id"]
PLAN_KEYS = ["medical_group_id", "plan_id"]


def _monthly_aggregates(daily: DataFrame, keys: list[str], end_of_month, extra: list[Column]) -> DataFrame:
    return daily.groupBy(*keys, month_start(F.col("date_day")).alias("date_month")).agg(
        F.max("actions_start_of_day").alias("actions_available_start_month"),
        end_of_month("actions_end_of_day").alias("actions_available_end_of_month"),
        F.sum("count_actions_completed_in_day").alias("monthly_actions_completed"),
        F.sum("count_actions_became_ineligible_in_day").alias("monthly_actions_became_ineligible"),
        F.max("cumulative_actions_completed").alias("monthly_running_total_actions_completed"),
        F.max("cumulative_actions_became_ineligible").alias("monthly_running_total_actions_became_ineligible"),
        F.sum("daily_net_change_of_actions").alias("monthly_net_change_of_actions"),
        *extra,
        F.count(F.lit(1)).alias("days_with_data"),
        F.sum(F.when(F.col("is_weekend"), F.lit(1)).otherwise(F.lit(0))).cast("long").alias("weekend_days"),
    )


def _month_over_month(w) -> list[Column]:
    return [
        F.lag("monthly_completion_rate", 1).over(w).alias("monthly_completion_rate_prev_month"),
        F.lag("monthly_lost_opportunity_rate", 1).over(w).alias("monthly_lost_opportunity_rate_prev_month"),
    ]


def _mom_changes() -> list[Column]:
    return [
        (F.col("monthly_completion_rate") - F.col("monthly_completion_rate_prev_month"))
        .alias("monthly_completion_rate_change_mom"),
        (F.col("monthly_lost_opportunity_rate") - F.col("monthly_lost_opportunity_rate_prev_month"))
        .alias("lost_opportunity_rate_change_mom"),
    ]


def group_monthly_action_summary(daily: DataFrame, params: KpiParams = KpiParams()) -> DataFrame:
    """#14: AAC % and lost-opportunity rate per (group, month)."""
    keys = GROUP_KEYS
    scale = params.rate_scale
    monthly = _monthly_aggregates(
        daily, keys, F.max,
        [F.sum("daily_net_new_available_actions").alias("monthly_net_new_available_actions")])
    start = F.col("actions_available_start_month")
    rated = monthly.select(
        "*",
        safe_rate(F.col("monthly_actions_completed"), start, scale).alias("monthly_completion_rate"),
        safe_rate(F.col("monthly_actions_became_ineligible"), start, scale).alias("monthly_lost_opportunity_rate"),
    )
    w = Window.partitionBy(*keys).orderBy("date_month")
    # One window pass: the running total is a plain window, no self-join needed
    # because (group, month) is unique after the aggregate.
    windowed = rated.select(
        "*",
        running("actions_available_start_month", w).alias("monthly_running_total_actions_available"),
        *_month_over_month(w),
    )
    run_avail = F.col("monthly_running_total_actions_available")
    final = windowed.select(
        *keys, "date_month",
        "actions_available_start_month",
        "actions_available_end_of_month",
        "monthly_actions_completed",
        "monthly_actions_became_ineligible",
        "monthly_running_total_actions_completed",
        "monthly_running_total_actions_became_ineligible",
        "monthly_net_change_of_actions",
        "monthly_net_new_available_actions",
        "monthly_completion_rate",
        "monthly_lost_opportunity_rate",
        "monthly_running_total_actions_available",
        safe_rate(F.col("monthly_running_total_actions_completed"), run_avail, scale)
        .alias("running_monthly_completion_rate"),
        safe_rate(F.col("monthly_running_total_actions_became_ineligible"), run_avail, scale)
        .alias("running_monthly_lost_opportunity_rate"),
        aac_status(F.col("monthly_completion_rate"), params).alias("aac_performance_status"),
        loss_status(F.col("monthly_lost_opportunity_rate"), params).alias("lost_opportunity_status"),
        "monthly_completion_rate_prev_month",
        "monthly_lost_opportunity_rate_prev_month",
        "days_with_data",
        "weekend_days",
    )
    return final.select("*", *_mom_changes())


def plan_monthly_action_summary(daily: DataFrame, params: KpiParams = KpiParams()) -> DataFrame:
    """#15: per (group, plan, month), rates against the global max start-of-day."""
    keys = PLAN_KEYS
    scale = params.rate_scale
    monthly = _monthly_aggregates(daily, keys, F.min, [])
    # Uncorrelated scalar subquery over the monthly rows.  It takes whole rows (structs compare by their first field,
    # nulls least), so that no column is pruned and both uses share the exchange of the monthly aggregate.
    first = "actions_available_start_month"
    whole = F.struct(first, *[c for c in monthly.columns if c != first])
    global_start = monthly.agg(F.max(whole)[first]).scalar()
    w = Window.partitionBy(*keys).orderBy("date_month")
    rated = monthly.select(
        *keys, "date_month",
        "actions_available_start_month",
        "actions_available_end_of_month",
        "monthly_actions_completed",
        "monthly_actions_became_ineligible",
        "monthly_running_total_actions_completed",
        "monthly_running_total_actions_became_ineligible",
        "monthly_net_change_of_actions",
        safe_rate(F.col("monthly_actions_completed"), global_start, scale).alias("monthly_completion_rate"),
        safe_rate(F.col("monthly_running_total_actions_completed"), global_start, scale)
        .alias("running_monthly_completion_rate"),
        safe_rate(F.col("monthly_actions_became_ineligible"), global_start, scale)
        .alias("monthly_lost_opportunity_rate"),
        safe_rate(F.col("monthly_running_total_actions_became_ineligible"), global_start, scale)
        .alias("running_monthly_lost_opportunity_rate"),
        "days_with_data",
        "weekend_days",
    )
    final = rated.select(
        "*",
        aac_status(F.col("monthly_completion_rate"), params).alias("aac_performance_status"),
        loss_status(F.col("monthly_lost_opportunity_rate"), params).alias("lost_opportunity_status"),
        *_month_over_month(w),
    )
    return final.select("*", *_mom_changes())
