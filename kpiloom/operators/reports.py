"""Reporting marts (#20-23): an (entity x period) scaffold with KPIs attached.

The scaffold makes missing periods visible as rows.  Periods are those of the
date spine: the spine is contiguous, so its distinct months are exactly the
months between its first and last ``date_month``.  Each dimension row
therefore generates its own periods with ``explode(sequence(lo, hi))``, where
``lo``/``hi`` are scalar subqueries over the spine (computed once) — a
generator, not a cross join, and the scaffold size is |dim| x |periods| by
construction.  KPI summaries are attached with equi left joins; the planner
picks broadcast or shuffle from runtime sizes (AQE).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.params import LABEL_MISSING_DATA, KpiParams


def _periods(dim: DataFrame, spine: DataFrame, period: str, step: str) -> DataFrame:
    """dim x every ``period`` of the spine; its bounds are one scalar subquery."""
    bounds = spine.agg(F.struct(F.min(period).alias("lo"), F.max(period).alias("hi")).alias("b")).scalar()
    return (dim.select("*", bounds.alias("__bounds"))
            .select(*dim.columns, F.explode(F.sequence(F.col("__bounds.lo"), F.col("__bounds.hi"), F.expr(f"INTERVAL 1 {step}")))
                    .alias(period)))


def month_scaffold(dim: DataFrame, spine: DataFrame) -> DataFrame:
    """dim x every month of the spine, as column ``date_month``."""
    return _periods(dim, spine, "date_month", "MONTH")


def year_scaffold(dim: DataFrame, spine: DataFrame, year: int) -> DataFrame:
    """dim x the spine's ``date_year`` values restricted to ``year`` (0 or 1 period)."""
    return _periods(dim, spine.filter(F.col("year") == year), "date_year", "YEAR")


def _attach(rows: DataFrame, kpis: DataFrame, keys: list[str]) -> DataFrame:
    """Equi left join on ``keys``; a null key meets nothing.

    The nulls are named on the left side only.  With plain equality the optimizer
    takes rows with null keys out of ``kpis``, down to the daily rows, which then are no
    longer those that its global maximum is taken from and are computed twice.
    """
    other = kpis.withColumnsRenamed({k: f"__{k}" for k in keys})
    same = reduce(Column.__and__, [rows[k].isNotNull() & rows[k].eqNullSafe(other[f"__{k}"]) for k in keys])
    return rows.join(other, same, "left").drop(*[f"__{k}" for k in keys])


def _zero(name: str, alias: str | None = None) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(alias or name)


def _missing(name: str, alias: str) -> Column:
    return F.coalesce(F.col(name), F.lit(LABEL_MISSING_DATA)).alias(alias)


def group_annual_report(dim_mg: DataFrame, spine: DataFrame, mg_annual: DataFrame,
                        params: KpiParams = KpiParams()) -> DataFrame:
    """#20: group x report year with the annual AWV columns (no fill)."""
    scaffold = year_scaffold(dim_mg, spine, params.report_year)
    joined = scaffold.join(mg_annual, ["medical_group_id", "date_year"], "left")
    return joined.select(
        "medical_group_id", "date_year", "medical_group_name",
        "visit_count", "patient_count", "visit_target_gap", "remaining_patients_without_visit",
        "awv_rate", "awv_performance_status",
    )


def _monthly_measures(prefix: str, with_net_new: bool) -> list[Column]:
    cols = [
        _zero("actions_available_start_month"),
        _zero("actions_available_end_of_month"),
        _zero("monthly_net_change_of_actions"),
    ]
    if with_net_new:
        cols.append(_zero("monthly_net_new_available_actions"))
    cols += [
        _zero("days_with_data"),
        _zero("weekend_days"),
        _zero("monthly_actions_completed"),
        _zero("monthly_actions_became_ineligible"),
        _zero("visit_count_per_month"),
        _zero("total_patient_count"),
        _zero("monthly_running_total_actions_completed"),
        _zero("monthly_running_total_actions_became_ineligible"),
        _zero("cumulative_monthly_visits"),
        _zero("visit_target_gap"),
        _zero("remaining_patients_without_visit"),
        _zero("monthly_completion_rate"),
        _zero("running_monthly_completion_rate"),
        _zero("awv_cumulative_monthly_visit_rate", "cumulative_monthly_awv_visit_rate"),
        _zero("monthly_lost_opportunity_rate"),
        _zero("running_monthly_lost_opportunity_rate"),
        _missing("monthly_awv_performance_status", f"{prefix}cumulative_monthly_awv_performance_status"),
        _missing("lost_opportunity_status", f"{prefix}lost_opportunity_status"),
        _missing("aac_performance_status", f"{prefix}aac_performance_status"),
        F.col("monthly_completion_rate_prev_month"),
        F.col("monthly_lost_opportunity_rate_prev_month"),
        F.col("monthly_completion_rate_change_mom"),
        F.col("lost_opportunity_rate_change_mom"),
    ]
    return cols


def group_monthly_report(dim_mg: DataFrame, spine: DataFrame, mg_actions: DataFrame,
                         mg_visits: DataFrame) -> DataFrame:
    """#21: group x month; AAC and AWV measures 0-filled, statuses 'Missing Data'."""
    keys = ["medical_group_id", "date_month"]
    scaffold = month_scaffold(dim_mg, spine)
    joined = (scaffold.join(mg_actions, keys, "left")
              .join(mg_visits, keys, "left"))
    return joined.select("medical_group_id", "medical_group_name", "date_month",
                         *_monthly_measures("", with_net_new=True))


def plan_annual_report(dim_mgp: DataFrame, spine: DataFrame, mgp_annual: DataFrame,
                       mg_annual: DataFrame, params: KpiParams = KpiParams()) -> DataFrame:
    """#22: group-plan x report year, plan and group AWV side by side.

    The group-level row is attached on the *plan row's* year as well, so it is
    null whenever the plan has no row for the year; ``date_year`` is the plan
    row's too (null then), as in the reference.
    """
    scaffold = year_scaffold(dim_mgp, spine, params.report_year).withColumnRenamed("date_year", "period")
    plan = mgp_annual.select(
        "medical_group_id", "plan_id", "date_year", "visit_count", "patient_count",
        "visit_target_gap", "remaining_patients_without_visit",
        F.col("awv_rate").alias("mgp_awv_rate"),
        F.col("awv_performance_status").alias("mgp_awv_performance_status"))
    group = mg_annual.select(
        F.col("medical_group_id").alias("g_id"), F.col("date_year").alias("g_year"),
        F.col("awv_rate").alias("mg_awv_rate"),
        F.col("awv_performance_status").alias("mg_awv_performance_status"))
    with_plan = scaffold.join(
        plan,
        (scaffold["medical_group_id"] == plan["medical_group_id"]) & (scaffold["plan_id"] == plan["plan_id"])
        & (scaffold["period"] == plan["date_year"]),
        "left").select(scaffold["*"], *[plan[c] for c in plan.columns if c not in ("medical_group_id", "plan_id")])
    with_group = with_plan.join(
        group,
        (F.col("date_year") == F.col("g_year")) & (F.col("medical_group_id") == F.col("g_id"))
        & (F.col("period") == F.col("g_year")),
        "left")
    return with_group.select(
        "medical_group_id", "plan_id", "date_year", "medical_group_name", "plan_name",
        "visit_count", "patient_count", "visit_target_gap", "remaining_patients_without_visit",
        "mgp_awv_rate", "mgp_awv_performance_status", "mg_awv_rate", "mg_awv_performance_status",
    )


def plan_monthly_report(dim_mgp: DataFrame, spine: DataFrame, mgp_actions: DataFrame,
                        mgp_visits: DataFrame) -> DataFrame:
    """#23: group-plan x month; like #21 with 'mg_' status names and no net-new column."""
    keys = ["medical_group_id", "plan_id", "date_month"]
    scaffold = month_scaffold(dim_mgp, spine)
    joined = _attach(_attach(scaffold, mgp_actions, keys), mgp_visits, keys)
    return joined.select("medical_group_id", "medical_group_name", "plan_id", "plan_name", "date_month",
                         *_monthly_measures("mg_", with_net_new=False))
