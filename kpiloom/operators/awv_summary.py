"""Annual-wellness-visit summaries (#16/#18 annual, #17/#19 monthly).

``claims`` is the table that grows with the patient population.  It is read once:
``visit_rollup`` reduces it with a partial and a final hash aggregate to one row
per (group, plan, month), and all four models are rolled up from those rows, the
group level from the plan level and years from months.  So a hot medical group
costs one row per map task, plan and month, not a hot shuffle partition.

Kept reference semantics: patients are counted as claim *rows* (not
distinct); undated claims fall into the year of ``undated_claim_date``; the
monthly cumulative count runs over months that have visits and does not reset
at a year boundary; an entity without any dated claim has no monthly row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions.calendar import month_start, year_start
from kpiloom.functions.metrics import awv_status, running, safe_rate, shortfall, target_gap
from kpiloom.params import KpiParams

GROUP_KEYS = ["medical_group_id"]
PLAN_KEYS = ["medical_group_id", "plan_id"]


def visit_rollup(claim_fact: DataFrame) -> DataFrame:
    """Claims per (group, plan, month of the visit): rows, rows with a patient, visits; null month: undated."""
    return claim_fact.groupBy(*PLAN_KEYS, month_start(F.col("date_day")).alias("date_month")).agg(
        F.count(F.lit(1)).alias("claim_rows"),
        F.count("patient_id").alias("patient_rows"),
        F.sum("had_visit").cast("long").alias("visits"),
    )


def annual_visit_summary(rollup: DataFrame, keys: list[str],
                         params: KpiParams = KpiParams()) -> DataFrame:
    """Visit rate per (entity, year); keys = GROUP_KEYS (#16) or PLAN_KEYS (#18)."""
    year = year_start(F.coalesce(F.col("date_month"), F.lit(params.undated_claim_date)))
    agg = rollup.groupBy(*keys, year.alias("date_year")).agg(
        F.sum("patient_rows").alias("patient_count"),
        F.sum("visits").alias("visit_count"),
    )
    patients, visits = F.col("patient_count"), F.col("visit_count")
    return agg.select(
        *keys, "date_year", "visit_count", "patient_count",
        safe_rate(visits, patients).alias("awv_rate"),
        awv_status(patients, visits, params).alias("awv_performance_status"),
        target_gap(patients, visits, params.awv_target).alias("visit_target_gap"),
        shortfall(patients, visits).alias("remaining_patients_without_visit"),
    )


def monthly_visit_summary(rollup: DataFrame, keys: list[str],
                          params: KpiParams = KpiParams()) -> DataFrame:
    """Cumulative visit rate per (entity, month); GROUP_KEYS (#17) or PLAN_KEYS (#19).

    The roll-up serves both the all-time patient total (all rows, dated or not)
    and the visits per month: the per-(entity, month) counts are summed over the
    entity by a window (at most one row per month + one for undated claims), then
    undated rows are dropped.  Same rows as the reference's two aggregates + inner
    join.  At plan level the roll-up has the rows already.
    """
    per_month = rollup.withColumnRenamed("visits", "visit_count_per_month")
    if keys != PLAN_KEYS:
        per_month = rollup.groupBy(*keys, "date_month").agg(
            F.sum("claim_rows").alias("claim_rows"), F.sum("visits").alias("visit_count_per_month"))
    entity = Window.partitionBy(*keys)
    with_total = per_month.select("*", F.sum("claim_rows").over(entity).alias("total_patient_count"))
    dated = with_total.filter(F.col("date_month").isNotNull())
    ordered = Window.partitionBy(*keys).orderBy("date_month")
    cumulative = dated.select(
        *keys, "date_month", "visit_count_per_month",
        running("visit_count_per_month", ordered).alias("cumulative_monthly_visits"),
        "total_patient_count",
    )
    total, visits = F.col("total_patient_count"), F.col("cumulative_monthly_visits")
    return cumulative.select(
        *keys, "date_month", "visit_count_per_month", "cumulative_monthly_visits", "total_patient_count",
        safe_rate(visits, total).alias("awv_cumulative_monthly_visit_rate"),
        awv_status(total, visits, params).alias("monthly_awv_performance_status"),
        target_gap(total, visits, params.awv_target).alias("visit_target_gap"),
        shortfall(total, visits).alias("remaining_patients_without_visit"),
    )
