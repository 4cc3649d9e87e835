"""Staging (#1-4): type the raw tables; nothing else.

Ids become LongType (a warehouse ``integer`` is 38 digits; Spark ``int`` would
overflow under ANSI), ``patient_id`` becomes a string, dates become DateType.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def whole_number(df: DataFrame, name: str) -> Column:
    """Cast to BIGINT; fractional input is rounded first (the warehouse rounds, Spark truncates)."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
        c = F.round(c)
    return c.cast("long").alias(name)


def as_date(name: str) -> Column:
    """DATE from a date, timestamp(_ntz) or ISO string column."""
    return F.col(name).cast("date").alias(name)


def stage_plan_medical_group(raw: DataFrame) -> DataFrame:
    return raw.select(
        whole_number(raw, "medical_group_id"),
        whole_number(raw, "plan_id"),
        F.trim(F.col("medical_group_name")).alias("medical_group_name"),
        F.trim(F.col("plan_name")).alias("plan_name"),
    )


def stage_claims(raw: DataFrame) -> DataFrame:
    return raw.select(
        whole_number(raw, "medical_group_id"),
        F.col("patient_id").cast("string").alias("patient_id"),
        whole_number(raw, "plan_id"),
        as_date("awv_date_of_service"),  # null = no visit in claims yet
    )


def stage_actions_available(raw: DataFrame) -> DataFrame:
    return raw.select(
        as_date("date_day"),
        whole_number(raw, "medical_group_id"),
        whole_number(raw, "plan_id"),
        whole_number(raw, "count_actions_available"),
    )


def stage_actions_attested(raw: DataFrame) -> DataFrame:
    return raw.select(
        as_date("date_day"),
        whole_number(raw, "medical_group_id"),
        whole_number(raw, "plan_id"),
        whole_number(raw, "count_actions_attested_as_complete"),
    )
