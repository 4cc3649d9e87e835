"""Dimensions (#5-9): the date spine and the distinct entity dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.calendar import iso_day_of_week, iso_week, month_start, weekend_int, year_start

NO_DATES_MESSAGE = "the date spine needs at least one dated claim, available or attested row"


def date_bounds(*dated: tuple[DataFrame, str]) -> DataFrame:
    """One row (lo, hi): min and max over several date columns, nulls skipped.

    Each source is reduced to its own bounds first (over a ``footer_scan`` of
    Parquet files by their footers alone, else by a partial aggregate), so a row
    for each source meets the others and nothing is collected to the driver.
    """
    bounds = [df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")) for df, col in dated]
    return reduce(DataFrame.unionByName, bounds).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def date_spine(available: DataFrame, attested: DataFrame, claims: DataFrame) -> DataFrame:
    """#5: every day from the first to the last date in the three sources, inclusive."""
    bounds = date_bounds((available, "date_day"), (attested, "date_day"), (claims, "awv_date_of_service"))
    lo = F.when(F.col("lo").isNull(), F.raise_error(F.lit(NO_DATES_MESSAGE))).otherwise(F.col("lo"))
    days = bounds.select(F.explode(F.sequence(lo, F.col("hi"))).alias("date_day"))
    d = F.col("date_day")
    return days.select(
        d.alias("date_day"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        month_start(d).alias("date_month"),
        year_start(d).alias("date_year"),
        iso_week(d).alias("week_number"),
        iso_day_of_week(d).alias("day_of_week"),
        weekend_int(d).alias("is_weekend"),
    )


def distinct_dim(df: DataFrame, *cols: str) -> DataFrame:
    """SELECT DISTINCT cols (a partial+final hash aggregate)."""
    return df.select(*cols).distinct()


def dim_medical_group(pmg: DataFrame) -> DataFrame:
    return distinct_dim(pmg, "medical_group_id", "medical_group_name")


def dim_medical_group_plan(pmg: DataFrame) -> DataFrame:
    return distinct_dim(pmg, "medical_group_id", "plan_id", "medical_group_name", "plan_name")


def dim_plan(pmg: DataFrame) -> DataFrame:
    return distinct_dim(pmg, "plan_id", "plan_name")


def dim_patient(claims: DataFrame) -> DataFrame:
    return distinct_dim(claims, "patient_id")
