"""Calendar helpers, all built-in (codegen'd) Spark expressions.

Spark numbers days of week 1=Sunday..7=Saturday (``dayofweek``) and
0=Monday..6=Sunday (``weekday``); the helpers below give the ISO and the
weekend semantics the models need so no caller has to remember which.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_day_of_week(day: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return (F.weekday(day) + 1).cast("int")


def iso_week(day: Column) -> Column:
    """ISO-8601 week number (2024-12-30 is week 1)."""
    return F.weekofyear(day).cast("int")


def weekend_flag(day: Column) -> Column:
    """Boolean: Saturday or Sunday; a null day gives False (CASE ... ELSE FALSE)."""
    return F.when(F.dayofweek(day).isin(1, 7), F.lit(True)).otherwise(F.lit(False))


def weekend_int(day: Column) -> Column:
    """Integer 1 for Saturday/Sunday else 0 (the date dimension's flavour)."""
    return F.when(iso_day_of_week(day).isin(6, 7), F.lit(1)).otherwise(F.lit(0))


def month_start(day: Column) -> Column:
    """First day of the month as a DATE (``date_trunc`` would give a timestamp)."""
    return F.trunc(day, "MM")


def year_start(day: Column) -> Column:
    return F.trunc(day, "YEAR")
