"""Rates, guards and performance tiers shared by the KPI models."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from kpiloom import params as P


def safe_rate(numerator: Column, denominator: Column, scale: int | None = None) -> Column:
    """``numerator / denominator`` as DOUBLE when the denominator is > 0, else 0.

    ANSI mode raises on division by zero, so the guard is required, not
    cosmetic.  ``scale`` optionally rounds like the warehouse's integer division.
    """
    rate = numerator.cast("double") / denominator.cast("double")
    if scale is not None:
        rate = F.round(rate, scale)
    return F.when(denominator > 0, rate).otherwise(F.lit(0.0))


def non_negative(value: Column) -> Column:
    """``greatest(value, 0)`` that keeps a null input null.

    Spark's ``greatest`` skips nulls (would give 0); the warehouse returns null.
    """
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0)))


def target_gap(population: Column, achieved: Column, target: Decimal = P.AWV_TARGET) -> Column:
    """``greatest(0, ceil(population * target) - achieved)`` with exact decimal maths."""
    needed = F.ceil(population * F.lit(target))
    return F.greatest(F.lit(0), needed - achieved).cast("long")


def shortfall(population: Column, achieved: Column) -> Column:
    """``greatest(0, population - achieved)``."""
    return F.greatest(F.lit(0), population - achieved).cast("long")


def aac_status(rate: Column, params: P.KpiParams) -> Column:
    return (F.when(rate >= F.lit(params.aac_meeting_target), F.lit(P.LABEL_MEETING_TARGET))
            .when(rate >= F.lit(params.aac_below_target), F.lit(P.LABEL_BELOW_TARGET))
            .otherwise(F.lit(P.LABEL_SIGNIFICANTLY_BELOW)))


def loss_status(rate: Column, params: P.KpiParams) -> Column:
    return (F.when(rate <= F.lit(params.loss_low), F.lit(P.LABEL_LOW_LOSS))
            .when(rate <= F.lit(params.loss_moderate), F.lit(P.LABEL_MODERATE_LOSS))
            .otherwise(F.lit(P.LABEL_HIGH_LOSS)))


def awv_status(population: Column, achieved: Column, params: P.KpiParams) -> Column:
    """'Missing Data' without population, else 'Good' / 'Needs Improvement' at the target."""
    rate = achieved.cast("double") / population.cast("double")
    return (F.when(population <= 0, F.lit(P.LABEL_MISSING_DATA))
            .when(rate >= F.lit(params.awv_target), F.lit(P.LABEL_GOOD))
            .when(rate < F.lit(params.awv_target), F.lit(P.LABEL_NEEDS_IMPROVEMENT))
            .otherwise(F.lit(P.LABEL_MISSING_DATA)))


def running(col: str | Column, window) -> Column:
    """Running sum over ``window`` (ROWS UNBOUNDED PRECEDING .. CURRENT ROW)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
